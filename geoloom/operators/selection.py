"""Choosing what to process and shaping the outcome: years and layers, locations, record schemas, factors of variants, ordered outputs."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import predicates
from .relational import first_per_key, last_per_key


def chosen_years(df: DataFrame, keys: list[str], year: str, wanted: tuple[int, ...] = (), every: bool = False) -> DataFrame:
    """Rows of the wanted years; if none is named, of all years or else of each key's latest."""
    if wanted:
        return df.where(F.col(year).isin(*wanted))
    if every:
        return df
    latest = df.groupBy(*keys).agg(F.max(year).alias(year))
    return df.join(latest, [*keys, year], "left_semi")


def selected_layers(plan: DataFrame, wanted_years: tuple[int, ...] = (), variables: tuple[str, ...] = (), every_year: bool = False, every_variable: bool = False, offset: int = 0, limit: int | None = None) -> DataFrame:
    """(dataset, year, variable) of plan (dataset, year, place, variable), in order of dataset, year and place: of the chosen years the named variables that exist (all named ones where none does), else all or the first by place."""
    rows = chosen_years(plan, ["dataset"], "year", wanted_years, every_year)
    if variables:
        names = F.array(*map(F.lit, sorted(variables)))
        sets = rows.groupBy("dataset", "year").agg(F.collect_set("variable").alias("_have"))
        some = F.filter(names, lambda v: F.array_contains("_have", v))
        out = sets.select("dataset", "year", F.posexplode(F.when(F.size(some) > 0, some).otherwise(names)).alias("place", "variable"))
    elif every_variable:
        out = rows
    else:
        out = first_per_key(rows, ["dataset", "year"], F.col("place"))
    ordered = out.select("dataset", "year", "place", "variable").orderBy("dataset", "year", "place").drop("place")
    ordered = ordered.offset(offset) if offset else ordered
    return ordered.limit(limit) if limit else ordered


def locations(df: DataFrame, key: str, order: str, x: Column, y: Column, province: Column, code: str, box: tuple[float, float, float, float]) -> DataFrame:
    """The last row by order of each key that is not blank, of a province's rows with finite coordinates in a box."""
    kept = df.where((province == code) & predicates.finite(x, y) & predicates.in_box(x, y, *box) & (F.trim(key) != ""))
    return last_per_key(kept, [key], order)


def resolved_sources(files: DataFrame, wanted: DataFrame) -> DataFrame:
    """(dataset, year, path, is_folder, columns): for each wanted (dataset, year) its folder, or else its first archive by path, whose first column is the key column of that year. files: dataset, year, path, is_folder, header (an array)."""
    fits = files.where(F.get("header", F.lit(0)) == F.concat(F.lit("postalcode"), F.lpad((F.col("year") % 100).cast("string"), 2, "0")))
    best = fits.groupBy("dataset", "year").agg(F.min_by(F.struct("path", "is_folder", "header"), F.struct(~F.col("is_folder"), "path")).alias("b"))
    return wanted.join(best, ["dataset", "year"]).select("dataset", "year", "b.path", "b.is_folder", F.slice("b.header", 2, F.greatest(F.size("b.header") - 1, F.lit(1))).alias("columns"))


def unified(sources: list[tuple[DataFrame, dict[str, Column]]], columns: list[str]) -> DataFrame:
    """Records of several sources under one list of columns; what a source lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (df.select(*(c.alias(k) for k, c in own.items())) for df, own in sources)).select(*columns)


def kept_properties(columns: list[str], keep: list[str]) -> Column:
    """The listed columns that exist, as JSON text without nulls."""
    return F.to_json(F.struct(*(F.col(f"`{c}`").alias(c) for c in keep if c in columns)))


def row_id(prefix: str, *parts: Column, index: Column | None = None) -> Column:
    """An id of the parts; where one is null, of the row's index."""
    own = F.concat_ws("-", F.lit(prefix), *(p.cast("string") for p in parts))
    known = reduce(lambda a, b: a & b, (p.isNotNull() for p in parts))
    return F.when(known, own).otherwise(F.concat_ws("-", F.lit(prefix), index.cast("string")) if index is not None else F.lit(None))


def public_url(base: str, *parts: Column) -> Column:
    """An address below base of the last parts of paths."""
    return F.concat_ws("/", F.lit(base.rstrip("/")), *(F.element_at(F.split(p, "/"), -1) for p in parts))


def varied_factors(factors: DataFrame, variants: DataFrame) -> DataFrame:
    """Factors of each variant, with all their columns and the variant's buffer. factors: ref, description, layer, values and more; variants: variant, drop_refs, drop_descriptions, drop_layers, narrow (a map of ref to the values that stay), buffer. A factor that keeps none of its values goes."""
    pairs = factors.crossJoin(F.broadcast(variants))  # literals both, some hundred pairs
    kept = pairs.where(~F.array_contains("drop_refs", F.col("ref")) & ~F.array_contains("drop_descriptions", F.col("description")) & ~F.array_contains("drop_layers", F.col("layer")))
    narrow = F.try_element_at("narrow", F.col("ref"))
    values = F.when(narrow.isNull(), F.col("values")).otherwise(F.array_intersect("values", narrow))
    rest = [c for c in factors.columns if c != "values"]
    narrowed = kept.select("variant", "buffer", *rest, values.alias("values"), narrow.isNotNull().alias("_narrowed"))
    return narrowed.where(~F.col("_narrowed") | (F.size("values") > 0)).drop("_narrowed")


def scored_distances(factors: DataFrame) -> DataFrame:
    """A row for each distance at which a factor scores: those of its own that score above 0 where it is of proximity, else its variant's buffer."""
    near = F.filter("distances", lambda d: d["score"] > 0)
    own = F.when(F.col("mode") == "proximity", near).otherwise(F.array(F.struct(F.col("buffer").alias("distance"), F.col("score").alias("score"))))
    return factors.withColumn("_d", F.explode(own)).drop("distances", "score").select("*", "_d.*").drop("_d")


def feature_totals(factors: DataFrame, features: DataFrame) -> DataFrame:
    """factors with the number of features (layer, value) that each takes, of its layer and, where it names values, with one of them, and their score in all. Features are counted by layer and value before they meet factors."""
    counts = features.groupBy("layer", "value").agg(F.count("*").alias("_n"))
    takes = (F.size("values") == 0) | F.coalesce(F.array_contains("values", F.col("value")), F.lit(False))
    joined = factors.join(counts, "layer", "left").withColumn("_n", F.when(takes, F.col("_n")))
    keys = [c for c in factors.columns if c != "narrow"]
    return joined.groupBy(*keys).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("features")).withColumn("total", F.col("score") * F.col("features"))


def labelled_variables(variables: DataFrame, metadata: DataFrame, headers: DataFrame) -> DataFrame:
    """(id, label, groups) of the variables (id, category) that a table's headers (id, label) have: the header's label, else the metadata's; the sorted categories that list the variable."""
    listed = variables.groupBy("id").agg(F.array_sort(F.collect_set("category")).alias("groups"))
    known = headers.select("id", F.col("label").alias("_header")).dropDuplicates(["id"])
    told = metadata.select("id", F.col("label").alias("_told")).dropDuplicates(["id"])
    return listed.join(known, "id").join(told, "id", "left").select("id", F.coalesce(F.nullif(F.trim("_header"), F.lit("")), "_told").alias("label"), "groups")


def weighted_counts(df: DataFrame, key: str, weight: Column, order: str) -> DataFrame:
    """(key, n) sums of weights, most first, ties by the first row of each."""
    sums = df.groupBy(key).agg(F.sum(weight).alias("n"), F.min(order).alias("_first"))
    return sums.orderBy(F.desc("n"), "_first").drop("_first")


def bucket_counts(df: DataFrame, bucket: Column, conditions: dict[str, Column]) -> DataFrame:
    """Rows of each bucket, and how many of them fulfil each condition."""
    return df.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("records"), *(F.count_if(c).alias(k) for k, c in conditions.items()))


def indexed(df: DataFrame, *order: Column | str, name: str = "index") -> DataFrame:
    """df with each row's number, from 0, in an order: numbers within sorted ranges after the rows of the ranges before, so no task sees all rows."""
    ranged = df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id())
    ranged = ranged.checkpoint() if df.sparkSession.sparkContext.getCheckpointDir() else ranged.persist()
    sizes = ranged.groupBy("_p").agg(F.count("*").alias("_size"))
    before = sizes.select("_p", (F.sum("_size").over(Window.orderBy("_p")) - F.col("_size")).alias("_before"))  # a row for each range
    place = F.row_number().over(Window.partitionBy("_p").orderBy(*order)) - 1
    return ranged.withColumn("_place", place).join(before, "_p").withColumn(name, F.col("_before") + F.col("_place")).drop("_p", "_place", "_before")


def ordinal(c: Column, order: list[str]) -> Column:
    """The place of a value in a list, after all others if it is not there."""
    return F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, order)), c), F.lit(0)), F.lit(99))


def retry_set(failures: DataFrame, keys: list[str]) -> DataFrame:
    """What failed, once each, without what lacks a key."""
    return failures.dropna(subset=keys).select(*keys).distinct()


def split_by_outcome(df: DataFrame, attempt: Callable[[], Column], problem: str) -> tuple[DataFrame, DataFrame]:
    """(rows for which an expression of try_ functions has a value, the others with an error text): a bad row is a row, not a failed job."""
    tried = df.withColumn("result", attempt())
    return tried.where(F.col("result").isNotNull()), tried.where(F.col("result").isNull()).drop("result").withColumn("error", F.lit(problem))
