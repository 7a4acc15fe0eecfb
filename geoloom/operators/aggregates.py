"""Grid and boundary statistics, scores, bands, roll-ups and order-dependent aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.parse import round_even, round_up

#: Thresholds of the five score bands; shares at which population density is cut into quintiles.
BANDS = (27.4, 45.7, 63.9, 82.2)
QUINTILES = (0.2, 0.4, 0.6, 0.8)


def value_stats(value: str = "value", digits: int = 6) -> list[Column]:
    """count, mean (sum by count, ties to even), min and max of the values that are not null."""
    v = F.col(value)
    return [F.count(v).alias("count"), round_even(F.sum(v) / F.count(v), digits).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max")]


def grid_stats(df: DataFrame, x: str, y: str, value: str, origin: tuple[float, float], steps: tuple[float, float], by: tuple[str, ...] = ()) -> DataFrame:
    """Statistics of each grid cell (ix, iy), and of each further key."""
    cells = df.where(F.col(value).isNotNull()).withColumn("ix", geo.cell(F.col(x), origin[0], steps[0])).withColumn("iy", geo.cell(F.col(y), origin[1], steps[1]))
    return cells.groupBy(*by, "ix", "iy").agg(*value_stats(value))


def boundary_stats(hits: DataFrame, boundary: str, values: list[str]) -> DataFrame:
    """(boundary, variable, count, mean, min, max) over joined points; variables and boundaries without values are left out."""
    long = hits.unpivot([boundary], values, "variable", "value").where(F.col("value").isNotNull() & ~F.isnan("value"))
    return long.groupBy(boundary, "variable").agg(*value_stats())


def variable_stats(cells: DataFrame) -> DataFrame:
    """Totals of each variable from the statistics of its cells."""
    return cells.groupBy("variable").agg(F.sum("count").alias("count"), F.min("min").alias("min"), F.max("max").alias("max"), F.count("*").alias("cells"))


def density(value: Column, area: Column) -> Column:
    """Per unit of area; an area that is null or not above zero counts as one."""
    return value / F.when(area > 0, area).otherwise(F.lit(1.0))


def min_max_scores(df: DataFrame, columns: list[str], inverted: tuple[str, ...] = ()) -> DataFrame:
    """Each column scaled to 0..100 over all rows as <column>_score; all equal give 50, what is not finite 0. The extremes are one small row that every task gets."""
    finite = lambda c: F.when(~F.isnan(c) & (F.abs(F.col(c)) != float("inf")), F.col(c))
    ends = df.agg(*(f(finite(c)).alias(f"_{n}_{c}") for c in columns for f, n in ((F.min, "low"), (F.max, "high"))))
    joined = df.crossJoin(F.broadcast(ends))  # one row

    def score(c: str) -> Column:
        low, high = F.col(f"_low_{c}"), F.col(f"_high_{c}")
        share = (F.col(c) - low) / F.when(high > low, high - low) * 100
        return F.when(finite(c).isNull(), 0.0).when(high == low, 50.0).otherwise(100 - share if c in inverted else share)

    return joined.select(*df.columns, *(score(c).alias(f"{c}_score") for c in columns))


def weighted_score(weights: dict[str, float], suffix: str = "_score") -> Column:
    """The weighted mean of score columns, one decimal, ties up."""
    total = sum((F.col(f"{c}{suffix}") * w for c, w in weights.items()), F.lit(0.0))
    return round_up(total / sum(weights.values()), 1)


def variant_scores(df: DataFrame, key: str, variants: dict[str, dict[str, float]]) -> DataFrame:
    return df.select(key, *(weighted_score(w).alias(v) for v, w in variants.items()))


def ranked_counts(counts: DataFrame, value: str) -> DataFrame:
    """(value, _upto): of (value, _n), how many rows there are up to each value, by running sums within sorted ranges and a table with a row for each range."""
    ranged = counts.repartitionByRange(value).withColumn("_p", F.spark_partition_id())
    ranged = ranged.checkpoint() if counts.sparkSession.sparkContext.getCheckpointDir() else ranged.persist()
    sizes = ranged.groupBy("_p").agg(F.sum("_n").alias("_size"))
    before = sizes.withColumn("_before", F.sum("_size").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)))  # a row for each partition
    within = F.sum("_n").over(Window.partitionBy("_p").orderBy(value))
    return ranged.join(before.select("_p", F.coalesce("_before", F.lit(0)).alias("_before")), "_p").select(value, (F.col("_before") + within).alias("_upto"))


def quantile_bands(df: DataFrame, value: str, shares: tuple[float, ...] = QUINTILES, band: str = "band") -> DataFrame:
    """A band from 1 on by nearest-rank cuts of the positive values: the cut of share q is the value at place floor(q * n) - 1, at least the first; what is not positive is in band 1.

    The cuts come from exact counts of distinct values, a running sum over their sorted ranges, not from one sorted task.
    """
    positive = df.where(F.col(value) > 0).groupBy(value).agg(F.count("*").alias("_n"))
    places = ranked_counts(positive, value).withColumnRenamed(value, "_v")
    total = F.broadcast(positive.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_total")))
    place = lambda q: F.greatest(F.lit(0), F.least(F.floor(F.col("_total") * q) - 1, F.col("_total") - 1))
    cuts = places.crossJoin(total).agg(*(F.min(F.when(F.col("_upto") > place(q), F.col("_v"))).alias(f"_cut_{i}") for i, q in enumerate(shares)))
    out = df.crossJoin(F.broadcast(cuts))
    ladder = F.when(F.col(value).isNull() | ~(F.col(value) > 0), 1)
    for i in range(len(shares)):
        ladder = ladder.when(F.col(value) <= F.col(f"_cut_{i}"), i + 1)
    return out.select(*df.columns, ladder.otherwise(len(shares) + 1).alias(band))


def score_band(value: Column, cuts: tuple[float, ...] = BANDS) -> Column:
    """1 to 5 by thresholds, each the least value of the next band; null, which is outside, is 0."""
    out = F.when(value.isNull(), 0)
    for i, c in enumerate(cuts, 1):
        out = out.when(value < c, i)
    return out.otherwise(len(cuts) + 1)


def band_histogram(df: DataFrame, band: str, bands: int = 5) -> DataFrame:
    """Rows of each band from 0 on, with those that are empty."""
    return df.sparkSession.range(bands + 1).select(F.col("id").cast("int").alias(band)).join(df.groupBy(band).agg(F.count("*").alias("n")), band, "left").select(band, F.coalesce("n", F.lit(0)).alias("n"))


def factor_mask_scores(cells: DataFrame, factor: tuple[str, ...] = ("factor", "distance"), score: str = "score") -> DataFrame:
    """(row, col, score): each factor and distance counts once in a cell, however many shapes reach it."""
    return cells.groupBy("row", "col", *factor).agg(F.max(score).alias(score)).groupBy("row", "col").agg(F.sum(score).alias(score))


def run_lengths(df: DataFrame, order: str, value: str, by: tuple[str, ...] = ()) -> DataFrame:
    """(start, value, run) of runs of equal values by a dense order without gaps: a row begins a run if the row before it differs, found by an equi-join, so that no task sorts all rows."""
    keys = list(by)
    before = df.select(*keys, (F.col(order) + 1).alias(order), F.col(value).alias("_before"), F.lit(True).alias("_has"))
    starts = df.join(before, [*keys, order], "left").where(F.col("_has").isNull() | ~F.col(value).eqNullSafe(F.col("_before"))).select(*keys, order, value)
    spark = df.sparkSession
    ranged = starts.repartitionByRange(*keys, order).sortWithinPartitions(*keys, order).withColumn("_p", F.spark_partition_id())
    ranged = ranged.checkpoint() if spark.sparkContext.getCheckpointDir() else ranged.persist()
    heads = ranged.groupBy("_p", *keys).agg(F.min(order).alias("_head"))
    # The next start in the same range, else the first one of the next range that has the key, else the end.
    following = F.lead(order).over(Window.partitionBy("_p", *keys).orderBy(order))
    next_head = heads.select(*keys, "_p", F.lead("_head").over(Window.partitionBy(*keys).orderBy("_p")).alias("_next")) if keys else heads.select("_p", F.lead("_head").over(Window.orderBy("_p")).alias("_next"))
    ends = df.groupBy(*keys).agg((F.max(order) + 1).alias("_end"))
    joined = ranged.withColumn("_following", following).join(next_head, ["_p", *keys])
    joined = joined.join(ends, keys) if keys else joined.crossJoin(F.broadcast(ends))
    return joined.select(*keys, F.col(order).alias("start"), value, (F.coalesce("_following", "_next", "_end") - F.col(order)).alias("run"))


def collapsed(df: DataFrame, by: list[str], order: str, values: list[str]) -> DataFrame:
    """Rows whose values equal those of the row before them in their group are dropped."""
    w = Window.partitionBy(*by).orderBy(order)
    same = F.coalesce(F.lag(F.struct(*values)).over(w) == F.struct(*values), F.lit(False))
    return df.withColumn("_same", same).where(~F.col("_same")).drop("_same")


def segments(df: DataFrame, by: list[str], order: list[str], x: str, y: str) -> DataFrame:
    """Consecutive points of a line as (by, n, ax, ay, bx, by_)."""
    w = Window.partitionBy(*by).orderBy(*order)
    pairs = df.select(*by, F.row_number().over(w).alias("n"), F.col(x).alias("ax"), F.col(y).alias("ay"), F.lead(x).over(w).alias("bx"), F.lead(y).over(w).alias("by_"))
    return pairs.where(F.col("bx").isNotNull())


def edge_offsets(df: DataFrame, edge: list[str], route_order: list[Column], gap: float = 4.0) -> DataFrame:
    """Each route of an edge with the number of routes there and its offset, centred about 0; routes of an edge are few."""
    w = Window.partitionBy(*edge)
    ranked = df.withColumn("shared", F.count("*").over(w)).withColumn("place", F.row_number().over(w.orderBy(*route_order)) - 1)
    return ranked.withColumn("offset", F.when(F.col("shared") > 1, (F.col("place") - (F.col("shared") - 1) / 2) * gap).otherwise(0.0))


def numeric_first(c: Column) -> Column:
    """Sort key of route numbers: digits by value, all else as 9999."""
    return F.when(c.rlike("^[0-9]+$"), c.try_cast("int")).otherwise(9999)


def span_summary(df: DataFrame, key: str, seconds: Column, fallback: Column | None = None) -> DataFrame:
    """count, first and last second, and the hours between them (two decimals, ties to even) of each key; rows without a second are left out."""
    s = F.coalesce(seconds, fallback) if fallback is not None else seconds
    out = df.select(key, s.alias("_s")).where("_s is not null").groupBy(key).agg(F.count("*").alias("n"), F.min("_s").alias("first_s"), F.max("_s").alias("last_s"))
    return out.withColumn("span_hours", round_even(F.greatest(F.lit(0), F.col("last_s") - F.col("first_s")) / 3600, 2))


def sets_by(df: DataFrame, key: str, sets: list[str], first: str | None = None, order: str | None = None) -> DataFrame:
    """Sorted distinct values of columns in each key, and the first value of another by order."""
    extra = [F.min_by(first, order).alias(f"first_{first}")] if first else []
    return df.groupBy(key).agg(*(F.array_sort(F.collect_set(c)).alias(f"{c}_set") for c in sets), *extra)


def cumulative_buckets(df: DataFrame, distance: str, limits: tuple[int, ...], times: str | None = None) -> DataFrame:
    """One row: how many are within each limit, beyond the last, and known at all; a row counts as often as its column `times` says."""
    d, n = F.col(distance), F.col(times) if times else F.lit(1).cast("long")
    count = lambda condition: F.coalesce(F.sum(F.when(condition, n)), F.lit(0).cast("long"))
    return df.agg(*(count(d <= m).alias(f"within_{m}") for m in limits), count(d > limits[-1]).alias(f"over_{limits[-1]}"), count(d.isNotNull()).alias("known"))


def label_counts(df: DataFrame, labels: str, empty: str = "Unknown") -> DataFrame:
    """Rows of each label; rows without any count as one of `empty`."""
    some = F.when(F.size(F.coalesce(labels, F.array().cast("array<string>"))) > 0, F.col(labels)).otherwise(F.array(F.lit(empty)))
    return df.select(F.explode(some).alias("label")).groupBy("label").agg(F.count("*").alias("n"))


def hierarchy(df: DataFrame, levels: list[str], sums: list[str], area: str, population: str) -> DataFrame:
    """Sums of each level of nested keys (nulls as 0), its rows as `rows_n`, the number of keys it has as `level`, and people per area, from one pass over the rows. A key that is null itself is a key like others: levels are told by the grouping, not by nulls."""
    sets = [levels[: i + 1] for i in range(len(levels))]
    keyed = df.groupingSets(sets, *levels).agg(*(F.sum(F.coalesce(s, F.lit(0))).alias(s) for s in sums), F.count("*").alias("rows_n"), F.grouping_id().alias("_g"))
    # Each key that a set lacks is a bit of the grouping's number.
    depth = F.lit(len(levels)) - F.bit_count("_g")
    return keyed.withColumn("level", depth.cast("int")).drop("_g").withColumn("density", F.try_divide(F.col(population), F.nullif(F.col(area), F.lit(0))))


def distribution(df: DataFrame, value: str, shares: dict[str, float] = {"median": 0.5, "p90": 0.9}) -> DataFrame:  # noqa: B006
    """One row: n, mean, and exact, interpolated percentiles, from counts of distinct values over sorted ranges; no task sees more than its range."""
    v = F.col(value)
    base = df.where(v.isNotNull()).groupBy(value).agg(F.count("*").alias("_n"))
    totals = base.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n"), (F.sum(v * F.col("_n")) / F.sum("_n")).alias("mean"))
    places = ranked_counts(base, value)
    low = lambda q: F.floor((F.col("n") - 1) * q)
    at = lambda p: F.min(F.when(F.col("_upto") > p, v))
    found = places.crossJoin(F.broadcast(totals)).groupBy("n", "mean").agg(*(c for k, q in shares.items() for c in (at(low(q)).alias(f"_{k}"), at(F.least(low(q) + 1, F.col("n") - 1)).alias(f"_{k}_next"))))  # one row
    share = lambda q: (F.col("n") - 1) * q - low(q)
    out = totals.join(found.drop("mean"), "n", "left")
    return out.select("n", "mean", *((F.col(f"_{k}") + (F.col(f"_{k}_next") - F.col(f"_{k}")) * share(q)).alias(k) for k, q in shares.items()))


def inventory(files: DataFrame, key: str, size: str, cadence: str, path: str, examples: int = 3) -> DataFrame:
    """Archives of each dataset: number, bytes, those of each cadence, the first few paths."""
    return files.groupBy(key).agg(F.count("*").alias("archives"), F.sum(size).alias("bytes"), F.count_if(F.col(cadence) == "annual").alias("annual"), F.count_if(F.col(cadence) == "monthly").alias("monthly"), F.slice(F.array_sort(F.collect_set(path)), 1, examples).alias("examples"))


def layer_plan(rows: DataFrame) -> DataFrame:
    """(dataset, years, variables_by_year) from (dataset, year, variable)."""
    yearly = rows.groupBy("dataset", "year").agg(F.array_sort(F.collect_set("variable")).alias("variables"))
    return yearly.groupBy("dataset").agg(F.array_sort(F.collect_list("year")).alias("years"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("year", "variables")))).alias("variables_by_year"))


def catalog(layers: DataFrame) -> DataFrame:
    """Families with their layers by year from (family, dataset, year, variables)."""
    return layers.groupBy("family").agg(F.countDistinct("dataset").alias("datasets"), F.sum("variables").alias("variables"), F.array_sort(F.collect_list(F.struct("year", "dataset", "variables"))).alias("layers"))


def savings(old: Column, new: Column) -> list[Column]:
    """The difference and its share of the old in percent, null where that is zero."""
    return [(old - new).alias("saved"), F.try_divide((old - new) * 100.0, old).alias("saved_percent")]


def matrix(df: DataFrame, keys: list[str], row: str, column: str, value: str, order: list[str]) -> DataFrame:
    """For each key the map of a row's id to its values in the given column order."""
    wide = df.groupBy(*keys, row).pivot(column, order).agg(F.first(value))
    return wide.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(row).cast("string"), F.array(*(F.col(f"`{c}`") for c in order)))))).alias("data"))


def compact_metadata(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Distinct values of each field that are not blank, sorted."""
    return df.groupBy(key).agg(*(F.array_sort(F.collect_set(F.nullif(F.trim(F.col(f)), F.lit("")))).alias(f) for f in fields))
