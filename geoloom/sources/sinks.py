"""Sinks: GeoJSON, line-delimited features, CSV with its quoting rule, gzip, manifests and compact arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Features of one collection.
MOST_FEATURES = 200_000


def feature(geometry: Column, **properties: Column) -> Column:
    """One feature as JSON text; properties that are null are left out."""
    return F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*(c.alias(k) for k, c in properties.items())).alias("properties"), geometry.alias("geometry")))


def point(lon: Column, lat: Column) -> Column:
    return F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates"))


def write_feature_lines(df: DataFrame, path: str, feature_column: str, *order: str, compression: str | None = None) -> None:
    """A feature a line, in order over all files."""
    ordered = df.orderBy(*order) if order else df
    ordered.select(feature_column).write.text(path, compression=compression or "none")


def feature_collection(df: DataFrame, feature_column: str, *order: str) -> DataFrame:
    """One row with the text of a collection, which one task makes: for results that a page can load. More than MOST_FEATURES raise an error: those go out as lines."""
    if df.limit(MOST_FEATURES + 1).count() > MOST_FEATURES:
        raise ValueError(f"more than {MOST_FEATURES} features: write them as lines")
    rows = df.agg(F.array_sort(F.collect_list(F.struct(*order, feature_column))).alias("f"))
    return rows.select(F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.transform("f", lambda x: x[feature_column]), ","), F.lit("]}")).alias("value"))


def write_feature_collection(df: DataFrame, path: str, feature_column: str, *order: str) -> None:
    """One collection of any size as a folder of parts, which in the order of their paths are the document: `0-head`, the sorted features in `1-features`, `2-end`. Parts are written by many tasks; a file system that joins files makes one of them without reading any. landed.split_geojson() reads the folder."""
    spark = df.sparkSession
    rows = df.select(F.struct(*order, feature_column).alias("_r"))
    first = rows.agg(F.min("_r").alias("_r"))
    begin = first.select(F.concat(F.lit('{"type":"FeatureCollection","features":['), F.coalesce(F.col(f"_r.{feature_column}"), F.lit(""))).alias("value"))
    begin.coalesce(1).write.text(f"{path}/0-head")
    # All but one row that is equal to the first follow it.
    same = F.equal_null(F.col("_r"), F.col("_first"))
    marked = rows.crossJoin(F.broadcast(first.withColumnRenamed("_r", "_first"))).withColumn("_same", same)  # one row
    again = marked.where("_same").groupBy("_r").agg(F.count("*").alias("n")).where("n > 1").select("_r", F.explode(F.sequence(F.lit(2), F.col("n").cast("int")))).select("_r")
    rest = marked.where("not _same").select("_r").unionByName(again).orderBy("_r")
    rest.select(F.concat(F.lit(","), F.col(f"_r.{feature_column}"))).write.text(f"{path}/1-features")
    spark.range(1).select(F.lit("]}")).coalesce(1).write.text(f"{path}/2-end")


def write_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    """With a header; only what holds a comma, a quote or a line break is quoted, quotes are doubled."""
    df.write.csv(path, header=True, quote='"', escape='"', emptyValue="", compression=compression or "none")


def copied(spark: SparkSession, source: str, target: str) -> int:
    """The text files below source copied line by line to target by many tasks; their number of lines, counted in the copy."""
    spark.read.text(source).write.text(target)
    return spark.read.text(target).count()


def manifest(df: DataFrame, *aggregates: Column) -> DataFrame:
    """One row of counts and ranges as JSON text."""
    return df.agg(*aggregates).select(F.to_json(F.struct("*")).alias("value"))


def row_arrays(df: DataFrame, codes: dict[str, str]) -> DataFrame:
    """Rows as JSON arrays in the order of codes ({column: short code}), each value in its own JSON type, and the codes with them."""
    values = F.concat(F.lit("["), F.concat_ws(",", *(F.coalesce(F.regexp_extract(F.to_json(F.struct(F.col(c).alias("v")), {"ignoreNullFields": "false"}), r'(?s)^\{"v":(.*)\}$', 1), F.lit("null")) for c in codes)), F.lit("]"))
    return df.select(values.alias("row"), F.lit(list(codes.values())).alias("fields"))


def compression_ratio(raw: Column, packed: Column) -> Column:
    return F.round(F.try_divide(packed, raw), 4)
