"""Incremental state: upserts of micro-batches by key, and windows over event streams as an extension."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..operators.relational import first_per_key, last_per_key, upsert


def upsert_batches(stream: DataFrame, table: str, keys: list[str], order: str, checkpoint: str):
    """A streaming query that keeps the last row of each key in versions of a table (table/<batch>); each batch reads the version before it and writes its own, so a batch that is run again gives the same. A row of a later batch stands unless its order is less, or missing where the state's is not."""

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = last_per_key(batch, keys, order)
        if number:
            old = spark.read.parquet(f"{table}/{number - 1}")
            seen = old.select(*keys, F.col(order).alias("_seen"))
            newer = new.join(seen, keys, "left").where(F.col("_seen").isNull() | (F.col(order) >= F.col("_seen"))).drop("_seen")
            new = upsert(old, newer, keys)
        new.write.mode("overwrite").parquet(f"{table}/{number}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)


def session_counts(events: DataFrame, ts: str, key: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Rows of each session of a key; for batches and streams."""
    timed = events.withWatermark(ts, late) if events.isStreaming else events
    return timed.groupBy(key, F.session_window(ts, gap).alias("s")).agg(F.count("*").alias("n")).select(key, F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n")


def tumbling_counts(events: DataFrame, ts: str, width: str, *keys: str, late: str = "1 hour") -> DataFrame:
    timed = events.withWatermark(ts, late) if events.isStreaming else events
    return timed.groupBy(F.window(ts, width).alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *keys, "n")


def sliding_counts(events: DataFrame, ts: str, width: str, slide: str, *keys: str, late: str = "1 hour") -> DataFrame:
    """Rows of each window of a width that begins every slide, for batches and streams; rows later than the watermark are in none."""
    timed = events.withWatermark(ts, late) if events.isStreaming else events
    return timed.groupBy(F.window(ts, width, slide).alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *keys, "n")


def without_repeats(events: DataFrame, ts: str, *keys: str, late: str = "1 hour") -> DataFrame:
    """The first row of each key. A stream keeps a key for as long as the watermark lets another row of it come; a batch keeps the earliest, rows without a time last."""
    if events.isStreaming:
        return events.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))
    return first_per_key(events, list(keys), F.col(ts))


class _Latest(StatefulProcessor):
    """The row with the greatest order of each key so far; a key's row goes out whenever a greater one replaces it."""

    def __init__(self, columns: list[str], order: str, schema: str):
        self.columns, self.order, self.schema = columns, order, schema

    def init(self, handle) -> None:
        self.held = handle.getValueState("latest", self.schema)

    def handleInputRows(self, key, rows, timerValues):
        found = pd.concat(list(rows))
        known = found[found[self.order].notna()]
        best = (known.sort_values(self.order, kind="stable") if len(known) else found).iloc[-1]
        at = self.columns.index(self.order)
        held = self.held.get() if self.held.exists() else None
        if held is None or (not pd.isna(best[self.order]) and (held[at] is None or pd.isna(held[at]) or best[self.order] > held[at])):
            self.held.update(tuple(None if pd.isna(v) else v.item() if hasattr(v, "item") else v for v in best[self.columns]))
            yield pd.DataFrame([best[self.columns]])

    def close(self) -> None:
        pass


def latest_rows(stream: DataFrame, key: str, order: str) -> DataFrame:
    """Updates of a stream's last row of each key by order, with the state in Spark's own store: a late row with a lesser order changes nothing, a row without one only opens a key."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stream.schema.fields)
    return stream.groupBy(key).transformWithStateInPandas(statefulProcessor=_Latest(stream.columns, order, schema), outputStructType=stream.schema, outputMode="Update", timeMode="None")
