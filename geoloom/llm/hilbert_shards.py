"""Sharding along a Hilbert curve: rows near each other in several metadata dimensions share a shard, so readers that ask for a range of them skip most shards."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Stage, picked, ranked

BITS = 10


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cells (n, dimensions), whose entries are below 2**bits. By Skilling's transform, a bit plane at a time."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            up = (x[i] & q) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(up, low, swap)
            x[i] ^= np.where(up & (i > 0), 0, swap)
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


def label_cell(column: Column, bits: int = BITS) -> Column:
    """A cell for a label: equal labels share a cell, null has cell 0."""
    return F.when(column.isNull(), F.lit(0)).otherwise(F.shiftright(F.crc32(column.cast("binary")), 32 - bits)).cast("int")


def size_cell(column: Column, bits: int = BITS) -> Column:
    """A cell for a size: by its logarithm, in order; null and what is below 1 have cell 0."""
    top = (1 << bits) - 1
    return F.least(F.floor(F.log2(F.greatest(column.cast("double"), F.lit(1.0))) * F.lit(top / 48.0)), F.lit(top)).cast("int")


def hilbert_shards(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", label_cols: tuple[str, ...] = ("lang", "source"), bits: int = BITS) -> DataFrame:
    """A row for each row of docs: doc_id, size, text_crc32, law ('rows': shard sizes differ by a row at most), shard, slot (0 on, without gaps), grown_shard (null), curve (the Hilbert index), cell_0... (its quantised dimensions: the labels, then the size).

    size: UTF-8 bytes of the text plus 8; a null text counts as empty. Ties on the curve go by checksum and id, so that
    equal texts of one cell lie together; rows that repeat in everything get slots of their own. Extra columns are
    ignored; an empty table gives an empty result. What is sorted is a few numbers a row, never the text; places come
    from the counts of the sorted ranges, so no task sees more than its range.
    """
    spark = docs.sparkSession
    columns = {"doc_id": (id_col, docs.schema[id_col].dataType.simpleString()), "text": (text_col, "string")} | {f"label_{i}": (c, "string") for i, c in enumerate(label_cols)}
    base = picked(docs, **columns)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + F.lit(8)
    base = base.select("doc_id", size.alias("size"), F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"), *(label_cell(F.col(f"label_{i}"), bits).alias(f"cell_{i}") for i in range(len(label_cols))))
    cells = [f"cell_{i}" for i in range(len(label_cols) + 1)]
    base = base.withColumn(cells[-1], size_cell(F.col("size"), bits))

    @F.pandas_udf(T.LongType())
    def curve(*columns: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.stack([c.to_numpy() for c in columns], 1), bits))

    placed, n = ranked(Stage(spark, "hilbert"), base.withColumn("curve", curve(*cells)), "curve", "text_crc32", "doc_id")
    # In whole numbers: the first place of shard s is the least p with p * shards >= s * n.
    exact = placed.withColumn("shard", F.expr(f"(place * {shards}L) div {max(n, 1)}L"))
    slot = F.col("place") - F.expr(f"(shard * {n}L + {shards - 1}L) div {shards}L")
    return exact.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve", *cells)


def manifest(sharded: DataFrame) -> DataFrame:
    """The least and greatest cell of each dimension in each shard: what a reader prunes by."""
    cells = [c for c in sharded.columns if c.startswith("cell_")]
    return sharded.groupBy("shard").agg(F.count("*").alias("n_rows"), F.sum("size").alias("bytes"), *(f(c).alias(f"{f.__name__}_{c}") for c in cells for f in (F.min, F.max)))


def write_shards(docs: DataFrame, sharded: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Whole rows of docs as one Parquet folder for each shard, each in curve order. Needs unique ids."""
    placed = docs.join(sharded.select(F.col("doc_id").alias(id_col), "shard", "curve"), id_col)
    placed.repartition("shard").sortWithinPartitions("shard", "curve").drop("curve").write.partitionBy("shard").parquet(path)
