"""What several of the training-data operators share: shared-folder tables, safe column picks, vectorised word hashes."""

from __future__ import annotations

import ctypes
import math
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Byte tables for bytes.translate. Words of letters and digits (all bytes over 0x7F count), and words between white space.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
SPACES = bytes(32 if b == 32 or 9 <= b <= 13 else b for b in range(256))
ALNUM_LOWER = bytes((b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
LOWER_SPACES = bytes(LOWER[SPACES[b]] for b in range(256))


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for tables between jobs: spark.checkpoint.dir; a folder of this machine only if that is unset and Spark is local."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"file://{tempfile.gettempdir()}/checkpoints"


class Stage:
    """Tables written to the shared folder: they cut lineage and outlive a lost executor."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base, self.n = spark, f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}", 0

    def table(self, df: DataFrame) -> DataFrame:
        """df, written and read again. Columns keep their order and types."""
        self.n += 1
        path = f"{self.base}/{self.n}"
        df.write.parquet(path)
        self.spark.sparkContext._jvm.System.gc()  # what the write shuffled is of no use now; Spark drops it once the driver's JVM has collected it
        out = self.spark.read.schema(df.schema).parquet(path)
        out._stage_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that no later step reads."""
        jvm = self.spark.sparkContext._jvm
        for df in tables:
            path = jvm.org.apache.hadoop.fs.Path(df._stage_path)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ranked(stage: Stage, df: DataFrame, *keys: str) -> tuple[DataFrame, int]:
    """(df with `place`, each row's number in the order of keys, from 0 without gaps; the number of rows). Places come from the counts of sorted ranges: no task sees more than its range, and the table of counts has a row for each shuffle partition."""
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    # The ids are the partition's number in the upper bits and the row's place in its partition in the lower 33.
    ranged = stage.table(ranged.withColumn("_range", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND((1 << 33) - 1)))
    counts = ranged.groupBy("_range").agg(F.count("*").alias("n"))
    before = stage.table(counts.select("_range", "n", (F.sum("n").over(Window.orderBy("_range")) - F.col("n")).alias("_before")))
    n = before.agg(F.sum("n")).first()[0] or 0
    return ranged.join(before.drop("n"), "_range").withColumn("place", F.col("_before") + F.col("_at")).drop("_range", "_at", "_before"), n


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under the given new names, found by exact name and position, so that other columns may clash in anything."""
    names = df.columns
    flat = df.toDF(*(f"c{i}" for i in range(len(names))))
    at = {new: names.index(old) for new, old in columns.items()}
    return flat.select(*(F.col(f"c{i}").alias(new) for new, i in at.items()))


def picked(df: DataFrame, **columns: tuple[str, str]) -> DataFrame:
    """As pick(), with a type for each: new=(old, type)."""
    return pick(df, **{k: v[0] for k, v in columns.items()}).select(*(F.col(k).cast(v[1]).alias(k) for k, v in columns.items()))


def added(df: DataFrame, *fields: tuple[str, T.DataType]) -> T.StructType:
    """df's schema with more fields at its end, for mapInArrow functions that pass rows through."""
    return T.StructType([*df.schema.fields, *(T.StructField(n, t) for n, t in fields)])


def released(run):
    """A function of Arrow batches that at its end gives back what Arrow and the C library keep of their memory: Python workers live on from task to task."""

    def wrapped(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
        if trim:
            trim(0)

    return wrapped


def text_at(df: DataFrame, text_col: str) -> int:
    return df.columns.index(text_col)


def in_passes(stage: Stage, docs: DataFrame, at: int, tables, search, **found: str) -> DataFrame:
    """docs with columns named c0 and so on, and at the end what all passes found in column `at` of each row: arrays, null where there is nothing.

    tables: an iterator of what each pass looks for, of bounded size; one pass's table is broadcast, its finds are
    written, and only then the next one's is made. search(table) is a function of Arrow batches (row, text) that yields
    batches (row, then arrays of the types in found) of the rows with finds.
    """
    spark, width = docs.sparkSession, len(docs.columns)
    flat = stage.table(docs.toDF(*(f"c{i}" for i in range(width))).withColumn("row", F.monotonically_increasing_id()))
    hits = None
    for wanted in tables:
        table = spark.sparkContext.broadcast(wanted)
        part = stage.table(flat.select("row", f"c{at}").mapInArrow(search(table), "row long, " + ", ".join(f"{k} {v}" for k, v in found.items())))
        table.destroy()
        hits = part if hits is None else hits.unionByName(part)
    of_row = hits.groupBy("row").agg(*(F.flatten(F.collect_list(k)).alias(k) for k in found))
    return flat.join(of_row, "row", "left").select(*flat.columns[:-1], *found)


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every bit of the result depends on every bit of h."""
    h = h.copy()
    with np.errstate(over="ignore"):
        h ^= h >> np.uint64(30)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(27)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
    return h


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse, modulo 2**64."""
    global _powers
    if len(_powers[0]) < n:
        size = 1 << max(16, math.ceil(math.log2(n)))
        out = []
        for base in (_BASE, _INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            with np.errstate(over="ignore"):
                out.append(np.cumprod(steps))
        _powers = out[0], out[1]
    return _powers[0][:n], _powers[1][:n]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of data between single or repeated bytes 0x20: (64-bit hash, start, end) of each, by one polynomial prefix sum over the bytes."""
    codes = np.frombuffer(data, np.uint8)
    if not len(codes):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = np.concatenate(([False], codes != 32, [False]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    up, down = powers(len(codes) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[: len(codes)], out=total[1:])
        raw = (total[end] - total[start]) * down[start]
        return mixed(raw + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), start, end


def chunks(texts: list[str | None], table: bytes, most: int = 1 << 18):
    """Runs of whole texts of about `most` bytes, for the vectorised functions: (index of the first, the bytes of the run joined by a space, each one's start and end there). None counts as empty."""
    at, parts, size = 0, [], 0
    for i, x in enumerate(texts):
        parts.append((x or "").encode("utf-8", "surrogatepass").translate(table))
        size += len(parts[-1]) + 1
        if size >= most or i == len(texts) - 1:
            ends = np.cumsum([len(p) + 1 for p in parts])
            yield at, b" ".join(parts), ends - [len(p) + 1 for p in parts], ends - 1
            at, parts, size = i + 1, [], 0


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of each n consecutive entries."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(len(words) - n + 1, np.uint64)
        for k in range(n):
            out = out * np.uint64(0x9FB21C651E98DF25) + words[k : len(words) - n + 1 + k]
            if k < n - 1:
                out ^= out >> np.uint64(29)
    return mixed(out)
