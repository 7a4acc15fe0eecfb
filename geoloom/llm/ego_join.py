"""Embedding near-duplicates by an epsilon grid order join.

Vectors are normalised and projected on their leading principal axes; grid cells of the link distance on these give the
epsilon grid order. The order is cut into bundles, which are joined in pairs; bundles whose intervals' boxes are all
farther apart than the distance never meet. Two that meet are joined recursively by halves of their intervals, skipping
halves that are provably too far, down to small matrix products: of the projections, which prove most pairs too far, and
of the whole vectors in double precision.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Stage, picked, ranked
from .components import connected_components, forest

#: Axes of the grid, axes of the projections that prove pairs too far, and rows of an interval that is compared at once.
COSINE, AXES, SHADOW, LEAF = 0.95, 8, 24, 256
#: A vector is shipped once for each bundle that its own meets, so bundles are few: as many as give each core two pairs of them, this many at least, but none above so many bytes of vectors. Boxes of a bundle.
BUNDLES, BUNDLE_BYTES, BOXES = 8, 32 << 20, 32
#: Links that a task keeps before it replaces them by a forest of them.
KEPT_LINKS = 1 << 20


def usable(values: np.ndarray) -> np.ndarray | None:
    """The vector in double precision and of length 1, or None if it cannot link with any. It is divided by its largest magnitude first, so that no square overflows or vanishes."""
    x = values.astype(np.float64)
    most = np.abs(x).max(initial=0.0)
    if not np.isfinite(most) or most == 0:
        return None
    x = x / most + 0.0
    return x / np.linalg.norm(x)


def _vectors(base: DataFrame, kind: str) -> DataFrame:
    """vec_id, digest (null for vectors that link with nothing), dims, vector (as it came, as bytes of the type kind)."""

    def run(batches):
        for batch in batches:
            column = batch.column(1)
            ends, values = column.offsets.to_numpy(), column.values
            holes = np.concatenate(([0], np.cumsum(values.is_null().to_numpy(zero_copy_only=False)))) if values.null_count else None
            numbers = values.to_numpy(zero_copy_only=False).astype(kind) + np.array(0, kind)
            there = column.is_valid().to_numpy(zero_copy_only=False)
            digests, dims, data = [], [], []
            for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
                own = numbers[a:b]
                good = there[i] and b > a and (holes is None or holes[a] == holes[b]) and usable(own) is not None
                raw = own.tobytes()
                digests.append(hashlib.blake2b(raw, digest_size=16).digest() if good else None)
                dims.append(b - a if good else 0)
                data.append(raw if good else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()), pa.array(dims, pa.int32()), pa.array(data, pa.binary())], ["vec_id", "digest", "dims", "vector"])

    return base.mapInArrow(run, "vec_id long, digest binary, dims int, vector binary")


def _matrix(column, dims: int, kind: str) -> np.ndarray:
    """The vectors of a column, of length 1 each."""
    x = np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dims).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True, initial=0.0)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def principal_axes(vectors: DataFrame, dims: int, axes: int, kind: str) -> np.ndarray:
    """The leading eigenvectors of the second moments, summed over all rows by Spark; dims * dims numbers reach the driver."""

    def run(batches):
        total = np.zeros((dims + 1, dims))
        for batch in batches:
            x = _matrix(batch.column(0), dims, kind)
            total[:dims] += x.T @ x
            total[dims] += x.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["at", "v"])

    total, n = np.zeros((dims + 1) * dims), max(1, vectors.count())
    for r in vectors.select("vector").mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect():
        total[r["at"]] = r["v"]
    total = total.reshape(dims + 1, dims) / n
    values, base = np.linalg.eigh(total[:dims] - np.outer(total[dims], total[dims]))
    return base[:, np.argsort(-values)[:axes]]


def joined(x: slice, y: slice, shadow: tuple[np.ndarray, np.ndarray], distance: float, leaf: int):
    """The pairs of leaves (slices) of two intervals of the order that their boxes don't prove too far apart, by recursion on the intervals' halves. An interval meets itself once."""
    px, py = shadow[0][x], shadow[1][y]
    gap = np.maximum(0, np.maximum(px.min(0) - py.max(0), py.min(0) - px.max(0)))
    if gap @ gap > distance * distance:
        return
    m, n = x.stop - x.start, y.stop - y.start
    if max(m, n) <= leaf:
        yield x, y
        return
    halves = lambda s: (slice(s.start, (s.start + s.stop) // 2), slice((s.start + s.stop) // 2, s.stop))
    if shadow[0] is shadow[1] and x == y:
        one, two = halves(x)
        for a, b in ((one, one), (one, two), (two, two)):
            yield from joined(a, b, shadow, distance, leaf)
    else:
        for a, b in [(a, y) for a in halves(x)] if m >= n else [(x, b) for b in halves(y)]:
            yield from joined(a, b, shadow, distance, leaf)


def linked(x: np.ndarray, y: np.ndarray, copies_x: np.ndarray, copies_y: np.ndarray, base: np.ndarray, distance: float, cosine: float, leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(how many vectors of y each of x links with, as many times as they were copied; the same of x for each of y; links (i, j) that connect what all links connect, y numbered after x). x and y may be the same object."""
    same, m = x is y, len(x)
    flat_x = (x @ base).astype(np.float32)
    flat_y = flat_x if same else (y @ base).astype(np.float32)
    half = lambda p: (p * p).sum(1, keepdims=True) / 2
    one = lambda p: np.ones((len(p), 1), np.float32)
    # A product of these is minus half the squared distance of the projections, which is no more than that of the vectors.
    far_x, far_y = np.hstack((flat_x, -half(flat_x), one(flat_x))), np.hstack((flat_y, one(flat_y), -half(flat_y)))
    least = np.float32(-(distance * distance) / 2 - 1e-5)
    weight_x, weight_y = np.zeros(m, np.int64), np.zeros(len(y), np.int64)
    found, kept = [np.zeros((2, 0), np.int64)], 0
    for a, b in joined(slice(0, m), slice(0, len(y)), (flat_x, flat_y), distance + 1e-5, leaf):
        close = far_x[a] @ far_y[b].T >= least
        some = int(np.count_nonzero(close))
        if not some:
            continue
        if some * 8 < close.size:
            i, j = np.nonzero(close)
            good = np.einsum("ij,ij->i", x[a][i], y[b][j]) >= cosine
            i, j = i[good], j[good]
        else:
            i, j = np.nonzero(x[a] @ y[b].T >= cosine)
        i, j = i + a.start, j + b.start
        if same and a == b:
            i, j = i[i < j], j[i < j]
        if not len(i):
            continue
        np.add.at(weight_x, i, copies_y[j])
        np.add.at(weight_x if same else weight_y, j, copies_x[i])
        # What connects the leaves' rows is kept, not each link of them.
        size = a.stop - a.start
        label = forest(i - a.start, j - b.start + size, size + b.stop - b.start)
        at = np.flatnonzero(label != np.arange(len(label)))
        place = lambda k: np.where(k < size, k + a.start, k - size + b.start + (0 if same else m))  # noqa: B023, E731
        found.append(np.stack((place(at), place(label[at]))))
        kept += len(at)
        if kept > KEPT_LINKS:
            label = forest(*np.concatenate(found, axis=1), m + (0 if same else len(y)))
            at = np.flatnonzero(label != np.arange(len(label)))
            found, kept = [np.stack((at, label[at]))], len(at)
    return weight_x, weight_y, *np.concatenate(found, axis=1)


def _links(stage: Stage, reps: DataFrame, dims: int, kind: str, cosine: float, axes: int, leaf: int) -> DataFrame:
    """Of vectors of one length: (rep, weight: how many vectors one pair of bundles links it to, other: the least of the links' component there)."""
    spark = reps.sparkSession
    distance = math.sqrt(max(0.0, 2 - 2 * cosine)) * (1 + 1e-9) + 1e-9
    base = principal_axes(reps, dims, min(max(axes, SHADOW), dims), kind)
    width = min(axes, dims)
    cells, lows = [f"cell_{i}" for i in range(width)], [f"p_{i}" for i in range(width)]

    def placed(batches):
        for batch in batches:
            p = _matrix(batch.column(2), dims, kind) @ base[:, :width]
            at = np.floor(p / max(distance, 1e-6)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(at[:, i]) for i in range(width)), *(pa.array(p[:, i]) for i in range(width))], ["rep", "copies", "vector", *cells, *lows])

    schema = "rep long, copies long, vector binary, " + ", ".join([f"{c} int" for c in cells] + [f"{c} double" for c in lows])
    ordered, n = ranked(stage, reps.select("rep", "copies", "vector").mapInArrow(placed, schema), *cells, "rep")
    cores = spark.sparkContext.defaultParallelism
    bundles = max(1, -(-n * dims * np.dtype(kind).itemsize // BUNDLE_BYTES), min(-(-n // (4 * leaf)), max(BUNDLES, math.ceil(math.sqrt(4 * cores)))))
    cut = ordered.withColumn("bundle", F.expr(f"(place * {bundles}L) div {n}L")).withColumn("box", F.expr(f"(place * {bundles * BOXES}L) div {n}L"))
    cut = stage.table(cut)
    # Two bundles meet if boxes of theirs do, which they can only if their first cells overlap or are neighbours.
    boxes = stage.table(cut.groupBy("bundle", "box").agg(F.min("cell_0").alias("low_cell"), F.max("cell_0").alias("high_cell"), F.array(*(F.min(c) for c in lows)).alias("low"), F.array(*(F.max(c) for c in lows)).alias("high")))
    one = boxes.select(F.col("bundle").alias("a"), F.col("low").alias("low_a"), F.col("high").alias("high_a"), F.explode(F.sequence("low_cell", "high_cell")).alias("cell"))
    two = boxes.select(F.col("bundle").alias("b"), F.col("low").alias("low_b"), F.col("high").alias("high_b"), F.explode(F.sequence(F.col("low_cell") - 1, F.col("high_cell") + 1)).alias("cell"))
    gap = F.expr("aggregate(zip_with(arrays_zip(low_a, high_a), arrays_zip(low_b, high_b), (x, y) -> greatest(0D, x.low_a - y.high_b, y.low_b - x.high_a)), 0D, (s, g) -> s + g * g)")
    pairs = stage.table(one.join(two, "cell").where(gap <= distance * distance).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    meets = pairs.select(F.col("a").alias("bundle"), "a", "b").unionByName(pairs.where("a != b").select(F.col("b").alias("bundle"), "a", "b"))

    def bundle_of(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        reps_, copies, vectors = zip(*rows, strict=True)
        return np.array(reps_, np.int64), np.array(copies, np.int64), _matrix(pa.array(vectors, pa.binary()), dims, kind)

    def met(a: int, b: int, rows: dict[int, list]) -> pa.RecordBatch:
        ra, ca, x = bundle_of(rows[a])
        rb, cb, y = (ra, ca, x) if a == b else bundle_of(rows[b])
        wx, wy, i, j = linked(x, y, ca, cb, base, distance, cosine, leaf)
        ids, weight = (ra, wx) if a == b else (np.concatenate((ra, rb)), np.concatenate((wx, wy)))
        label = forest(i, j, len(ids))
        some = np.flatnonzero(weight)
        return pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(weight[some]), pa.array(ids[label[some]])], ["rep", "weight", "other"])

    def meet(batches):
        key, rows = None, {}
        for batch in batches:
            for a, b, bundle, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (a, b) != key:
                    if key:
                        yield met(*key, rows)
                    key, rows = (a, b), {a: [], b: []}
                rows[bundle].append(row)
        if key:
            yield met(*key, rows)

    shipped = cut.join(meets, "bundle").select("a", "b", "bundle", "rep", "copies", "vector", "place").repartition("a", "b").sortWithinPartitions("a", "b", "place").drop("place")
    return shipped.mapInArrow(meet, "rep long, weight long, other long")


def embedding_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE, axes: int = AXES, leaf: int = LEAF) -> DataFrame:
    """A row for each row of vectors: vec_id, n_links (other rows whose vectors have at least that cosine with it), component_id (the least id reachable by links), kept (whether that is its own).

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, as do those of
    different lengths with each other; magnitudes don't matter, however great or small. A null id links with nothing
    and is kept, as its component is null. Equal vectors are compared once and count as often as they occur. Rows that
    repeat an id, with the same vector or another, are rows of their own, which count as links of each other where
    their vectors do. Extra columns are ignored; an empty table gives an empty result.
    """
    stage = Stage(vectors.sparkSession, "ego")
    inner = vectors.schema[vector_col].dataType.elementType
    kind = "<f4" if isinstance(inner, T.FloatType) else "<f8"
    base = picked(vectors, vec_id=(id_col, "long"), values=(vector_col, "array<float>" if kind == "<f4" else "array<double>"))
    rows = stage.table(_vectors(base, kind).withColumn("digest", F.when(F.col("vec_id").isNotNull(), F.col("digest"))))
    reps = rows.where("digest is not null").groupBy("digest").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"), F.first("dims").alias("dims"), F.first("vector").alias("vector"))
    reps = stage.table(reps.withColumn("rep", F.monotonically_increasing_id()))
    found = None
    for r in reps.select("dims").distinct().collect():  # as many as there are lengths of vectors
        new = _links(stage, reps.where(F.col("dims") == r["dims"]), r["dims"], kind, cosine, axes, leaf)
        found = new if found is None else found.unionByName(new)
    if found is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = stage.table(found)
    labels = connected_components(stage, found, "rep", "other").withColumnRenamed("node", "rep")
    weights = found.groupBy("rep").agg(F.sum("weight").alias("weight"))
    per_rep = stage.table(reps.select("digest", "rep", "first_id", "copies").join(weights, "rep", "left").join(labels, "rep", "left").withColumn("component", F.coalesce("component", "rep")))
    least = stage.table(per_rep.groupBy("component").agg(F.min("first_id").alias("component_id")))
    of_digest = per_rep.join(least, "component").select("digest", (F.coalesce("weight", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = rows.select("vec_id", "digest").join(of_digest, "digest", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept"))
