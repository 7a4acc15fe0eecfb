"""Exact search for the largest inner products by elimination over a table of distances to pivots.

All vectors' distances to a few dozen pivots are a table. By the triangle inequality two vectors are at least as far apart
as their distances to any pivot differ, and with both lengths that bounds their inner product from above. Vectors are cut
into parts of near ones, a part into groups, and each group's range of every distance bounds its members at once. A query
first meets the part that promises most; its k-th best score there decides which other parts it meets at all. Within a
part it visits groups in the order of their bounds and stops at the first that cannot reach its k-th best score.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Stage, picked, ranked, released

#: Results of a query, the factor before components are rounded down, and every how manieth id is a query.
BEST, SCALE, QUERY_IDS = 10, 1024, 100
#: Pivots, and rows and bytes of the sample that they are chosen from: the rows with the least hashes of their numbers.
PIVOTS, SAMPLE, SAMPLE_BYTES = 32, 2048, 64 << 20
#: Vectors of a group; of a part at least and at most, unless parts would be more than so many.
GROUP, LEAST_PART, PART, MOST_PARTS = 64, 1024, 65_536, 100_000
#: Whole components from here on have no exact products in 64 bits; vectors that hold one take no part.
LIMIT = 1 << 28
#: Queries whose bounds are made at once, and queries that meet a part in one task; more meet a copy of it.
BLOCK, ASKED, MOST_SHARES = 64, 4096, 1 << 32


def whole(values: np.ndarray) -> np.ndarray | None:
    """floor(1024 x) of each component, or None if the vector takes no part."""
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(values.astype(np.float64) * SCALE)
    return scaled.astype(np.int32) if np.isfinite(values).all() and (np.abs(scaled) < LIMIT).all() else None


def distances(vectors: np.ndarray, pivots: list[np.ndarray]) -> np.ndarray:
    """Distances of vectors of one length to the pivots; whichever is shorter goes on with zeros."""
    x = vectors.astype(np.float64)
    own = (x * x).sum(1)
    out = np.empty((len(x), len(pivots)))
    for j, p in enumerate(pivots):
        m = min(len(p), x.shape[1])
        out[:, j] = ((x[:, :m] - p[:m]) ** 2).sum(1) + (own - (x[:, :m] ** 2).sum(1)) + (p[m:] ** 2).sum()
    return np.sqrt(out)


def choose_pivots(sample: list[np.ndarray], most: int = PIVOTS) -> list[np.ndarray]:
    """Vectors of the sample that are far from each other: each the farthest from those before it."""
    chosen, far = [], np.full(len(sample), np.inf)
    while len(chosen) < most and len(sample) and far.max() > 0:
        pivot = sample[int(far.argmax())].astype(np.float64)
        chosen.append(pivot)
        for n in {len(x) for x in sample}:
            at = [i for i, x in enumerate(sample) if len(x) == n]
            far[at] = np.minimum(far[at], distances(np.stack([sample[i] for i in at]), [pivot])[:, 0])
    return chosen


def _list(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    flat = np.concatenate(rows) if rows else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum([len(r) for r in rows]))), pa.int32()), pa.array(flat, kind))


def _floored(batches):
    """(row, vec_id, vector) of the vectors that take part."""
    for batch in batches:
        kept, rows = [], []
        for i, x in enumerate(batch.column(2)):
            # A null component is NaN in numpy.
            vector = whole(x.values.to_numpy(zero_copy_only=False).astype(np.float64)) if x.is_valid else None
            if vector is not None:
                kept.append(i)
                rows.append(vector)
        at = pa.array(kept, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), _list(rows, pa.int32())], ["row", "vec_id", "vector"])


def _tabled(pivots: list[np.ndarray]):
    """Adds size (of the vector), cell (its nearest pivot), near (the distance to it), square (its length's square) and far (its distances to all pivots)."""

    def run(batches):
        for batch in batches:
            vectors = [x.values.to_numpy() for x in batch.column(2)]
            sizes = np.array([len(x) for x in vectors], np.int64)
            far, square = np.zeros((len(vectors), len(pivots))), np.zeros(len(vectors))
            for n in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == n)
                some = np.stack([vectors[i] for i in at]) if n else np.zeros((len(at), 0), np.int32)
                far[at], square[at] = distances(some, pivots), (some.astype(np.float64) ** 2).sum(1)
            cell = far.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sizes), pa.array(cell.astype(np.int32)), pa.array(far[np.arange(len(far)), cell]), pa.array(square), _list(list(far), pa.float64())],
                ["row", "vec_id", "vector", "size", "cell", "near", "square", "far"],
            )

    return run


def most_product(apart: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The greatest inner product of two vectors that are so far apart at least and whose squares have this sum. What rounding may take is added."""
    apart = np.maximum(apart - 1e-7 * (1 + np.sqrt(sizes)), 0)
    return (sizes - apart * apart) / 2 + 1e-7 * (1 + sizes)


def box_products(far: np.ndarray, square: np.ndarray, low: np.ndarray, high: np.ndarray, longest: np.ndarray) -> np.ndarray:
    """For each query (row) and box (column) a score that no member of the box is above. low, high: the least and greatest distance of its members to each pivot; longest: their greatest square."""
    apart = np.zeros((len(far), len(low)))
    for j in range(far.shape[1]):
        q = far[:, j, None]
        np.maximum(apart, np.maximum(low[None, :, j] - q, q - high[None, :, j]), out=apart)
    return most_product(apart, square[:, None] + longest[None, :])


class Part:
    """The vectors of one length of a part, in groups of near ones. Of equal vectors only those with the `best` + 1 least ids can be results."""

    def __init__(self, rows: np.ndarray, ids: pa.Array, vectors: np.ndarray, far: np.ndarray, square: np.ndarray, best: int):
        # Nulls come after all other ids.
        key = np.lexsort((rows, np.asarray(ids.fill_null(0)), np.asarray(ids.is_null())))
        copies = np.unique(np.ascontiguousarray(vectors).view(np.dtype((np.void, max(1, vectors.itemsize * vectors.shape[1])))).ravel(), return_inverse=True)[1] if vectors.shape[1] else np.zeros(len(rows), np.int64)
        key = key[np.argsort(copies[key], kind="stable")]
        edge = np.flatnonzero(np.concatenate(([True], copies[key][1:] != copies[key][:-1])))
        kept = np.sort(key[np.arange(len(key)) - np.repeat(edge, np.diff([*edge, len(key)])) <= best])
        cell = far[kept].argmin(1)
        order = kept[np.lexsort((far[kept, cell], cell))]
        self.rows, self.ids, self.vectors, self.far, self.square = rows[order], ids.take(pa.array(order)), vectors[order], far[order], square[order]
        self.key = np.empty(len(order), np.int64)
        self.key[np.lexsort((self.rows, np.asarray(self.ids.fill_null(0)), np.asarray(self.ids.is_null())))] = np.arange(len(order))
        self.starts = np.arange(0, len(order), GROUP)
        self.low, self.high = np.minimum.reduceat(self.far, self.starts, axis=0), np.maximum.reduceat(self.far, self.starts, axis=0)
        self.longest = np.maximum.reduceat(self.square, self.starts)
        self.most = int(np.abs(self.vectors).max(initial=0))

    def _products(self, at: np.ndarray, query: np.ndarray) -> np.ndarray:
        exact = self.most * int(np.abs(query).max(initial=0)) * max(1, len(query)) < 1 << 53
        kind = np.float64 if exact else np.int64
        return (self.vectors[at].astype(kind) @ query.astype(kind)).astype(np.int64)

    def search(self, own: int, query: np.ndarray, far: np.ndarray, square: float, bounds: np.ndarray, known: float, best: int) -> tuple[np.ndarray, np.ndarray]:
        """(scores, places in the part) of the best results that are not below the score known to be reached."""
        order = np.argsort(-bounds, kind="stable")
        scores, places, reached, at, step = np.zeros(0, np.int64), np.zeros(0, np.int64), known, 0, 4
        while at < len(order) and bounds[order[at]] >= reached:
            groups = order[at : at + step]
            groups = groups[bounds[groups] >= reached]
            at, step = at + step, 2 * step
            some = (self.starts[groups][:, None] + np.arange(GROUP)).ravel()
            some = some[some < len(self.rows)]
            single = most_product(np.abs(self.far[some] - far).max(1), square + self.square[some])
            some = some[(single >= reached) & (self.rows[some] != own)]
            scores, places = np.concatenate((scores, self._products(some, query))), np.concatenate((places, some))
            top = np.lexsort((self.key[places], -scores))[:best]
            scores, places = scores[top], places[top]
            if len(scores) == best:
                reached = max(known, float(scores[-1]))
        return scores, places


def _met(best: int):
    """Rows of parts, vectors (kind 0) before queries (kind 1): (row, query_id, vec_id, target, score) of each query's best in the part."""

    def found(parts: dict[int, Part], batch: pa.RecordBatch):
        vectors = [x.values.to_numpy() for x in batch.column(4)]
        sizes = np.array([len(x) for x in vectors])
        out = []
        for n in np.unique(sizes).tolist():
            part, at = parts.get(n), np.flatnonzero(sizes == n)
            if part is None:
                continue
            for low in range(0, len(at), BLOCK):
                some = at[low : low + BLOCK]
                taken = batch.take(pa.array(some))
                far = np.stack([x.values.to_numpy() for x in taken.column(6)])
                square, rows, known = (np.asarray(taken.column(c)) for c in (5, 2, 7))
                bounds = box_products(far, square, part.low, part.high, part.longest)
                for i in range(len(some)):
                    scores, places = part.search(rows[i], vectors[some[i]], far[i], square[i], bounds[i], known[i], best)
                    out.append((taken.column(2).take(pa.array([i] * len(places), pa.int64())), taken.column(3).take(pa.array([i] * len(places), pa.int64())), part.ids.take(pa.array(places)), pa.array(part.rows[places]), pa.array(scores)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in zip(*out, strict=True)], ["row", "query_id", "vec_id", "target", "score"])

    def run(batches):
        now, held, parts = None, [], None
        for batch in batches:
            keys, kinds = np.asarray(batch.column(0)) * MOST_SHARES + np.asarray(batch.column(8)), np.asarray(batch.column(1))
            edges = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]) | (kinds[1:] != kinds[:-1])))) if len(keys) else []
            for start, end in zip(edges, [*edges[1:], len(keys)], strict=True):
                piece = batch.slice(start, end - start)
                if keys[start] != now:
                    now, held, parts = keys[start], [], None
                if kinds[start] == 0:
                    held.append(piece)
                    continue
                if parts is None:
                    parts = _parts(held, best)
                    held = []
                yield from found(parts, piece)

    return released(run)


def _parts(held: list[pa.RecordBatch], best: int) -> dict[int, Part]:
    if not held:
        return {}
    table = pa.Table.from_batches(held).combine_chunks()
    vectors, far = (table.column(c).chunk(0) for c in (4, 6))
    sizes = np.diff(np.asarray(vectors.offsets))
    flat, starts, out = np.asarray(vectors.values), np.asarray(vectors.offsets), {}
    rows, ids, square = np.asarray(table.column(2)), table.column(3).chunk(0), np.asarray(table.column(5))
    distance = np.asarray(far.values)[far.offsets[0].as_py() : far.offsets[-1].as_py()].reshape(len(rows), -1)
    for n in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == n)
        out[n] = Part(rows[at], ids.take(pa.array(at)), flat[starts[at][:, None] + np.arange(n)], distance[at], square[at], best)
    return out


def _routed(boxes, best_only: bool):
    """Queries with the parts that they meet: the one that promises most, or all others that can reach the score known to be reached."""

    def run(batches):
        parts, low, high, longest = boxes.value
        for batch in batches:
            far = np.stack([x.values.to_numpy() for x in batch.column(4)]) if batch.num_rows else np.zeros((0, low.shape[1]))
            square, known = np.asarray(batch.column(3)), np.asarray(batch.column(5))
            for start in range(0, batch.num_rows, BLOCK):
                some = slice(start, start + BLOCK)
                bounds = box_products(far[some], square[some], low, high, longest)
                first = bounds.argmax(1)
                meets = np.zeros(bounds.shape, bool)
                meets[np.arange(len(first)), first] = True
                if not best_only:
                    meets = ~meets & (bounds >= known[some, None])
                query, part = np.nonzero(meets)
                yield pa.RecordBatch.from_arrays([pa.array(parts[part]), *batch.take(pa.array(query + start)).columns], ["part", *batch.schema.names])

    return run


def top_products(vectors: DataFrame, best: int = BEST, every: int = QUERY_IDS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by `every` the other rows with the greatest integer inner products, at most `best`, equal scores by ascending id.

    Only vectors of one length meet. Vectors that are null, hold null or non-finite components or one whose whole value has
    29 bits or more take no part. Rows that repeat an id are rows of their own; a row without id is no query and comes after
    all others of its score. Empty vectors have products of 0. Extra columns are ignored; an empty table gives an empty result.
    """
    spark, stage = vectors.sparkSession, Stage(vectors.sparkSession, "pivots")
    base = picked(vectors, vec_id=(id_col, "long"), embedding=(vector_col, "array<double>")).select(F.monotonically_increasing_id().alias("row"), "vec_id", "embedding")
    base = stage.table(base.mapInArrow(_floored, "row long, vec_id long, vector array<int>"))
    widest = base.agg(F.max(F.size("vector"))).first()[0] or 1
    # So many vectors and bytes at most, whatever the table's size, but two vectors at least.
    sample = [np.array(r[0], np.int32) for r in base.orderBy(F.xxhash64("row")).limit(max(2, min(SAMPLE, SAMPLE_BYTES // (4 * widest)))).select("vector").collect()]
    pivots = choose_pivots(sample) or [np.zeros(1)]
    fields = "row long, vec_id long, vector array<int>, size long, cell int, near double, square double, far array<double>"
    placed, n = ranked(stage, base.mapInArrow(_tabled(pivots), fields), "size", "cell", "near", "row")
    part = max(min(PART, max(LEAST_PART, n // (4 * spark.sparkContext.defaultParallelism))), math.ceil(n / MOST_PARTS))
    table = stage.table(placed.withColumn("part", F.floor(F.col("place") / part).cast("long")).select("part", "row", "vec_id", "vector", "square", "far"))

    # A row for each part, of so many at most.
    spans = [f(F.get("far", F.lit(j))).alias(f"{name}{j}") for name, f in (("low", F.min), ("high", F.max)) for j in range(len(pivots))]
    rows = table.groupBy("part").agg(F.max("square").alias("longest"), *spans).orderBy("part").collect()
    if not rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    flat = np.array([r[2:] for r in rows], np.float64)
    boxes = spark.sparkContext.broadcast((np.array([r["part"] for r in rows], np.int64), flat[:, : len(pivots)], flat[:, len(pivots) :], np.array([r["longest"] for r in rows], np.float64)))

    queries = table.where(F.col("vec_id") % every == 0).select("row", "vec_id", "vector", "square", "far", F.lit(float("-inf")).alias("known"))
    meeting = "part long, row long, vec_id long, vector array<int>, square double, far array<double>, known double"

    def met(asked: DataFrame) -> DataFrame:
        asked = stage.table(asked)
        shares = F.broadcast(asked.groupBy("part").agg(F.ceil(F.count("*") / ASKED).cast("int").alias("shares")))
        held = table.join(shares, "part").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).withColumn("known", F.lit(0.0)).withColumn("kind", F.lit(0))
        asking = asked.join(shares, "part").withColumn("share", F.pmod(F.xxhash64("row"), F.col("shares")).cast("int")).withColumn("kind", F.lit(1))
        dealt = held.unionByName(asking).repartition("part", "share").sortWithinPartitions("part", "share", "kind")
        dealt = dealt.select("part", "kind", "row", "vec_id", "vector", "square", "far", "known", "share")
        return stage.table(dealt.mapInArrow(_met(best), "row long, query_id long, vec_id long, target long, score long"))

    first = met(queries.mapInArrow(_routed(boxes, True), meeting))
    found = first
    if len(rows) > 1:
        known = first.groupBy("row").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= best).select("row", F.col("least").cast("double").alias("known"))
        asked = queries.drop("known").join(known, "row", "left").select("row", "vec_id", "vector", "square", "far", F.coalesce("known", F.lit(float("-inf"))).alias("known"))
        found = first.unionByName(met(asked.mapInArrow(_routed(boxes, False), meeting)))
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "target")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best).select("query_id", "rank", "vec_id", "score")
