"""Simplification of a whole layer that keeps shared borders shared."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import written
from . import aggregates as agg


def ring_vertices(layer: DataFrame, key: str, parts: str = "parts") -> DataFrame:
    """(key, part, ring, place, v, ends, area): each vertex of each ring without the closing one, its two neighbours in order, and the area of the triangle they make."""
    rings = layer.select(key, F.posexplode(parts).alias("part", "_p")).select(key, "part", F.posexplode("_p").alias("ring", "_r"))
    n = F.size("_r") - 1
    at = lambda i: F.element_at("_r", (i + 1).cast("int"))
    placed = rings.where(n >= 3).select(key, "part", "ring", F.explode(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(i.alias("place"), at(i).alias("v"), at((i + n - 1) % n).alias("a"), at((i + 1) % n).alias("b")))).alias("_x"))
    x = lambda f: F.col(f"_x.{f}")
    area = F.abs((x("a")["x"] - x("v")["x"]) * (x("b")["y"] - x("v")["y"]) - (x("b")["x"] - x("v")["x"]) * (x("a")["y"] - x("v")["y"])) / 2
    return placed.select(key, "part", "ring", x("place").alias("place"), x("v").alias("v"), F.array_sort(F.array(x("a"), x("b"))).alias("ends"), area.alias("area"))


def effective_areas(line: np.ndarray) -> np.ndarray:
    """For each inner vertex of a line the area that its removal takes, when always the least is taken next (Visvalingam and Whyatt): triangles are made anew with the neighbours that are left, and none counts less than one removed before."""
    n = len(line)
    before, after, out = list(range(-1, n - 1)), list(range(1, n + 1)), np.full(n, np.inf)
    span = lambda i: abs((line[before[i], 0] - line[i, 0]) * (line[after[i], 1] - line[i, 1]) - (line[after[i], 0] - line[i, 0]) * (line[before[i], 1] - line[i, 1])) / 2
    heap = [(span(i), i) for i in range(1, n - 1)]
    current = {i: area for area, i in heap}
    heapq.heapify(heap)
    most = 0.0
    while heap:
        area, i = heapq.heappop(heap)
        if current.get(i) != area:
            continue
        del current[i]
        out[i] = most = max(most, area)
        a, b = before[i], after[i]
        after[a], before[b] = b, a
        for k in (a, b):
            if k in current:
                current[k] = span(k)
                heapq.heappush(heap, (current[k], k))
    return out[1:-1]


_POINTS = "array<struct<x:double,y:double>>"
_ARROW_POINTS = pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))


def _xy(points) -> list[tuple[float, float]]:
    return [(p["x"], p["y"]) for p in points]


def _arcs(points: pa.Array, nodes: pa.Array) -> pa.Array:
    """The arcs of each ring (points without the closing one, and whether each is a node), each in the direction that begins with the lesser of its first and last pair of points; a ring without nodes is one arc from its least point."""
    out = []
    for ring, marks in zip(points.to_pylist(), nodes.to_pylist(), strict=True):
        ring, at = _xy(ring), [i for i, m in enumerate(marks) if m]
        at = at or [min(range(len(ring)), key=ring.__getitem__)]
        arcs = [ring[a : b + 1] if b > a else ring[a:] + ring[: b + 1] for a, b in zip(at, at[1:] + at[:1], strict=True)]
        out.append([[{"x": x, "y": y} for x, y in (arc if (arc[0], arc[1]) <= (arc[-1], arc[-2]) else arc[::-1])] for arc in arcs])
    return pa.array(out, pa.list_(_ARROW_POINTS))


def _weighed(arcs: pa.Array) -> pa.Array:
    """The inner vertices of arcs with their effective areas."""
    out = []
    for arc in arcs.to_pylist():
        areas = effective_areas(np.array(_xy(arc)))
        out.append([{"v": v, "area": float(a)} for v, a in zip(arc[1:-1], areas, strict=True)])
    return pa.array(out, pa.list_(pa.struct([("v", pa.struct([("x", pa.float64()), ("y", pa.float64())])), ("area", pa.float64())])))


def vertex_weights(vertices: DataFrame) -> DataFrame:
    """(v, area) for all vertices of ring_vertices(): the effective area within its arc, null for nodes. A node is where rings that pass have different neighbours; arcs between nodes are shared by neighbours and weighed once."""
    points = vertices.groupBy("v").agg(F.min("ends").alias("low"), F.max("ends").alias("high"))
    nodes = points.where("low != high").select("v", F.lit(True).alias("node"))
    marked = vertices.join(nodes, "v", "left").groupBy(*(c for c in vertices.columns if c not in ("place", "v", "ends", "area")))
    rings = marked.agg(F.array_sort(F.collect_list(F.struct("place", "v", F.coalesce("node", F.lit(False)).alias("node")))).alias("_l"))  # the vertices of one ring
    cut, weigh = F.arrow_udf(_arcs, f"array<{_POINTS}>"), F.arrow_udf(_weighed, "array<struct<v:struct<x:double,y:double>,area:double>>")
    arcs = rings.select(F.explode(cut(F.transform("_l", lambda e: e["v"]), F.transform("_l", lambda e: e["node"]))).alias("arc")).distinct()
    inner = arcs.select(F.inline(weigh("arc"))).groupBy("v").agg(F.max("area").alias("area"))
    ends = points.select("v").join(inner, "v", "left_anti")
    return inner.unionByName(ends.withColumn("area", F.lit(None).cast("double")))


def simplified_layer(layer: DataFrame, key: str, keep: float, parts: str = "parts") -> DataFrame:
    """(key, parts): the layer with about a share `keep` of the vertices that can go, those of the largest effective areas.

    A vertex can go if all rings that pass it have the same two neighbours there. The arcs of such vertices between
    those where others meet are weighed once for all rings that have them, and whether a vertex stays is decided once,
    so borders of neighbours go on meeting. Every ring keeps its three weightiest vertices at least, so no shape vanishes.
    """
    vertices = ring_vertices(layer, key, parts)
    weights = written(vertex_weights(vertices), "weights")
    weighed = vertices.drop("area").join(weights, "v")
    by_ring = Window.partitionBy(key, "part", "ring").orderBy(F.desc_nulls_first("area"), "place")  # the vertices of one ring
    needed = weighed.withColumn("_n", F.row_number().over(by_ring)).where("_n <= 3").select("v").distinct().withColumn("needed", F.lit(True))
    told = weights.join(needed, "v", "left")
    cut = agg.distribution(told, "area", {"cut": 1 - keep}).select("cut")
    stays = told.crossJoin(F.broadcast(cut)).where("needed or area is null or area > cut").select("v")  # one row
    kept = vertices.join(stays, "v").groupBy(key, "part", "ring").agg(F.array_sort(F.collect_list(F.struct("place", "v"))).alias("_l"))
    points_of: Column = F.transform("_l", lambda e: e["v"])
    rings = kept.select(key, "part", F.struct("ring", F.concat(points_of, F.slice(points_of, 1, 1)).alias("r")).alias("_r"))
    polygons = rings.groupBy(key, "part").agg(F.transform(F.array_sort(F.collect_list("_r")), lambda e: e["r"]).alias("_p"))
    return polygons.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("part", "_p"))), lambda e: e["_p"]).alias(parts))
