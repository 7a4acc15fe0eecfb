"""Work on single geometries that needs loops over points: simplification and the grouping of rings. Each is a function of one geometry; Spark hands them out in Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import arrangement
from .geo import MULTIPOLYGON


def _apart(p: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of points from a segment."""
    d = b - a
    t = np.clip(((p - a) @ d) / (d @ d), 0, 1)[:, None] if d @ d else 0.0
    return ((p - (a + t * d)) ** 2).sum(1)


def simplified_line(points: np.ndarray, tolerance: float) -> np.ndarray:
    """Points nearer to the last kept one than the tolerance go; of the rest, those that a chord passes within it (Douglas and Peucker)."""
    limit, kept = tolerance * tolerance, [0]
    for i in range(1, len(points)):
        if ((points[i] - points[kept[-1]]) ** 2).sum() > limit:
            kept.append(i)
    if kept[-1] != len(points) - 1:
        kept.append(len(points) - 1)
    p = points[kept]
    stay, open_ = np.zeros(len(p), bool), [(0, len(p) - 1)]
    stay[[0, -1]] = True
    while open_:
        a, b = open_.pop()
        if b - a > 1:
            apart = _apart(p[a + 1 : b], p[a], p[b])
            k = int(apart.argmax())
            if apart[k] > limit:
                stay[a + 1 + k] = True
                open_ += [(a, a + 1 + k), (a + 1 + k, b)]
    return p[stay]


def simplified_ring(points: np.ndarray, tolerance: float) -> np.ndarray:
    """A closed ring simplified, by ever less (a hundredth each time) until it is still a ring; as it is if it has no more than four points."""
    if len(points) <= 4:
        return points
    for _ in range(2000):
        out = simplified_line(points, tolerance)
        if (out[0] != out[-1]).any():
            out = np.vstack((out, out[:1]))
        if len(out) > 4 or len(out) == 4 and len(np.unique(out, axis=0)) == 3:
            return out
        tolerance *= 0.99
    return points


def regrouped(rings: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Polygons from rings in any order: a ring inside an even number of others is an outer one, each other is a hole of the smallest outer one that holds a point of it."""
    area = lambda r: abs(np.sum(r[:-1, 0] * r[1:, 1] - r[1:, 0] * r[:-1, 1])) / 2
    rings = sorted((r for r in rings if len(r) >= 4 and area(r) > 0), key=area, reverse=True)
    holds = [[k for k in range(i) if _inside(_a_point_of(r), rings[k])] for i, r in enumerate(rings)]
    outer = {i: [r] for i, r in enumerate(rings) if len(holds[i]) % 2 == 0}
    for i, r in enumerate(rings):
        if i not in outer:
            outer[max(k for k in holds[i] if k in outer)].append(r)
    return list(outer.values())


def _inside(p: np.ndarray, ring: np.ndarray) -> bool:
    a, b = ring[:-1], ring[1:]
    spans = (a[:, 1] > p[1]) != (b[:, 1] > p[1])
    return bool(np.count_nonzero(p[0] < (b[spans, 0] - a[spans, 0]) * (p[1] - a[spans, 1]) / (b[spans, 1] - a[spans, 1]) + a[spans, 0]) % 2)


def _a_point_of(ring: np.ndarray) -> np.ndarray:
    """A point inside a ring: the middle of the first stretch of a level line between its vertices' heights."""
    ys = np.unique(ring[:, 1])
    y = (ys[len(ys) // 2] + ys[len(ys) // 2 - 1]) / 2 if len(ys) > 1 else ys[0]
    a, b = ring[:-1], ring[1:]
    spans = (a[:, 1] > y) != (b[:, 1] > y)
    xs = np.sort((b[spans, 0] - a[spans, 0]) * (y - a[spans, 1]) / (b[spans, 1] - a[spans, 1]) + a[spans, 0])
    return np.array([(xs[0] + xs[1]) / 2, y]) if len(xs) > 1 else ring[0]


def _array(ring) -> np.ndarray:
    return np.array([(p["x"], p["y"]) for p in ring], float).reshape(-1, 2)


def _rows(polygons: list[list[np.ndarray]]) -> list:
    return [[[{"x": float(x), "y": float(y)} for x, y in ring] for ring in p] for p in polygons]


ARROW = pa.list_(pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))))


def _each(parts: Column, work) -> Column:
    """work on the rings of each multipolygon, by Arrow batches (rings of different lengths are no matrix)."""

    @F.arrow_udf(MULTIPOLYGON)
    def run(c: pa.Array) -> pa.Array:
        return pa.array([None if m is None else _rows(work([[_array(r) for r in p] for p in m])) for m in c.to_pylist()], ARROW)

    return run(parts)


def simplified(parts: Column, tolerance: float) -> Column:
    """Each ring of a multipolygon simplified by itself."""
    return _each(parts, lambda m: [[simplified_ring(r, tolerance) for r in p] for p in m])


def made_valid(rings: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Valid polygons of what lies in an odd number of the rings. Rings that touch none are grouped by what lies in what; others are cut where they meet first. Spikes and what rings share go."""
    closed = [np.vstack((r, r[:1])) if len(r) and (r[0] != r[-1]).any() else r for r in rings]
    cut = arrangement.repaired([r for r in closed if len(r) >= 4 and np.isfinite(r).all()])
    return regrouped(closed) if cut is None else cut


def repaired(parts: Column) -> Column:
    """A multipolygon made valid from its rings, in whatever order and however they cross."""
    return _each(parts, lambda m: made_valid([r for p in m for r in p]))
