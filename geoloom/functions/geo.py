"""Geometry as Column expressions: distances, projections, grid and tile cells, rings.

A ring is an array of struct<x, y>; a polygon an array of rings, the outer first; a multipolygon an array of polygons.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0
RING = "array<struct<x:double,y:double>>"
POLYGON = f"array<{RING}>"
MULTIPOLYGON = f"array<{POLYGON}>"


def haversine_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    dy, dx = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    a = F.pow(F.sin(dy / 2), F.lit(2)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dx / 2), F.lit(2))
    return 2 * EARTH_M * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def local_xy(lon: Column, lat: Column, lat0: float, lon0: float = 0.0) -> tuple[Column, Column]:
    """Metres of a local equirectangular plane."""
    return (lon - lon0) * (math.cos(math.radians(lat0)) * 111_320.0), (lat - 0.0) * 110_540.0


def utm10(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Easting and northing in metres of zone 10 north, by the usual series on the WGS84 ellipsoid."""
    a, f, k0 = 6_378_137.0, 1 / 298.257223563, 0.9996
    e2 = f * (2 - f)
    ep2 = e2 / (1 - e2)
    p, dl = F.radians(lat), F.radians(lon + 123.0)
    n = a / F.sqrt(1 - e2 * F.pow(F.sin(p), F.lit(2)))
    t, c, s = F.pow(F.tan(p), F.lit(2)), ep2 * F.pow(F.cos(p), F.lit(2)), dl * F.cos(p)
    m = a * ((1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * p - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * F.sin(2 * p) + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * F.sin(4 * p) - (35 * e2**3 / 3072) * F.sin(6 * p))
    power = lambda x, k: F.pow(x, F.lit(k))
    east = k0 * n * (s + (1 - t + c) * power(s, 3) / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep2) * power(s, 5) / 120) + 500_000
    north = k0 * (m + n * F.tan(p) * (power(s, 2) / 2 + (5 - t + 9 * c + 4 * c * c) * power(s, 4) / 24 + (61 - 58 * t + t * t + 600 * c - 330 * ep2) * power(s, 6) / 720))
    return east, north


def utm10_inverse(east: Column, north: Column) -> tuple[Column, Column]:
    """Longitude and latitude from zone 10 north."""
    a, f, k0 = 6_378_137.0, 1 / 298.257223563, 0.9996
    e2 = f * (2 - f)
    ep2, e1 = e2 / (1 - e2), (1 - math.sqrt(1 - e2)) / (1 + math.sqrt(1 - e2))
    mu = north / k0 / (a * (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256))
    p = mu + (3 * e1 / 2 - 27 * e1**3 / 32) * F.sin(2 * mu) + (21 * e1**2 / 16 - 55 * e1**4 / 32) * F.sin(4 * mu) + 151 * e1**3 / 96 * F.sin(6 * mu) + 1097 * e1**4 / 512 * F.sin(8 * mu)
    power = lambda x, k: F.pow(x, F.lit(k))
    w = 1 - e2 * power(F.sin(p), 2)
    c, t, n, r = ep2 * power(F.cos(p), 2), power(F.tan(p), 2), a / F.sqrt(w), a * (1 - e2) / power(w, 1.5)
    d = (east - 500_000) / (n * k0)
    lat = p - n * F.tan(p) / r * (power(d, 2) / 2 - (5 + 3 * t + 10 * c - 4 * c * c - 9 * ep2) * power(d, 4) / 24 + (61 + 90 * t + 298 * c + 45 * t * t - 252 * ep2 - 3 * c * c) * power(d, 6) / 720)
    lon = (d - (1 + 2 * t + c) * power(d, 3) / 6 + (5 - 2 * c + 28 * t - 3 * c * c + 8 * ep2 + 24 * t * t) * power(d, 5) / 120) / F.cos(p)
    return F.degrees(lon) - 123.0, F.degrees(lat)


def looks_projected(x: Column, y: Column) -> Column:
    """Whether a pair can only be metres."""
    return (F.abs(x) > 180) | (F.abs(y) > 90)


def tile(lon: Column, lat: Column, zoom: int) -> tuple[Column, Column]:
    """Web-Mercator tile numbers; latitudes beyond the square are clamped."""
    n = float(1 << zoom)
    r = F.radians(F.greatest(F.lit(-85.05112878), F.least(F.lit(85.05112878), lat)))
    x = F.floor((lon + 180) / 360 * n)
    y = F.floor((1 - F.log(F.tan(r) + 1 / F.cos(r)) / math.pi) / 2 * n)
    clamp = lambda c: F.greatest(F.lit(0), F.least(F.lit(int(n) - 1), c)).cast("int")
    return clamp(x), clamp(y)


def grid_steps(km: float, lat0: float) -> tuple[float, float]:
    """Steps in degrees of longitude and latitude of a grid of so many kilometres."""
    lat = km / 111.32
    return lat / max(math.cos(math.radians(lat0)), 0.1), lat


def cell(v: Column, origin: float, step: float) -> Column:
    return F.floor((v - origin) / step).cast("long")


def segment_projection(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> tuple[Column, Column, Column]:
    """(share along the segment from 0 to 1, nearest x, nearest y); a segment of no length is its first point."""
    dx, dy = bx - ax, by - ay
    length = dx * dx + dy * dy
    t = F.when(length > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - ax) * dx + (py - ay) * dy) / F.when(length > 0, length)))).otherwise(0.0)
    return t, ax + t * dx, ay + t * dy


def segment_distance(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    _, x, y = segment_projection(px, py, ax, ay, bx, by)
    return F.hypot(px - x, py - y)


def angle_penalty(ax: Column, ay: Column, bx: Column, by: Column, scale: float = 45.0) -> Column:
    """From 0 for vectors on one line to scale for a right angle."""
    norm = F.hypot(ax, ay) * F.hypot(bx, by)
    return F.when(norm > 0, (1 - F.abs((ax * bx + ay * by) / F.when(norm > 0, norm))) * scale).otherwise(scale)


def edges(ring: Column) -> Column:
    """array<struct<a, b>> of consecutive points."""
    n = F.greatest(F.size(ring) - 1, F.lit(0))
    return F.zip_with(F.slice(ring, 1, n), F.slice(ring, 2, n), lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Even-odd rule, half-open in y: a ray to the right crosses an odd number of edges."""

    def crossed(e: Column) -> Column:
        a, b = e["a"], e["b"]
        spans = (a["y"] > y) != (b["y"] > y)
        return spans & (x < (b["x"] - a["x"]) * (y - a["y"]) / F.when(spans, b["y"] - a["y"]) + a["x"])

    return F.size(F.filter(edges(ring), crossed)) % 2 == 1


def turn(ax: Column, ay: Column, bx: Column, by: Column, px: Column, py: Column) -> Column:
    """1, 0 or -1: whether p lies to the left of the line from a to b, on it or to its right."""
    return F.signum((bx - ax) * (py - ay) - (by - ay) * (px - ax))


def on_ring(x: Column, y: Column, ring: Column) -> Column:
    """Whether a point is on one of a ring's edges."""

    def touched(e: Column) -> Column:
        a, b = e["a"], e["b"]
        within = x.between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"])) & y.between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"]))
        return within & (turn(a["x"], a["y"], b["x"], b["y"], x, y) == 0)

    return F.exists(edges(ring), touched)


def in_polygon(x: Column, y: Column, polygon: Column, border: bool = False) -> Column:
    """Inside the outer ring and in none of the holes. With border, points on any ring are inside, else the half-open rule decides."""
    holes = F.slice(polygon, 2, F.greatest(F.size(polygon) - 1, F.lit(1)))
    inside = in_ring(x, y, F.element_at(polygon, 1)) & ~F.exists(holes, lambda hole: in_ring(x, y, hole))
    return inside | F.exists(polygon, lambda r: on_ring(x, y, r)) if border else inside


def in_multipolygon(x: Column, y: Column, parts: Column, border: bool = False) -> Column:
    return F.exists(parts, lambda p: in_polygon(x, y, p, border))


def segments_meet(ax: Column, ay: Column, bx: Column, by: Column, cx: Column, cy: Column, dx: Column, dy: Column) -> Column:
    """Whether the segments from a to b and from c to d share a point."""
    level = lambda a, b, c, d: (F.greatest(a, b) >= F.least(c, d)) & (F.greatest(c, d) >= F.least(a, b))
    apart = lambda *p: turn(*p[:4], *p[4:6]) * turn(*p[:4], *p[6:]) <= 0
    return level(ax, bx, cx, dx) & level(ay, by, cy, dy) & apart(ax, ay, bx, by, cx, cy, dx, dy) & apart(cx, cy, dx, dy, ax, ay, bx, by)


def ring_area(ring: Column) -> Column:
    """Unsigned shoelace area."""
    return F.abs(F.aggregate(edges(ring), F.lit(0.0), lambda s, e: s + e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"])) / 2


def multipolygon_area(parts: Column) -> Column:
    """Outer rings less their holes, none below zero."""
    one = lambda p: F.greatest(F.lit(0.0), 2 * ring_area(F.element_at(p, 1)) - F.aggregate(p, F.lit(0.0), lambda s, r: s + ring_area(r)))
    return F.aggregate(parts, F.lit(0.0), lambda s, p: s + one(p))


def ring_area_sphere(ring: Column) -> Column:
    """Square metres of a ring of degrees on the sphere."""
    term = lambda e: F.radians(e["b"]["x"] - e["a"]["x"]) * (2 + F.sin(F.radians(e["a"]["y"])) + F.sin(F.radians(e["b"]["y"])))
    return F.abs(F.aggregate(edges(ring), F.lit(0.0), lambda s, e: s + term(e))) * EARTH_M * EARTH_M / 2


def line_length_m(line: Column) -> Column:
    return F.aggregate(edges(line), F.lit(0.0), lambda s, e: s + haversine_m(e["a"]["x"], e["a"]["y"], e["b"]["x"], e["b"]["y"]))


def points(parts: Column) -> Column:
    return F.flatten(F.flatten(parts))


def bbox(parts: Column) -> Column:
    """struct(xmin, ymin, xmax, ymax) over all points of a multipolygon."""
    p = points(parts)
    take = lambda f, k: f(F.transform(p, lambda q: q[k]))
    return F.struct(take(F.array_min, "x").alias("xmin"), take(F.array_min, "y").alias("ymin"), take(F.array_max, "x").alias("xmax"), take(F.array_max, "y").alias("ymax"))


def vertex_mean(parts: Column, closing: bool = True) -> Column:
    """struct(x, y): the mean of all vertices, with the closing ones of the rings or without."""
    p = points(parts) if closing else F.flatten(F.transform(F.flatten(parts), lambda r: F.slice(r, 1, F.greatest(F.size(r) - 1, F.lit(0)))))
    mean = lambda k: F.aggregate(p, F.lit(0.0), lambda s, q: s + q[k]) / F.size(p)
    return F.struct(mean("x").alias("x"), mean("y").alias("y"))


def ring_centroid(ring: Column) -> Column:
    """struct(x, y): the centroid of the ring's area."""
    cross = lambda e: e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"]
    total = F.aggregate(edges(ring), F.lit(0.0), lambda s, e: s + cross(e))
    part = lambda k: F.aggregate(edges(ring), F.lit(0.0), lambda s, e: s + (e["a"][k] + e["b"][k]) * cross(e)) / (3 * F.nullif(total, F.lit(0.0)))
    return F.struct(part("x").alias("x"), part("y").alias("y"))


def bbox_order(a: Column, b: Column, c: Column, d: Column) -> Column:
    """[west, south, east, north] from the two corners in any order."""
    return F.array(F.least(a, c), F.least(b, d), F.greatest(a, c), F.greatest(b, d))


def edge_key(x1: Column, y1: Column, x2: Column, y2: Column, digits: int = 5) -> Column:
    """One key for both directions of an edge."""
    end = lambda x, y: F.concat_ws(",", F.format_number(x, f"0.{'0' * digits}"), F.format_number(y, f"0.{'0' * digits}"))
    return F.array_join(F.array_sort(F.array(end(x1, y1), end(x2, y2))), "|")


def snapped(v: Column, step: float) -> Column:
    return F.floor(v / step + 0.5) * step


def bound(c: Column, use) -> Column:
    """use(c) with c evaluated once, however often use names it."""
    return F.element_at(F.transform(F.array(c), use), 1)


def closed(ring: Column) -> Column:
    """A ring whose last point is its first."""
    return F.when((F.size(ring) > 0) & (F.element_at(ring, 1) != F.element_at(ring, -1)), F.concat(ring, F.slice(ring, 1, 1))).otherwise(ring)


def _half(ring: Column, axis: str, limit: float, above: bool) -> Column:
    """A closed ring cut by a line along an axis: the part on one side."""
    other = "y" if axis == "x" else "x"
    inside = lambda p: p[axis] >= limit if above else p[axis] <= limit

    def kept(e: Column) -> Column:
        a, b = e["a"], e["b"]
        share = (F.lit(limit) - a[axis]) / F.nullif(b[axis] - a[axis], F.lit(0.0))
        cross = {axis: F.lit(float(limit)), other: a[other] + share * (b[other] - a[other])}
        at = F.struct(cross["x"].alias("x"), cross["y"].alias("y"))
        own = F.struct(b["x"].alias("x"), b["y"].alias("y"))
        return F.when(inside(a) & inside(b), F.array(own)).when(inside(a), F.array(at)).when(inside(b), F.array(at, own)).otherwise(F.array().cast(RING))

    return bound(F.flatten(F.transform(edges(ring), kept)), closed)


def clipped(parts: Column, west: float, south: float, east: float, north: float) -> Column:
    """A multipolygon cut by a box, edge by edge; rings of fewer than four points go, and polygons without an outer ring. Null where nothing is left."""
    cut = lambda r: bound(bound(bound(_half(r, "x", west, True), lambda q: _half(q, "x", east, False)), lambda q: _half(q, "y", south, True)), lambda q: _half(q, "y", north, False))
    polygon = lambda p: bound(F.transform(p, cut), lambda rings: F.when(F.size(F.element_at(rings, 1)) >= 4, F.filter(rings, lambda r: F.size(r) >= 4)))
    return bound(F.filter(F.transform(parts, polygon), lambda p: p.isNotNull()), lambda m: F.when(F.size(m) > 0, m))


def geometry_text(parts: Column) -> Column:
    """A multipolygon as JSON text of coordinates."""
    return F.to_json(F.transform(parts, lambda p: F.transform(p, lambda r: F.transform(r, lambda q: F.array(q["x"], q["y"])))))


def projected_or_degrees(x: Column, y: Column) -> tuple[Column, Column]:
    """Metres of zone 10 north, whether the pair is given so or in degrees."""
    east, north = utm10(x, y)
    metres = looks_projected(x, y)
    return F.when(metres, x).otherwise(east), F.when(metres, y).otherwise(north)
