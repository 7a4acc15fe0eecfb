"""Indexed joins of shapes, repair and simplification against plain loops, and orders with nulls."""

import random
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from geoloom.functions import arrangement, geo, shapes, text
from geoloom.operators import relational, spatial, topology

SHAPES = f"id int, parts {geo.MULTIPOLYGON}"


def box(x, y, w, h=None):
    h = w if h is None else h
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]


def frame(spark, shapes_, name="id"):
    return spark.createDataFrame([(i, [[[{"x": float(x), "y": float(y)} for x, y in r] for r in p] for p in parts]) for i, parts in shapes_], f"{name} int, parts {geo.MULTIPOLYGON}")


def ring_holds(p, ring):
    return sum((a[1] > p[1]) != (b[1] > p[1]) and p[0] < (b[0] - a[0]) * (p[1] - a[1]) / (b[1] - a[1]) + a[0] for a, b in zip(ring, ring[1:], strict=False)) % 2 == 1


def holds(p, parts):
    return any(ring_holds(p, q[0]) and not any(ring_holds(p, h) for h in q[1:]) for q in parts)


def turn(a, b, p):
    return np.sign((b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0]))


def meet(a, b, c, d):
    level = all(max(min(a[k], b[k]), min(c[k], d[k])) <= min(max(a[k], b[k]), max(c[k], d[k])) for k in (0, 1))
    return level and turn(a, b, c) * turn(a, b, d) <= 0 and turn(c, d, a) * turn(c, d, b) <= 0


def edges(parts):
    return [e for p in parts for r in p for e in zip(r, r[1:], strict=False)]


def intersect(p, q):
    return any(meet(*e, *f) for e in edges(p) for f in edges(q)) or any(holds(x[0][0], q) for x in p) or any(holds(x[0][0], p) for x in q)


def test_points_among_one_huge_and_many_small_polygons(spark):
    rng = random.Random(6)
    given = [(0, [[box(-180, -90, 360, 180), box(-1, -1, 2)]])] + [(i, [[box(rng.uniform(-3, 3), rng.uniform(-3, 3), rng.choice((0.001, 0.05, 0.6)))]]) for i in range(1, 300)]
    points = [(i, rng.uniform(-4, 4), rng.uniform(-4, 4)) for i in range(500)] + [(500, float("nan"), 1.0), (501, None, 1.0), (502, float("inf"), 0.0)]
    df, polygons = spark.createDataFrame(points, "k int, x double, y double"), frame(spark, given)
    got = spatial.points_in_polygons(df, polygons, "x", "y")
    want = {(k, i) for k, x, y in points[:500] for i, parts in given if holds((x, y), parts)}
    assert {(r["k"], r["id"]) for r in got.collect()} == want and got.count() == len(want)
    index = spatial.ShapeIndex(polygons)
    copies = index.boxes("s", "b").select("s", F.size(spatial.cells_at(F.col("b"), F.array(spatial.level_of(F.col("b"))))).alias("n")).agg(F.max("n"), F.count("*")).first()
    assert copies[0] <= 4 and copies[1] == 300 and len(index.levels) <= 5
    # Geometries are not read by the side that tests boxes.
    plan = spatial.box_pairs(df.withColumn("lbox", F.struct(F.col("x").alias("xmin"), F.col("y").alias("ymin"), F.col("x").alias("xmax"), F.col("y").alias("ymax"))), index.boxes("s", "rbox"), [], index.levels)._jdf.queryExecution().toString()
    assert "parts" not in plan.split("== Physical Plan ==")[1]


def test_borders_count_where_asked(spark):
    polygons = frame(spark, [(1, [[box(0, 0, 4), box(1, 1, 2)]])])
    points = [(0, 0.0, 0.0), (1, 4.0, 2.0), (2, 2.0, 4.0), (3, 1.0, 2.0), (4, 3.0, 3.0), (5, 2.0, 2.0), (6, 0.5, 0.5), (7, 4.0, 4.1)]
    df = spark.createDataFrame(points, "k int, x double, y double")
    assert {r["k"] for r in spatial.points_in_polygons(df, polygons, "x", "y", border=True).collect()} == {0, 1, 2, 3, 4, 6}
    mean = frame(spark, [(1, [[[(0, 0), (3, 0), (0, 3), (0, 0)]]])]).select(geo.vertex_mean(F.col("parts"), closing=False).alias("m")).first()["m"]
    assert tuple(mean) == (1.0, 1.0)


def test_intersecting_shapes_are_those_of_brute_force(spark):
    rng = random.Random(8)

    def star(x, y, size):
        n = rng.randint(3, 9)
        at = sorted(rng.uniform(0, 6.28) for _ in range(n))
        ring = [(x + size * rng.uniform(0.3, 1) * np.cos(t), y + size * rng.uniform(0.3, 1) * np.sin(t)) for t in at]
        return [(float(a), float(b)) for a, b in [*ring, ring[0]]]

    one = [(i, [[star(rng.uniform(0, 20), rng.uniform(0, 20), rng.choice((0.3, 2, 6)))]]) for i in range(40)]
    two = [(i, [[star(rng.uniform(0, 20), rng.uniform(0, 20), rng.choice((0.2, 1, 9)))] for _ in range(rng.choice((1, 1, 2)))]) for i in range(40)]
    one += [(100, [[box(30, 30, 8), box(32, 32, 4)]]), (101, [[box(50, 50, 1)]]), (102, [[box(60, 60, 2)]]), (103, [[box(-1000, -1000, 3000)]]), (104, [[box(80, 80, 1)], [box(90, 90, 1)]])]
    # In a hole, in the ring, touching by a corner, by a border, inside, around.
    two += [(200, [[box(33, 33, 1)]]), (201, [[box(30.5, 30.5, 0.5)]]), (202, [[box(51, 51, 1)]]), (203, [[box(49, 50.5, 1, 0.1)]]), (204, [[box(60.5, 60.5, 0.5)]]), (205, [[box(59, 59, 4)]]), (206, [[box(32, 33, 0.5)]]), (207, [[box(90.2, 90.2, 0.1)]])]
    want = sorted((i, j) for i, p in one for j, q in two if intersect(p, q))
    got = spatial.polygons_intersecting(frame(spark, one), frame(spark, two, "other"), "id", "other")
    assert sorted(map(tuple, got.collect())) == want
    assert {(101, 202), (101, 203), (102, 204), (102, 205), (100, 201), (100, 206), (104, 207)} <= set(want) and (100, 200) not in want


def test_areas_by_name_centre_or_touch(spark):
    known = frame(spark, [(1, [[box(0, 0, 2)]]), (2, [[box(10, 0, 2)]]), (3, [[box(20, 0, 8), box(22, 2, 4)]])], "k").withColumn("name", F.concat(F.lit("b"), "k"))
    areas = frame(spark, [(1, [[box(100, 100, 1)]]), (2, [[box(-1, -1, 3, 3)]]), (3, [[box(11, 1, 5)]]), (4, [[box(12, 0, 1)]]), (5, [[box(22.5, 2.5, 1)]]), (6, [[box(0.9, 0.9, 11)]])], "a").withColumn("slug", F.when(F.col("a") == 1, "b3").otherwise("none"))
    got = sorted(map(tuple, spatial.area_cascade(areas, known, "a", "slug", "k", "name").collect()))
    assert got == [(1, 1, 3), (2, 2, 1), (3, 2, 2), (4, 3, 2), (5, None, None), (6, 2, 1), (6, 2, 2)]


def area(polygons):
    one = lambda r: abs(np.sum(r[:-1, 0] * r[1:, 1] - r[1:, 0] * r[:-1, 1])) / 2
    return [float(one(p[0]) - sum(map(one, p[1:]))) for p in polygons]


def test_crossing_rings_become_valid():
    a = lambda *p: np.array(p, float)
    b = lambda *p: a(*box(*p))
    eight = a((0, 0), (2, 2), (2, 0), (0, 2), (0, 0))
    assert area(shapes.made_valid([eight])) == [1, 1]
    assert area(shapes.made_valid([a((0, 0), (2, 0), (2, 2), (2, 5), (2, 2), (0, 2), (0, 0))])) == [4]
    assert sorted(area(shapes.made_valid([b(0, 0, 4), b(3, 1, 2)]))) == [2, 14]
    touching = shapes.made_valid([b(0, 0, 4), a((0, 0), (2, 1), (1, 2), (0, 0))])
    assert area(touching) == [14.5] and len(touching[0]) == 2
    assert sorted(area(shapes.made_valid([b(0, 0, 8), b(1, 1, 6), b(2, 2, 4), eight + 3]))) == [14, 28]
    assert shapes.made_valid([]) == [] and shapes.made_valid([a((0, 0), (1, 1), (0, 0))]) == []
    rng = random.Random(1)
    for _ in range(60):
        rings = [a(*r, r[0]) for n in (rng.randint(4, 14), 5) for r in [[(rng.randint(0, 12), rng.randint(0, 12)) for _ in range(n)]]]
        made = shapes.made_valid(rings)
        for _ in range(40):
            p = (rng.random() * 12, rng.random() * 12)
            inside = sum(ring_holds(p, [tuple(x) for x in r]) for r in rings) % 2
            assert sum(holds(p, [[[tuple(x) for x in r] for r in q]]) for q in made) == inside
        for q in made:
            for r in q:
                assert len(r) >= 4 and len({tuple(x) for x in r.tolist()}) == len(r) - 1
    odd, _ = arrangement.pieces([b(0, 0, 1)])
    assert all(isinstance(c, Fraction) for e in odd for p in e for c in p)


def plain_areas(line):
    """Effective areas with all triangles made anew at each step."""
    left, out, most = list(range(len(line))), {}, 0.0
    size = lambda a, b, c: abs((a[0] - b[0]) * (c[1] - b[1]) - (c[0] - b[0]) * (a[1] - b[1])) / 2
    while len(left) > 2:
        area_, k = min((size(line[left[i - 1]], line[left[i]], line[left[i + 1]]), left[i]) for i in range(1, len(left) - 1))
        out[k] = most = max(most, area_)
        left.remove(k)
    return [out[i] for i in range(1, len(line) - 1)]


def test_effective_areas_equal_plain_loop():
    rng = np.random.default_rng(2)
    for n in (2, 3, 4, 40):
        line = rng.normal(size=(n, 2))
        assert topology.effective_areas(line).tolist() == plain_areas([tuple(p) for p in line.tolist()])


def test_neighbours_keep_their_borders(spark):
    """Nine cells with wiggly borders, one of them a hole's filling, and a tiny island: 3 percent stay, borders go on being the same."""
    rng = random.Random(5)
    memo = {}

    def border(a, b):
        if (b, a) in memo:
            return memo[b, a][::-1]
        if (a, b) not in memo:
            steps = [(a[0] + (b[0] - a[0]) * t / 60, a[1] + (b[1] - a[1]) * t / 60) for t in range(61)]
            memo[a, b] = [p if i in (0, 60) else (p[0] + rng.uniform(-0.04, 0.04), p[1] + rng.uniform(-0.04, 0.04)) for i, p in enumerate(steps)]
        return memo[a, b]

    def ring(x, y):
        corners = [(x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1)]
        out = [p for a, b in zip(corners, corners[1:] + corners[:1], strict=True) for p in border(a, b)[:-1]]
        return [*out, out[0]]

    lake = [(0.5 + 0.2 * np.cos(t / 10), 0.5 + 0.2 * np.sin(t / 10)) for t in range(62)]
    lake = [(float(x), float(y)) for x, y in [*lake, lake[0]]]
    cells = [(3 * y + x, [[ring(x, y), *([lake[::-1]] if x == y == 0 else [])]]) for x in range(3) for y in range(3)]
    layer = [*cells, (20, [[lake]]), (21, [[[(9, 9), (9.01, 9), (9.01, 9.01), (9, 9.01), (9, 9)]]])]
    kept = {r["id"]: r["parts"] for r in topology.simplified_layer(frame(spark, layer), "id", 0.03).collect()}
    before, after = sum(len(r) for _, parts in layer for p in parts for r in p), sum(len(r) for parts in kept.values() for p in parts for r in p)
    assert set(kept) == {i for i, _ in layer} and after < 0.12 * before
    sides = lambda parts: [frozenset(((e[0]["x"], e[0]["y"]), (e[1]["x"], e[1]["y"]))) for p in parts for r in p for e in zip(r, r[1:], strict=False)]
    count = {}
    for parts in kept.values():
        for e in sides(parts):
            count[e] = count.get(e, 0) + 1
    # Every edge inside the layer belongs to two shapes still, and the whole has the area of its outline.
    inner = [e for e, n in count.items() if all(0.1 < c < 2.9 for p in e for c in p)]
    assert inner and all(count[e] == 2 for e in inner)
    assert all(len(r) >= 4 for parts in kept.values() for p in parts for r in p)
    assert {frozenset(e) for e in sides(kept[20])} <= set(sides(kept[0]))


def test_nulls_are_last_in_orders_of_a_key(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 5, "b"), (1, 3, "c"), (2, None, "d")], "k int, i int, v string")
    assert sorted(map(tuple, relational.last_per_key(df, ["k"], "i").collect())) == [(1, 5, "b"), (2, None, "d")]
    assert sorted(map(tuple, relational.first_per_key(df, ["k"], F.col("i")).collect())) == [(1, 3, "c"), (2, None, "d")]


def test_names_of_archives_and_sizes(spark):
    names = [("aqfpm_01_2026-01-02_03-04-05_annual.zip", "aqfpm_01", "annual"), ("/x/nhacs_ava_2026-05-07_20-31-54_annual.zip", "nhacs_ava", "annual"), ("grlan_2020-01-01_00-00-00_MONTHLY.zip", "grlan", "monthly"), ("cbm_monthly.zip", "cbm_monthly", "monthly"), ("plain.zip", "plain", "annual")]
    got = spark.createDataFrame([(n,) for n, _, _ in names], "p string").select("p", text.archive_name(F.col("p")).alias("a")).collect()
    assert {r["p"]: tuple(r["a"]) for r in got} == {n: (d, c) for n, d, c in names}
    sizes = {0: "0 B", 1023: "1023 B", 1024: "1.0 KB", 1024**2 - 1: "1024.0 KB", 5_500_000: "5.2 MB", 5_486_940_000: "5.11 GB", 3 * 1024**4 // 2: "1.50 TB"}
    got = spark.createDataFrame([(b,) for b in sizes], "b long").select("b", text.byte_size(F.col("b")).alias("s")).collect()
    assert {r["b"]: r["s"] for r in got} == sizes
