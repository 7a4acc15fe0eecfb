"""Queries whose tables have few keys: joins make no more rows than their results need, and the results are those of all pairs."""

import random

from pyspark.sql import functions as F

from geoloom.operators import aggregates, relational, spatial


def most_rows(df) -> int:
    """Runs df; the rows of the step that made most."""
    df._jdf.collectToPython()
    plan = lambda p: p.executedPlan() if "AdaptiveSparkPlan" in p.getClass().getName() else p.plan() if "QueryStage" in p.getClass().getName() else p

    def below(p):
        inner = plan(p)
        if inner is not p and not inner.equals(p):
            yield from below(inner)
        else:
            m = p.metrics().get("numOutputRows")
            yield m.get().value() if m.isDefined() else 0
            for i in range(p.children().size()):
                yield from below(p.children().apply(i))

    return max(below(df._jdf.queryExecution().executedPlan()))


def test_tiers_of_keys_are_those_of_the_cascade(spark):
    source = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None), (None, "a"), (2, "b"), (6, "z"), (6, "z")], "id int, k string")
    known = spark.createDataFrame([(1, "a", 10), (7, "a", 11), (8, "b", None), (1, "q", 12), (None, None, 13)], "n int, k2 string, t int")
    tiers = [source.join(known, F.col("id") == F.col("n")).select("id", "t"), source.join(known, F.col("k") == F.col("k2")).select("id", "t")]
    key = lambda r: tuple((x is None, x) for x in r)
    want = sorted(map(tuple, relational.cascade(source, "id", tiers, "t").collect()), key=key)
    assert sorted(map(tuple, relational.key_cascade(source, "id", known, "t", [("id", "n"), ("k", "k2")]).collect()), key=key) == want
    # Ids that the first tier matches make no pairs in the second.
    many, few = spark.range(1000).select("id", F.lit(1).alias("k")), spark.range(1000).select(F.col("id").alias("n"), F.lit(1).alias("k2"), F.col("id").alias("t"))
    assert most_rows(relational.key_cascade(many, "id", few, "t", [("id", "n"), ("k", "k2")])) <= 16000


def test_results_of_crowded_keys_take_little_room_as_columns(spark, tmp_path):
    source, known = spark.range(400).select("id", F.lit(1).alias("k")), spark.range(5000).select((F.col("id") + 1000).alias("n"), F.lit(1).alias("k2"), F.col("id").alias("t"))
    relational.key_cascade(source, "id", known, "t", [("id", "n"), ("k", "k2")]).write.parquet(f"{tmp_path}/r")
    assert spark.read.parquet(f"{tmp_path}/r").distinct().count() == 2_000_000
    assert sum(p.stat().st_size for p in tmp_path.glob("r/*.parquet")) < 1_000_000


def test_block_join_is_the_join(spark, monkeypatch):
    left = spark.createDataFrame([(i, i % 3 if i % 5 else 8, "a") for i in range(60)] + [(1, 8, "a"), (7, None, "b")], "i int, k int, s string")
    right = spark.createDataFrame([(i % 3, None if i % 7 == 0 else i) for i in range(100)] + [(0, 3), (0, 3), (8, 1), (9, 1), (None, 2)], "r int, v int")
    want = sorted(map(str, left.join(right, F.col("k") == F.col("r")).select("i", "k", "s", "r", "v").collect()))
    for block, pairs in ((168, 1 << 22), (3, 50), (1, 1)):
        monkeypatch.setattr(relational, "BLOCK", block)
        monkeypatch.setattr(relational, "PAIRS", pairs)
        assert sorted(map(str, relational.block_join(left, right, "k", "r").collect())) == want and len(want) > 1000


def test_scores_by_keys_are_those_of_all_pairs(spark):
    draw = random.Random(3)
    side = lambda n, mark: spark.createDataFrame([(i, i % 7 if i % 11 else None, draw.choice([1, 2, 3, None])) for i in range(n)], f"{mark} int, name int, street int")
    left, right = side(60, "l"), side(40, "r")
    pairs = lambda c: left.join(right.withColumnRenamed(c, "other"), F.col(c) == F.col("other")).select("l", "r")
    want = sorted(map(tuple, relational.scored_matches(pairs("name"), pairs("street"), "l", "r").collect()))
    assert sorted(map(tuple, relational.scored_by_keys(left, right, "l", "r", ["name"], ["street"]).collect())) == want
    ids = lambda n, mark: spark.range(n).select(F.col("id").alias(mark), F.lit(1).alias("name"), F.lit(1).alias("street"))
    assert most_rows(relational.scored_by_keys(ids(2000, "l"), ids(1000, "r"), "l", "r", ["name"], ["street"])) <= 4000


def test_buckets_of_places(spark):
    d = spark.createDataFrame([(50.0, 3), (200.0, 2), (5000.0, 4), (None, 9)], "d double, n long")
    assert tuple(aggregates.cumulative_buckets(d, "d", (100, 500), "n").first()) == (3, 5, 4, 9)
    assert tuple(aggregates.cumulative_buckets(d, "d", (100, 500)).first()) == (1, 2, 1, 3)


def test_distances_are_those_of_places(spark, tmp_path):
    from geoloom.plans.queries import queries

    spark.range(2000).select((F.col("id") % 20 * 26000).alias("c_custkey"), F.lit(1).alias("c_nationkey")).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(1000).select((F.col("id") * 26000 + 5).alias("s_suppkey"), F.lit(1).alias("s_nationkey")).write.parquet(f"{tmp_path}/supplier.parquet")
    found = queries()["haversine_buckets"](spark, str(tmp_path))
    assert found.first()["known"] == 2_000_000
    assert most_rows(found) <= 2000


def test_a_piece_of_a_route_is_looked_up_once(spark):
    draw = random.Random(5)
    line = lambda i: (i, *(draw.uniform(0, 200) for _ in range(4)))
    routes, roads = (spark.createDataFrame([line(i) for i in range(n)], f"{k} int, ax double, ay double, bx double, by double") for n, k in ((400, "k"), (3, "seg")))
    wide, narrow = (spatial.nearest_for_segments(routes, roads, "k", "seg", cell, 30.0, 50.0) for cell in (1000.0, 10.0))
    assert sorted(wide.collect()) == sorted(narrow.collect()) and wide.where("seg is not null").count() > 5
    assert "SortMergeJoin" in next(x for x in wide._jdf.queryExecution().executedPlan().toString().splitlines() if "LeftOuter" in x)
    assert most_rows(narrow) <= 1200 + 3 * 41 * 41


def test_points_in_any_of_many_polygons(spark, monkeypatch):
    draw = random.Random(11)
    box = lambda x, y, w, h: [{"x": a, "y": b} for a, b in ((x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y))]
    shapes = [(i, [[box(x, y, w, h), box(x + w / 4, y + h / 4, w / 2, h / 2)]]) for i in range(60) for x, y, w, h in [(draw.uniform(-9, 9), draw.uniform(-9, 9), draw.uniform(0.1, 3), draw.uniform(0.1, 3))]]
    shapes += [(99, [[[{"x": 20.0, "y": 0.0}, {"x": 30.0, "y": 1.0}, {"x": 22.0, "y": 9.0}, {"x": 20.0, "y": 0.0}]]]), (100, [[[{"x": 5.0, "y": 5.0}]]]), (101, None), (102, [[box(-10.5, -10.5, 20.0, 20.0)]])]
    polygons = spark.createDataFrame(shapes, "i int, parts array<array<array<struct<x:double,y:double>>>>")
    rows = [(draw.uniform(-10, 32), draw.uniform(-10, 12)) for _ in range(900)] + [(None, 1.0), (float("nan"), 1.0), (-0.0, 0.0), (20.0, 0.0)]
    points = spark.createDataFrame([(i, *r) for i, r in enumerate(rows + rows)], "k int, px double, py double")
    want = sorted({r[0] for r in spatial.points_in_polygons(points, polygons, "px", "py").select("k").collect()})
    tested = []
    whole = spatial.points_in_polygons
    monkeypatch.setattr(spatial, "points_in_polygons", lambda p, *a, **b: (tested.append(p.count()), whole(p, *a, **b))[1])
    assert sorted(r[0] for r in spatial.points_in_any(points, polygons, "px", "py").select("k").collect()) == want
    assert len(want) > 200 and tested[0] <= 902 - 30


def test_centres_on_borders_are_those_of_the_sql(spark, tmp_path):
    import duckdb

    from geoloom.plans.queries import oracle_sql, queries

    # Customers whose area has a supplier's centre or hole on its border, in decimals.
    spark.createDataFrame([(k,) for k in (4954, 5044, 5164, 5254, 5374, 5404, 5434, 6373)], "c_custkey long").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(k,) for k in (79, 354, 444, 564, 654, 774, 804, 834)], "s_suppkey long").coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    base = duckdb.connect()
    for t in ("customer", "supplier"):
        base.execute(f"create view {t} as from '{tmp_path}/{t}.parquet/*.parquet'")
    want = base.execute(oracle_sql()["cascade_match"]).fetchall()
    assert sorted(map(str, map(tuple, queries()["cascade_match"](spark, str(tmp_path)).collect()))) == sorted(map(str, want))


def test_areas_of_one_geometry_are_matched_once(spark, monkeypatch):
    box = lambda x, y, w, h: [[[{"x": a, "y": b} for a, b in ((x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y))]]]
    # One holds both centres, one meets a shape only, one meets none; then a zero with a sign, a name, an id twice, and what is missing.
    areas = [(i, f"a{i}", (box(0.0, 0.0, 9.0, 9.0), box(0.0, 0.0, 1.5, 1.5), box(50.0, 50.0, 1.0, 1.0))[i % 3]) for i in range(300)]
    areas += [(300, "a", box(-0.0, 0.0, 9.0, 9.0)), (301, "k7", box(0.0, 0.0, 9.0, 9.0)), (302, "a", None), (303, None, []), (None, "k7", box(0.0, 0.0, 9.0, 9.0)), (304, "a", box(0.0, 0.0, 9.0, 9.0)), (304, "b", box(0.0, 0.0, 1.5, 1.5))]
    known = [(i, f"k{i}", box(1.0, 1.0, 2.0, 2.0) if i % 2 else box(4.0, 4.0, 2.0, 2.0)) for i in range(40)] + [(40, "k40", None), (41, None, box(80.0, 80.0, 1.0, 1.0))]
    parts = "parts array<array<array<struct<x:double,y:double>>>>"
    tested = {}
    for f in ("points_in_polygons", "polygons_intersecting"):
        monkeypatch.setattr(spatial, f, lambda a, b, *x, _w=getattr(spatial, f), _f=f, **k: (tested.update({_f: (a.count(), b.count())}), _w(a, b, *x, **k))[1])
    found = spatial.area_cascade(spark.createDataFrame(areas, f"id int, slug string, {parts}"), spark.createDataFrame(known, f"t int, name string, {parts}"), "id", "slug", "t", "name")
    all_, odd = range(40), range(1, 40, 2)
    want = [(i, 2, t) for i in range(0, 300, 3) for t in all_] + [(i, 3, t) for i in range(1, 300, 3) for t in odd] + [(i, None, None) for i in range(2, 300, 3)]
    want += [(300, 2, t) for t in all_] + [(301, 1, 7), (302, None, None), (303, None, None), (None, None, None)] + [(304, 2, t) for t in all_ for _ in range(2)]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want))
    assert tested["points_in_polygons"][0] <= 4 and tested["points_in_polygons"][1] <= 5 and tested["polygons_intersecting"][0] <= 3 and tested["polygons_intersecting"][1] <= 4


def test_sets_of_parts_are_matched_once(spark):
    left = spark.range(3000).select(F.col("id").alias("l"), F.array(F.lit("A"), F.lit("B"), F.when(F.col("id") % 2 == 0, "C").otherwise("D")).alias("parts"))
    right = spark.createDataFrame([(10, ["B", "A"]), (11, ["C", "B", "A"])], "r int, parts array<string>")
    found = relational.part_set_matches(left, right, "l", "r")
    assert {tuple(r) for r in found.groupBy("r", "exact").count().collect()} == {(10, False, 1500), (11, True, 1500)}
    assert most_rows(found) <= 3000
    bar = spark.createDataFrame([(1, ["A|B"])], "l int, parts array<string>")
    assert relational.part_set_matches(bar, right, "l", "r").count() == 0


def test_lines_of_archives_are_held_some_at_once(spark):
    import io
    import zipfile

    import pyarrow as pa

    from geoloom.sources import table_functions

    def packed(**members):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for name, text in members.items():
                z.writestr(f"{name}.txt", text)
        return out.getvalue()

    n = 3 * table_functions.LINES + 5
    rows = [("a", packed(x="﻿one\r\ntwo\n", y="")), ("b", None), ("c", packed(z="".join(f"{i}\n" for i in range(n)))), ("d", packed())]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.binary())], ["path", "content"])
    assert [len(t) for t in table_functions.ZipTableLines().eval(batch, pa.array([".txt$"]))] == [2, *[table_functions.LINES] * 3, 5]
    table_functions.register(spark)
    zips = spark.createDataFrame(rows, "path string, content binary")
    of_rows = spark.sql("select z.path, l.* from {zips} z, lateral zip_lines(z.content, '.txt$') l", zips=zips)
    of_table = spark.sql("select * from zip_table_lines(table(select path, content from {zips}), '.txt$')", zips=zips)
    assert of_table.count() == n + 2 and not of_table.exceptAll(of_rows).count() and not of_rows.exceptAll(of_table).count()


def test_archives_are_packed_as_their_rows_come(spark):
    from geoloom.plans.source_queries import _zipped
    from geoloom.sources import landed

    rows = spark.range(25_000).select(F.lit(7).alias("by"), F.col("id").alias("v"), F.repeat(F.lit("x"), 5).alias("other"))
    zips = _zipped(rows, "by", "s.txt", {"v": "k", "by": "b"})
    found = landed.archive_csv(zips, r"^s\.txt$", ["k", "b"])
    assert [c for c in zips._jdf.queryExecution().optimizedPlan().toString().split() if c.startswith("other")] == []  # columns that no file needs are not sent
    assert sorted((r["path"], int(r["k"]), r["b"]) for r in found.collect()) == [("/z/7.zip", i, "7") for i in range(25_000)]
