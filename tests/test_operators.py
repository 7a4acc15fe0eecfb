import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.operators import aggregates, graph, relational, spatial
from geoloom.sources import landed, paged, sinks
from geoloom.streaming import incremental


def test_first_and_last(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, None), ("b", 5, "z")], "k string, i int, v string")
    assert sorted(map(tuple, relational.first_per_key(df, ["k"], F.col("i")).collect())) == [("a", 1, None), ("b", 5, "z")]
    assert sorted(map(tuple, relational.last_per_key(df, ["k"], "i").collect())) == [("a", 2, "x"), ("b", 5, "z")]


def test_part_sets_and_scores(spark):
    left = spark.createDataFrame([(1, ["A", "B"]), (2, ["A", "B", "C"]), (3, ["Z"])], "l int, parts array<string>")
    right = spark.createDataFrame([(10, ["B", "A"]), (11, ["A", "B"]), (12, ["C", "B"])], "r int, parts array<string>")
    assert sorted(map(tuple, relational.part_set_matches(left, right, "l", "r").collect())) == [(1, 11, True), (2, 10, False)]
    names = spark.createDataFrame([(1, "p"), (2, "q")], "l int, r string")
    streets = spark.createDataFrame([(1, "p"), (3, "q")], "l int, r string")
    assert sorted(map(tuple, relational.scored_matches(names, streets, "l", "r").collect())) == [(1, "p", 100), (3, "q", 85)]


def test_wide_merge_geocode_and_bridge(spark):
    a = spark.createDataFrame([("1", "x", "5")], "id string, name string, v1 string")
    b = spark.createDataFrame([("1", "y", "6", 7), ("2", "w", None, 8)], "id string, name string, v1 string, v2 int")
    assert sorted(map(tuple, relational.wide_merge([a, b], "id", ["name"]).select("id", "name", "v1", "v2").collect())) == [("1", "x", "6", 7), ("2", "w", None, 8)]
    cache = spark.createDataFrame([("q1", "matched", 74.0, "Town", 1.0, 2.0), ("q2", "matched", 96.0, "town", 3.0, 4.0)], "query string, status string, score double, locality string, lon double, lat double")
    asked = spark.createDataFrame([("i", 0, "q1"), ("i", 1, "q2")], "id string, rank int, query string")
    assert tuple(relational.geocoded(asked, cache, "Town").first()) == ("i", "q2", 96.0, 3.0, 4.0, "high")
    both = relational.bridged([(a, {"key": "id", "old": "v1"}), (b, {"key": "id", "new": "v2"})])
    assert both.columns == ["key", "old", "new"] and both.count() == 3


def test_cell_join_is_brute_force(spark):
    from geoloom.plans.queries import RINGS, polygons

    random.seed(2)
    points = [(i, random.uniform(-140, -114), random.uniform(47, 61)) for i in range(400)]

    def inside(x, y, ring):
        return sum((a[1] > y) != (b[1] > y) and x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0] for a, b in zip(ring, ring[1:], strict=False)) % 2 == 1

    want = set()
    for i, x, y in points:
        for n in {r[0] for r in RINGS}:
            rings = {r[3]: r[4] for r in RINGS if r[0] == n}
            if inside(x, y, rings[0]) and not any(inside(x, y, p) for k, p in rings.items() if k):
                want.add((i, n))
    got = spatial.points_in_polygons(spark.createDataFrame(points, "k int, x double, y double"), polygons(spark), "x", "y")
    assert {(r["k"], r["n"]) for r in got.collect()} == want and want


def test_nearest_is_brute_force(spark):
    random.seed(3)
    segments = [(i, *(random.uniform(0, 1000) for _ in range(4))) for i in range(60)]
    points = [(i, random.uniform(0, 1000), random.uniform(0, 1000)) for i in range(80)]
    got = {r["p"]: (r["s"], r["distance"]) for r in spatial.nearest_segment(spark.createDataFrame(points, "p int, x double, y double"), spark.createDataFrame(segments, "s int, ax double, ay double, bx double, by double"), "p", "s", 30.0, 40.0).collect()}
    for p, x, y in points:
        best = min(((lambda a, d: (float(np.hypot(*(np.array([x, y]) - a - d * np.clip((np.array([x, y]) - a) @ d / (d @ d), 0, 1)))), s))(np.array([ax, ay]), np.array([bx - ax, by - ay])) for s, ax, ay, bx, by in segments))
        assert got[p] == (None, None) if best[0] > 30 else (got[p][0] == best[1] and abs(got[p][1] - best[0]) < 1e-9)


def test_runs_segments_and_collapse(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate("aabbbac")], "i long, v string")
    assert sorted(map(tuple, aggregates.run_lengths(df, "i", "v").collect())) == [(0, "a", 2), (2, "b", 3), (5, "a", 1), (6, "c", 1)]
    assert [r["v"] for r in aggregates.collapsed(df.withColumn("g", F.lit(1)), ["g"], "i", ["v"]).orderBy("i").collect()] == list("abac")
    line = spark.createDataFrame([(1, 0, 0.0, 0.0), (1, 1, 1.0, 0.0), (1, 2, 1.0, 1.0)], "g int, i int, x double, y double")
    assert aggregates.segments(line, ["g"], ["i"], "x", "y").count() == 2


def test_quantile_bands_by_rank(spark):
    random.seed(1)
    values = [random.choice([0.0, -1.0, 1.0, 2.0, 3.5, 4.0, 9.0]) for _ in range(53)]
    kept = sorted(v for v in values if v > 0)
    cuts = [kept[max(0, min(int(q * len(kept)) - 1, len(kept) - 1))] for q in (0.2, 0.4, 0.6, 0.8)]
    want = sorted((v, 1 if v <= 0 else 1 + sum(v > c for c in cuts)) for v in values)
    assert sorted(map(tuple, aggregates.quantile_bands(spark.createDataFrame([(v,) for v in values], "v double"), "v").collect())) == want


def test_chains_and_holes(spark):
    edges = spark.createDataFrame([(1, "a", "b"), (1, "b", "c"), (1, "c", "d"), (1, "c", "e"), (2, "x", "y"), (2, "y", "z"), (2, "z", "x")], "g int, a string, b string")
    got = sorted((r["g"], tuple(r["nodes"])) for r in graph.chains(edges, "g", "a", "b").collect())
    assert got == [(1, ("a", "b", "c")), (1, ("c", "d")), (1, ("c", "e")), (2, ("x", "y", "z", "x"))]
    ring = [(r, c) for r in range(1, 4) for c in range(1, 4) if (r, c) != (2, 2)]
    assert graph.fill_holes(spark.createDataFrame(ring, "row int, col int"), 5, 5).count() == 9


def test_long_chains_are_no_task(spark):
    """A chain of 20,000 edges, a circle of 1,000 and single edges in one group."""
    rng = random.Random(3)
    names = [f"n{i:05}" for i in range(20_001)]
    rng.shuffle(names)
    circle = [f"z{i:04}" for i in range(1000)]
    rng.shuffle(circle)
    edges = [(1, *p) for p in zip(names, names[1:], strict=False)] + [(1, a, b) for a, b in zip(circle, circle[1:] + circle[:1], strict=True)] + [(1, "p", "q"), (1, "q", "p"), (1, "p", "p"), (2, "p", "q")]
    rng.shuffle(edges)
    got = {(r["group"], len(r["nodes"])): r["nodes"] for r in graph.chains(spark.createDataFrame(edges, "group int, a string, b string"), "group", "a", "b").collect()}
    assert set(got) == {(1, 20_001), (1, 1001), (1, 2), (2, 2)}
    assert got[1, 20_001] == (names if names[0] < names[-1] else names[::-1])
    k = circle.index(min(circle))
    turned = circle[k:] + circle[:k]
    turned = turned if turned[1] < turned[-1] else turned[:1] + turned[:0:-1]
    assert got[1, 1001] == [*turned, turned[0]]


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿x,y,x\n1,"say ""hi""",2\n3\n', encoding="utf-8")
    rows = landed.csv_rows(spark, str(tmp_path / "a.csv"))
    assert rows.columns == ["x", "y", "x_2"] and tuple(rows.first()) == ("1", 'say "hi"', "2")
    (tmp_path / "b.json").write_text('{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"n":"p"},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}}]}')
    g = landed.geojson(spark, str(tmp_path / "b.json"), "n string").select("n", F.size(landed.polygon_parts(F.col("geometry_type"), F.col("coordinates"))[0][0]).alias("k"))
    assert tuple(g.first()) == ("p", 4)
    import zipfile

    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("d_20.csv", "k,v\nA,1\nB,2\n")
    (tmp_path / "bad.zip").write_bytes(b"no")
    zips = landed.archives(spark, str(tmp_path))
    assert zips.count() == 2
    assert landed.archive_members(zips).where("error is not null").count() == 1
    assert [tuple(r) for r in landed.archive_csv(zips.where("path like '%z.zip'"), "^d_", ["k", "v"]).select("row", "k", "v").orderBy("row").collect()] == [(0, "A", "1"), (1, "B", "2")]
    assert spark.range(1).select(landed.jsonp(F.lit("cb({\"a\": 1});"), "a int")["a"].alias("a")).first()["a"] == 1
    assert spark.range(1).select(landed.decoded(F.lit(b"caf\xe9"))).first()[0] == "café"
    df = spark.createDataFrame([(2, 1.0, 2.0), (1, 3.0, 4.0)], "id int, x double, y double").withColumn("f", sinks.feature(sinks.point(F.col("x"), F.col("y")), id=F.col("id")))
    sinks.write_feature_lines(df, str(tmp_path / "out"), "f", "id")
    assert spark.read.json(str(tmp_path / "out")).select("properties.id").count() == 2
    assert '"FeatureCollection"' in sinks.feature_collection(df, "f", "id").first()[0]


def test_collections_of_any_size_round_trip(spark, tmp_path):
    """Parts joined in the order of their paths are one document; repeated rows and an empty table, too. One file is read by several tasks."""
    import json

    df = spark.range(30_000).select((F.col("id") % 29_990).alias("id"), F.when(F.col("id") % 7 == 0, 'a "Feature" {"type":"Feature" of [x]}').otherwise("n").alias("name"))
    df = df.withColumn("f", sinks.feature(sinks.point(F.col("id") / 10, F.lit(1.5)), id=F.col("id"), name=F.col("name")))
    whole = lambda path: "".join(p.read_text() for p in sorted(path.rglob("part-*")))
    sinks.write_feature_collection(df.repartition(7), str(tmp_path / "c"), "f", "id")
    document = json.loads(whole(tmp_path / "c"))
    want = sorted((r["id"], r["name"]) for r in df.collect())
    assert document["type"] == "FeatureCollection" and [f["properties"]["id"] for f in document["features"]] == [i for i, _ in want]
    for spaced in (False, True):
        (tmp_path / "one.json").write_text(json.dumps({"type": "FeatureCollection", "name": "x", "features": document["features"], "bbox": [1, 2]}, separators=None if spaced else (",", ":")) + "\n")
        before = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
        got = landed.split_geojson(spark, str(tmp_path / "one.json"), "id long, name string")
        assert got.rdd.getNumPartitions() > 5 and sorted((r["id"], r["name"]) for r in got.collect()) == want and got.where("geometry_type = 'Point' and coordinates like '[%,1.5]'").count() == len(want)
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    sinks.write_feature_collection(df.limit(0), str(tmp_path / "none"), "f", "id")
    assert json.loads(whole(tmp_path / "none")) == {"type": "FeatureCollection", "features": []}
    (tmp_path / "mixed.json").write_text('{"type":"FeatureCollection","features":[{"type":"Feature","properties":{},"geometry":null},{ "type": "Feature","properties":{},"geometry":null}]}')
    with pytest.raises(Exception, match="several ways"):
        landed.split_geojson(spark, str(tmp_path / "mixed.json"), "id long").collect()
    (tmp_path / "late.json").write_text('{"type":"FeatureCollection","features":[{"id":1,"type":"Feature","properties":{"id":4},"geometry":null}]}')
    with pytest.raises(ValueError, match="begin with their type"):
        landed.split_geojson(spark, str(tmp_path / "late.json"), "id long")


class Service:
    """A local service of 25 features; the first two answers to each page, and to each range of its archive, are errors."""

    def __init__(self, archive=b""):
        import collections
        import http.server
        import json
        import threading
        import urllib.parse

        self.asked = collections.Counter()
        service = self

        class Handler(http.server.BaseHTTPRequestHandler):
            def log_message(self, *_):
                pass

            def _answer(self, code, data=b"", **headers):
                self.send_response(code)
                self.send_header("Content-Length", str(len(data)) if data else headers.pop("Content_Length", "0"))
                self.end_headers()
                self.wfile.write(data)

            def do_HEAD(self):
                self._answer(200, Content_Length=str(len(archive)))

            def do_GET(self):
                url = urllib.parse.urlparse(self.path)
                q = {k: v[0] for k, v in urllib.parse.parse_qs(url.query).items()}
                key = (url.path, q.get("resultOffset"), self.headers.get("Range"))
                service.asked[key] += 1
                if url.path == "/broken":
                    return self._answer(200, b'{"error": {"code": 400, "message": "no such layer"}}')
                if service.asked[key] <= 2:
                    return self._answer(503)
                if url.path == "/z.zip":
                    low, high = map(int, self.headers["Range"].removeprefix("bytes=").split("-"))
                    return self._answer(206, archive[low : high + 1])
                if "returnCountOnly" in q:
                    return self._answer(200, b'{"count": 25}')
                low, n = int(q["resultOffset"]), int(q["resultRecordCount"])
                rows = [{"type": "Feature", "properties": {"id": i, "name": None if i == 3 else f"n{i}", "x": i}, "geometry": {"type": "Point", "coordinates": [i, 1]}} for i in range(low, min(low + n, 25))]
                return self._answer(200, json.dumps({"features": rows}).encode())

        self.server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.server.server_port}"


def test_paged_services_are_read_by_page_with_retries(spark):
    spark.dataSource.register(paged.PagedService)
    service = Service()
    read = lambda path, **more: spark.read.format("paged_service").schema("id long, name string, x double, geometry string, absent string").options(url=service.url + path, page="10", pause="0.01", **more).load()
    df = read("/layer")
    assert df.rdd.getNumPartitions() == 3
    got = sorted(tuple(r) for r in df.collect())
    assert [g[0] for g in got] == list(range(25)) and got[3][1] is None and got[4] == (4, "n4", 4.0, '{"type": "Point", "coordinates": [4, 1]}', None)
    assert all(n >= 3 for n in service.asked.values())
    with pytest.raises(Exception, match="no such layer"):
        read("/broken").collect()
    with pytest.raises(Exception, match="503"):
        read("/other", tries="2").collect()
    calls = []
    with pytest.raises(TimeoutError):
        paged.with_retries(lambda: (_ for _ in ()).throw(TimeoutError()), 4, 1.0, calls.append)
    assert calls == [1.0, 2.0, 4.0]


def test_members_of_remote_archives_are_partitions(spark):
    import io
    import zipfile

    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a/stops.txt", "\ufeffk,v\r\n1,x\n")
        z.writestr("b/stops.txt", "k,v\n2,é")
        z.writestr("other.bin", np.random.default_rng(1).bytes(3_000_000))
    service = Service(held.getvalue())
    spark.dataSource.register(paged.ZippedLines)
    df = spark.read.format("zipped_lines").options(url=service.url + "/z.zip", pattern="stops", pause="0.01").load()
    assert df.rdd.getNumPartitions() == 2
    assert sorted(map(tuple, df.collect())) == [("a/stops.txt", 0, "k,v"), ("a/stops.txt", 1, "1,x"), ("b/stops.txt", 0, "k,v"), ("b/stops.txt", 1, "2,é")]


def test_late_rows_sessions_and_repeats_of_a_stream(spark, tmp_path):
    """Rows behind the watermark are in no window, a session closes once the watermark has passed it, repeats within it go, and keyed state ignores what is older."""
    import datetime

    at = lambda m: datetime.datetime(2024, 1, 1, 12) + datetime.timedelta(minutes=m)
    schema = "k string, ts timestamp, i int"
    batches = [[("a", at(0), 1), ("a", at(5), 2), ("b", at(1), 9)], [("a", at(200), 3), ("a", at(200), 3)], [("a", at(2), 4), ("b", at(210), 1), ("c", at(211), None)], [("b", at(400), 5), ("c", at(401), 7)]]

    def run(name, made, mode):
        source, seen = tmp_path / name / "in", []
        for n, rows in enumerate(batches):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))
            stream = made(spark.readStream.schema(schema).parquet(str(source)))
            stream.writeStream.outputMode(mode).option("checkpointLocation", str(tmp_path / name / "c")).foreachBatch(lambda df, _: seen.extend(map(tuple, df.collect()))).trigger(availableNow=True).start().awaitTermination(120)
        return seen

    windows = run("w", lambda s: incremental.sliding_counts(s, "ts", "20 minutes", "10 minutes", "k", late="30 minutes"), "append")
    assert (at(0), "a", 2) in windows and (at(-10), "a", 2) in windows and (at(200), "a", 2) in windows  # the row of minute 2 in the third batch is late
    sessions = run("s", lambda s: incremental.session_counts(s, "ts", "k", "30 minutes", "30 minutes"), "append")
    assert ("a", at(0), at(35), 2) in sessions and ("b", at(1), at(31), 1) in sessions
    once = run("d", lambda s: incremental.without_repeats(s, "ts", "k", "i", late="30 minutes"), "append")
    assert once.count(("a", at(200), 3)) == 1 and ("a", at(0), 1) in once and not any(r[2] == 4 for r in once)


def test_keyed_state_of_a_stream(spark, tmp_path):
    pytest.importorskip("google.protobuf")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    seen = []
    for rows in ([("a", 1, "x"), ("b", None, "y")], [("a", 0, "old"), ("b", 4, "z")], [("b", None, "none"), ("a", 2, "w")]):
        spark.createDataFrame(rows, "k string, i int, v string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = incremental.latest_rows(spark.readStream.schema("k string, i int, v string").parquet(str(tmp_path / "in")), "k", "i")
        seen.append([])
        stream.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "c")).foreachBatch(lambda df, _: seen[-1].extend(map(tuple, df.collect()))).trigger(availableNow=True).start().awaitTermination(120)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    assert [sorted(s, key=str) for s in seen] == [[("a", 1, "x"), ("b", None, "y")], [("b", 4, "z")], [("a", 2, "w")]]


def test_undated_rows_do_not_replace_state(spark, tmp_path):
    for i, rows in enumerate(([("a", 5, 1), ("b", None, 2)], [("a", None, 9), ("a", 3, 8), ("b", 1, 3)])):
        spark.createDataFrame(rows, "k string, i int, v int").write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("k string, i int, v int").parquet(str(tmp_path / "in"))
        incremental.upsert_batches(stream, str(tmp_path / "t"), ["k"], "i", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination(60)
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "t" / "1")).collect())) == [("a", 5, 1), ("b", 1, 3)]


def test_incremental_upsert(spark, tmp_path):
    for i, rows in enumerate(([("a", 1, 1)], [("a", 2, 5), ("b", 1, 7)])):
        spark.createDataFrame(rows, "k string, i int, v int").write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("k string, i int, v int").parquet(str(tmp_path / "in"))
        incremental.upsert_batches(stream, str(tmp_path / "t"), ["k"], "i", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination(60)
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "t" / "1")).collect())) == [("a", 2, 5), ("b", 1, 7)]


def test_trees_are_followed_to_their_end_and_circles_raise(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)], "parent int, child int")
    got = graph.flatten_tree(chain, spark.createDataFrame([(0,)], "id int"))
    assert got.count() == 41 and got.agg(F.max("depth")).first()[0] == 40
    with pytest.raises(Exception, match="circle"):
        graph.flatten_tree(spark.createDataFrame([(0, 1), (1, 0)], "parent int, child int"), spark.createDataFrame([(0,)], "id int")).count()


def test_holes_behind_long_ways(spark):
    """A spiral that is open to the outside encloses nothing; closed, all of its inside."""
    n = 13
    wall, (r, c), turn, steps = set(), (1, 1), 0, [n - 3]
    while steps[-1] > 1:
        steps += [steps[-1] if len(steps) % 2 == 0 or len(steps) == 1 else steps[-1] - 2]
    for k in steps:
        for _ in range(k):
            wall.add((r, c))
            r, c = r + (0, 1, 0, -1)[turn % 4], c + (1, 0, -1, 0)[turn % 4]
        turn += 1
    outside, grow = set(), [(0, 0)]
    while grow:
        p = grow.pop()
        if p in outside or p in wall or not (0 <= p[0] < n and 0 <= p[1] < n):
            continue
        outside.add(p)
        grow += [(p[0] + i, p[1] + j) for i, j in ((0, 1), (1, 0), (0, -1), (-1, 0))]
    got = {tuple(x) for x in graph.fill_holes(spark.createDataFrame(sorted(wall), "row int, col int"), n, n).collect()}
    assert got == {(i, j) for i in range(n) for j in range(n)} - outside


def test_levels_are_told_from_null_keys(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", None, 2.0), (None, None, 4.0)], "n string, b string, v double").withColumn("area", F.lit(2.0))
    got = aggregates.hierarchy(df, ["n", "b"], ["v", "area"], "area", "v").select("level", "n", "b", "v", "rows_n").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, "a", None, 3.0, 2), (1, None, None, 4.0, 1), (2, "a", "x", 1.0, 1), (2, "a", None, 2.0, 1), (2, None, None, 4.0, 1)], key=str)


def test_duplicates_are_rows(spark):
    df = spark.createDataFrame([(1, "k", ["a"]), (2, "k", ["b", "a"]), (3, "m", ["c"])], "i int, key string, ways array<string>")
    first, others = relational.dedupe_listing_duplicates(df, F.col("key"), "i", F.lit(0), "ways")
    assert sorted((r["i"], r["ways"]) for r in first.collect()) == [(1, ["a", "b"]), (3, ["c"])]
    assert [tuple(r) for r in others.collect()] == [(1, 2)]


def test_percentiles_are_those_of_all_values(spark):
    random.seed(4)
    values = [random.choice([1.0, 2.5, 2.5, 7.0, 11.0]) for _ in range(31)]
    got = aggregates.distribution(spark.createDataFrame([(v,) for v in [*values, None]], "v double"), "v").first()
    assert got["n"] == 31 and np.allclose((got["mean"], got["median"], got["p90"]), (np.mean(values), np.quantile(values, 0.5), np.quantile(values, 0.9)))


def test_lines_of_features_and_files_that_are_none(spark, tmp_path):
    (tmp_path / "l.json").write_text("\n".join('{"type":"Feature","properties":{"n":"%d"},"geometry":{"type":"Point","coordinates":[1,2]}}' % i for i in range(3)) + "\n")
    assert sorted(r["n"] for r in landed.geojson(spark, str(tmp_path / "l.json"), "n string", lines=True).collect()) == ["0", "1", "2"]
    (tmp_path / "x.json").write_text("<html>busy</html>")
    with pytest.raises(Exception, match="no feature or collection"):
        landed.geojson(spark, str(tmp_path / "x.json"), "n string").collect()
    assert spark.range(1).select(landed.decoded(F.lit(b"\x80 caf\xe9"))).first()[0] == "€ café"
    df = spark.createDataFrame([(1, "a", 2.5, None)], "i int, s string, d double, n int")
    assert sinks.row_arrays(df, {"i": "i", "s": "s", "d": "d", "n": "n"}).first()["row"] == '[1,"a",2.5,null]'
