"""Vector tiles against plain loops: codes, cutting, crowded tiles, archives."""

import random
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.functions import geo, tiles
from geoloom.sources import tiles as archives


def box(x, y, w, h):
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]


def area(polygons):
    return sum(abs(int(tiles.twice_area(r))) * (1 if i == 0 else -1) for p in polygons for i, r in enumerate(p)) / 2


def test_numbers_and_places():
    rng = random.Random(1)
    given = [0, 1, 127, 128, 2**32, 2**63, 2**64 - 1] + [rng.getrandbits(rng.randrange(1, 65)) for _ in range(500)]
    assert tiles.numbers(tiles.varints(given)).tolist() == given and tiles.varints([]) == b"" and len(tiles.numbers(b"")) == 0
    assert tiles.varints([300]) == b"\xac\x02"
    # The curve's first squares, as the form of the archive tells them.
    assert [tiles.tile_number(*p) for p in ((0, 0, 0), (1, 0, 0), (1, 0, 1), (1, 1, 1), (1, 1, 0), (2, 0, 0))] == [0, 1, 2, 3, 4, 5]
    places = [tiles.tile_place(n) for n in range(5461)]
    assert [tiles.tile_number(*p) for p in places] == list(range(5461)) and len(set(places)) == 5461
    assert all(abs(a[1] - b[1]) + abs(a[2] - b[2]) == 1 for a, b in zip(places, places[1:], strict=False) if a[0] == b[0])


def test_commands_are_those_of_the_form():
    # The point and the polygon that the form's own description gives as examples.
    assert tiles.numbers(tiles.commands(tiles.POINT, [[np.array([(25, 17)])]])).tolist() == [9, 50, 34]
    assert tiles.numbers(tiles.commands(tiles.POLYGON, [[np.array([(3, 6), (8, 12), (20, 34)])]])).tolist() == [9, 6, 12, 18, 10, 12, 24, 44, 15]
    line = tiles.varints([9, 4, 4, 18, 0, 16, 16, 0])
    assert [[r.tolist() for r in p] for p in tiles.shape(2, line)] == [[[[2, 2], [2, 10], [10, 10]]]]


def test_layers_hold_every_kind_of_property():
    data = tiles.layer("a", ["s", "d", "i", "b", "n"], [(1, tiles.commands(1, [[np.array([(1, 2)])]]), ("é", 0.5, -3, True, None)), (1, tiles.commands(1, [[np.array([(4095, 0)])]]), (None, None, 2**40, False, None))])
    ((name, extent, found),) = tiles.layers(data)
    assert (name, extent) == ("a", 4096) and [p for _, _, p in found] == [{"s": "é", "d": 0.5, "i": -3, "b": True}, {"i": 2**40, "b": False}]
    assert [n for n, _, _ in tiles.layers(data + data)] == ["a", "a"] and list(tiles.layers(b"")) == []


@pytest.mark.parametrize("zoom", [0, 3, 7])
def test_cut_shapes_cover_what_they_covered(zoom):
    """Boxes have borders on whole units, so the tiles' areas add up to the whole one's; each tile holds what the box has there."""
    rng = random.Random(zoom)
    for _ in range(30):
        w, h = rng.uniform(0.5, 60), rng.uniform(0.5, 40)
        x, y = rng.uniform(-179, 179 - w), rng.uniform(-80, 80 - h)
        hole = box(x + w / 4, y + h / 4, w / 3, h / 3)
        px = np.floor(tiles.mercator(np.array([(x, y + h), (x + w, y), hole[3], hole[1]])) * (1 << zoom) * 4096 + 0.5)
        total = np.prod(px[1] - px[0]) - np.prod(px[3] - px[2])
        found = list(tiles.cut([[box(x, y, w, h), hole]], zoom))
        assert sum(area(tiles.shape(k, tiles.commands(k, p))) for _, _, k, p in found) == (total or 1)
        assert len({f[:2] for f in found}) == len(found)
        for tx, ty, _, p in found:
            low, high = np.vstack([r for q in p for r in q]).min(0), np.vstack([r for q in p for r in q]).max(0)
            assert (low >= 0).all() and (high <= 4096).all(), (tx, ty)


def test_odd_shapes():
    square = box(10, 10, 1, 1)
    assert list(tiles.cut(None, 5)) == list(tiles.cut([], 5)) == list(tiles.cut([[[]]], 5)) == []
    assert list(tiles.cut([[[(float("nan"), 1.0)]]], 5)) == [] and list(tiles.cut([[[(200.0, 1.0)]]], 5)) == []
    ((_, _, kind, p),) = tiles.cut([[box(10, 10, 1e-9, 1e-9)]], 5)
    assert kind == tiles.POLYGON and area(p) == 1
    assert {k for _, _, k, _ in tiles.cut([[square], [[(10.5, 10.5)]]], 4)} == {tiles.POINT, tiles.POLYGON}
    # Corners of the world, and a point on a border, which is in one tile unless there is a margin.
    assert [f[:2] for lon, lat in ((-180.0, 89.0), (180.0, -89.0)) for f in tiles.cut([[[(lon, lat)]]], 2)] == [(0, 0), (3, 3)]
    assert [f[:2] for f in tiles.cut([[[(0.0, 40.0)]]], 1)] == [(1, 0)] and len(list(tiles.cut([[[(0.0, 40.0)]]], 1, margin=8))) == 2
    # An open ring and a closed one are the same.
    plain = lambda s: [(x, y, [r.tolist() for q in p for r in q]) for x, y, _, p in s]
    assert plain(tiles.cut([[square[:-1]]], 6)) == plain(tiles.cut([[square]], 6))
    # A hole that fills the tile leaves nothing of it there.
    assert (2, 1) not in {f[:2] for f in tiles.cut([[box(-170, -80, 340, 160), box(-10, -10, 110, 80)]], 2)}


def shapes(spark, rows):
    return spark.createDataFrame([(i, n, v, p if p is None else [[[{"x": float(x), "y": float(y)} for x, y in r] for r in q] for q in p]) for i, n, v, p in rows], f"id long, name string, v double, parts {geo.MULTIPOLYGON}")


class Ranged(BaseHTTPRequestHandler):
    data, fails = b"", 2

    def do_HEAD(self):
        self.send_response(200)
        self.send_header("Content-Length", str(len(self.data)))
        self.end_headers()

    def do_GET(self):
        if type(self).fails:
            type(self).fails -= 1
            self.send_error(503)
            return
        a, b = (int(v) for v in self.headers["Range"].removeprefix("bytes=").split("-"))
        self.send_response(206)
        self.end_headers()
        self.wfile.write(self.data[a : b + 1])

    def log_message(self, *_):
        pass


def test_archive_round_trip(spark, tmp_path):
    rng = random.Random(4)
    points = [(i, f"p{i % 7}" if i % 5 else None, i / 4 if i % 3 else None, [[[(rng.uniform(-20, 20), rng.uniform(-20, 20))]]]) for i in range(300)]
    crowd = [(1000 + i, "c", 1.0, [[[(5.0 + i / 1e5, 5.0)]]]) for i in range(400)] + [(7, "same", 2.0, [[[(6.0, 6.0)]]])] * 50
    areas = [(5000, "huge", None, [[box(-179, -80, 358, 160), box(-1, -1, 2, 2)]]), (5001, "tiny", 3.0, [[box(1, 1, 1e-7, 1e-7)]]), (5002, "null", 1.0, None), (5003, "empty", 1.0, [])]
    df = shapes(spark, points + crowd + areas)
    made = archives.tiled(df, "parts", ["id", "name", "v"], [0, 4], "things", layer_bytes=6_000).cache()
    assert made.groupBy("tile_id").count().agg(F.max("count")).first()[0] > 1 and made.groupBy("tile_id", "part").count().count() == made.count()
    archives.write_archive(made, str(tmp_path / "a"), {"name": "things"})
    spark.dataSource.register(archives.TileArchive)
    read = spark.read.format("tile_archive").option("path", str(tmp_path / "a")).load().cache()
    assert read.count() == made.select("tile_id").distinct().count()
    assert all(tiles.tile_number(r["z"], r["tile_x"], r["tile_y"]) == r["tile_id"] for r in read.collect())
    found = archives.features(read, "things", "id long, name string, v double").cache()
    for zoom in (0, 4):
        kept = {(r["id"], r["name"], r["v"]): r["count"] for r in found.where(F.col("z") == zoom).groupBy("id", "name", "v").count().collect()}
        want = {}
        for i, n, v, p in points + crowd + areas:
            if p:
                want[i, n, v] = want.get((i, n, v), 0) + 1
        assert kept.keys() == want.keys() and all(kept[k] == n for k, n in want.items() if k[0] != 5000)
        # Of the 16 rows of zoom 4, one each in the north and south lies beyond 80 degrees.
        assert kept[5000, "huge", None] == (1 if zoom == 0 else 16 * 14)
    at = {r["id"]: r["parts"][0][0][0] for r in found.where("z = 4 and id < 300").where(F.col("id") != 7).collect()}
    assert all(abs(at[i]["x"] - p[0][0][0][0]) < 0.003 and abs(at[i]["y"] - p[0][0][0][1]) < 0.003 for i, _, _, p in points if i != 7)
    assert archives.features(read, "others", "id long").count() == 0
    wrong = archives.features(read, "things", "id string, v long").where("z = 4")
    assert wrong.where("id is not null").count() == 0 and {r["v"] for r in wrong.where("v is not null").collect()} == {int(v) for _, _, v, p in points + crowd + areas if v is not None and v == int(v) and p}

    whole = b"".join(p.read_bytes() for p in sorted(Path(tmp_path / "a").rglob("*")) if p.is_file())
    (tmp_path / "one").write_bytes(whole)
    one = spark.read.format("tile_archive").option("path", str(tmp_path / "one")).load()
    key = lambda d: sorted((r["tile_id"], bytes(r["data"])) for r in d.collect())
    assert whole[:8] == b"PMTiles\x03" and key(one) == key(read)
    Ranged.data, Ranged.fails = whole, 2
    server = ThreadingHTTPServer(("127.0.0.1", 0), Ranged)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        remote = spark.read.format("tile_archive").option("url", f"http://127.0.0.1:{server.server_port}/a").option("pause", "0.01").load()
        assert key(remote) == key(read)
    finally:
        server.shutdown()


def test_numbers_that_are_not_finite_are_read_beside_whole_ones(spark):
    given = [(1, "a", float("inf")), (2, "b", float("nan")), (3, "c", float("-inf")), (4, "d", 2.0)]
    made = archives.tiled(shapes(spark, [(*g, [[[(5.0, 5.0)]]]) for g in given]), "parts", ["id", "name", "v"], [3], "a")
    read = {(r["id"], r["name"], str(r["v"])) for r in archives.features(made, "a", "id long, name string, v double").collect()}
    assert read == {(i, n, str(v)) for i, n, v in given}
    assert {r["v"] for r in archives.features(made, "a", "v long").collect()} == {None, 2}


def test_empty_and_foreign_archives(spark, tmp_path):
    spark.dataSource.register(archives.TileArchive)
    archives.write_archive(archives.tiled(shapes(spark, [(1, None, None, None)]), "parts", ["id"], [3], "a"), str(tmp_path / "a"))
    assert spark.read.format("tile_archive").option("path", str(tmp_path / "a")).load().count() == 0
    (tmp_path / "b").write_bytes(b"x" * 200)
    with pytest.raises(Exception, match="no archive of tiles"):
        spark.read.format("tile_archive").option("path", str(tmp_path / "b")).load().count()
    # Runs of equal tiles, a directory in a directory, packed tiles.
    import gzip

    tile = gzip.compress(tiles.layer("a", ["k"], [(1, tiles.commands(1, [[np.array([(1, 2)])]]), (5,))]))
    low = archives.directory([5, 9], [3, 1], [len(tile), len(tile)], [0, 0])
    mid = archives.directory([5], [0], [len(low)], [0])
    first = archives.directory([1, 5], [1, 0], [len(tile), len(mid)], [0, len(low)])
    h = archives.HEAD.size
    head = archives.HEAD.pack(b"PMTiles", 3, h, len(first), 0, 0, h + len(first), len(low) + len(mid), h + len(first) + len(low) + len(mid), len(tile), 5, 3, 1, 1, 2, 2, 1, 0, 2, 0, 0, 0, 0, 0, 0, 0)
    (tmp_path / "c").write_bytes(head + first + low + mid + tile)
    read = spark.read.format("tile_archive").option("path", str(tmp_path / "c")).load()
    assert sorted(r["tile_id"] for r in read.collect()) == [1, 5, 6, 7, 9]
    assert [r["k"] for r in archives.features(read, "a", "k long").collect()] == [5] * 5


def test_many_shapes_are_cut_at_once():
    draw = random.Random(4)
    shapes = [[[box(draw.uniform(-170, 160), draw.uniform(-70, 60), w, 4.0), box(-170, -70, 1.0, 1.0)]] for w in (1e-9, 0.3, 8.0, 30.0) for _ in range(50)]
    rings = [(i, np.asarray(r, float)) for i, s in enumerate(shapes) for p in s for r in p]
    sizes, owner = np.array([len(r) for _, r in rings]), np.array([i for i, _ in rings])
    held = tiles.rings_of(np.vstack([r for _, r in rings]), sizes, owner, owner, 6, 4096)

    def features(most):
        for f in tiles.cut_all(held, 6, most=most):
            data, lengths = tiles.all_commands(f)
            ends = np.cumsum(lengths)
            yield from zip(f.shape.tolist(), f.x.tolist(), f.y.tolist(), (data[a:b].tobytes() for a, b in zip(ends - lengths, ends, strict=True)), strict=True)

    want = sorted((i, x, y, tiles.commands(k, p)) for i, s in enumerate(shapes) for x, y, k, p in tiles.cut(s, 6))
    assert len(want) > 900 and sorted(features(1 << 17)) == sorted(features(100)) == want
    assert len(list(tiles.cut_all(held, 6))) == 1 and len(list(tiles.cut_all(held, 6, most=100))) > 20


def test_flat_layers_are_the_layers():
    ring = np.array([(0, 0), (40, 0), (40, 40), (0, 40)])
    polygons = [[ring, ring[::-1] // 2 + 5], [ring + 100]]
    line = tiles.varints([9, 4, 4, 18, 0, 16, 16, 0])
    plain = [(3, tiles.commands(3, polygons), ("a", 1)), (1, tiles.commands(1, [[np.array([(1, 2)])], [np.array([(3, 1)])]]), (None, 2)), (3, tiles.commands(3, [[ring]]), ("a", None))]
    for given in (plain, [*plain, (2, line, ("b", 3))], []):
        data = tiles.layer("a", ["s", "n"], given)
        ((_, _, found),), ((_, extent, flat),) = tiles.layers(data), tiles.flat_layers(data)
        each = [p for _, p, _ in found]
        assert extent == 4096 and flat.features == len(found) and flat.polygons.tolist() == [len(p) for p in each]
        assert flat.rings.tolist() == [len(r) for p in each for r in p] and flat.size.tolist() == [len(r) for p in each for q in p for r in q]
        assert flat.points.tolist() == [c for p in each for q in p for r in q for c in r.tolist()]
        got = [{} for _ in found]
        for f, k, v in zip(*flat.tags, strict=True):
            got[f][flat.keys[k]] = flat.values[v]
        assert got == [p for _, _, p in found]


def test_shapes_of_one_file_are_cut_by_many_tasks(spark):
    shapes = spark.range(400).coalesce(1).select("id", geo_box(F.col("id")).alias("parts"))
    found = archives.tiled(shapes, "parts", ["id"], [7], "a")
    # The pieces were written by the tasks that cut them.
    written = [f for f in found.inputFiles() if "tile-pieces" in f]
    assert len(written) > 1 and found.agg(F.sum("features")).first()[0] >= 400


def geo_box(k):
    x, y = k % 300 - 150.0, k % 100 - 50.0
    return F.array(F.array(F.array(*(F.struct((x + a).alias("x"), (y + b).alias("y")) for a, b in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))))))
