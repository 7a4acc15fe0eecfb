"""Vector tiles: shapes to tiles, tiles to archives with a directory along the Hilbert curve, and both back.

    tiles = tiled(shapes, "parts", ["id", "mean"], zooms=range(4, 9), layer="areas")
    write_archive(tiles, folder)
    spark.dataSource.register(TileArchive)
    features(spark.read.format("tile_archive").option("path", archive).load(), "areas", "id long, mean double")
"""

from __future__ import annotations

import gzip
import io
import json
import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import geo, tiles
from .paged import RangeFile
from .scratch import written

#: Bytes of features that one task makes a layer of; a tile of more has several.
LAYER_BYTES = 4 << 20
#: Fixed values of the archive's form (version 3): its head, where the first directory must end, kinds of packing and content.
HEAD = struct.Struct("<7sB11Q6B4iB2i")
FIRST_BYTES, PLAIN, GZIP, VECTOR = 16_384, 1, 2, 1


def tiled(shapes: DataFrame, parts: str, properties: list[str], zooms: Iterable[int], layer: str, extent: int = 4096, margin: int = 0, layer_bytes: int = LAYER_BYTES) -> DataFrame:
    """(tile_id, z, tile_x, tile_y, part, features, data): the tiles of each zoom.

    parts is a multipolygon of degrees; a ring of one point is a point. Properties are text, numbers or truth values;
    nulls are left out. Shapes are dealt over as many tasks as shuffles have partitions, as a small file of them makes
    many tiles, and cut there by blocks of bounded size, however many tiles a shape meets. All
    features of a tile are kept: where they take more than layer_bytes, they are spread over several layers, named
    layer, layer_2 and so on, each a row, whose data one after the other are one tile; no task holds a crowded tile.
    Rows that are equal in all columns meet in one of them.
    """
    wanted, kinds = list(zooms), {f.name: f.dataType for f in shapes.schema.fields}
    schema = T.StructType([T.StructField(n, kinds[n]) for n in properties])
    inner = T.StructType([T.StructField(n, T.IntegerType()) for n in ("_z", "_x", "_y", "_kind")] + [T.StructField("_g", T.BinaryType())] + list(schema))

    def run(batches):
        for batch in batches:
            points, sizes, shape, polygon = _flat(batch.column(0))
            for z in wanted:
                for f in tiles.cut_all(tiles.rings_of(points, sizes, shape, polygon, z, extent), z, extent, margin):
                    data, lengths = tiles.all_commands(f)
                    ends = pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32())
                    own = pa.RecordBatch.from_arrays(batch.columns[1:], batch.schema.names[1:]).take(pa.array(f.shape)).columns if properties else []
                    g = pa.BinaryArray.from_buffers(pa.binary(), len(lengths), [None, ends.buffers()[1], pa.py_buffer(data)])
                    yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int32()) for c in (np.full(len(f.x), z), f.x, f.y, f.kind)), g, *own], inner.names)

    dealt = shapes.select(F.col(parts).cast(geo.MULTIPOLYGON), *properties).repartition(int(shapes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    pieces = written(dealt.mapInArrow(run, inner), "tile-pieces")
    # How many layers a tile has is one row a tile; the rows of one tile are told apart by a hash of all they hold.
    sizes = pieces.groupBy("_z", "_x", "_y").agg(F.ceil(F.sum(F.length("_g") + 64) / layer_bytes).cast("int").alias("_n"))
    keyed = pieces.join(sizes.where("_n > 1"), ["_z", "_x", "_y"], "left").withColumn("_part", F.pmod(F.xxhash64("_kind", "_g", *properties), F.coalesce("_n", F.lit(1))).cast("int"))

    def whole(key, rows):
        z, x, y, part = (k.as_py() for k in key)
        given = zip(*(rows.column(n).to_pylist() for n in ("_kind", "_g", *properties)), strict=True)
        ordered = sorted(((k, g, tuple(p)) for k, g, *p in given), key=lambda r: (str(r[2]), r[0], r[1]))
        data = tiles.layer(layer if part == 0 else f"{layer}_{part + 1}", properties, ordered, extent)
        return pa.table([[tiles.tile_number(z, x, y)], [z], [x], [y], [part], [len(ordered)], [data]], pa.schema([("tile_id", pa.int64()), *((n, pa.int32()) for n in ("z", "tile_x", "tile_y", "part")), ("features", pa.int64()), ("data", pa.binary())]))

    return keyed.groupBy("_z", "_x", "_y", "_part").applyInArrow(whole, "tile_id long, z int, tile_x int, tile_y int, part int, features long, data binary")


def _flat(shapes: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(points, points of each ring, each ring's shape and polygon) of multipolygons as Arrow holds them; shapes with a null place, or of none, have no rings."""
    rows, polygons = np.arange(len(shapes)), shapes.flatten()
    polygon_row = np.repeat(rows, pc.fill_null(pc.list_value_length(shapes), 0).to_numpy(zero_copy_only=False))
    rings = polygons.flatten()
    ring_polygon = np.repeat(np.arange(len(polygons)), pc.fill_null(pc.list_value_length(polygons), 0).to_numpy(zero_copy_only=False))
    places = rings.flatten()
    sizes = pc.fill_null(pc.list_value_length(rings), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    # A null place reads as one that is not finite.
    x, y = (pc.fill_null(pc.cast(c, pa.float64()), float("nan")).to_numpy(zero_copy_only=False) for c in places.flatten())
    return np.column_stack((x, y)), sizes, polygon_row[ring_polygon], ring_polygon


def features(found: DataFrame, layer: str, schema: str, tile_units: bool = False) -> DataFrame:
    """(z, tile_x, tile_y, parts, the properties that schema names) for each feature of a layer in rows of tiles: in degrees, or in the tile's units. A layer's further parts (layer_2 ...) count as it. What a feature has not, or has in another kind, is null."""
    own = T._parse_datatype_string(schema)
    out = T.StructType([*(T.StructField(n, T.IntegerType()) for n in ("z", "tile_x", "tile_y")), T.StructField("parts", T._parse_datatype_string(geo.MULTIPOLYGON)), *own])
    arrow = pa.schema([("z", pa.int32()), ("tile_x", pa.int32()), ("tile_y", pa.int32()), ("parts", pa.list_(pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))))])

    def typed(v, kind):
        number = isinstance(v, (int, float)) and not isinstance(v, bool)
        if isinstance(kind, T.StringType):
            return v if isinstance(v, str) else None
        if isinstance(kind, T.BooleanType):
            return v if isinstance(v, bool) else None
        if isinstance(kind, T.IntegralType):
            return int(v) if number and v % 1 == 0 else None  # NaN and infinity leave NaN
        return float(v) if number else None

    def nested(some, z, x, y, extent):
        # Rings that are no single points are closed again.
        start, closed = np.cumsum(some.size) - some.size, some.size > 1
        points = np.insert(some.points, (start + some.size)[closed], some.points[start[closed]], 0)
        places = (points.astype(float) if tile_units else tiles.degrees((points / extent + (x, y)) / (1 << z))).reshape(-1, 2)
        out = pa.StructArray.from_arrays([pa.array(places[:, 0]), pa.array(places[:, 1])], ["x", "y"])
        for n in (some.size + closed, some.rings, some.polygons):
            out = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))), pa.int32()), out)
        return out.cast(arrow.field(3).type)

    def column(some, field):
        values = np.array([*(typed(v, field.dataType) for v in some.values), None], object)
        feature, key, value = some.tags
        mine = np.array([k == field.name for k in some.keys], bool)[key] if len(key) else np.zeros(0, bool)
        out = np.full(some.features, None, object)
        out[feature[mine]] = values[value[mine]]
        return pa.array(out.tolist(), _arrow(field.dataType))

    def run(batches):
        for batch in batches:
            for z, x, y, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for name, extent, some in tiles.flat_layers(data):
                    if name != layer and not (name.startswith(f"{layer}_") and name[len(layer) + 1 :].isdigit()):
                        continue
                    if some.features:
                        yield pa.RecordBatch.from_arrays([*(pa.array(np.full(some.features, v), pa.int32()) for v in (z, x, y)), nested(some, z, x, y, extent), *(column(some, f) for f in own)], out.names)

    return found.select("z", "tile_x", "tile_y", "data").mapInArrow(run, out)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def _opened(path: str):
    """(file system, path) of a path or an address that Arrow reads."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class Joined:
    """The files below a folder, in the order of their paths, as one file."""

    def __init__(self, system, folder: str):
        self.system, self.at, self.files = system, 0, []
        end = 0
        for info in sorted(system.get_file_info(fs.FileSelector(folder, recursive=True)), key=lambda i: i.path):
            if info.is_file and not info.path.endswith(".tried"):
                self.files.append((end, end + info.size, info.path))
                end += info.size

    def __enter__(self) -> Joined:
        return self

    def __exit__(self, *_) -> None:
        pass

    def seek(self, at: int) -> None:
        self.at = at

    def read(self, size: int) -> bytes:
        out = []
        for start, end, path in self.files:
            if start < self.at + size and self.at < end:
                with self.system.open_input_file(path) as f:
                    f.seek(max(self.at - start, 0))
                    out.append(f.read(min(end, self.at + size) - max(start, self.at)))
        self.at += size
        return b"".join(out)


def directory(ids, runs, sizes, starts) -> bytes:
    """A packed directory of entries in order of their ids: a place that follows the last entry's end is told by a 0."""
    ids, sizes, starts = (np.asarray(v, np.int64) for v in (ids, sizes, starts))
    follows = np.append(False, starts[1:] == starts[:-1] + sizes[:-1])[: len(ids)]
    lists = np.diff(ids, prepend=0), np.asarray(runs, np.int64), sizes, np.where(follows, 0, starts + 1)
    return gzip.compress(tiles.varints(np.concatenate(([len(ids)], *lists))), mtime=0)


def entries(data: bytes) -> Iterator[tuple[int, int, int, int]]:
    """(id, run, size, start) of a directory; a run of 0 is a directory below it."""
    v = tiles.numbers(data).astype(np.int64)
    n = int(v[0]) if len(v) else 0
    ids, runs, sizes, places = v[1 : 1 + 4 * n].reshape(4, n)
    end = 0
    for number, run, size, place in zip(ids.cumsum().tolist(), runs.tolist(), sizes.tolist(), places.tolist(), strict=True):
        start = place - 1 if place else end
        end = start + size
        yield number, run, size, start


def write_archive(found: DataFrame, folder: str, metadata: dict | None = None, partitions: int | None = None, bounds: tuple[float, float, float, float] = (-180.0, -tiles.NORTH, 180.0, tiles.NORTH)) -> None:
    """Rows of tiled() as an archive of any size: files that in the order of their paths are one document, `0-head`, `1-leaves/`, `2-tiles/`.

    Each of the partitions writes its run of tiles along the curve as one file and, when it is known how much lies
    before it, the directory of them; the driver sees a row a partition. A task that is tried again writes its file
    anew. folder must be reachable from all tasks. partitions are as many as those of shuffles, and 1,000 at most, as
    the first directory holds no more than about 2,000; too many raise an error.
    """
    target, root = _opened(folder)
    partitions = partitions or min(1000, int(found.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    for name in ("1-leaves", "2-tiles"):
        target.create_dir(f"{root}/{name}", recursive=True)

    def put(path: str, chunks: Iterable[bytes]) -> None:
        system, base = _opened(folder)
        with system.open_output_stream(f"{base}/{path}.tried") as f:
            for c in chunks:
                f.write(c)
        system.move(f"{base}/{path}.tried", f"{base}/{path}")

    def body(batches):
        from pyspark import TaskContext

        task, rows = TaskContext.get(), []

        def chunks():
            for batch in batches:
                for number, z, n, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if rows and rows[-1][1] == number:
                        rows[-1][3] += len(data)
                        rows[-1][4] += n
                    else:
                        rows.append([task.partitionId(), number, z, len(data), n])
                    yield data

        stream = chunks()
        if (head := next(stream, None)) is not None:
            put(f"2-tiles/part-{task.partitionId():05d}", (c for part in ((head,), stream) for c in part))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 5, (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)], ["p", "tile_id", "z", "size", "features"])

    # Ranges are found by a look at all ids, which must not make the tiles again.
    made = written(found.select("tile_id", "z", "features", "data", "part"), "tiles")
    ordered = made.repartitionByRange(partitions, "tile_id").sortWithinPartitions("tile_id", "part").drop("part")
    listed = written(ordered.mapInArrow(body, "p int, tile_id long, z int, size long, features long"), "tile-directory")
    parts = sorted(listed.groupBy("p").agg(F.sum("size").alias("size"), F.count("*").alias("n"), F.min("z").alias("low"), F.max("z").alias("high")).collect(), key=lambda r: r["p"])  # a row a partition
    before, total = {}, 0
    for r in parts:
        before[r["p"]], total = total, total + r["size"]

    def leaf(key, rows):
        rows = rows.sort_values("tile_id")
        sizes = rows["size"].to_numpy()
        data = directory(rows["tile_id"], np.ones(len(rows), int), sizes, before[int(key[0])] + sizes.cumsum() - sizes)
        put(f"1-leaves/part-{int(key[0]):05d}", [data])
        return pd.DataFrame({"p": [key[0]], "tile_id": [int(rows["tile_id"].iloc[0])], "size": [len(data)]})

    leaves = sorted(listed.groupBy("p").applyInPandas(leaf, "p int, tile_id long, size long").collect(), key=lambda r: r["p"])  # a row a partition
    sizes = np.array([r["size"] for r in leaves], np.int64)
    first = directory([r["tile_id"] for r in leaves], np.zeros(len(leaves), int), sizes, sizes.cumsum() - sizes)
    if HEAD.size + len(first) > FIRST_BYTES:
        raise ValueError(f"the first directory of {len(leaves)} partitions is too large: use fewer")
    about = gzip.compress(json.dumps(metadata or {}).encode(), mtime=0)
    n, at = sum(r["n"] for r in parts), HEAD.size + len(first)
    low, high = min((r["low"] for r in parts), default=0), max((r["high"] for r in parts), default=0)
    west, south, east, north = (round(b * 10_000_000) for b in bounds)
    leaf_bytes = int(sizes.sum())
    head = HEAD.pack(b"PMTiles", 3, HEAD.size, len(first), at, len(about), at + len(about), leaf_bytes, at + len(about) + leaf_bytes, total, n, n, n, 1, GZIP, PLAIN, VECTOR, low, high, west, south, east, north, low, (west + east) // 2, (south + north) // 2)
    put("0-head", [head, first, about])


@dataclass
class Leaf(InputPartition):
    entries: list[tuple[int, int, int, int]]


class TileArchive(DataSource):
    """Tiles of an archive: (tile_id, z, tile_x, tile_y, data), a partition a directory below the first. Options: path (of a file or of write_archive()'s folder, that all tasks reach) or url (of a server that gives ranges), tries, pause, timeout. Tiles that are packed are unpacked."""

    @classmethod
    def name(cls) -> str:
        return "tile_archive"

    def schema(self) -> str:
        return "tile_id long, z int, tile_x int, tile_y int, data binary"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return TileArchiveReader(dict(self.options))


class TileArchiveReader(DataSourceReader):
    #: Tiles of a partition where the first directory names tiles itself.
    TILES = 1000

    def __init__(self, options: dict[str, str]):
        self.path, self.url = options.get("path"), options.get("url")
        self.limits = int(options.get("tries", 5)), float(options.get("pause", 0.5)), float(options.get("timeout", 60))

    def _file(self):
        if self.url:
            return io.BufferedReader(RangeFile(self.url, *self.limits), 1 << 20)
        system, path = _opened(self.path)
        return system.open_input_file(path) if system.get_file_info(path).is_file else Joined(system, path)

    @staticmethod
    def _part(f, start: int, size: int, packing: int = PLAIN) -> bytes:
        f.seek(start)
        data = f.read(size)
        if len(data) < size:
            raise ValueError(f"the archive ends before {start + size}")
        if packing not in (0, PLAIN, GZIP):
            raise ValueError(f"packing {packing} is not known")
        return zlib.decompress(data, 47) if packing == GZIP else data

    def _head(self, f) -> tuple:
        head = HEAD.unpack(self._part(f, 0, HEAD.size))
        if head[0] != b"PMTiles" or head[1] != 3:
            raise ValueError("no archive of tiles, version 3")
        return head

    def partitions(self) -> list[Leaf]:
        with self._file() as f:
            head = self._head(f)
            first = list(entries(self._part(f, head[2], head[3], head[14])))
        own = [e for e in first if e[1]]
        return [Leaf([e]) for e in first if not e[1]] + [Leaf(own[i : i + self.TILES]) for i in range(0, len(own), self.TILES)] or [Leaf([])]

    def read(self, partition: Leaf) -> Iterator[tuple]:
        with self._file() as f:
            head, waiting = self._head(f), [iter(partition.entries)]
            while waiting:
                entry = next(waiting[-1], None)
                if entry is None:
                    waiting.pop()
                    continue
                number, run, size, start = entry
                if not run:
                    waiting.append(entries(self._part(f, head[6] + start, size, head[14])))
                    continue
                data = self._part(f, head[8] + start, size, head[15])
                for k in range(number, number + run):
                    yield k, *tiles.tile_place(k), data
