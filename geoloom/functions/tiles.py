"""Single map tiles: shapes cut by a quadtree of Web-Mercator squares, and the protocol-buffer form in which tiles hold them (vector tiles, version 2).

A shape is a list of polygons, each a list of rings; a ring of one point is a point.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Fixed values of the form: kinds of geometry, commands, numbers of fields.
POINT, POLYGON = 1, 3
MOVE, LINE, CLOSE = 1, 2, 7
LAYER, NAME, FEATURE, KEY, VALUE, EXTENT, VERSION = 3, 1, 2, 3, 4, 5, 15
TAGS, KIND, GEOMETRY = 2, 3, 4
#: Latitude at which the square world ends.
NORTH = 85.05112878


def mercator(points: np.ndarray) -> np.ndarray:
    """Degrees to the unit square, whose origin is its north-western corner."""
    lat = np.radians(np.clip(points[:, 1], -NORTH, NORTH))
    return np.column_stack(((points[:, 0] + 180) / 360, np.clip((1 - np.log(np.tan(lat) + 1 / np.cos(lat)) / math.pi) / 2, 0, 1)))


def degrees(points: np.ndarray) -> np.ndarray:
    return np.column_stack((points[:, 0] * 360 - 180, np.degrees(np.arctan(np.sinh(math.pi * (1 - 2 * points[:, 1]))))))


def twice_area(ring: np.ndarray):
    """Signed, of a ring with or without its closing point."""
    b = np.roll(ring, -1, 0)
    return (ring[:, 0] * b[:, 1] - b[:, 0] * ring[:, 1]).sum()


@dataclass
class Rings:
    """Many rings as arrays: their points one after the other, and for each ring its number of points, its shape, the polygon's place in the shape, whether it is the polygon's outer one, and the square it is cut to. Closed but for single points. Rings of one polygon in one square follow each other, as do the polygons of a shape there."""

    points: np.ndarray
    size: np.ndarray
    shape: np.ndarray
    polygon: np.ndarray
    outer: np.ndarray
    x: np.ndarray
    y: np.ndarray
    tiny: np.ndarray

    @property
    def start(self) -> np.ndarray:
        return np.cumsum(self.size) - self.size

    def take(self, at: np.ndarray) -> Rings:
        return Rings(self.points[_ranges(self.start[at], self.size[at])], *(getattr(self, n)[at] for n in ("size", "shape", "polygon", "outer", "x", "y", "tiny")))

    def begins(self, polygons: bool) -> np.ndarray:
        """Which rings are the first of their shape in its square, or of their polygon."""
        out = np.ones(len(self.size), bool)
        for i, c in enumerate((self.shape, self.x, self.y, *([self.polygon] if polygons else []))):
            out[1:] = c[1:] != c[:-1] if i == 0 else out[1:] | (c[1:] != c[:-1])
        return out

    def without_lost(self, kept: np.ndarray) -> Rings:
        """The kept rings of polygons whose outer ring is kept."""
        if not len(self.size):
            return self
        owner = np.cumsum(self.begins(True)) - 1
        alive = np.zeros(owner[-1] + 1, bool)
        alive[owner[kept & self.outer]] = True
        return self.take(np.flatnonzero(kept & alive[owner]))


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1 ... of each range, one after the other."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _half(points: np.ndarray, size: np.ndarray, axis: int, limit: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
    """Closed rings' parts on one side of a level or upright line each: (points, sizes); a ring with no point there has none."""
    full = np.flatnonzero(size)
    if not len(full):
        return points, size
    n = size[full]
    start = np.cumsum(n) - n
    v = side * (points[:, axis] - np.repeat(limit[full], n))
    inside = v >= 0
    some = np.add.reduceat(inside, start)
    mixed = np.repeat((some > 0) & (some < n), n)
    if not mixed.any() and some.all():
        return points, size
    cross = np.zeros(len(v), bool)
    cross[1:] = inside[1:] != inside[:-1]
    cross[start] = False
    keep = inside.copy()
    keep[start] &= ~mixed[start]
    emitted = cross.astype(np.int64) + keep
    last = start + n - 1
    closed = last[mixed[last]]
    emitted[closed] += 1
    at = np.cumsum(emitted) - emitted
    out = np.empty((int(emitted.sum()), 2))
    c = np.flatnonzero(cross)
    share = (v[c - 1] / (v[c - 1] - v[c]))[:, None]
    hit = points[c - 1] + share * (points[c] - points[c - 1])
    hit[:, axis] = np.repeat(limit[full], n)[c]
    out[at[c]] = hit
    out[(at + cross)[keep]] = points[keep]
    out[at[closed] + emitted[closed] - 1] = out[at[start[mixed[last]]]]
    sizes = size.copy()
    sizes[full] = np.add.reduceat(emitted, start)
    return out, sizes


def _within(r: Rings, side: float, margin: float, whole: int, zoom: int) -> Rings:
    """The parts of each ring in its square with a margin around it; single points are in one square only, but for margins. A polygon below a tile unit goes with its known tile; squares are `whole` zooms above tiles."""
    if not len(r.size):
        return r
    start, corner = r.start, np.column_stack((r.x, r.y)) * side
    low, high = corner - margin, corner + side + margin
    least, most = np.minimum.reduceat(r.points, start), np.maximum.reduceat(r.points, start)
    single = r.size == 1
    kept = np.where(single, (least >= low).all(1) & ((least < high) | (high >= 1 + margin) & (least <= 1)).all(1), ~((least >= high).any(1) | (most <= low).any(1)))
    if r.tiny.any():
        to = np.clip(np.floor((least + most) / 2 * (1 << zoom)), 0, (1 << zoom) - 1).astype(np.int64) >> whole
        kept = np.where(r.tiny, (to[:, 0] == r.x) & (to[:, 1] == r.y), kept)
    r = r.without_lost(kept)
    if not len(r.size):
        return r
    start, corner = r.start, np.column_stack((r.x, r.y)) * side
    low, high = corner - margin, corner + side + margin
    outside = (np.minimum.reduceat(r.points, start) < low) | (np.maximum.reduceat(r.points, start) > high)
    crossing = (r.size > 1) & ~r.tiny & outside.any(1)
    at = np.flatnonzero(crossing)
    if not len(at):
        return r
    some = r.take(at)
    points, size = some.points, some.size
    for axis in (0, 1):
        points, size = _half(points, size, axis, low[at, axis], 1)
        points, size = _half(points, size, axis, high[at, axis], -1)
    sizes = r.size.copy()
    sizes[at] = size
    new = np.repeat(crossing, sizes)
    both = np.empty((len(new), 2))
    both[new], both[~new] = points, r.points[~np.repeat(crossing, r.size)]
    r.points, r.size = both, sizes
    return r.without_lost(sizes > 0)


def _quartered(r: Rings) -> Rings:
    """Each ring four times, in the squares of half the side."""
    n = len(r.size)
    # Rings of a shape stay together in each of its squares.
    group = np.cumsum(r.begins(False)) - 1
    at, k = np.tile(np.arange(n), 4), np.repeat(np.arange(4), n)
    order = np.lexsort((at, k, group[at]))
    at, k = at[order], k[order]
    out = r.take(at)
    out.x, out.y = 2 * out.x + k // 2, 2 * out.y + k % 2
    return out


def rings_of(points: np.ndarray, sizes: np.ndarray, shape: np.ndarray, polygon: np.ndarray, zoom: int, extent: int) -> Rings:
    """Rings of degrees, in order of their shapes and polygons, for cut_all(). Shapes with empty rings or points that are not finite go."""
    good = np.ones(int(shape.max()) + 1 if len(shape) else 0, bool)
    good[shape[sizes == 0]] = False
    places = mercator(points)
    good[np.repeat(shape, sizes)[~np.isfinite(places).all(1)]] = False
    outer = np.ones(len(sizes), bool)
    outer[1:] = (shape[1:] != shape[:-1]) | (polygon[1:] != polygon[:-1])
    zero = np.zeros(len(sizes), np.int64)
    r = Rings(places, sizes, shape, polygon, outer, zero, zero, np.zeros(len(sizes), bool))
    first = np.maximum.accumulate(np.where(outer, np.arange(len(sizes)), 0))
    # A ring of one point is a polygon of its own kind, which has no holes, and no hole.
    r = r.take(np.flatnonzero(good[shape] & (outer | (sizes > 1) & (sizes[first] > 1))))
    if not len(r.size):
        return r
    start = r.start
    last = start + r.size - 1
    open_ = (r.size > 1) & (r.points[start] != r.points[last]).any(1)
    r.points, r.size = np.insert(r.points, last[open_] + 1, r.points[start[open_]], 0), r.size + open_
    start = r.start
    whole = np.floor(r.points * (1 << zoom) * extent + 0.5)
    ahead = np.vstack((whole[1:], whole[:1]))
    ahead[start + r.size - 1] = whole[start + r.size - 1]  # the closing point meets itself
    area = np.add.reduceat(whole[:, 0] * ahead[:, 1] - ahead[:, 0] * whole[:, 1], start)
    r.tiny = r.outer & (r.size > 1) & (area == 0)
    first = np.maximum.accumulate(np.where(r.outer, np.arange(len(r.size)), 0))
    return r.take(np.flatnonzero(r.outer | ~r.tiny[first]))


@dataclass
class Features:
    """Features as arrays: shape, tile, kind and number of rings of each; of each ring the points and whether it is an outer one; all rings' points in tile units, without closing points."""

    shape: np.ndarray
    x: np.ndarray
    y: np.ndarray
    kind: np.ndarray
    rings: np.ndarray
    size: np.ndarray
    outer: np.ndarray
    points: np.ndarray


def _quantised(r: Rings, zoom: int, extent: int) -> Features:
    """Rings in whole tile units without the closing point and without points that repeat; those that are nothing go."""
    n, start = 1 << zoom, r.start
    owner = np.repeat(np.arange(len(r.size)), r.size)
    tile = np.column_stack((r.x, r.y))
    q = np.floor((r.points * n - tile[owner]) * extent + 0.5).astype(np.int64)
    size = r.size.copy()
    if r.tiny.any():
        at = np.flatnonzero(r.tiny)
        middle = (np.minimum.reduceat(r.points, start)[at] + np.maximum.reduceat(r.points, start)[at]) / 2
        unit = np.floor((middle * n - tile[at]) * extent).astype(np.int64)
        square = (unit[:, None] + np.array([(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)])).reshape(-1, 2)
        size[at] = 5
        all_, to = np.empty((int(size.sum()), 2), np.int64), np.repeat(r.tiny, size)
        all_[to], all_[~to] = square, q[~r.tiny[owner]]
        q, start = all_, np.cumsum(size) - size
        owner = np.repeat(np.arange(len(size)), size)
    point = size == 1
    # Without the closing point, a point's last one is the one before it, the first one's that before the closing one.
    before = np.arange(len(q)) - 1
    before[start] = start + np.maximum(size - 2, 0)
    kept = (q != q[before]).any(1)
    kept[(start + size - 1)[~point]] = False
    kept[start[point]] = True
    size = np.add.reduceat(kept, start)
    q, owner = q[kept], owner[kept]
    full = np.flatnonzero(size)
    begin = (np.cumsum(size) - size)[full]
    after = np.arange(len(q)) + 1
    after[begin + size[full] - 1] = begin
    area = np.zeros(len(size), np.int64)
    if len(q):
        area[full] = np.add.reduceat(q[:, 0] * q[after, 1] - q[after, 0] * q[:, 1], begin)
    area[size < 3] = 0
    outer = r.outer
    polygon = np.cumsum(r.begins(True)) - 1
    balance = np.zeros(polygon[-1] + 1 if len(polygon) else 0, np.int64)
    np.add.at(balance, polygon, np.where(outer, abs(area), -abs(area)))
    good = point | (area != 0) & (balance[polygon] > 0)
    # An outer ring goes the way of positive areas, holes the other.
    turn = np.flatnonzero(good & ~point & ((area > 0) != outer))
    begin, every = np.cumsum(size) - size, np.arange(len(q))
    if len(turn):
        at = _ranges(begin[turn], size[turn])
        every[at] = np.repeat(2 * begin[turn] + size[turn] - 1, size[turn]) - at
    q = q[every]
    # Points and polygons of a shape in one tile are two features; polygons below a unit come last.
    group = np.cumsum(r.begins(False)) - 1
    at = np.flatnonzero(good)
    at = at[np.lexsort((at, r.tiny[at], ~point[at], group[at]))]
    q, size, point, outer, group = q[_ranges(begin[at], size[at])], size[at], point[at], outer[at], group[at]
    new = np.ones(len(at), bool)
    new[1:] = (group[1:] != group[:-1]) | (point[1:] != point[:-1])
    f = np.flatnonzero(new)
    return Features(r.shape[at][f], r.x[at][f], r.y[at][f], np.where(point[f], POINT, POLYGON), np.diff(np.append(f, len(at))), size, outer, q)


def cut_all(r: Rings, zoom: int, extent: int = 4096, margin: int = 0, most: int = 1 << 17) -> Iterator[Features]:
    """The features of many shapes in the tiles of a zoom that they meet, by blocks of about `most` points, however many tiles there are.

    All squares are halved again and again, so a tile costs what is in it. Rings that are nothing in tile units go; a
    polygon that is nothing wherever it lies stays as a square of one unit in the tile of its middle. Points and
    polygons of one shape are features of their own. What lies west or east of the world meets no tile.
    """
    unit = margin / (1 << zoom) / extent
    waiting = [(0, r)]
    while waiting:
        depth, r = waiting.pop()
        if not len(r.size):
            continue
        if len(r.points) > most and len(cuts := np.flatnonzero(r.begins(False))) > 1:
            middle = cuts[min(max(int(np.searchsorted(r.start[cuts], len(r.points) // 2)), 1), len(cuts) - 1)]
            waiting += [(depth, r.take(np.arange(middle, len(r.size)))), (depth, r.take(np.arange(middle)))]
        elif depth < zoom:
            waiting.append((depth + 1, _within(_quartered(r), 1.0 / (2 << depth), unit, zoom - depth - 1, zoom)))
        else:
            r = _within(r, 1.0 / (1 << zoom), unit, 0, zoom)
            if len(r.size) and len((found := _quantised(r, zoom, extent)).shape):
                yield found


def cut(parts: list, zoom: int, extent: int = 4096, margin: int = 0) -> Iterator[tuple[int, int, int, list]]:
    """(x, y, kind, polygons in tile units) for each tile of a zoom that one shape meets; null shapes and those with points that are not finite meet none."""
    rings = [(i, np.asarray(r, float).reshape(-1, 2)) for i, p in enumerate(parts or []) for r in p]
    if not rings:
        return
    sizes = np.array([len(r) for _, r in rings])
    for f in cut_all(rings_of(np.vstack([r for _, r in rings]), sizes, np.zeros(len(sizes), np.int64), np.array([i for i, _ in rings]), zoom, extent), zoom, extent, margin):
        every = np.split(f.points, np.cumsum(f.size)[:-1])
        ends = np.cumsum(f.rings)
        for x, y, kind, low, high in zip(f.x.tolist(), f.y.tolist(), f.kind.tolist(), (ends - f.rings).tolist(), ends.tolist(), strict=True):
            polygons: list = []
            for i in range(low, high):
                polygons += [[every[i]]] if f.outer[i] else []
                if not f.outer[i]:
                    polygons[-1].append(every[i])
            yield x, y, kind, polygons


def all_commands(f: Features) -> tuple[np.ndarray, np.ndarray]:
    """What commands() writes for each feature: (the bytes of all, each one's number of them)."""
    feature = np.repeat(np.arange(len(f.rings)), f.rings)
    of_point = np.repeat(feature, f.size)
    first = np.ones(len(of_point), bool)
    first[1:] = of_point[1:] != of_point[:-1]
    d = np.diff(f.points, axis=0, prepend=np.zeros((1, 2), np.int64))
    d[first] = f.points[first]
    steps = (d << 1) ^ (d >> 63)
    area = f.kind[feature] == POLYGON
    # A ring's numbers: move, a place, line, places, close. A feature of points has one move before all.
    begin = np.zeros(len(f.rings), np.int64)
    begin[1:] = np.cumsum(f.rings)[:-1]
    extra = np.where(area, 3, 0)
    extra[begin] += ~area[begin]
    n = 2 * f.size + extra
    at = np.cumsum(n) - n
    out = np.zeros(int(n.sum()), np.int64)
    inner = np.arange(len(of_point)) - np.repeat(np.cumsum(f.size) - f.size, f.size)
    lead = np.zeros(len(f.size), np.int64)
    lead[begin] = 1
    place = np.repeat(np.where(area, at + 1, at + lead), f.size) + 2 * inner + (np.repeat(area, f.size) & (inner > 0))
    out[place], out[place + 1] = steps[:, 0], steps[:, 1]
    out[at[area]] = MOVE | 1 << 3
    out[at[area] + 3] = LINE | (f.size[area] - 1) << 3
    out[(at + n)[area] - 1] = CLOSE | 1 << 3
    dots = begin[~area[begin]]
    out[at[dots]] = MOVE | f.rings[~area[begin]] << 3
    data, sizes = packed(out)
    return data, np.add.reduceat(sizes, at[begin]) if len(begin) else sizes


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the bytes of varints(), each number's number of them)."""
    v = np.asarray(values).astype(np.uint64)
    sizes = np.ones(len(v), np.int64)
    for k in range(1, 10):
        more = v >= np.uint64(1 << 7 * k)
        if not more.any():
            break
        sizes += more
    start = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)
    for k in range(int(sizes.max(initial=0))):
        m = np.flatnonzero(sizes > k)
        out[start[m] + k] = (v[m] >> np.uint64(7 * k)).astype(np.uint8) & 127 | (sizes[m] > k + 1) * np.uint8(128)
    return out, sizes


def varints(values) -> bytes:
    """Numbers of 64 bits, seven bits a byte, the low ones first."""
    v = np.asarray(values, np.uint64).reshape(-1, 1)
    digits = v >> (np.arange(10, dtype=np.uint64) * np.uint64(7))
    more = np.column_stack((digits[:, 1:] > 0, np.zeros(len(v), bool)))
    used = np.column_stack((np.ones(len(v), bool), digits[:, 1:] > 0))
    return ((digits & np.uint64(127)).astype(np.uint8) | (more * np.uint8(128)))[used].tobytes()


def numbers(data: bytes) -> np.ndarray:
    """What varints() has packed."""
    b = np.frombuffer(data, np.uint8)
    if not len(b):
        return np.zeros(0, np.uint64)
    starts = np.concatenate(([0], np.flatnonzero(b < 128)[:-1] + 1))
    place = np.arange(len(b)) - np.repeat(starts, np.diff(np.append(starts, len(b))))
    return np.add.reduceat((b & 127).astype(np.uint64) << (place * 7).astype(np.uint64), starts)


def commands(kind: int, polygons: list) -> bytes:
    """The pen's way along points or rings: steps from the last place, outer rings one way round, holes the other."""
    out, at = [], np.zeros((1, 2), np.int64)

    def steps(points):
        nonlocal at
        d = np.diff(np.vstack((at, points)), axis=0)
        at = points[-1:]
        return ((d << 1) ^ (d >> 63)).ravel()

    if kind == POINT:
        places = np.vstack([p[0] for p in polygons])
        return varints(np.concatenate(([MOVE | len(places) << 3], steps(places))))
    for rings in polygons:
        for i, ring in enumerate(rings):
            ring = ring if (twice_area(ring) > 0) == (i == 0) else ring[::-1]
            out += [[MOVE | 1 << 3], steps(ring[:1]), [LINE | (len(ring) - 1) << 3], steps(ring[1:]), [CLOSE | 1 << 3]]
    return varints(np.concatenate(out))


def shape(kind: int, data: bytes) -> list:
    """What commands() has written: polygons of rings without closing points; each ring that goes the outer way begins a polygon. Of a line, each stroke is a ring."""
    v, out, at, i, ring = numbers(data), [], np.zeros(2, np.int64), 0, []
    while i < len(v):
        command, count = int(v[i]) & 7, int(v[i]) >> 3
        i += 1
        if command == CLOSE:
            ring = np.vstack(ring)
            if twice_area(ring) > 0 or not out:
                out.append([ring])
            else:
                out[-1].append(ring)
            ring = []
            continue
        z = v[i : i + 2 * count].astype(np.int64).reshape(-1, 2)
        i += 2 * count
        places = at + ((z >> 1) ^ -(z & 1)).cumsum(0)
        at = places[-1]
        if kind == POINT:
            out += [[p.reshape(1, 2)] for p in places]
        elif command == MOVE:
            if ring and kind != POLYGON:
                out.append([np.vstack(ring)])
            ring = [places]
        else:
            ring.append(places)
    return out + ([[np.vstack(ring)]] if ring and kind != POINT else [])


def _varint(n: int) -> bytes:
    """varints() of one number, without arrays."""
    if n < 128:
        return _ONE[n]
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


_ONE = [bytes([b]) for b in range(128)]


def _sized(number: int, data: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(data)) + data


def _number(number: int, value: int) -> bytes:
    return _varint(number << 3) + _varint(value)


def _value(v) -> bytes:
    """A property as the form's value: text, double, signed whole number or truth."""
    if isinstance(v, str):
        return _sized(1, v.encode())
    if isinstance(v, bool):
        return _number(7, int(v))
    if isinstance(v, int):
        return _number(6, v << 1 if v >= 0 else (-v << 1) - 1)
    return _varint(3 << 3 | 1) + struct.pack("<d", v)


def layer(name: str, names: list[str], features: list[tuple[int, bytes, tuple]], extent: int = 4096) -> bytes:
    """A tile of one layer from (kind, commands, properties in the order of names); null properties are left out. Tiles written one after the other are a tile of all their layers."""
    values: dict[bytes, int] = {}
    body = []
    for kind, geometry, properties in features:
        tags = [t for k, v in enumerate(properties) if v is not None for t in (k, values.setdefault(_value(v), len(values)))]
        body.append(_sized(FEATURE, _sized(TAGS, b"".join(map(_varint, tags))) + _number(KIND, kind) + _sized(GEOMETRY, geometry)))
    head = _number(VERSION, 2) + _sized(NAME, name.encode())
    return _sized(LAYER, head + b"".join(body) + b"".join(_sized(KEY, n.encode()) for n in names) + b"".join(_sized(VALUE, v) for v in values) + _number(EXTENT, extent))


def fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a message's fields: bytes, whole numbers or doubles."""
    i = 0

    def number():
        nonlocal i
        value = shift = 0
        while True:
            b = data[i]
            i += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while i < len(data):
        key = number()
        wire = key & 7
        if wire == 0:
            yield key >> 3, number()
        else:
            size = number() if wire == 2 else 8 if wire == 1 else 4
            part = data[i : i + size]
            i += size
            yield key >> 3, part if wire == 2 else struct.unpack("<d" if wire == 1 else "<f", part)[0]


def _read_value(data: bytes):
    (number, v), *_ = fields(data)
    if number == 1:
        return v.decode()
    if number == 4:  # signed, in two's complement
        return v - (1 << 64) if v >> 63 else v
    return (v >> 1) ^ -(v & 1) if number == 6 else bool(v) if number == 7 else v


def _raw_layers(data: bytes) -> Iterator[tuple[str, int, list[bytes], list[str], list]]:
    """(name, extent, messages of features, keys, values) of a tile."""
    for number, content in fields(data):
        if number != LAYER:
            continue
        name, extent, raw, keys, values = "", 4096, [], [], []
        for k, v in fields(content):
            if k == NAME:
                name = v.decode()
            elif k == FEATURE:
                raw.append(v)
            elif k == KEY:
                keys.append(v.decode())
            elif k == VALUE:
                values.append(_read_value(v))
            elif k == EXTENT:
                extent = v
        yield name, extent, raw, keys, values


def layers(data: bytes) -> Iterator[tuple[str, int, list[tuple[int, list, dict]]]]:
    """(name, extent, features as (kind, polygons in tile units, properties)) of a tile."""
    for name, extent, raw, keys, values in _raw_layers(data):
        out = []
        for f in raw:
            parts = dict(fields(f))
            tags = numbers(parts.get(TAGS, b"")).astype(int).reshape(-1, 2)
            kind = parts.get(KIND, 0)
            out.append((kind, shape(kind, parts.get(GEOMETRY, b"")), {keys[a]: values[b] for a, b in tags}))
        yield name, extent, out


@dataclass
class Layer:
    """A layer as arrays: of each feature the number of polygons, of each polygon that of rings, of each ring that of points; all points, rings without closing ones; and the properties as (feature, key, value), the last of which counts."""

    features: int
    polygons: np.ndarray
    rings: np.ndarray
    size: np.ndarray
    points: np.ndarray
    tags: tuple[np.ndarray, np.ndarray, np.ndarray]
    keys: list[str]
    values: list


def flat_layers(data: bytes) -> Iterator[tuple[str, int, Layer]]:
    """(name, extent, Layer) of a tile: layers(), all features at once."""
    for name, extent, raw, keys, values in _raw_layers(data):
        found = [dict(fields(f)) for f in raw]
        pairs, n = _numbers_of([f.get(TAGS, b"") for f in found])
        tags = np.repeat(np.arange(len(found)), n // 2), pairs[::2].astype(np.int64), pairs[1::2].astype(np.int64)
        kinds, geometry = np.array([f.get(KIND, 0) for f in found], np.int64), [f.get(GEOMETRY, b"") for f in found]
        shapes = _flat_shapes(kinds, geometry)
        if shapes is None:
            each = [shape(k, g) for k, g in zip(kinds.tolist(), geometry, strict=True)]
            rings = [r for f in each for p in f for r in p]
            shapes = np.array([len(f) for f in each], np.int64), np.array([len(p) for f in each for p in f], np.int64), np.array([len(r) for r in rings], np.int64), np.vstack([np.zeros((0, 2), np.int64), *rings])
        yield name, extent, Layer(len(found), *shapes, tags, keys, values)


def _numbers_of(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(the numbers of all parts, how many each has)."""
    data = b"".join(parts)
    ends = np.cumsum([0, *map(len, parts)])
    count = np.concatenate(([0], np.cumsum(np.frombuffer(data, np.uint8) < 128)))[ends]
    return numbers(data), np.diff(count)


def _flat_shapes(kinds: np.ndarray, geometry: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """(polygons of each feature, rings of each polygon, points of each ring, points) of shape(), or None where features are neither places after one move nor rings of a move, lines and a close."""
    v, n = _numbers_of(geometry)
    v, end = v.astype(np.int64), np.cumsum(n)
    at, dot = end - n, kinds == POINT
    if not (n > 0).all() or not (dot | (kinds == POLYGON)).all() or (v[at] & 7 != MOVE).any():
        return None
    moved = v[at[dot]] >> 3
    if (1 + 2 * moved != n[dot]).any():
        return None
    owner, begin, size = [np.repeat(np.flatnonzero(dot), moved)], [_ranges(at[dot] + 1, 2 * moved)[::2]], [np.ones(int(moved.sum()), np.int64)]
    feature = np.flatnonzero(~dot)
    at, end = at[feature], end[feature]
    while len(feature):  # the next ring of each
        if (at + 4 > end - 1).any() or (v[at] != (MOVE | 1 << 3)).any() or (v[at + 3] & 7 != LINE).any():
            return None
        lines = v[at + 3] >> 3
        close = at + 4 + 2 * lines
        if (close >= end).any() or (v[close] & 7 != CLOSE).any():
            return None
        owner.append(feature)
        begin.append(at)
        size.append(lines + 1)
        more = close + 1 < end
        feature, at, end = feature[more], close[more] + 1, end[more]
    owner, begin, size = (np.concatenate(x) for x in (owner, begin, size))
    order = np.argsort(begin, kind="stable")
    owner, begin, size = owner[order], begin[order], size[order]
    # A ring's first place follows its move, the others its line.
    inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    area = np.repeat(~dot[owner], size)
    place = np.repeat(begin, size) + 2 * inner + area + (area & (inner > 0))
    z = np.column_stack((v[place], v[place + 1]))
    points = ((z >> 1) ^ -(z & 1)).cumsum(0)
    start = np.cumsum(size) - size
    first = np.ones(len(owner), bool)
    first[1:] = owner[1:] != owner[:-1]
    if len(owner):
        lead = start[first]
        offset = np.vstack((np.zeros((1, 2), np.int64), points))[lead]
        points = points - np.repeat(offset, np.add.reduceat(size, np.flatnonzero(first)), 0)
        after = np.arange(len(points)) + 1
        after[start + size - 1] = start
        twice = np.add.reduceat(points[:, 0] * points[after, 1] - points[after, 0] * points[:, 1], start)
        new = first | dot[owner] | (twice > 0)
    else:
        new = first
    at = np.flatnonzero(new)
    return np.bincount(owner[at], minlength=len(kinds)), np.diff(np.append(at, len(owner))), size, points


def tile_number(z: int, x: int, y: int) -> int:
    """A tile's place among all: smaller zooms first, within a zoom along the Hilbert curve."""
    total = (4**z - 1) // 3
    for a in reversed(range(z)):
        s = 1 << a
        right, down = bool(x & s), bool(y & s)
        total += s * s * ((3 * right) ^ down)
        if not down:
            x, y = (s - 1 - (y & (s - 1)), s - 1 - (x & (s - 1))) if right else (y, x)
    return total


def tile_place(number: int) -> tuple[int, int, int]:
    """(z, x, y) of tile_number()."""
    z = 0
    while number >= 4**z:
        number -= 4**z
        z += 1
    x = y = 0
    for a in range(z):
        s = 1 << a
        right = bool(number & 2)
        down = bool(number & 1) != right
        if not down:
            x, y = (s - 1 - y, s - 1 - x) if right else (y, x)
        x, y = x + s * right, y + s * down
        number >>= 2
    return z, x, y
