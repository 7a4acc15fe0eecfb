"""The area of rings that cross, touch or run over each other: what lies in an odd number of them, as valid polygons.

All edges are cut where they meet, and pieces that lie on each other cancel in pairs. What is left cuts the plane into
faces. Around the joined pieces of one kind the faces are inside and outside in turn, and a face that is inside is a
polygon. Coordinates are rational numbers until the end, so that no decision depends on rounding.
"""

from __future__ import annotations

from collections import defaultdict
from fractions import Fraction
from functools import cmp_to_key

import numpy as np

Point = tuple[Fraction, Fraction]


def _cross(o: Point, a: Point, b: Point) -> Fraction:
    return (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])


def near_pairs(low: np.ndarray, high: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of segments whose boxes meet: a line sweeps over them by x, and those that it still crosses are compared by y."""
    order = np.argsort(low[:, 0], kind="stable")
    active, out = np.zeros(0, np.int64), []
    for i in order:
        active = active[high[active, 0] >= low[i, 0]]
        out += [(int(j), int(i)) for j in active[(high[active, 1] >= low[i, 1]) & (low[active, 1] <= high[i, 1])]]
        active = np.append(active, i)
    return out


def _cuts(a: Point, b: Point, c: Point, d: Point) -> list[Point]:
    """Where the segments from a to b and from c to d meet: a point, or the ends of what they share."""
    r, s, o = (b[0] - a[0], b[1] - a[1]), (d[0] - c[0], d[1] - c[1]), (c[0] - a[0], c[1] - a[1])
    slope, side = r[0] * s[1] - r[1] * s[0], o[0] * r[1] - o[1] * r[0]
    if slope:
        t = (o[0] * s[1] - o[1] * s[0]) / slope
        return [(a[0] + t * r[0], a[1] + t * r[1])] if 0 <= t <= 1 and 0 <= side / slope <= 1 else []
    if side:
        return []
    between = lambda p, q, x: min(p, q) <= x <= max(p, q)  # noqa: E731  on one line, points are in order as pairs
    return [x for x in (c, d) if between(a, b, x)] + [x for x in (a, b) if between(c, d, x)]


def pieces(rings: list[np.ndarray]) -> tuple[set[tuple[Point, Point]], bool]:
    """(the pieces of edges on which an odd number of rings runs, whether any edge was cut or cancelled)."""
    edges = np.concatenate([np.hstack((r[:-1], r[1:])) for r in rings]) if rings else np.zeros((0, 4))
    edges = edges[(edges[:, :2] != edges[:, 2:]).any(1)]
    ends = [((Fraction(x), Fraction(y)), (Fraction(z), Fraction(w))) for x, y, z, w in edges.tolist()]
    on = [set(e) for e in ends]
    for i, j in near_pairs(np.minimum(edges[:, :2], edges[:, 2:]), np.maximum(edges[:, :2], edges[:, 2:])):
        for x in _cuts(*ends[i], *ends[j]):
            on[i].add(x)
            on[j].add(x)
    odd: set[tuple[Point, Point]] = set()
    for points in on:
        ordered = sorted(points)
        odd ^= set(zip(ordered, ordered[1:], strict=False))
    return odd, len(odd) != len(edges)


def _around(centre: Point, others: list[Point]) -> list[Point]:
    """Points in order of their angle, counter-clockwise."""
    upper = lambda p: p[1] < centre[1] or (p[1] == centre[1] and p[0] < centre[0])

    def compare(p: Point, q: Point) -> int:
        turn = _cross(centre, p, q)
        return upper(p) - upper(q) or (turn < 0) - (turn > 0)

    return sorted(others, key=cmp_to_key(compare))


def _area(cycle: list[Point]) -> Fraction:
    return sum((p[0] * q[1] - q[0] * p[1] for p, q in zip(cycle, cycle[1:] + cycle[:1], strict=True)), Fraction(0))


def _holds(edges, p: Point) -> bool:
    """Whether a point lies in an odd number of the rings of these edges, on none of which it is."""
    odd = False
    for a, b in edges:
        if (a[1] > p[1]) != (b[1] > p[1]):
            odd ^= p[0] < (b[0] - a[0]) * (p[1] - a[1]) / (b[1] - a[1]) + a[0]
    return odd


def _simple(cycle: list[Point]) -> list[list[Point]]:
    """A cycle that comes back to a point, as cycles that do not."""
    out, way, at = [], [], {}
    for p in cycle:
        if p in at:
            out.append(way[at[p] :])
            for q in way[at[p] + 1 :]:
                del at[q]
            way = way[: at[p] + 1]
        else:
            at[p] = len(way)
            way.append(p)
    return [*out, way]


def polygons(odd: set[tuple[Point, Point]]) -> list[list[list[Point]]]:
    """The polygons, outer ring first, of what lies in an odd number of rings."""
    beside = defaultdict(list)
    for a, b in odd:
        beside[a].append(b)
        beside[b].append(a)
    for p, others in beside.items():
        beside[p] = _around(p, others) if len(others) > 2 else others
    # The face to the left of a step turns at its end as far to the left as it can.
    onward = {(q, p): (p, others[i - 1]) for p, others in beside.items() for i, q in enumerate(others)}
    face_of, faces = {}, []
    for step in onward:
        if step not in face_of:
            cycle, now = [], step
            while now not in face_of:
                face_of[now] = len(faces)
                cycle.append(now[0])
                now = onward[now]
            faces.append(cycle)
    # Pieces that hang together have one face around them all, which runs clockwise.
    group, groups = {}, []
    for start in beside:
        if start not in group:
            members, open_ = [], [start]
            group[start] = len(groups)
            while open_:
                p = open_.pop()
                members.append(p)
                for q in beside[p]:
                    if q not in group:
                        group[q] = len(groups)
                        open_.append(q)
            groups.append(members)
    areas = [_area(f) for f in faces]
    around = {group[f[0]]: i for i, f in enumerate(faces) if areas[i] < 0}
    edges_of = defaultdict(list)
    for a, b in odd:
        edges_of[group[a]].append((a, b))
    within = {g: _holds([e for k, es in edges_of.items() if k != g for e in es], members[0]) for g, members in enumerate(groups)}
    inside = {}
    for g, outer in around.items():
        inside[outer], open_ = within[g], [outer]
        while open_:
            f = open_.pop()
            cycle = faces[f]
            for p, q in zip(cycle, cycle[1:] + cycle[:1], strict=True):
                other = face_of[q, p]
                if other not in inside:
                    inside[other] = not inside[f]
                    open_.append(other)
    out, where = [], {}
    for f, yes in inside.items():
        if yes and f not in around.values():
            where[f] = len(out)
            out.append(sorted(_simple(faces[f]), key=_area, reverse=True))  # what a face goes round clockwise is a hole that touches its border
    for g, outer in around.items():
        if within[g]:
            p = groups[g][0]
            holders = [f for f in where if group[faces[f][0]] != g and _holds(list(zip(faces[f], faces[f][1:] + faces[f][:1], strict=True)), p)]
            out[where[min(holders, key=lambda f: areas[f])]] += _simple(faces[outer])
    return out


def repaired(rings: list[np.ndarray]) -> list[list[np.ndarray]] | None:
    """Valid polygons of what lies in an odd number of the rings; None if no ring touches itself or another, so that nothing has to be cut."""
    odd, changed = pieces(rings)
    if not changed and all(n == 2 for n in _degrees(odd).values()):
        return None
    close = lambda ring: np.array([(float(x), float(y)) for x, y in [*ring, ring[0]]])
    return [[close(r) for r in p] for p in polygons(odd)]


def _degrees(odd) -> dict[Point, int]:
    out: dict[Point, int] = defaultdict(int)
    for a, b in odd:
        out[a] += 1
        out[b] += 1
    return out
