"""Spatial joins as equi-joins on grid cells, with an exact predicate after them.

Shapes are indexed by their boxes in a tree of grids whose cells are powers of four: a box lies in the level whose cells
are just larger than it, and so in four of them at most, however large it is. What looks for boxes looks into its own
cells of each level that has any. Boxes, ids and cells go through these joins; geometries are fetched by id for the
pairs whose boxes meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..sources.scratch import scratch_path, written
from . import relational

#: The least and greatest level; a level's cells have sides of 2 to its power.
LEAST, MOST = -40, 40


def cells_of_box(box: Column, step: float) -> Column:
    """array<struct<cx, cy>> of all cells that a bounding box meets."""
    span = lambda low, high: F.sequence(F.floor(box[low] / step).cast("long"), F.floor(box[high] / step).cast("long"))
    return F.flatten(F.transform(span("xmin", "xmax"), lambda x: F.transform(span("ymin", "ymax"), lambda y: F.struct(x.alias("cx"), y.alias("cy")))))


def boundary_index(df: DataFrame, id_columns: list[str], name_columns: list[str], parts: str = "parts") -> DataFrame:
    """(boundary_id, boundary_name, parts, box) of the rows with a geometry; the first id and name that are not null."""
    kept = df.where(F.col(parts).isNotNull() & (F.size(parts) > 0))
    return kept.select(F.coalesce(*(F.col(c).cast("string") for c in id_columns)).alias("boundary_id"), F.coalesce(*(F.col(c).cast("string") for c in name_columns)).alias("boundary_name"), parts, geo.bbox(F.col(parts)).alias("box"))


def level_of(box: Column) -> Column:
    """The level of a box: an even number, of the smallest cells that are no smaller than it."""
    side = F.greatest(box["xmax"] - box["xmin"], box["ymax"] - box["ymin"])
    return F.greatest(F.lit(LEAST), F.least(F.lit(MOST), F.when(side > 0, 2 * F.ceil(F.log2(side) / 2)).otherwise(LEAST))).cast("int")


def cells_at(box: Column, levels: Column) -> Column:
    """array<struct<level, cx, cy>> of the cells of these levels that a box meets."""
    span = lambda low, high, size: F.sequence(F.floor(box[low] / size).cast("long"), F.floor(box[high] / size).cast("long"))
    cell = lambda n, x, y: F.struct(n.alias("level"), x.alias("cx"), y.alias("cy"))
    return F.flatten(F.transform(levels, lambda n: geo.bound(F.pow(F.lit(2.0), n), lambda size: F.flatten(F.transform(span("xmin", "xmax", size), lambda x: F.transform(span("ymin", "ymax", size), lambda y: cell(n, x, y)))))))


def levels_in(df: DataFrame) -> list[int]:
    """The levels of a table's boxes, few as there are."""
    return sorted(r[0] for r in df.select(level_of(F.col("box")).alias("level")).distinct().collect())


def box_pairs(left: DataFrame, right: DataFrame, left_levels: list[int], right_levels: list[int]) -> DataFrame:
    """Rows of left and right whose boxes (`lbox`, `rbox`) share a point, each pair once. Levels are those of either side's boxes; without left_levels left only looks for boxes of right, as points do."""

    def placed(df: DataFrame, box: str, own: bool, other: list[int], mark: str) -> DataFrame:
        level = level_of(F.col(box))
        visited = F.filter(F.lit(other).cast("array<int>"), lambda n: n > level if own else n >= level)
        cells = F.concat(F.array(level), visited) if own else visited
        return df.select("*", F.inline(cells_at(F.col(box), cells))).withColumn(mark, (F.col("level") == level) if own else F.lit(False))

    cells = placed(left, "lbox", bool(left_levels), right_levels, "_l").join(placed(right, "rbox", True, left_levels, "_r"), ["level", "cx", "cy"])
    c = F.col
    meet = (c("lbox.xmin") <= c("rbox.xmax")) & (c("rbox.xmin") <= c("lbox.xmax")) & (c("lbox.ymin") <= c("rbox.ymax")) & (c("rbox.ymin") <= c("lbox.ymax"))
    # Of the cells in which two meet, the one that holds the lower corner of what they share stands.
    size = F.pow(F.lit(2.0), c("level"))
    first = (F.floor(F.greatest(c("lbox.xmin"), c("rbox.xmin")) / size) == c("cx")) & (F.floor(F.greatest(c("lbox.ymin"), c("rbox.ymin")) / size) == c("cy"))
    return cells.where((c("_l") | c("_r")) & meet & first).drop("level", "cx", "cy", "_l", "_r")


class ShapeIndex:
    """Shapes with a number and a box each, in a table of which boxes are read without the geometries."""

    def __init__(self, df: DataFrame, parts: str = "parts"):
        spark, path = df.sparkSession, scratch_path(df.sparkSession, "shapes")
        kept = df.where(F.col(parts).isNotNull() & (F.size(geo.points(F.col(parts))) > 0))
        kept.withColumn("_shape", F.monotonically_increasing_id()).withColumn("box", geo.bbox(F.col(parts))).write.parquet(path)
        self.parts, self.table = parts, spark.read.parquet(path)
        self.levels = levels_in(self.table)

    def boxes(self, shape: str, box: str) -> DataFrame:
        return self.table.select(F.col("_shape").alias(shape), F.col("box").alias(box))

    def geometry(self, shape: str, parts: str) -> DataFrame:
        return self.table.select(F.col("_shape").alias(shape), F.col(self.parts).alias(parts))

    def edges(self, shape: str, wanted: DataFrame) -> DataFrame:
        """(shape, box, ax, ay, bx, by) for each edge of the wanted shapes."""
        rings = self.geometry(shape, "_p").join(wanted.select(shape).distinct(), shape, "left_semi").select(shape, F.explode(F.flatten("_p")).alias("_r"))
        e = rings.select(shape, F.explode(geo.edges(F.col("_r"))).alias("_e")).select(shape, *(F.col(f"_e.{p}.{k}").alias(p + k) for p in "ab" for k in "xy"))
        low, high = (F.struct(*(f(f"a{k}", f"b{k}").alias(f"{k}{n}") for k in "xy")) for f, n in ((F.least, "min"), (F.greatest, "max")))
        return e.withColumn("box", F.struct(low["xmin"].alias("xmin"), low["ymin"].alias("ymin"), high["xmax"].alias("xmax"), high["ymax"].alias("ymax")))


def points_in_polygons(points: DataFrame, polygons: DataFrame, x: str, y: str, parts: str = "parts", border: bool = False) -> DataFrame:
    """All pairs of a point and a polygon that holds it, with the columns of both. With border, points on a ring are inside. Points without finite coordinates are in none."""
    index = ShapeIndex(polygons, parts)
    finite = lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False))
    placed = points.where(finite(F.col(x)) & finite(F.col(y))).withColumn("lbox", F.struct(F.col(x).alias("xmin"), F.col(y).alias("ymin"), F.col(x).alias("xmax"), F.col(y).alias("ymax")))
    near = box_pairs(placed, index.boxes("_shape", "rbox"), [], index.levels).drop("lbox", "rbox")
    return near.join(index.table, "_shape").where(geo.in_multipolygon(F.col(x), F.col(y), F.col(parts), border)).drop("_shape")


def points_in_any(points: DataFrame, polygons: DataFrame, x: str, y: str, parts: str = "parts") -> DataFrame:
    """The points that lie inside any of the polygons, each once, however many hold it; the rule is that of points_in_polygons.

    Places are judged once each. The cells of a grid, eight at most to a side of a polygon's box, that none of its edges can
    enter lie inside it or outside as wholes; a place in a cell that is inside any polygon needs no other. Only the
    places in no such cell are tested against the polygons around them.
    """
    c = F.col
    places = written(points.where(F.coalesce(F.abs(c(x)) < float("inf"), F.lit(False)) & F.coalesce(F.abs(c(y)) < float("inf"), F.lit(False))).select(c(x).alias("_x"), c(y).alias("_y")).distinct(), "places")
    shapes = polygons.where(c(parts).isNotNull() & (F.size(geo.points(c(parts))) > 0)).select(c(parts).alias("_p"), geo.bbox(c(parts)).alias("box")).where("box.xmax > box.xmin and box.ymax > box.ymin")
    shapes = shapes.repartition(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")))  # a small file of shapes is many cells
    cells = shapes.select("_p", F.inline(cells_at(c("box"), F.array(level_of(c("box")) - 3)))).withColumn("_s", F.pow(F.lit(2.0), c("level")))
    low = {k: c(f"c{k}") * c("_s") for k in "xy"}
    apart = lambda e, k: (F.greatest(e["a"][k], e["b"][k]) < low[k]) | (F.least(e["a"][k], e["b"][k]) > low[k] + c("_s"))
    entered = F.exists(F.flatten("_p"), lambda r: F.exists(geo.edges(r), lambda e: ~(apart(e, "x") | apart(e, "y"))))
    whole = cells.where(~entered).where(geo.in_multipolygon(low["x"] + c("_s") / 2, low["y"] + c("_s") / 2, c("_p")))
    covered = written(whole.select("level", "cx", "cy").distinct(), "covered")
    levels = sorted(r[0] for r in covered.select("level").distinct().collect())
    at = F.struct(c("_x").alias("xmin"), c("_y").alias("ymin"), c("_x").alias("xmax"), c("_y").alias("ymax"))
    within = places.select("_x", "_y", F.inline(cells_at(at, F.lit(levels).cast("array<int>")))).join(covered, ["level", "cx", "cy"], "left_semi").select("_x", "_y").distinct()
    within = written(within, "within")
    open_ = places.join(within, ["_x", "_y"], "left_anti")
    inside = within.unionByName(points_in_polygons(open_, polygons.select(parts), "_x", "_y", parts).select("_x", "_y").distinct())
    return points.join(inside, (c(x) == c("_x")) & (c(y) == c("_y")), "left_semi")


def polygons_intersecting(left: DataFrame, right: DataFrame, left_id: str, right_id: str, parts: str = "parts") -> DataFrame:
    """(left_id, right_id) of the shapes that share a point, be it of their borders only.

    Two shapes meet if edges of theirs do, or else if a part of one lies in the other as a whole. Edges meet by cells as
    boxes do, so no pair of shapes compares all edges of one with all of the other.
    """
    one, two = ShapeIndex(left, parts), ShapeIndex(right, parts)
    near = box_pairs(one.boxes("_one", "lbox"), two.boxes("_two", "rbox"), one.levels, two.levels).select("_one", "_two")
    near = written(near, "near")
    mine, theirs = one.edges("_one", near), two.edges("_two", near)
    c = F.col
    meeting = box_pairs(mine.withColumnRenamed("box", "lbox"), theirs.toDF("_two", "cx_", "cy_", "dx_", "dy_", "rbox"), levels_in(mine), levels_in(theirs))
    crossing = meeting.where(geo.segments_meet(*(c(k) for k in ("ax", "ay", "bx", "by", "cx_", "cy_", "dx_", "dy_")))).select("_one", "_two").distinct()
    crossing = written(crossing, "crossing")
    apart = near.join(crossing, ["_one", "_two"], "left_anti").join(one.geometry("_one", "_p"), "_one").join(two.geometry("_two", "_q"), "_two")
    within = lambda p, q: F.exists(c(p), lambda part: geo.in_multipolygon(part[0][0]["x"], part[0][0]["y"], c(q)))
    inside = apart.where(within("_p", "_q") | within("_q", "_p")).select("_one", "_two")
    ids = lambda index, shape, name: index.table.select(c("_shape").alias(shape), name)
    return crossing.unionByName(inside).join(ids(one, "_one", left_id), "_one").join(ids(two, "_two", right_id), "_two").select(left_id, right_id)


def area_cascade(areas: DataFrame, known: DataFrame, area_id: str, name: str, known_id: str, known_name: str, parts: str = "parts", centre: tuple[str, str] | None = None) -> DataFrame:
    """(area_id, tier, known_id): for each area the known shapes of the first tier that has any: those of its name (1), those whose mean vertex lies in it or on its border (2), those that share a point with it (3). Areas with none keep a null. Only areas without a match go on to the next tier. `centre` names columns of known that hold its mean vertex, where the caller knows it without the rounding of a sum over vertices, which moves centres across borders that they lie on.

    Areas of one geometry, known shapes of one geometry and centres at one place are one each when they are matched; rows
    meet by the numbers of these, in a join that makes results only.
    """
    mean, c = geo.vertex_mean(F.col(parts), closing=False), F.col
    x, y = (c(k) for k in centre) if centre else (mean["x"], mean["y"])
    wanted, shapes = numbered_shapes(areas.select(area_id, c(name).alias("_name"), parts), parts, "_shape")
    kept, others = numbered_shapes(known.select(c(known_id).alias("_target"), c(known_name).alias("_name"), parts, x.alias("_x"), y.alias("_y")), parts, "_other")
    places = written(kept.select("_x", "_y").distinct().withColumn("_place", F.monotonically_increasing_id()), "places")

    def open_shapes(rest: DataFrame) -> DataFrame:
        return shapes.join(rest.select("_shape").distinct(), "_shape", "left_semi").withColumnRenamed("_shape", "_key")

    def named(rest: DataFrame) -> tuple[DataFrame, DataFrame]:
        there = kept.select(c("_name").alias("_key"), "_target")
        return there, there

    def centred(rest: DataFrame) -> tuple[DataFrame, DataFrame]:
        pairs = written(points_in_polygons(places, open_shapes(rest), "_x", "_y", parts, border=True).select("_key", "_place"), "tier")
        return pairs, pairs.join(places, "_place").join(kept, ["_x", "_y"]).select("_key", "_target")

    def meeting(rest: DataFrame) -> tuple[DataFrame, DataFrame]:
        pairs = written(polygons_intersecting(open_shapes(rest), others, "_key", "_other", parts), "tier")
        return pairs, pairs.join(kept, "_other").select("_key", "_target")

    found = relational.keyed_tiers(wanted, area_id, [("_name", named), ("_shape", centred), ("_shape", meeting)], "_target", known.schema[known_id].dataType)
    return found.withColumnRenamed("_target", known_id)


def numbered_shapes(df: DataFrame, parts: str, number: str) -> tuple[DataFrame, DataFrame]:
    """df with a number in place of its geometries, equal for equal ones and null where there is none; (number, parts)."""
    keyed = df.withColumn("_digest", F.sha2(F.col(parts).cast("string"), 256))
    shapes = written(keyed.where("_digest is not null").select("_digest", parts).distinct().withColumn(number, F.monotonically_increasing_id()), "shapes")
    return written(keyed.drop(parts).join(shapes.select("_digest", number), "_digest", "left").drop("_digest"), "numbered"), shapes.select(number, parts)


def first_polygon(points: DataFrame, polygons: DataFrame, point_id: str, x: str, y: str, order: str, value: str, parts: str = "parts") -> DataFrame:
    """Every point with `value` of the first polygon by `order` that holds it, null if none does, also if that polygon's value is null."""
    hits = points_in_polygons(points.select(point_id, x, y), polygons.select(*dict.fromkeys((order, value, parts))), x, y, parts)
    best = hits.groupBy(point_id).agg(F.min_by(F.struct(value), order).alias("_b")).select(point_id, F.col(f"_b.{value}").alias(value))
    return points.join(best, point_id, "left")


def first_of_places(rows: DataFrame, polygons: DataFrame, place: list[str], x: str, y: str, order: str, value: str, parts: str = "parts") -> DataFrame:
    """rows with `value` of the first polygon by `order` that holds them, found once for each distinct place (key columns, of which the coordinates depend) and joined back; places may be null."""
    number = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in place] + [F.col(c).isNull() for c in place]
    keyed = rows.withColumn("_place", F.to_json(F.struct(*(c.alias(f"k{i}") for i, c in enumerate(number)))))
    places = keyed.groupBy("_place").agg(F.first(x).alias("_x"), F.first(y).alias("_y"))
    found = first_polygon(places, polygons, "_place", "_x", "_y", order, value, parts).select("_place", value)
    return keyed.join(found, "_place", "left").drop("_place")


def membership(points: DataFrame, polygons: DataFrame, point_id: str, x: str, y: str, level: str, order: str, value: str) -> DataFrame:
    """(point_id, members): for each level the first polygon that holds the point, as a map without nulls."""
    hits = points_in_polygons(points.select(point_id, x, y).dropDuplicates([point_id]), polygons.select(level, order, value, "parts"), x, y)
    best = hits.groupBy(point_id, level).agg(F.min_by(value, order).alias("_v")).where("_v is not null")
    return points.select(point_id).distinct().join(best.groupBy(point_id).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(level, "_v")))).alias("members")), point_id, "left")


def nearest_segment(points: DataFrame, segments: DataFrame, point_id: str, segment_id: str, tolerance: float, cell: float) -> DataFrame:
    """(point_id, segment_id, distance, x, y): each point of (x, y) moved to its nearest segment of (ax, ay, bx, by) within the tolerance; ties go to the least segment; a point without any stays where it is. cell must be at least the tolerance."""
    box = F.struct(F.least("ax", "bx").alias("xmin"), F.least("ay", "by").alias("ymin"), F.greatest("ax", "bx").alias("xmax"), F.greatest("ay", "by").alias("ymax"))
    gridded = segments.withColumn("_c", F.explode(cells_of_box(box, cell))).select(segment_id, "ax", "ay", "bx", "by", F.col("_c.cx").alias("_cx"), F.col("_c.cy").alias("_cy"))
    around = F.sequence(F.lit(-1), F.lit(1))
    probes = points.select(point_id, "x", "y", F.explode(around).alias("_i")).select("*", F.explode(around).alias("_j"))
    probes = probes.withColumn("_cx", geo.cell(F.col("x"), 0.0, cell) + F.col("_i")).withColumn("_cy", geo.cell(F.col("y"), 0.0, cell) + F.col("_j")).drop("_i", "_j")
    _, nx, ny = geo.segment_projection(F.col("x"), F.col("y"), F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"))
    near = probes.join(gridded, ["_cx", "_cy"]).select(point_id, segment_id, F.hypot(F.col("x") - nx, F.col("y") - ny).alias("distance"), nx.alias("nx"), ny.alias("ny")).where(F.col("distance") <= tolerance)
    best = near.groupBy(point_id).agg(F.min(F.struct("distance", segment_id, "nx", "ny")).alias("b"))
    joined = points.select(point_id, "x", "y").join(best, point_id, "left")
    return joined.select(point_id, F.col(f"b.{segment_id}").alias(segment_id), F.col("b.distance").alias("distance"), F.coalesce("b.nx", "x").alias("x"), F.coalesce("b.ny", "y").alias("y"))


def nearest_for_segments(routes: DataFrame, segments: DataFrame, route_id: str, segment_id: str, cell: float, mid_most: float = 130.0, end_most: float = 234.0) -> DataFrame:
    """(route_id, segment_id, score): each route piece (ax, ay, bx, by) and the segment with the least sum of the distance of its middle, a quarter of those of its ends and a penalty for the angle, within both limits; ties go to the least segment."""
    other = segments.select(segment_id, *(F.col(c).alias(f"s{c}") for c in ("ax", "ay", "bx", "by")))
    # A segment lies in all cells within reach of its box, so a route piece is looked up once, by the cell of its middle.
    reach = int(-(-mid_most // cell)) * cell
    box = F.struct((F.least("sax", "sbx") - reach).alias("xmin"), (F.least("say", "sby") - reach).alias("ymin"), (F.greatest("sax", "sbx") + reach).alias("xmax"), (F.greatest("say", "sby") + reach).alias("ymax"))
    gridded = other.withColumn("_c", F.explode(cells_of_box(box, cell))).withColumn("_cx", F.col("_c.cx")).withColumn("_cy", F.col("_c.cy")).drop("_c")
    c = F.col
    mx, my = (c("ax") + c("bx")) / 2, (c("ay") + c("by")) / 2
    probes = routes.select(route_id, "ax", "ay", "bx", "by", geo.cell(mx, 0.0, cell).alias("_cx"), geo.cell(my, 0.0, cell).alias("_cy"))
    far = lambda x, y: geo.segment_distance(x, y, c("sax"), c("say"), c("sbx"), c("sby"))
    scored = probes.join(gridded, ["_cx", "_cy"]).withColumn("_mid", far(mx, my)).withColumn("_start", far(c("ax"), c("ay"))).withColumn("_end", far(c("bx"), c("by")))
    scored = scored.where((c("_mid") <= mid_most) & (c("_start") <= end_most) & (c("_end") <= end_most))
    penalty = geo.angle_penalty(c("bx") - c("ax"), c("by") - c("ay"), c("sbx") - c("sax"), c("sby") - c("say"))
    best = scored.groupBy(route_id).agg(F.min(F.struct((c("_mid") + 0.25 * (c("_start") + c("_end")) + penalty).alias("score"), segment_id)).alias("b"))
    # As many rows as routes: they meet by a shuffle, never as a copy of all that passes the driver.
    return routes.select(route_id).join(best.hint("merge"), route_id, "left").select(route_id, F.col(f"b.{segment_id}").alias(segment_id), F.col("b.score").alias("score"))


def cells_within(shapes: DataFrame, shape_id: str, distance: Column, cell: float, rows: int, cols: int) -> DataFrame:
    """(shape_id, row, col): the cells of a grid from the origin whose centre is within a distance of a segment (ax, ay, bx, by)."""
    span = lambda a, b, most: F.sequence(F.greatest(F.lit(0), F.floor((F.least(a, b) - distance) / cell)).cast("int"), F.least(F.lit(most - 1), F.floor((F.greatest(a, b) + distance) / cell)).cast("int"))
    c = F.col
    ok = lambda a, b, most: (F.floor((F.greatest(a, b) + distance) / cell) >= 0) & (F.floor((F.least(a, b) - distance) / cell) <= most - 1)
    inside = shapes.where(ok(c("ax"), c("bx"), cols) & ok(c("ay"), c("by"), rows))
    grid = inside.select("*", F.explode(span(c("ax"), c("bx"), cols)).alias("col")).select("*", F.explode(span(c("ay"), c("by"), rows)).alias("row"))
    far = geo.segment_distance((c("col") + 0.5) * cell, (c("row") + 0.5) * cell, c("ax"), c("ay"), c("bx"), c("by"))
    return grid.where(far <= distance).select(shape_id, "row", "col").distinct()


def tile_cover(boxes: DataFrame, zoom: int) -> DataFrame:
    """boxes with a row for each Web-Mercator tile (z, x, y) that their `box` meets."""
    x0, y1 = geo.tile(F.col("box.xmin"), F.col("box.ymin"), zoom)
    x1, y0 = geo.tile(F.col("box.xmax"), F.col("box.ymax"), zoom)
    return boxes.select("*", F.lit(zoom).alias("z"), F.explode(F.sequence(x0, x1)).alias("tile_x")).select("*", F.explode(F.sequence(y0, y1)).alias("tile_y"))


def parent_by_prefix(children: DataFrame, parents: DataFrame, child_id: str, parent_id: str, length: int, fallback: DataFrame | None = None) -> DataFrame:
    """Children with the parent whose id is their id's prefix, else the one of `fallback` (child_id, parent_id); those with neither are dropped."""
    known = parents.select(F.col(parent_id).alias("_p"))
    out = children.join(known, F.substring(child_id, 1, length) == F.col("_p"), "left")
    if fallback is not None:
        out = out.join(fallback.select(child_id, F.col(parent_id).alias("_f")), child_id, "left").withColumn("_p", F.coalesce("_p", "_f")).drop("_f")
    return out.where("_p is not null").withColumnRenamed("_p", parent_id)
