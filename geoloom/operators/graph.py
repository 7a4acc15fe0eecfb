"""Edges of routes: shared edges, chains of edges, filled regions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import written


def shared_edges(df: DataFrame, edge: str, route: str, sets: list[str], order: str, coordinates: str) -> DataFrame:
    """A row for each edge and route: its sorted sets, and the coordinates of its first occurrence."""
    return df.groupBy(edge, route).agg(*(F.array_sort(F.collect_set(c)).alias(c) for c in sets), F.min_by(coordinates, order).alias(coordinates))


def chains(df: DataFrame, group: str, a: str, b: str) -> DataFrame:
    """(group, nodes): the edges of each group joined where exactly two meet, from the lesser end; circles start at their least node, towards its lesser neighbour.

    Every step along an edge points to the one after it, the last one to itself. Round by round each takes over where
    the one that it points to points, so that n steps need log2(n) joins of narrow rows, and no task holds a group.
    Steps that never come to an end are on circles, which are cut at their least node and ranked again.
    """
    name = F.col
    ends = df.select(group, name(a).cast("string").alias("_a"), name(b).cast("string").alias("_b")).where("_a != _b")
    edges = ends.select(group, F.least("_a", "_b").alias("u"), F.greatest("_a", "_b").alias("v")).distinct()
    steps = edges.unionByName(edges.select(group, name("v").alias("u"), name("u").alias("v"))).withColumn("id", F.monotonically_increasing_id())
    steps = written(steps, "steps")
    through = steps.groupBy(group, "u").agg(F.count("*").alias("n")).where("n = 2").select(group, name("u").alias("v"))
    onward = steps.select(group, name("u").alias("v"), name("v").alias("w"), name("id").alias("to"))
    follow = steps.join(through, [group, "v"]).join(onward, [group, "v"]).where("w != u").select("id", "to")
    state = steps.join(follow, "id", "left").select("id", "u", "v", F.coalesce("to", "id").alias("to"))
    ranked, endless = _ranked(state)
    if endless:
        circles = ranked.where("endless")
        cut = circles.select("id", "u", "v", F.when(name("v") == name("least"), name("id")).alias("own"), "least").join(follow, "id").select("id", "u", "v", F.coalesce("own", "to").alias("to"))
        ranked = ranked.where("not endless").unionByName(_ranked(cut)[0].where("not endless"))
    nodes = F.transform(F.array_sort(F.collect_list(F.struct(F.negative("hops").alias("at"), "u", "v"))), lambda x: x["u"])
    found = ranked.join(steps.select("id", group), "id").groupBy(group, "to").agg(F.concat(nodes, F.array(F.max_by("v", F.negative("hops")))).alias("nodes"))
    size = F.size("nodes")
    pair = lambda i, k: F.struct(F.element_at("nodes", i).alias("p"), F.element_at("nodes", k).alias("q"))
    # Each chain has been found from both of its ends.
    return found.where(pair(F.lit(1), F.lit(2)) <= pair(size, size - 1)).select(group, "nodes")


def _ranked(state: DataFrame) -> tuple[DataFrame, int]:
    """(id, u, v, to, hops, least, endless) of (id, u, v, to): the last step that each comes to and how many it takes there; of endless steps, whose number is the second value, the least node on their way."""
    now = written(state.withColumn("hops", (F.col("to") != F.col("id")).cast("long")).withColumn("least", F.col("u")), "ranks")
    far, before = 1, -1
    while True:
        still = now.where(F.col("hops") == far).count()
        if still == 0 or (still == before and far >= still):
            return now.withColumn("endless", F.col("hops") == far), still
        other = now.select(F.col("id").alias("to"), F.col("to").alias("_to"), F.col("hops").alias("_hops"), F.col("least").alias("_least"))
        now = written(now.join(other, "to").select("id", "u", "v", F.col("_to").alias("to"), (F.col("hops") + F.col("_hops")).alias("hops"), F.least("least", "_least").alias("least")), "ranks")
        far, before = 2 * far, still


def flatten_tree(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """(id, depth, path) of all nodes below the roots of (parent, child); level by level, as deep as the tree is. A path that comes back to a node of its own raises an error."""
    level = roots.select(F.col("id"), F.lit(0).alias("depth"), F.array(F.col("id").cast("string")).alias("path"))
    levels, depth = [level], 0
    while True:
        depth += 1
        below = level.join(edges, F.col("id") == F.col("parent")).select(F.col("child").alias("id"), F.lit(depth).alias("depth"), "path", F.col("child").cast("string").alias("own"))
        known = F.assert_true(~F.array_contains("path", F.col("own")), F.concat(F.lit("circle at "), F.col("own")))
        level = _cut(below.select("id", "depth", F.concat("path", F.array(F.col("own"))).alias("path"), known.alias("ok")).where("ok is null").drop("ok"))
        if level.isEmpty():
            break
        levels.append(level)
    return reduce(DataFrame.unionByName, levels).withColumn("path", F.array_join("path", " / "))


def fill_holes(cells: DataFrame, rows: int, cols: int) -> DataFrame:
    """Cells (row, col) and all empty ones of the grid that no path of empty neighbours joins to its edge.

    Empty cells of a row that touch are one run; runs that touch a run of the row below take the least label of both,
    round by round, until none changes; what has the label of a run on the edge is outside.
    """
    spark = cells.sparkSession
    grid = spark.range(rows).select(F.col("id").cast("int").alias("row")).crossJoin(spark.range(cols).select(F.col("id").cast("int").alias("col")))  # the grid itself
    empty = grid.join(cells, ["row", "col"], "left_anti")
    w = Window.partitionBy("row").orderBy("col")
    runs = empty.withColumn("run", F.col("col") - F.row_number().over(w)).groupBy("row", "run").agg(F.min("col").alias("low"), F.max("col").alias("high"))
    runs = _cut(runs.select("row", "low", "high", (F.col("row").cast("long") * cols + F.col("low") + 1).alias("id")))
    below = runs.select((F.col("row") - 1).alias("row"), F.col("low").alias("low_b"), F.col("high").alias("high_b"), F.col("id").alias("b"))
    links = runs.join(below, "row").where("low <= high_b and low_b <= high").select(F.col("id").alias("a"), "b")
    links = _cut(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    at_edge = F.col("row").isin(0, rows - 1) | (F.col("low") == 0) | (F.col("high") == cols - 1)
    labels = _cut(runs.select("id", F.when(at_edge, F.lit(0)).otherwise(F.col("id")).cast("long").alias("label")))
    while True:
        near = links.join(labels, F.col("b") == F.col("id")).groupBy("a").agg(F.min("label").alias("near"))
        # A label is a run's own number: that run's label is a step further.
        hop = labels.select(F.col("id").alias("label"), F.col("label").alias("onward"))
        new = labels.join(near, F.col("id") == F.col("a"), "left").join(hop, "label", "left").select("id", F.least(F.col("label"), F.coalesce("near", "label"), F.coalesce("onward", "label")).alias("label"))
        new = _cut(new)
        if not new.join(labels.withColumnRenamed("label", "old"), "id").where("label < old").limit(1).count():
            break
        labels = new
    outside = runs.join(labels.where("label = 0"), "id").select("row", F.explode(F.sequence("low", "high")).alias("col"))
    return grid.join(outside, ["row", "col"], "left_anti")


def _cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut where the session has a folder for that."""
    return df.checkpoint() if df.sparkSession.sparkContext.getCheckpointDir() else df.persist()
