"""The registered queries of the analytics operators over the star-schema tables, and the SQL that gives the same rows.

Coordinates are derived from integer keys; polygons, segments, aliases and trees are literals.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, geo, parse, text
from ..operators import aggregates as agg
from ..operators import graph, relational, spatial
from ..sources import landed
from ..streaming.incremental import session_counts, sliding_counts, tumbling_counts, without_repeats
from .base import lat, lat_sql, lon, lon_sql, oracle_sql, queries, query, table

_lon, _lat = lon_sql, lat_sql


# Rings of the literal polygons: (number, level, id, ring number, points); ring 0 is the outer one.
RINGS = [
    (1, "region", "west", 0, [(-139, 48), (-130, 48), (-130, 58), (-139, 58), (-139, 48)]),
    (1, "region", "west", 1, [(-136, 50), (-134, 50), (-134, 53), (-136, 53), (-136, 50)]),
    (2, "region", "east", 0, [(-131, 49), (-115, 49), (-115, 60), (-131, 60), (-131, 49)]),
    (3, "district", "bent", 0, [(-128, 50), (-118, 50), (-118, 58), (-121, 58), (-121, 53), (-128, 53), (-128, 50)]),
    (4, "district", None, 0, [(-138, 55), (-125, 55), (-125, 57), (-138, 57), (-138, 55)]),
    (5, "district", "north", 0, [(-138, 54), (-120, 54), (-120, 59), (-138, 59), (-138, 54)]),
]


def polygons(spark: SparkSession) -> DataFrame:
    """(n, level, id, parts, box) of the literal polygons."""
    by: dict[int, tuple] = {}
    for n, level, name, _, points in RINGS:
        by.setdefault(n, (n, level, name, [[]]))[3][0].append([{"x": float(x), "y": float(y)} for x, y in points])
    df = spark.createDataFrame(list(by.values()), f"n int, level string, id string, parts {geo.MULTIPOLYGON}")
    return df.withColumn("box", geo.bbox(F.col("parts")))


_EDGES = ", ".join(f"({n}, '{lv}', {'NULL' if name is None else repr(name)}, {r}, {ax}, {ay}, {bx}, {by})" for n, lv, name, r, pts in RINGS for (ax, ay), (bx, by) in zip(pts, pts[1:], strict=False))
_PIP = f"""edges(n, level, id, ring, ax, ay, bx, by_) AS (VALUES {_EDGES}),
crossings AS (SELECT k, x, y, v, n, level, id, ring, count(*) FILTER (((ay > y) <> (by_ > y)) AND x < (bx - ax)::DOUBLE * (y - ay) / nullif(by_ - ay, 0) + ax) % 2 AS odd FROM pts, edges GROUP BY ALL),
hits AS (SELECT k, x, y, v, n, level, id FROM crossings GROUP BY ALL HAVING max(CASE WHEN ring = 0 THEN odd END) = 1 AND coalesce(max(CASE WHEN ring > 0 THEN odd END), 0) = 0)"""
_CUSTOMERS = f"pts AS (SELECT c_custkey AS k, {_lon('c_custkey')} AS x, {_lat('c_custkey')} AS y, c_acctbal AS v FROM customer)"
_SUPPLIERS = f"pts AS (SELECT s_suppkey AS k, {_lon('s_suppkey')} AS x, {_lat('s_suppkey')} AS y, s_acctbal AS v FROM supplier)"


def _points(spark: SparkSession, sf_dir: str, name: str, key: str, value: str) -> DataFrame:
    return table(spark, sf_dir, name).select(F.col(key).alias("k"), lon(F.col(key)).alias("x"), lat(F.col(key)).alias("y"), F.col(value).alias("v"))


@query("""SELECT ix, iy, count(v) AS "count", round_even(sum(v) / count(v), 6) AS mean, min(v) AS "min", max(v) AS "max" FROM (SELECT CAST(floor((l_extendedprice - 900) / 2000.0) AS BIGINT) AS ix, CAST(floor((l_quantity - 0) / 5.0) AS BIGINT) AS iy, l_discount AS v FROM lineitem) GROUP BY ix, iy""")
def grid_cell_stats(spark, sf_dir):
    """Statistics of the cells of a grid."""
    return agg.grid_stats(table(spark, sf_dir, "lineitem"), "l_extendedprice", "l_quantity", "l_discount", (900.0, 0.0), (2000.0, 5.0))


@query("""WITH l AS (SELECT CAST(floor(l_extendedprice / 2000.0) AS BIGINT) AS ix, CAST(floor(l_quantity / 5.0) AS BIGINT) AS iy, unnest(['l_discount', 'l_tax']) AS variable, unnest([l_discount, l_tax]) AS v FROM lineitem) SELECT variable, count(v) AS "count", min(v) AS "min", max(v) AS "max", count(DISTINCT (ix, iy)) AS cells FROM l GROUP BY variable""")
def variable_totals(spark, sf_dir):
    """Totals of each variable from its cells."""
    long = relational.unpivoted(table(spark, sf_dir, "lineitem"), ["l_extendedprice", "l_quantity"], ["l_discount", "l_tax"])
    return agg.variable_stats(agg.grid_stats(long, "l_extendedprice", "l_quantity", "value", (0.0, 0.0), (2000.0, 5.0), ("variable",)))


@query(f"""WITH {_CUSTOMERS}, {_PIP} SELECT n, 'v' AS variable, count(v) AS "count", round_even(sum(v) / count(v), 6) AS mean, min(v) AS "min", max(v) AS "max" FROM hits GROUP BY n""")
def boundary_means_all(spark, sf_dir):
    """All polygons that hold a point."""
    hits = spatial.points_in_polygons(_points(spark, sf_dir, "customer", "c_custkey", "c_acctbal"), polygons(spark), "x", "y")
    return agg.boundary_stats(hits.select("n", "v"), "n", ["v"])


@query(f"""WITH {_CUSTOMERS}, {_PIP}, f AS (SELECT k, n, id FROM hits QUALIFY row_number() OVER (PARTITION BY k ORDER BY n) = 1) SELECT k, id FROM pts LEFT JOIN f USING (k)""")
def first_boundary(spark, sf_dir):
    """The first polygon in order, whose id may be null."""
    points = _points(spark, sf_dir, "customer", "c_custkey", "c_acctbal")
    return spatial.first_polygon(points, polygons(spark), "k", "x", "y", "n", "id").select("k", "id")


@query(f"""WITH {_SUPPLIERS}, {_PIP}, f AS (SELECT k, level, id FROM hits QUALIFY row_number() OVER (PARTITION BY k, level ORDER BY n) = 1) SELECT k, level, id FROM f WHERE id IS NOT NULL""")
def membership_map(spark, sf_dir):
    """A point's polygon at each level, from a map."""
    m = spatial.membership(_points(spark, sf_dir, "supplier", "s_suppkey", "s_acctbal"), polygons(spark), "k", "x", "y", "level", "n", "id")
    return m.select("k", F.explode("members").alias("level", "id"))


_SEGMENTS = [(1, -139.0, 48.0, -130.0, 52.0), (2, -130.0, 52.0, -122.0, 59.0), (3, -125.0, 48.0, -118.0, 50.0), (4, -130.0, 52.0, -118.0, 50.0), (5, -135.0, 58.0, -135.0, 58.0)]
_T = "greatest(0.0, least(1.0, coalesce(((x - ax) * (bx - ax) + (y - ay) * (by_ - ay)) / nullif((bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay), 0), 0)))"


@query(f"""WITH {_SUPPLIERS}, s(seg, ax, ay, bx, by_) AS (SELECT column0, column1::DOUBLE, column2::DOUBLE, column3::DOUBLE, column4::DOUBLE FROM (VALUES {", ".join(map(str, _SEGMENTS))}) v(column0, column1, column2, column3, column4)),
d AS (SELECT k, x, y, seg, sqrt((x - (ax + {_T} * (bx - ax))) ** 2 + (y - (ay + {_T} * (by_ - ay))) ** 2) AS distance FROM pts, s),
b AS (SELECT k, seg, distance FROM d WHERE distance <= 1.3 QUALIFY row_number() OVER (PARTITION BY k ORDER BY distance, seg) = 1)
SELECT k, seg, round(distance, 6) AS distance FROM pts LEFT JOIN b USING (k)""")
def nearest_segment(spark, sf_dir):
    """The nearest segment within a tolerance."""
    segments = spark.createDataFrame(_SEGMENTS, "seg int, ax double, ay double, bx double, by double")
    found = spatial.nearest_segment(_points(spark, sf_dir, "supplier", "s_suppkey", "s_acctbal"), segments, "k", "seg", 1.3, 1.3)
    return found.select("k", "seg", F.round("distance", 6).alias("distance"))


@query("""WITH p AS (SELECT n_nationkey AS k, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS customers, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS suppliers, n_regionkey AS area FROM nation),
d AS (SELECT k, customers / (CASE WHEN area > 0 THEN area ELSE 1 END)::DOUBLE AS c, suppliers / (CASE WHEN area > 0 THEN area ELSE 1 END)::DOUBLE AS s, 7.0::DOUBLE AS e FROM p),
m AS (SELECT k, CASE WHEN max(c) OVER () = min(c) OVER () THEN 50.0 ELSE (c - min(c) OVER ()) / (max(c) OVER () - min(c) OVER ()) * 100 END AS cs, CASE WHEN max(s) OVER () = min(s) OVER () THEN 50.0 ELSE 100 - (s - min(s) OVER ()) / (max(s) OVER () - min(s) OVER ()) * 100 END AS ss, 50.0 AS es FROM d)
SELECT k, floor((cs * 0.5 + ss * 0.3 + es * 0.2) / 1.0 * 10 + 0.5) / 10 AS balanced, floor((cs * 0.75 + ss * 0.25) / 1.0 * 10 + 0.5) / 10 AS plain FROM m""")
def minmax_composite(spark, sf_dir):
    """Zero-filled counts, densities, scaled scores and weighted variants."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_regionkey").alias("area"))
    base = relational.summarised(table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "k"), nation, "k", lambda: F.count("*"), "customers")
    base = relational.summarised(table(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "k"), base, "k", lambda: F.count("*"), "suppliers")
    dense = base.select("k", agg.density(F.col("customers"), F.col("area")).cast("double").alias("c"), agg.density(F.col("suppliers"), F.col("area")).cast("double").alias("s"), F.lit(7.0).alias("e"))
    scored = agg.min_max_scores(dense, ["c", "s", "e"], inverted=("s",))
    return agg.variant_scores(scored, "k", {"balanced": {"c": 0.5, "s": 0.3, "e": 0.2}, "plain": {"c": 0.75, "s": 0.25}})


_CUT = "(SELECT v FROM r WHERE i = greatest(0, least(CAST(floor((SELECT count(*) FROM r) * {q}) AS BIGINT) - 1, (SELECT count(*) FROM r) - 1)))"


@query(f"""WITH r AS (SELECT c_acctbal AS v, row_number() OVER (ORDER BY c_acctbal) - 1 AS i FROM customer WHERE c_acctbal > 0)
SELECT c_custkey, CASE WHEN NOT c_acctbal > 0 THEN 1 {" ".join(f"WHEN c_acctbal <= {_CUT.format(q=q)} THEN {i}" for i, q in enumerate((0.2, 0.4, 0.6, 0.8), 1))} ELSE 5 END AS band FROM customer""")
def quantile_bands(spark, sf_dir):
    """Nearest-rank quintiles of the positive values."""
    return agg.quantile_bands(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), "c_acctbal").select("c_custkey", "band")


@query("""WITH b AS (SELECT CASE WHEN v IS NULL THEN 0 WHEN v < 27.4 THEN 1 WHEN v < 45.7 THEN 2 WHEN v < 63.9 THEN 3 WHEN v < 82.2 THEN 4 ELSE 5 END AS band FROM (SELECT value AS v FROM events)) SELECT g AS band, count(b.band) AS n FROM range(6) t(g) LEFT JOIN b ON b.band = g GROUP BY g""")
def band_histogram(spark, sf_dir):
    """Rows of each score band, with those that are empty."""
    return agg.band_histogram(table(spark, sf_dir, "events").select(agg.score_band(F.col("value")).alias("band")), "band")


@query("""WITH s AS (SELECT p_partkey AS id, p_partkey % 3 AS factor, CASE WHEN p_partkey % 2 = 0 THEN 1.5 ELSE 2.5 END AS d, (p_partkey * 7919 % 3000) / 100.0 AS ax, (p_partkey * 104729 % 3000) / 100.0 AS ay FROM part),
c AS (SELECT DISTINCT factor, d, r.g AS "row", c.g AS col FROM s, range(30) r(g), range(30) c(g) WHERE sqrt((c.g + 0.5 - ax) ** 2 + (r.g + 0.5 - ay) ** 2) <= d)
SELECT "row", col, sum(factor + 1) AS score FROM c GROUP BY "row", col""")
def factor_mask_score(spark, sf_dir):
    """Cells near shapes, each factor and distance once."""
    return _factor_masks(table(spark, sf_dir, "part"))


def _factor_masks(parts):
    k = F.col("p_partkey")
    shapes = parts.select(k.alias("id"), (k % 3).alias("factor"), F.when(k % 2 == 0, 1.5).otherwise(2.5).alias("d"), ((k * 7919 % 3000) / 100.0).alias("ax"), ((k * 104729 % 3000) / 100.0).alias("ay"))
    shapes = shapes.withColumn("bx", F.col("ax")).withColumn("by", F.col("ay")).withColumn("key", F.struct("factor", "d"))
    cells = spatial.cells_within(shapes, "key", F.col("d"), 1.0, 30, 30)
    scored = cells.select("row", "col", F.col("key.factor").alias("factor"), F.col("key.d").alias("distance"), (F.col("key.factor") + 1).alias("score"))
    return agg.factor_mask_scores(scored)


@query("""WITH e AS (SELECT event_id AS i, event_type AS v, lag(event_type) OVER (ORDER BY event_id) AS b FROM (SELECT row_number() OVER (ORDER BY event_id) AS event_id, event_type FROM events)), g AS (SELECT i, v, sum(CASE WHEN b IS DISTINCT FROM v THEN 1 ELSE 0 END) OVER (ORDER BY i) AS g FROM e) SELECT min(i) - (SELECT min(i) FROM e) AS start, v, count(*) AS run FROM g GROUP BY g, v""")
def rle_runs(spark, sf_dir):
    """Run lengths over a dense order."""
    events = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("v"))
    low = events.agg(F.min("event_id").alias("low"))
    dense = events.crossJoin(F.broadcast(low)).select((F.col("event_id") - F.col("low")).alias("i"), "v")  # one row
    return agg.run_lengths(dense, "i", "v")


@query("""WITH t AS (SELECT o_orderpriority AS p, year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1, 2), x AS (SELECT o_orderpriority AS p, year(o_orderdate) AS y, count(*) AS n FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1, 2)
SELECT p, y, greatest(0, t.n - coalesce(x.n, 0)) AS n FROM t LEFT JOIN x USING (p, y) WHERE greatest(0, t.n - coalesce(x.n, 0)) > 0""")
def residual_counts(spark, sf_dir):
    """Totals less the sum of parts, where above zero."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("p"), F.year("o_orderdate").alias("y"), "o_orderstatus")
    count = lambda df: df.groupBy("p", "y").agg(F.count("*").alias("n"))
    return relational.residual(count(o), [count(o.where(F.col("o_orderstatus") == s)) for s in ("F", "O")], ["p", "y"], "n")


@query("""WITH a(alias) AS (VALUES ('red-plate'), ('old-widget-small'), ('gear-red-hot'), ('unknown')), p AS (SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') AS name FROM part),
x AS (SELECT alias, p_partkey FROM a JOIN p ON p.name = a.alias), tk AS (SELECT alias, unnest(list_distinct(list_filter(string_split(alias, '-'), lambda t: len(t) > 2))) AS t, least(2, len(list_distinct(list_filter(string_split(alias, '-'), lambda t: len(t) > 2)))) AS need FROM a WHERE alias NOT IN (SELECT alias FROM x)),
pt AS (SELECT p_partkey, unnest(list_distinct(string_split(name, '-'))) AS t FROM p), c AS (SELECT alias, p_partkey, count(*) AS overlap FROM tk JOIN pt USING (t) GROUP BY alias, p_partkey, need HAVING count(*) >= need)
SELECT alias, p_partkey, true AS exact, NULL::BIGINT AS overlap FROM x UNION ALL SELECT alias, p_partkey, false, overlap FROM c QUALIFY row_number() OVER (PARTITION BY alias ORDER BY p_partkey) <= 5""")
def fuzzy_token_match(spark, sf_dir):
    """Equal names, else shared tokens, five at most."""
    aliases = spark.createDataFrame([("red-plate",), ("old-widget-small",), ("gear-red-hot",), ("unknown",)], "alias string").withColumn("name", F.col("alias"))
    parts = table(spark, sf_dir, "part").select("p_partkey", text.slug(F.col("p_name")).alias("name"))
    return relational.token_matches(aliases, parts, "alias", "p_partkey")


@query("""WITH s AS (SELECT c_custkey, c_nationkey FROM customer), t1 AS (SELECT c_custkey, s_suppkey AS target FROM s JOIN supplier ON s_suppkey = c_custkey), t2 AS (SELECT c_custkey, s_suppkey AS target FROM s JOIN supplier ON s_nationkey = c_nationkey),
u AS (SELECT c_custkey, 1 AS tier, target FROM t1 UNION ALL SELECT c_custkey, 2, target FROM t2), m AS (SELECT c_custkey, min(tier) AS tier FROM u GROUP BY 1)
SELECT s.c_custkey, m.tier, u.target FROM s LEFT JOIN m USING (c_custkey) LEFT JOIN u ON u.c_custkey = s.c_custkey AND u.tier = m.tier""")
def key_cascade(spark, sf_dir):
    """Tiers of keys alone: the matches of the first tier that has any."""
    c, s = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", F.col("s_suppkey").alias("target"))
    return relational.key_cascade(c, "c_custkey", s, "target", [("c_custkey", "s_suppkey"), ("c_nationkey", "s_nationkey")])


@query("""SELECT coalesce(n_regionkey, -1) AS region, coalesce(n_nationkey, -1) AS nation, count(*) AS n, round(sum(c_acctbal), 4) AS balance, CASE WHEN grouping(n_nationkey) = 1 THEN 1 ELSE 2 END AS level FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY GROUPING SETS ((n_regionkey), (n_regionkey, n_nationkey))""")
def hierarchy_rollup(spark, sf_dir):
    """Sums of each level from one pass."""
    df = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).withColumn("area", F.lit(1.0))
    up = agg.hierarchy(df, ["n_regionkey", "n_nationkey"], ["c_acctbal", "area"], "area", "c_acctbal")
    return up.select(F.coalesce("n_regionkey", F.lit(-1)).alias("region"), F.coalesce("n_nationkey", F.lit(-1)).alias("nation"), F.col("rows_n").alias("n"), F.round("c_acctbal", 4).alias("balance"), "level")


@query(r"""WITH d AS (SELECT doc_id, source, md5(trim(regexp_replace(lower(text), '[ \t\n\r\f\v]+', ' ', 'g'))) AS k FROM documents WHERE text IS NOT NULL)
SELECT min(doc_id) AS doc_id, array_to_string(list_sort(list(DISTINCT source)), ',') AS sources, array_to_string(list_sort(list(doc_id))[2:], ',') AS duplicates FROM d GROUP BY k""")
def dedupe_with_duplicates(spark, sf_dir):
    """The first of equal texts with the ids of the others."""
    docs = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", F.array("source").alias("sources"), F.md5(F.trim(F.regexp_replace(F.lower("text"), r"[ \t\n\r\f\x0B]+", " ")).cast("binary")).alias("k"))
    first, others = relational.dedupe_listing_duplicates(docs, F.col("k"), "doc_id", F.lit(0), "sources")
    listed = others.groupBy(F.col("kept").alias("doc_id")).agg(F.array_sort(F.collect_list("duplicate")).alias("duplicates"))  # the report asks for lists
    out = first.join(listed, "doc_id", "left")
    return out.select("doc_id", F.array_join("sources", ",").alias("sources"), F.coalesce(F.array_join(F.transform("duplicates", lambda x: x.cast("string")), ","), F.lit("")).alias("duplicates"))


@query("""SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id) = 1""")
def latest_per_key(spark, sf_dir):
    """The latest row of each key, ties to the first."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    return relational.first_per_key(e, ["user_id"], F.negative(F.unix_micros(F.col("ts").cast("timestamp"))), F.col("event_id")).select("user_id", "event_id", "event_type")


@query("""WITH s AS (SELECT user_id, hour(ts) * 3600 + minute(ts) * 60 + CAST(floor(second(ts)) AS INT) AS s FROM events) SELECT user_id, count(*) AS n, min(s) AS first_s, max(s) AS last_s, round_even((max(s) - min(s)) / 3600.0, 2) AS span_hours FROM s GROUP BY user_id""")
def stop_span_summary(spark, sf_dir):
    """First and last second of the day and the hours between."""
    return agg.span_summary(table(spark, sf_dir, "events"), "user_id", dates.clock_seconds(F.date_format("ts", "HH:mm:ss")))


@query("""WITH r AS (SELECT DISTINCT l_suppkey, l_partkey % 50 AS edge FROM lineitem), w AS (SELECT edge, l_suppkey, count(*) OVER (PARTITION BY edge) AS shared, row_number() OVER (PARTITION BY edge ORDER BY l_suppkey) - 1 AS place FROM r) SELECT edge, l_suppkey, shared, CASE WHEN shared > 1 THEN (place - (shared - 1) / 2.0) * 4.0 ELSE 0.0 END AS "offset" FROM w""")
def edge_route_offsets(spark, sf_dir):
    """Routes of an edge side by side."""
    return _edge_routes(table(spark, sf_dir, "lineitem"))


def _edge_routes(lineitem):
    r = lineitem.select("l_suppkey", (F.col("l_partkey") % 50).alias("edge")).distinct()
    return agg.edge_offsets(r, ["edge"], [agg.numeric_first(F.col("l_suppkey").cast("string")), F.col("l_suppkey")]).select("edge", "l_suppkey", "shared", "offset")


_STRIPPED = r"regexp_replace(regexp_replace(regexp_replace(html, '<script.*?</script>', ' ', 'gsi'), '<style.*?</style>', ' ', 'gsi'), '<[^>]+>', ' ', 'gs')"
_NAMED = _STRIPPED
for _name, _char in (("&nbsp;", " "), ("&amp;", "&"), ("&ndash;", "-"), ("&#8211;", "-"), ("&mdash;", "-"), ("&#8212;", "-"), ("&rsquo;", "''"), ("&#8217;", "''"), ("&ldquo;", '"'), ("&rdquo;", '"'), ("&#8220;", '"'), ("&#8221;", '"')):
    _NAMED = f"replace({_NAMED}, '{_name}', '{_char}')"
# Each `&#number;` is a part's beginning once the text is split at `&#`.
_DECODED = f"""array_to_string(list_transform(string_split('&#' || {_NAMED}, '&#')[2:], lambda p, i: CASE WHEN i = 1 THEN p WHEN regexp_matches(p, '^[0-9]+;') THEN chr((regexp_extract(p, '^([0-9]+);', 1)::BIGINT % 65536)::INT) || regexp_replace(p, '^[0-9]+;', '') ELSE '&#' || p END), '')"""


@query(rf"""SELECT page_id, trim(regexp_replace({_DECODED}, '\s+', ' ', 'g')) AS plain FROM pages""")
def html_strip(spark, sf_dir):
    """T07, T08, S22 (HTML): the text of HTML pages."""
    return table(spark, sf_dir, "pages").select("page_id", text.html_text(F.col("html")).alias("plain"))


@query(r"""SELECT p_partkey, trim(regexp_replace(lower(replace(p_name, '&', 'and')), '[^a-z0-9]+', '_', 'g'), '_') AS slug, upper(regexp_replace(p_brand, '\s+', '', 'g')) AS code, regexp_replace(p_type, '[^A-Za-z0-9_-]', '', 'g') AS safe, concat(p_brand, '__', p_size) AS "key", left(sha1(p_name), 12) AS short_hash FROM part""")
def slug_and_keys(spark, sf_dir):
    """Slugs, codes and keys."""
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", text.slug(F.col("p_name"), "_", "and").alias("slug"), text.postal(F.col("p_brand")).alias("code"), text.safe_name(F.col("p_type")).alias("safe"), text.key("__", F.col("p_brand"), F.col("p_size")).alias("key"), text.short_hash(F.col("p_name")).alias("short_hash"))


@query("""SELECT doc_id, CASE WHEN contains(lower(coalesce(text, '')), 'vacant') THEN 'vacant' WHEN contains(lower(coalesce(text, '')), 'license') OR contains(lower(coalesce(text, '')), 'licensed') THEN 'legal' WHEN contains(lower(coalesce(text, '')), '@') THEN 'contact' ELSE 'other' END AS class FROM documents""")
def keyword_category(spark, sf_dir):
    """the first class of which a word occurs."""
    rules = [("vacant", ("vacant",)), ("legal", ("license", "licensed")), ("contact", ("@",))]
    return table(spark, sf_dir, "documents").select("doc_id", text.keyword_class(F.col("text"), rules).alias("class"))


@query(r"""WITH l AS (SELECT event_id, list_filter(['click', 'purchase'], lambda x: contains(event_type, x)) AS labels FROM events) SELECT label, count(*) AS n FROM (SELECT unnest(CASE WHEN len(labels) > 0 THEN labels ELSE ['Unknown'] END) AS label FROM l) GROUP BY label""")
def level_explode_counts(spark, sf_dir):
    """Rows of each label, those without any as Unknown."""
    labels = F.filter(F.array(F.lit("click"), F.lit("purchase")), lambda x: F.contains(F.col("event_type"), x))
    return agg.label_counts(table(spark, sf_dir, "events").select(labels.alias("labels")), "labels")


@query("""SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) % 7 AS bucket, count(*) AS n FROM events GROUP BY 1, 2""")
def json_props(spark, sf_dir):
    """Typed fields of JSON text."""
    return table(spark, sf_dir, "events").groupBy("event_type", (F.from_json("props", "k bigint")["k"] % 7).alias("bucket")).agg(F.count("*").alias("n"))


_HAVERSINE = f"2 * 6371.0 * asin(sqrt(least(1.0, sin(radians({_lat('s_suppkey')} - {_lat('c_custkey')}) / 2) ** 2 + cos(radians({_lat('c_custkey')})) * cos(radians({_lat('s_suppkey')})) * sin(radians({_lon('s_suppkey')} - {_lon('c_custkey')}) / 2) ** 2)))"


@query(f"""WITH d AS (SELECT round({_HAVERSINE}, 6) AS d FROM customer JOIN supplier ON c_nationkey = s_nationkey) SELECT count(*) FILTER (d <= 100) AS within_100, count(*) FILTER (d <= 500) AS within_500, count(*) FILTER (d <= 1000) AS within_1000, count(*) FILTER (d > 1000) AS over_1000, count(d) AS known FROM d""")
def haversine_buckets(spark, sf_dir):
    """How many distances are within limits."""
    # Rows at one place are one with their number: distances are those of places.
    places = lambda name, nation, k, mark: table(spark, sf_dir, name).where(F.col(nation).isNotNull()).groupBy(F.col(nation).alias(f"{mark}n"), lon(F.col(k)).alias(f"{mark}x"), lat(F.col(k)).alias(f"{mark}y")).agg(F.count("*").alias(f"{mark}c"))
    c, s = places("customer", "c_nationkey", "c_custkey", "l"), places("supplier", "s_nationkey", "s_suppkey", "r")
    km = geo.haversine_m(F.col("lx"), F.col("ly"), F.col("rx"), F.col("ry")) / 1000
    met = relational.spread_join(c, s, "ln", "rn")
    return agg.cumulative_buckets(met.select(F.round(km, 6).alias("d"), (F.col("lc") * F.col("rc")).alias("pairs")), "d", (100, 500, 1000), "pairs")


@query("""SELECT count(v) AS n, round(avg(v), 6) AS mean, median(v) AS median, round(quantile_cont(v, 0.9), 6) AS p90 FROM (SELECT c_acctbal AS v FROM customer)""")
def distribution_stats(spark, sf_dir):
    """Mean, median and 90th percentile."""
    d = agg.distribution(table(spark, sf_dir, "customer"), "c_acctbal")
    return d.select("n", F.round("mean", 6).alias("mean"), "median", F.round("p90", 6).alias("p90"))


@query("""WITH old AS (SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderkey % 3 <> 0), new AS (SELECT o_orderkey, o_totalprice + 1 AS o_totalprice, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 3 <> 1)
SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey, coalesce(n.o_totalprice, o.o_totalprice) AS o_totalprice, coalesce(n.o_orderstatus, o.o_orderstatus) AS o_orderstatus FROM old o FULL JOIN new n ON o.o_orderkey = n.o_orderkey""")
def upsert_merge(spark, sf_dir):
    """New rows win, fields they lack stay."""
    o = table(spark, sf_dir, "orders")
    old = o.where("o_orderkey % 3 <> 0").select("o_orderkey", "o_totalprice", "o_orderstatus")
    new = o.where("o_orderkey % 3 <> 1").select("o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).alias("o_orderstatus"))
    return relational.upsert(old, relational.preserve_missing(new, old, "o_orderkey", ["o_orderstatus"]), ["o_orderkey"])


@query("""WITH ov(name, region, rank, bal) AS (VALUES (1, NULL, 1, -1.0), (1, 0, 0, -2.0), (2, 99, 0, -3.0), (3, 1, 0, -4.0)) SELECT n_nationkey, coalesce(b, n_regionkey::DOUBLE) AS bal FROM nation LEFT JOIN (SELECT n_nationkey AS k, bal::DOUBLE AS b FROM nation JOIN ov ON ov.name = n_nationkey AND (region IS NULL OR region = n_regionkey) QUALIFY row_number() OVER (PARTITION BY n_nationkey ORDER BY rank) = 1) ON k = n_nationkey""")
def override_join(spark, sf_dir):
    """The first override that fits."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey", F.col("n_regionkey").cast("double").alias("bal"))
    o = spark.createDataFrame([(1, None, 1, -1.0), (1, 0, 0, -2.0), (2, 99, 0, -3.0), (3, 1, 0, -4.0)], "n_nationkey int, n_regionkey int, rank int, bal double")
    return relational.override(n, o, "n_nationkey", "n_regionkey", "rank", ["bal"]).select("n_nationkey", "bal")


@query("""SELECT year(o_orderdate) AS y, o_orderpriority AS p, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1, 2""")
def matrix_pivot(spark, sf_dir):
    """A matrix by column names, read back as rows."""
    o = table(spark, sf_dir, "orders").select(F.lit("all").alias("k"), F.year("o_orderdate").alias("y"), F.col("o_orderpriority").alias("p"), "o_totalprice")
    names = sorted(r[0] for r in o.select("p").distinct().collect())  # the columns of the matrix
    m = agg.matrix(o.groupBy("k", "y", "p").agg(F.round(F.sum("o_totalprice"), 2).alias("total")), ["k"], "y", "p", "total", names)
    cells = m.select(F.explode("data").alias("y", "v")).select(F.col("y").cast("int").alias("y"), F.posexplode("v").alias("i", "total"))
    return cells.select("y", F.element_at(F.lit(names), F.col("i") + 1).alias("p"), "total").where("total is not null")


@query("""WITH RECURSIVE e AS (SELECT 'all' AS parent, 'r' || r_regionkey AS child FROM region UNION ALL SELECT 'r' || n_regionkey, 'n' || n_nationkey FROM nation UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer UNION ALL SELECT 'n' || s_nationkey, 's' || s_suppkey FROM supplier),
t AS (SELECT 'all' AS id, 0 AS depth, 'all' AS path UNION ALL SELECT child, depth + 1, path || ' / ' || child FROM t JOIN e ON parent = id) SELECT id, depth, path FROM t""")
def tree_flatten(spark, sf_dir):
    """Regions, nations, customers and suppliers as one tree, its nodes as rows with paths."""
    name = lambda prefix, c: F.concat(F.lit(prefix), F.col(c))
    edges = [("region", F.lit("all"), name("r", "r_regionkey")), ("nation", name("r", "n_regionkey"), name("n", "n_nationkey")), ("customer", name("n", "c_nationkey"), name("c", "c_custkey")), ("supplier", name("n", "s_nationkey"), name("s", "s_suppkey"))]
    tree = reduce(DataFrame.unionByName, (table(spark, sf_dir, t).select(parent.alias("parent"), child.alias("child")) for t, parent, child in edges))
    return graph.flatten_tree(tree, spark.createDataFrame([("all",)], "id string"))


@query("""SELECT 'quality_known' AS rule, count(*) FILTER (NOT coalesce(quality IN (0, 1), false)) AS failures FROM labels UNION ALL SELECT 'not_toxic', count(*) FILTER (NOT coalesce(toxic = 0, false)) FROM labels UNION ALL SELECT 'labelled', count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def validation_report(spark, sf_dir):
    """Failures of each rule, and keys that are missing."""
    labels, docs = table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents")
    rules = relational.validated(labels, {"quality_known": F.col("quality").isin(0, 1), "not_toxic": F.col("toxic") == 0})
    missing = relational.missing_keys(labels, docs, ["doc_id"]).agg(F.count("*").alias("failures")).select(F.lit("labelled").alias("rule"), "failures")
    return rules.unionByName(missing)


@query("""WITH d AS (SELECT source, lang, n_chars, doc_id FROM documents) SELECT d.source, count(*) AS archives, sum(n_chars) AS bytes, count(*) FILTER (lang = 'en') AS annual, count(*) FILTER (lang <> 'en') AS monthly, count(l.doc_id) AS labelled FROM d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY d.source""")
def inventory_summary(spark, sf_dir):
    """Totals of each source, with what is labelled."""
    d = table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars", F.when(F.col("lang") == "en", "annual").otherwise("monthly").alias("cadence"))
    inv = agg.inventory(d, "source", "n_chars", "cadence", "cadence").drop("examples")
    labelled = d.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id").groupBy("source").agg(F.count("*").alias("labelled"))
    return inv.join(labelled, "source", "left").withColumn("labelled", F.coalesce("labelled", F.lit(0)))


@query("""SELECT CASE WHEN coalesce(c_mktsegment, '') = '' THEN 'unknown' ELSE c_mktsegment END AS "key", count(*) AS "count" FROM customer GROUP BY 1""")
def segment_counts(spark, sf_dir):
    """Rows by key."""
    return relational.count_by(table(spark, sf_dir, "customer"), F.col("c_mktsegment"))


@query("""SELECT p_brand, array_to_string(list_sort(list(DISTINCT p_type)), '|') AS types, array_to_string(list_transform(list_sort(list(DISTINCT p_size)), lambda x: x::VARCHAR), '|') AS sizes, min_by(p_name, p_partkey) AS first_name FROM part GROUP BY p_brand""")
def sets_by_brand(spark, sf_dir):
    """Sorted sets and a first value."""
    s = agg.sets_by(table(spark, sf_dir, "part"), "p_brand", ["p_type", "p_size"], "p_name", "p_partkey")
    return s.select("p_brand", F.array_join("p_type_set", "|").alias("types"), F.array_join(F.transform("p_size_set", lambda x: x.cast("string")), "|").alias("sizes"), F.col("first_p_name").alias("first_name"))


@query("""WITH p AS (SELECT p_brand, nullif(trim(CASE WHEN p_partkey % 3 = 0 THEN ' ' ELSE p_type END), '') AS t, nullif(trim(p_name), '') AS n FROM part) SELECT p_brand, coalesce(array_to_string(list_sort(list(DISTINCT t) FILTER (t IS NOT NULL)), '|'), '') AS types, coalesce(len(list(DISTINCT n) FILTER (n IS NOT NULL)), 0)::INTEGER AS names FROM p GROUP BY p_brand""")
def metadata_values(spark, sf_dir):
    """The distinct values of each field that are not blank."""
    p = table(spark, sf_dir, "part").select("p_brand", F.when(F.col("p_partkey") % 3 == 0, " ").otherwise(F.col("p_type")).alias("types"), F.col("p_name").alias("names"))
    return agg.compact_metadata(p, "p_brand", ["types", "names"]).select("p_brand", F.array_join("types", "|").alias("types"), F.size("names").alias("names"))


@query("""WITH e AS (SELECT least(l_partkey % 9, l_suppkey % 7) || '-' || greatest(l_partkey % 9, l_suppkey % 7) AS edge, l_orderkey % 11 AS route, l_returnflag AS flag, l_linestatus AS status, l_orderkey * 10 + l_linenumber AS o, l_quantity AS q FROM lineitem)
SELECT edge, route, array_to_string(list_sort(list(DISTINCT flag)), '') AS flags, array_to_string(list_sort(list(DISTINCT status)), '') AS statuses, min({'o': o, 'q': q}).q AS q FROM e GROUP BY edge, route""")
def undirected_edges(spark, sf_dir):
    """Edges of both directions under one key, with each route's sets and the coordinates of its first row."""
    a, b = F.col("l_partkey") % 9, F.col("l_suppkey") % 7
    e = table(spark, sf_dir, "lineitem").select(F.concat_ws("-", F.least(a, b), F.greatest(a, b)).alias("edge"), (F.col("l_orderkey") % 11).alias("route"), F.col("l_returnflag").alias("flags"), F.col("l_linestatus").alias("statuses"), F.struct(F.col("l_orderkey") * 10 + F.col("l_linenumber"), "l_quantity").alias("o"), F.col("l_quantity").alias("q"))
    return graph.shared_edges(e, "edge", "route", ["flags", "statuses"], "o", "q").select("edge", "route", F.array_join("flags", "").alias("flags"), F.array_join("statuses", "").alias("statuses"), "q")


@query(f"""WITH pts AS (SELECT DISTINCT user_id AS k, {_lon("user_id")} AS x, {_lat("user_id")} AS y, 0 AS v FROM events), {_PIP}, f AS (SELECT k, n FROM hits QUALIFY row_number() OVER (PARTITION BY k ORDER BY n) = 1) SELECT n, count(*) AS events, count(DISTINCT user_id) AS probes FROM events LEFT JOIN f ON k = user_id GROUP BY n""")
def cached_probes(spark, sf_dir):
    """The spatial step once for each distinct place, its outcome joined back to all rows of it."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("k"))
    x, y = lon(F.col("k")), lat(F.col("k"))
    found = spatial.first_of_places(e.withColumn("x", x).withColumn("y", y), polygons(spark), ["k"], "x", "y", "n", "n")
    return found.groupBy("n").agg(F.count("*").alias("events"), F.count_distinct("k").alias("probes"))


@query("""SELECT c_custkey, CASE WHEN c_nationkey >= 8 THEN 1900 + c_nationkey * 10 ELSE 2000 + c_nationkey END AS y, least(1.0, greatest(0.0, CASE WHEN c_acctbal / 100 > 1 THEN c_acctbal / 10000 ELSE c_acctbal / 100 END)) AS ratio, regexp_extract(c_name, '[0-5]', 0)::INT AS "level", floor(c_acctbal * 10 + 0.5) / 10 AS up, round_even(c_acctbal, 1) AS even FROM customer""")
def number_dialects(spark, sf_dir):
    """Parsing and rounding dialects."""
    bal, n = F.col("c_acctbal"), F.col("c_nationkey")
    y = F.when(n >= 8, parse.full_year(F.lit(80) + (n - 8) * 10)).otherwise(parse.full_year(n))
    return table(spark, sf_dir, "customer").select("c_custkey", y.cast("int").alias("y"), parse.clamp_ratio(bal / 100).alias("ratio"), parse.first_level(F.col("c_name")).alias("level"), parse.round_up(bal, 1).alias("up"), parse.round_even(bal, 1).alias("even"))


@query(f"""SELECT s_suppkey, 10 AS z, CAST(floor(({_lon('s_suppkey')} + 180) / 360 * 1024) AS INT) AS tile_x, CAST(floor((1 - ln(tan(radians({_lat('s_suppkey')})) + 1 / cos(radians({_lat('s_suppkey')}))) / pi()) / 2 * 1024) AS INT) AS tile_y FROM supplier""")
def tile_cover(spark, sf_dir):
    """Map tiles of points."""
    k = F.col("s_suppkey")
    x, y = lon(k), lat(k)
    boxes = table(spark, sf_dir, "supplier").select(k, F.struct(x.alias("xmin"), y.alias("ymin"), x.alias("xmax"), y.alias("ymax")).alias("box"))
    return spatial.tile_cover(boxes, 10).select("s_suppkey", "z", "tile_x", "tile_y")


@query("""SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def daily_events(spark, sf_dir):
    """Extension, X06: tumbling windows over events."""
    return tumbling_counts(table(spark, sf_dir, "events"), "ts", "1 day", "event_type")


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS b FROM events), s AS (SELECT user_id, ts, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM g) SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS n FROM s GROUP BY user_id, s""")
def user_sessions(spark, sf_dir):
    """Extension, X06: session windows over events."""
    return session_counts(table(spark, sf_dir, "events"), "ts", "user_id")


@query("""SELECT time_bucket(INTERVAL 1 HOUR, ts) - to_hours(s) AS start, event_type, count(*) AS n FROM events, range(3) r(s) GROUP BY ALL""")
def sliding_events(spark, sf_dir):
    """Extension, X06: windows of three hours that begin every hour."""
    return sliding_counts(table(spark, sf_dir, "events"), "ts", "3 hours", "1 hour", "event_type")


@query("""SELECT user_id, event_type, min(ts) AS ts FROM events GROUP BY ALL""")
def first_events(spark, sf_dir):
    """Extension, X06: the first event of each user and type; in a stream the repeats within the watermark go."""
    return without_repeats(table(spark, sf_dir, "events").select("user_id", "event_type", "ts"), "ts", "user_id", "event_type")


@query("""SELECT r.r_name AS name, n_nationkey AS k FROM nation JOIN region h ON n_regionkey = h.r_regionkey JOIN region r ON contains(lower(n_name || ' of ' || h.r_name), lower(r.r_name)) WHERE len(r.r_name) >= 4""")
def contained_names(spark, sf_dir):
    """Names that occur in texts, by an equi-join on their first letters."""
    r, n = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    texts = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.concat_ws(" of ", "n_name", "r_name").alias("t"))
    return relational.contained_names(texts, r, "n_nationkey", "t", "r_name", "r_name").select(F.col("r_name").alias("name"), F.col("n_nationkey").alias("k"))


@query("""SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def pending_work(spark, sf_dir):
    """What is wanted and not done."""
    return _pending(spark, sf_dir, table(spark, sf_dir, "orders"))


def _pending(spark, sf_dir, orders):
    return relational.pending(orders.select("o_orderkey"), table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"])


@query("""SELECT o * 250 AS "offset", least(250, (SELECT count(*) FROM orders) - o * 250) AS size FROM range(CAST(ceil((SELECT count(*) FROM orders) / 250.0) AS BIGINT)) t(o)""")
def paged_requests(spark, sf_dir):
    """The requests of a paged scan."""
    return landed.paged_offsets(spark, table(spark, sf_dir, "orders").count(), 250)


from . import compositions, function_queries, geometry_queries, source_queries  # noqa: E402, F401  they register their queries
