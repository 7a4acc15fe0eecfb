"""Queries of the joins, filters, projections, aggregates and ordered outputs, each over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import predicates
from ..operators import aggregates as agg
from ..operators import graph, relational, selection
from .base import query, table, values
from .factors import FACTORS, VARIANTS
from .function_queries import cycled, cycled_sql

# Joins


@query("""WITH b AS (SELECT l_orderkey, l_shipdate, l_suppkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC NULLS LAST, l_suppkey DESC NULLS LAST) = 1) SELECT o_orderkey, l_suppkey FROM orders JOIN b ON l_orderkey = o_orderkey""")
def last_wins_join(spark, sf_dir):
    """An inner join in which a key's last row stands."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    last = relational.first_per_key(lines, ["l_orderkey"], F.negative("l_linenumber"), F.negative("l_suppkey"))
    return table(spark, sf_dir, "orders").join(last, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "l_suppkey")


@query("""SELECT d.doc_id, quality, n FROM documents d JOIN labels l USING (doc_id) LEFT JOIN (SELECT l_orderkey AS doc_id, count(*) AS n FROM lineitem GROUP BY 1) x USING (doc_id)""")
def assets_with_scores(spark, sf_dir):
    """What has a score, with further tables where they have the key."""
    d, labels = table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id", "quality")
    extra = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("doc_id")).agg(F.count("*").alias("n"))
    return relational.scored_assets(d, labels, "doc_id", extra)


@query("""SELECT l.doc_id IS NOT NULL AS matched, count(*) AS "count" FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id) GROUP BY 1""")
def matched_counts(spark, sf_dir):
    """How many rows a left join enriches."""
    labels = table(spark, sf_dir, "labels").select("doc_id").distinct()
    return relational.left_with_counts(table(spark, sf_dir, "documents").select("doc_id"), labels, ["doc_id"])[1]


@query("""SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)""")
def customers_with_orders(spark, sf_dir):
    """Rows whose key is in another table."""
    return table(spark, sf_dir, "customer").select("c_custkey").join(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi")


_SIDES = ("Oak & Elm", "Elm & Ash & Oak", "Ash & Fir", "Fir", "Oak & Yew & Box", "Yew & Oak")
_KNOWN = [(1, "Elm & Oak"), (2, "Oak & Elm"), (3, "Ash & Elm"), (4, "Fir & Ash & Yew"), (5, "Box & Yew")]
_PARTS = "list_sort(string_split({}, ' & '))"


@query(f"""WITH l AS (SELECT o_orderkey AS k, {_PARTS.format(cycled_sql("o_orderkey", *_SIDES))} AS p FROM orders), r(i, name) AS (VALUES {", ".join(map(str, _KNOWN))}), rp AS (SELECT i, {_PARTS.format("name")} AS p FROM r),
e AS (SELECT k, max(i) AS i FROM l JOIN rp USING (p) GROUP BY k), c AS (SELECT k, i, len(list_intersect(l.p, rp.p)) AS n, len(l.p) AS a, len(rp.p) AS b FROM l, rp WHERE k NOT IN (SELECT k FROM e)),
x AS (SELECT k, i FROM c WHERE n >= 2 AND (n = a OR n = b) QUALIFY row_number() OVER (PARTITION BY k ORDER BY n DESC, b, i) = 1) SELECT k, i, true AS exact FROM e UNION ALL SELECT k, i, false FROM x""")
def crossing_matches(spark, sf_dir):
    """The last equal set of parts, else the best one that holds or is held."""
    left = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.array_sort(F.split(cycled(F.col("o_orderkey"), *_SIDES), " & ")).alias("parts"))
    right = values(spark, _KNOWN, "i int, name string").select("i", F.array_sort(F.split("name", " & ")).alias("parts"))
    return relational.part_set_matches(left, right, "k", "i")


@query("""WITH a AS (SELECT c_custkey AS id, c_name AS name, c_acctbal AS v1 FROM customer WHERE c_custkey % 3 <> 0), b AS (SELECT c_custkey AS id, c_mktsegment AS name, c_acctbal + 1 AS v1, c_nationkey AS v2 FROM customer WHERE c_custkey % 3 <> 1) SELECT id, coalesce(a.name, b.name) AS name, coalesce(b.v1, a.v1) AS v1, v2 FROM a FULL JOIN b USING (id)""")
def merged_batches(spark, sf_dir):
    """Batches of columns under one key; base columns of the first, others of the last."""
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    a = c.where(k % 3 != 0).select(k.alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("v1"))
    b = c.where(k % 3 != 1).select(k.alias("id"), F.col("c_mktsegment").alias("name"), (F.col("c_acctbal") + 1).alias("v1"), F.col("c_nationkey").alias("v2"))
    return relational.wide_merge([a, b], "id", ["name"])


@query("""WITH n AS (SELECT c_custkey AS l, s_suppkey AS r FROM customer JOIN supplier ON c_custkey % 40 = s_suppkey % 40), a AS (SELECT c_custkey AS l, s_suppkey AS r FROM customer JOIN supplier ON c_nationkey = s_nationkey AND c_custkey % 10 = s_suppkey % 10),
s AS (SELECT l, r, CASE WHEN bool_or(n) AND bool_or(a) THEN 100 WHEN bool_or(a) THEN 85 ELSE 75 END AS score FROM (SELECT l, r, true AS n, false AS a FROM n UNION ALL SELECT l, r, false, true FROM a) GROUP BY l, r),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY l ORDER BY score DESC, r) = 1) SELECT l, r, score FROM b QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, l) = 1""")
def scored_pairs(spark, sf_dir):
    """Pairs scored by what they agree in, each side once."""
    keyed = lambda name, k, nation, mark: table(spark, sf_dir, name).select(F.col(k).alias(mark), (F.col(k) % 40).alias("name"), F.col(nation).alias("nation"), (F.col(k) % 10).alias("street"))
    return relational.scored_by_keys(keyed("customer", "c_custkey", "c_nationkey", "l"), keyed("supplier", "s_suppkey", "s_nationkey", "r"), "l", "r", ["name"], ["nation", "street"])


@query("""WITH q AS (SELECT c_custkey AS id, unnest([0, 1]) AS rank, unnest([c_custkey % 50, c_nationkey + 100]) AS q FROM customer), g AS (SELECT q, 60.0 + q % 41 AS score FROM range(200) t(q) WHERE q % 7 <> 0 AND 60 + q % 41 >= 75 AND q % 3 <> 0)
SELECT id, q::VARCHAR AS query, score::DOUBLE AS score, CASE WHEN score >= 95 THEN 'high' ELSE 'medium' END AS confidence FROM q JOIN g USING (q) QUALIFY row_number() OVER (PARTITION BY id ORDER BY rank) = 1""")
def geocoded_customers(spark, sf_dir):
    """The first query that the cache answers well enough."""
    c = table(spark, sf_dir, "customer")
    asked = c.select(F.col("c_custkey").alias("id"), F.posexplode(F.array(F.col("c_custkey") % 50, F.col("c_nationkey").cast("long") + 100)).alias("rank", "q")).select("id", "rank", F.col("q").cast("string").alias("query"))
    q = F.col("id")
    cache = spark.range(200).select(q.cast("string").alias("query"), F.when(q % 7 == 0, "failed").otherwise("matched").alias("status"), (60.0 + q % 41).alias("score"), F.when(q % 3 == 0, "Elsewhere").otherwise("TOWN").alias("locality"), F.lit(1.0).alias("lon"), F.lit(2.0).alias("lat"))
    return relational.geocoded(asked, cache, "Town").select("id", "query", "score", "confidence")


@query("""SELECT c_custkey, coalesce(p.s, f.s) AS parent FROM customer LEFT JOIN (SELECT DISTINCT substr(s_name, 1, 18) AS s FROM supplier) p ON 'Supplier#' || right(c_name, 9) = p.s LEFT JOIN (SELECT n_nationkey, n_name AS s FROM nation WHERE n_nationkey % 2 = 0) f ON c_nationkey = n_nationkey WHERE coalesce(p.s, f.s) IS NOT NULL""")
def prefix_parents(spark, sf_dir):
    """The parent that an id begins with, else another's, else none."""
    from ..operators import spatial

    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.concat(F.lit("Supplier#"), F.substring("c_name", -9, 9), F.lit("-x")).alias("child"))
    parents = table(spark, sf_dir, "supplier").select(F.substring("s_name", 1, 18).alias("parent")).distinct()
    even = table(spark, sf_dir, "nation").where("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("parent"))
    fallback = c.join(even, "c_nationkey").select("child", "parent")
    return spatial.parent_by_prefix(c, parents, "child", "parent", 18, fallback).select("c_custkey", "parent")


@query("""WITH r AS (SELECT event_id, user_id AS postal, value, ts, event_type FROM events WHERE event_type <> 'view' AND isfinite(value) AND value BETWEEN 10 AND 90) SELECT postal, event_id, value FROM r QUALIFY row_number() OVER (PARTITION BY postal ORDER BY event_id DESC) = 1""")
def location_rows(spark, sf_dir):
    """The last usable location of each key."""
    e = table(spark, sf_dir, "events").select("event_id", F.col("user_id").cast("string").alias("postal"), "value", F.when(F.col("event_type") != "view", "BC").otherwise("AB").alias("province"))
    found = selection.locations(e, "postal", "event_id", F.col("value"), F.col("value"), F.col("province"), "BC", (10, 10, 90, 90))
    return found.select(F.col("postal").cast("long").alias("postal"), "event_id", "value")


@query("""WITH f AS (SELECT p_brand AS dataset, 1990 + p_size AS year, printf('/d/%06d', p_partkey) AS path, p_partkey % 5 = 0 AS is_folder, p_partkey % 4 <> 1 AS good FROM part), b AS (SELECT * FROM f WHERE good QUALIFY row_number() OVER (PARTITION BY dataset, year ORDER BY NOT is_folder, path) = 1), w AS (SELECT DISTINCT dataset, year FROM f) SELECT dataset, year, path, is_folder, 'a,b' AS columns FROM w JOIN b USING (dataset, year)""")
def resolved_files(spark, sf_dir):
    """The file that serves a dataset and year: folders before archives, the first by path, with the right key column."""
    k, year = F.col("p_partkey"), F.lit(1990) + F.col("p_size")
    header = F.array(F.when(k % 4 == 1, "other").otherwise(F.concat(F.lit("postalcode"), F.lpad((year % 100).cast("string"), 2, "0"))), F.lit("a"), F.lit("b"))
    files = table(spark, sf_dir, "part").select(F.col("p_brand").alias("dataset"), year.alias("year"), F.format_string("/d/%06d", k).alias("path"), (k % 5 == 0).alias("is_folder"), header.alias("header"))
    found = selection.resolved_sources(files, files.select("dataset", "year").distinct())
    return found.withColumn("columns", F.array_join("columns", ","))


# Filters


_TOWNS = ("Prince George", " prince-george (city)", "PG", "Princegorge BC", "Quesnel", None, "Page")


@query(rf"""SELECT c_custkey FROM (SELECT c_custkey, regexp_replace(upper(coalesce({cycled_sql("c_custkey", *_TOWNS)}, '')), '[^A-Z0-9]+', '', 'g') AS t FROM customer) WHERE t = 'PG' OR starts_with(t, 'PRINCEGEORGE') OR starts_with(t, 'PRINCEGORGE')""")
def town_rows(spark, sf_dir):
    """rows of a town, misspelt or not."""
    return table(spark, sf_dir, "customer").where(predicates.in_town(cycled(F.col("c_custkey"), *_TOWNS), ("PG",), ("PRINCEGEORGE", "PRINCEGORGE"))).select("c_custkey")


@query("""SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' OR starts_with(c_name, 'Customer#00000001')""")
def province_rows(spark, sf_dir):
    """rows by a code or by the beginning of another column."""
    return table(spark, sf_dir, "customer").where(predicates.in_province(F.col("c_mktsegment"), F.col("c_name"), "BUILDING", "Customer#00000001")).select("c_custkey")


@query("""SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity BETWEEN 10 AND 20 AND l_extendedprice BETWEEN 5000 AND 30000""")
def box_rows(spark, sf_dir):
    """rows in a box, edges included."""
    return table(spark, sf_dir, "lineitem").where(predicates.in_box(F.col("l_quantity"), F.col("l_extendedprice"), 10, 5000, 20, 30000)).select("l_orderkey", "l_linenumber")


_WHERES = ("Status = 'Active'", "status='active'", "", "anything else", "Kind = 'F'", "Missing = 'x'")


@query(f"""WITH o AS (SELECT o_orderkey, {cycled_sql("o_orderkey", "Active", " act ", "ACTIVE", "Retired", None)} AS status, o_orderstatus AS kind FROM orders)
SELECT w, count(*) AS n FROM o, (VALUES (0), (1), (2), (3), (4), (5)) v(w) WHERE CASE w WHEN 0 THEN lower(trim(coalesce(status, ''))) IN ('active', 'act') WHEN 1 THEN false WHEN 4 THEN kind = 'F' WHEN 5 THEN false ELSE true END GROUP BY w""")
def where_texts(spark, sf_dir):
    """conditions given as text."""
    o = table(spark, sf_dir, "orders").select(cycled(F.col("o_orderkey"), "Active", " act ", "ACTIVE", "Retired", None).alias("status"), "o_orderstatus")
    columns = {"Status": F.col("status"), "Kind": F.col("o_orderstatus")}
    counts = o.agg(*(F.count_if(predicates.where_text(columns, w)).alias(str(i)) for i, w in enumerate(_WHERES)))
    return counts.unpivot([], [str(i) for i in range(len(_WHERES))], "w", "n").select(F.col("w").cast("int").alias("w"), "n").where("n > 0")


@query("""SELECT p_partkey FROM part WHERE contains(lower(p_type), 'copper') OR contains(lower(p_type), 'economy')""")
def field_values(spark, sf_dir):
    """rows one of whose fields has a value as a part."""
    return table(spark, sf_dir, "part").where(predicates.field_among(F.col("p_type"), ["COPPER", "economy"])).select("p_partkey")


@query("""WITH p AS (SELECT DISTINCT o_orderpriority AS k, year(o_orderdate) AS year FROM orders WHERE o_orderkey % 5 <> 0 OR year(o_orderdate) < 1996) SELECT k, year, 'latest' AS choice FROM p WHERE (k, year) IN (SELECT (k, max(year)) FROM p GROUP BY k) UNION ALL SELECT k, year, 'named' FROM p WHERE year IN (1993, 1995)""")
def year_choices(spark, sf_dir):
    """the named years, or else the latest of each key."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("k"), F.year("o_orderdate").alias("year"), "o_orderkey")
    p = o.where("o_orderkey % 5 <> 0 or year < 1996").select("k", "year").distinct()
    latest, named = selection.chosen_years(p, ["k"], "year"), selection.chosen_years(p, ["k"], "year", (1993, 1995))
    return latest.withColumn("choice", F.lit("latest")).unionByName(named.withColumn("choice", F.lit("named")))


@query("""SELECT count(*) AS n FROM lineitem WHERE sqrt(l_quantity ** 2 + (l_discount * 100) ** 2) >= 12""")
def segment_filter(spark, sf_dir):
    """segments that are long enough."""
    return table(spark, sf_dir, "lineitem").where(predicates.long_enough(F.lit(0.0), F.lit(0.0), F.col("l_quantity"), F.col("l_discount") * 100, 12)).agg(F.count("*").alias("n"))


# Projections


@query("""SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN '{"c_name":"' || c_name || '","debt":' || c_nationkey || '}' ELSE '{"c_name":"' || c_name || '"}' END AS properties FROM customer""")
def kept_columns(spark, sf_dir):
    """The wanted columns that exist and are not null, as JSON text."""
    c = table(spark, sf_dir, "customer").withColumn("debt", F.when(F.col("c_acctbal") > 0, F.col("c_nationkey")))
    return c.select("c_custkey", selection.kept_properties(c.columns, ["c_name", "debt", "absent"]).alias("properties"))


@query("""SELECT o_custkey, array_to_string(list_sort(list(o_orderkey)), ',') AS orders, count(*) AS n FROM orders GROUP BY o_custkey""")
def nested_records(spark, sf_dir):
    """A record with an array of records, as text for the comparison."""
    nested = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_totalprice"))).alias("orders"))
    return nested.select("o_custkey", F.array_join(F.transform("orders", lambda x: x["o_orderkey"].cast("string")), ",").alias("orders"), F.size("orders").cast("long").alias("n"))


@query("""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'doc-i' || doc_id ELSE 'doc-' || source || '-' || doc_id END AS id FROM documents""")
def synthetic_ids(spark, sf_dir):
    """P10: ids of parts, else of an index."""
    k = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(k, selection.row_id("doc", F.when(k % 3 != 0, F.col("source")), k, index=F.concat(F.lit("i"), k.cast("string"))).alias("id"))


@query("""SELECT 'customer' AS kind, c_custkey AS id, c_name AS name, c_acctbal AS balance, NULL::VARCHAR AS brand FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name, s_acctbal, NULL FROM supplier UNION ALL SELECT 'part', p_partkey, p_name, NULL, p_brand FROM part""")
def unified_records(spark, sf_dir):
    """Records of several sources under one schema."""
    c = F.col
    sources = [
        (table(spark, sf_dir, "customer"), {"kind": F.lit("customer"), "id": c("c_custkey"), "name": c("c_name"), "balance": c("c_acctbal")}),
        (table(spark, sf_dir, "supplier"), {"kind": F.lit("supplier"), "id": c("s_suppkey"), "name": c("s_name"), "balance": c("s_acctbal")}),
        (table(spark, sf_dir, "part"), {"kind": F.lit("part"), "id": c("p_partkey"), "name": c("p_name"), "brand": c("p_brand")}),
    ]
    return selection.unified(sources, ["kind", "id", "name", "balance", "brand"])


@query("""SELECT 'new' AS era, o_orderkey AS id, o_totalprice AS amount, NULL::VARCHAR AS status FROM orders WHERE o_orderdate >= '1996-01-01' UNION ALL SELECT 'old', o_orderkey, NULL, o_orderstatus FROM orders WHERE o_orderdate < '1996-01-01'""")
def bridged_eras(spark, sf_dir):
    """Tables of two eras with different columns under one schema."""
    o = table(spark, sf_dir, "orders")
    new = o.where("o_orderdate >= '1996-01-01'").select(F.lit("new").alias("era"), "o_orderkey", F.col("o_totalprice").alias("Total Price"))
    old = o.where("o_orderdate < '1996-01-01'").select(F.lit("old").alias("era"), F.col("o_orderkey").alias("KEY"), "o_orderstatus")
    return relational.bridged([(new, {"era": "era", "id": "o_orderkey", "amount": "Total Price"}), (old, {"era": "era", "id": "KEY", "status": "o_orderstatus"})])


@query("""SELECT page_id, 'https://base.org/t/' || string_split(url, '/')[-1] AS url FROM pages""")
def public_urls(spark, sf_dir):
    """Public addresses of files."""
    return table(spark, sf_dir, "pages").select("page_id", selection.public_url("https://base.org/t/", F.col("url")).alias("url"))


# Aggregates


@query("""SELECT event_type AS species, sum(CASE WHEN user_id % 4 = 0 THEN 1 ELSE user_id % 4 END)::BIGINT AS n FROM events GROUP BY 1""")
def weighted_counters(spark, sf_dir):
    """Sums of quantities by key, blank ones counting one, most first."""
    q = F.col("user_id") % 4
    return selection.weighted_counts(table(spark, sf_dir, "events").withColumnRenamed("event_type", "species"), "species", F.when(q == 0, 1).otherwise(q), "event_id")


@query("""SELECT CASE WHEN year(o_orderdate) < 1995 THEN 'early' WHEN year(o_orderdate) <= 1996 THEN 'middle' ELSE 'late' END AS bucket, count(*) AS records, count(*) FILTER (o_orderstatus = 'F') AS filled, count(*) FILTER (o_totalprice > 100000) AS large, count(*) FILTER (o_orderpriority LIKE '1%') AS urgent FROM orders GROUP BY 1""")
def era_counts(spark, sf_dir):
    """Rows of each era and how many of them have what."""
    y = F.year("o_orderdate")
    era = F.when(y < 1995, "early").when(y <= 1996, "middle").otherwise("late")
    return selection.bucket_counts(table(spark, sf_dir, "orders"), era, {"filled": F.col("o_orderstatus") == "F", "large": F.col("o_totalprice") > 100000, "urgent": F.col("o_orderpriority").startswith("1")})


@query("""WITH v AS (SELECT DISTINCT p_brand AS dataset, 1990 + p_size % 3 AS year, p_type AS variable FROM part), y AS (SELECT dataset, year, array_to_string(list_sort(list(variable)), '+') AS variables FROM v GROUP BY 1, 2) SELECT dataset, array_to_string(list_sort(list(year::VARCHAR)), ',') AS years, array_to_string(list(year || ':' || variables ORDER BY year), ',') AS plan FROM y GROUP BY 1""")
def yearly_plan(spark, sf_dir):
    """The variables of each dataset by year."""
    rows = table(spark, sf_dir, "part").select(F.col("p_brand").alias("dataset"), (F.lit(1990) + F.col("p_size") % 3).alias("year"), F.col("p_type").alias("variable"))
    plan = agg.layer_plan(rows)
    entries = F.transform(F.map_entries("variables_by_year"), lambda e: F.concat(e["key"].cast("string"), F.lit(":"), F.array_join(e["value"], "+")))
    return plan.select("dataset", F.array_join(F.transform("years", lambda y: y.cast("string")), ",").alias("years"), F.array_join(entries, ",").alias("plan"))


@query("""WITH l AS (SELECT p_size % 4 AS family, p_brand AS dataset, 1990 + p_size % 3 AS year, count(*) AS variables FROM part GROUP BY ALL) SELECT family, count(DISTINCT dataset) AS datasets, sum(variables)::BIGINT AS variables, array_to_string(list(year || '/' || dataset || '/' || variables ORDER BY year, dataset, variables), ',') AS layers FROM l GROUP BY family""")
def family_catalog(spark, sf_dir):
    """Families with their layers by year."""
    rows = table(spark, sf_dir, "part").groupBy((F.col("p_size") % 4).alias("family"), F.col("p_brand").alias("dataset"), (F.lit(1990) + F.col("p_size") % 3).alias("year")).agg(F.count("*").alias("variables"))
    c = agg.catalog(rows)
    told = F.transform("layers", lambda x: F.concat_ws("/", x["year"].cast("string"), x["dataset"], x["variables"].cast("string")))
    return c.select("family", "datasets", "variables", F.array_join(told, ",").alias("layers"))


@query("""SELECT o_orderpriority, sum(o_totalprice) FILTER (o_orderkey % 2 = 0) - sum(o_totalprice) FILTER (o_orderkey % 4 = 0) AS saved, round((sum(o_totalprice) FILTER (o_orderkey % 2 = 0) - sum(o_totalprice) FILTER (o_orderkey % 4 = 0)) * 100 / nullif(sum(o_totalprice) FILTER (o_orderkey % 2 = 0), 0), 6) AS saved_percent FROM orders GROUP BY 1""")
def build_savings(spark, sf_dir):
    """Differences, and their share with a guard against zero."""
    k, v = F.col("o_orderkey"), F.col("o_totalprice")
    sums = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.sum(F.when(k % 2 == 0, v)).alias("a"), F.sum(F.when(k % 4 == 0, v)).alias("b"))
    out = sums.select("o_orderpriority", *agg.savings(F.col("a"), F.col("b")))
    return out.withColumn("saved_percent", F.round("saved_percent", 6))


@query("""SELECT year(ts) AS year, count(*) AS n_rows, count(*) FILTER (isfinite(value) AND event_type <> 'view') AS with_both FROM events GROUP BY 1""")
def coordinate_summary(spark, sf_dir):
    """Rows of each year, and those with both coordinates."""
    e = table(spark, sf_dir, "events")
    x, y = F.col("value"), F.when(F.col("event_type") != "view", F.col("value"))
    return e.groupBy(F.year("ts").alias("year")).agg(F.count("*").alias("n_rows"), F.count_if(F.coalesce(predicates.finite(x, y), F.lit(False))).alias("with_both"))


@query("""SELECT d.source, count(*) AS files, count(*) FILTER (l.doc_id IS NOT NULL) AS processed, count(*) FILTER (l.doc_id IS NULL) AS open, count(*) FILTER (lang = 'en') AS annual FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id) GROUP BY d.source""")
def inventory_report(spark, sf_dir):
    """What of each source is processed and what is open."""
    d, done = table(spark, sf_dir, "documents").select("doc_id", "source", "lang"), table(spark, sf_dir, "labels").select("doc_id").distinct()
    left = relational.pending(d, done, ["doc_id"]).groupBy("source").agg(F.count("*").alias("open"))
    every = d.groupBy("source").agg(F.count("*").alias("files"), F.count_if(F.col("lang") == "en").alias("annual"))
    return every.join(left, "source", "left").select("source", "files", (F.col("files") - F.coalesce("open", F.lit(0))).alias("processed"), F.coalesce("open", F.lit(0)).alias("open"), "annual")


# Order


@query("""SELECT user_id, event_id FROM events QUALIFY lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) IS DISTINCT FROM event_type""")
def collapsed_events(spark, sf_dir):
    """Rows that differ from the one before."""
    return agg.collapsed(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), ["user_id"], "event_id", ["event_type"]).select("user_id", "event_id")


@query("""SELECT user_id, n, ax, bx FROM (SELECT user_id, row_number() OVER w AS n, value AS ax, lead(value) OVER w AS bx FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) WHERE bx IS NOT NULL""")
def event_segments(spark, sf_dir):
    """Consecutive points as segments."""
    e = table(spark, sf_dir, "events").withColumn("y", F.lit(0.0))
    return agg.segments(e, ["user_id"], ["event_id"], "value", "y").select("user_id", "n", "ax", "bx")


@query("""SELECT doc_id, row_number() OVER (ORDER BY source, n_chars DESC, doc_id) - 1 AS "index" FROM documents""")
def stable_index(spark, sf_dir):
    """Numbers of rows in an order."""
    return selection.indexed(table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"), F.col("source"), F.col("n_chars").desc(), F.col("doc_id")).select("doc_id", "index")


def _placed(df, key, *order):
    """(key, place) in the order of a result, so that the comparison sees the order."""
    return selection.indexed(df, *order, name="place").select(key, "place")


@query("""SELECT o_orderkey, row_number() OVER (ORDER BY CASE WHEN o_orderkey % 5 = 0 THEN '1970-01-01'::TIMESTAMP ELSE o_orderdate END, o_orderkey) - 1 AS place FROM orders""")
def undated_first(spark, sf_dir):
    """By time, undated ones as of 1970, ties by id."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderdate").cast("timestamp")).alias("t"))
    return _placed(o, "o_orderkey", F.coalesce("t", F.timestamp_seconds(F.lit(0))), F.col("o_orderkey"))


_SPELLED = ("Å{}", "a{}", "Z{}", "é{}", "E{}", "ö-{}", "Zebra {}", "_{}", "ñu{}", "o{}")


@query(f"""WITH n AS (SELECT s_suppkey AS k, replace({cycled_sql("s_suppkey", *_SPELLED)}, '{{}}', (s_suppkey % 7)::VARCHAR) AS name FROM supplier) SELECT k, name, row_number() OVER (ORDER BY name COLLATE en, k) - 1 AS place FROM n""")
def collated_names(spark, sf_dir):
    """Names in the order of the root collation: accents and case count after letters."""
    name = F.replace(cycled(F.col("s_suppkey"), *_SPELLED), F.lit("{}"), (F.col("s_suppkey") % 7).cast("string"))
    n = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), name.alias("name"))
    return _placed(n.withColumn("_c", F.collate("name", "UNICODE")), "k", F.col("_c"), F.col("k")).join(n, "k").select("k", "name", "place")


@query("""SELECT event_id, row_number() OVER (ORDER BY CASE WHEN user_id % 3 = 0 THEN 0 ELSE year(ts) END, CAST(ts AS DATE), event_id) - 1 AS place FROM events""")
def year_date_id(spark, sf_dir):
    """By year (0 where it is unknown), date and id."""
    e = table(spark, sf_dir, "events")
    return _placed(e, "event_id", F.coalesce(F.when(F.col("user_id") % 3 != 0, F.year("ts")), F.lit(0)), F.to_date("ts"), F.col("event_id"))


@query("""SELECT s_suppkey, row_number() OVER (ORDER BY coalesce(nullif(list_position(['EUROPE', 'ASIA'], r_name), 0), 99), s_suppkey) - 1 AS place FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def family_order(spark, sf_dir):
    """By the place in a given list, then by key."""
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return _placed(s.select("s_suppkey", "r_name"), "s_suppkey", selection.ordinal(F.col("r_name"), ["EUROPE", "ASIA"]), F.col("s_suppkey"))


@query("""SELECT o_orderkey, row_number() OVER (ORDER BY strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S'), o_orderkey) - 1 AS place FROM orders WHERE o_totalprice < 200000 AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND month(o_orderdate) BETWEEN 6 AND 9""")
def scene_order(spark, sf_dir):
    """Scenes of the warm season with few clouds, by their time as text."""
    o = table(spark, sf_dir, "orders").where("o_totalprice < 200000 and o_orderpriority in ('1-URGENT', '2-HIGH')").where(F.month("o_orderdate").between(6, 9))
    return _placed(o.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("t")), "o_orderkey", F.col("t"), F.col("o_orderkey"))


@query("""SELECT c_custkey FROM customer ORDER BY c_custkey LIMIT 77""")
def truncated_fetch(spark, sf_dir):
    """The first rows up to an expected count."""
    return table(spark, sf_dir, "customer").select("c_custkey").orderBy("c_custkey").limit(77)


# Sets, plans and state


@query("""SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem WHERE l_discount > 0.05 AND l_returnflag <> 'N'""")
def retries(spark, sf_dir):
    """What failed, once each."""
    failed = table(spark, sf_dir, "lineitem").where("l_discount > 0.05").select("l_suppkey", F.nullif("l_returnflag", F.lit("N")).alias("l_returnflag"))
    return selection.retry_set(failed, ["l_suppkey", "l_returnflag"])


@query("""WITH p AS (SELECT DISTINCT p_brand AS dataset, 1990 + p_size % 4 AS year, p_type AS variable FROM part), l AS (SELECT * FROM p WHERE (dataset, year) IN (SELECT (dataset, max(year)) FROM p GROUP BY dataset))
SELECT dataset, year, variable FROM l QUALIFY row_number() OVER (PARTITION BY dataset, year ORDER BY variable) = 1 ORDER BY dataset, year LIMIT 10 OFFSET 3""")
def layer_selection(spark, sf_dir):
    """The first variable of each dataset's latest year, a page of them."""
    p = table(spark, sf_dir, "part").select(F.col("p_brand").alias("dataset"), (F.lit(1990) + F.col("p_size") % 4).alias("year"), F.col("p_type").alias("variable")).distinct()
    return selection.selected_layers(p.withColumn("place", F.col("variable")), offset=3, limit=10)


@query("""WITH v AS (SELECT p_partkey AS id, p_brand AS category FROM part UNION ALL SELECT p_partkey, p_type FROM part), h AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN ' ' ELSE p_name END AS label FROM part WHERE p_partkey % 4 <> 0)
SELECT h.id, coalesce(nullif(trim(h.label), ''), 'm' || h.id) AS label, array_to_string(list_sort(list(DISTINCT category)), '|') AS groups FROM h JOIN v ON v.id = h.id GROUP BY h.id, h.label""")
def variable_labels(spark, sf_dir):
    """Labels of the available variables, and the groups that list them."""
    p = table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "id")
    variables = p.select("id", F.col("p_brand").alias("category")).unionByName(p.select("id", F.col("p_type").alias("category")))
    headers = p.where("id % 4 <> 0").select("id", F.when(F.col("id") % 3 == 0, " ").otherwise(F.col("p_name")).alias("label"))
    metadata = p.select("id", F.concat(F.lit("m"), F.col("id").cast("string")).alias("label"))
    return selection.labelled_variables(variables, metadata, headers).withColumn("groups", F.array_join("groups", "|"))


def _list_sql(x: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in x) + "]::VARCHAR[]"


_DISTANCES = ", ".join(f"('{d}', {m}, {s})" for _, d, _, mode, _, _, near, _, _ in FACTORS if mode == "proximity" for m, s in near if s)


@query(f"""WITH f(ref, description, layer, mode, given, score) AS (VALUES {", ".join(f"('{r}', '{d}', '{y}', '{m}', {_list_sql(v)}, {s})" for r, d, y, m, _, v, _, s, _ in FACTORS)}), v(variant, refs, descriptions, layers, buffer) AS (VALUES {", ".join(f"('{k}', {_list_sql(r)}, {_list_sql(d)}, {_list_sql(y)}, {b})" for k, r, d, y, _, b in VARIANTS)}),
n(variant, ref, kept) AS (VALUES {", ".join(f"('{k}', '{r}', {_list_sql(kept)})" for k, _, _, _, narrow, _ in VARIANTS for r, kept in narrow.items())}), m(description, metres, points) AS (VALUES {_DISTANCES}),
k AS (SELECT variant, ref, f.description, array_to_string(CASE WHEN kept IS NULL THEN given ELSE list_filter(given, lambda x: list_contains(kept, x)) END, '|') AS "values", mode, score, buffer FROM f CROSS JOIN v LEFT JOIN n USING (variant, ref) WHERE NOT list_contains(refs, ref) AND NOT list_contains(descriptions, f.description) AND NOT list_contains(layers, layer)),
a AS (SELECT description, row_number() OVER (ORDER BY description) - 1 AS i, layer, given FROM f), p AS (SELECT layer, CASE WHEN len(given) > 0 THEN given[p_partkey % len(given) + 1] END AS v, count(*) AS n FROM part JOIN a ON i = p_partkey % (SELECT count(*) FROM a) GROUP BY ALL),
s AS (SELECT variant, ref, description, "values", CASE WHEN k.mode = 'proximity' THEN metres ELSE buffer END AS distance, CASE WHEN k.mode = 'proximity' THEN points ELSE k.score END AS score, f.layer FROM k JOIN f USING (ref, description) LEFT JOIN m USING (description)),
t AS (SELECT variant, ref, description, "values", distance, score, coalesce(sum(n), 0)::BIGINT AS features FROM s LEFT JOIN p ON p.layer = s.layer AND ("values" = '' OR list_contains(string_split("values", '|'), v)) GROUP BY ALL) SELECT *, score * features AS total FROM t""")
def factor_variants(spark, sf_dir):
    """The factors of each variant, some dropped, some narrowed, by the distances at which they score, with the features (parts that stand for them) whose layer and value they take, and their scores."""
    factors = values(spark, FACTORS, "ref string, description string, layer string, mode string, field string, values array<string>, distances array<struct<distance:int, score:int>>, score int, condition string")
    variants = values(spark, VARIANTS, "variant string, drop_refs array<string>, drop_descriptions array<string>, drop_layers array<string>, narrow map<string, array<string>>, buffer int")
    scored = selection.scored_distances(selection.varied_factors(factors, variants))
    order = values(spark, [(i, layer, given) for i, (_, layer, given) in enumerate(sorted((d, y, v) for _, d, y, _, _, v, _, _, _ in FACTORS))], "i int, layer string, given array<string>")
    parts = table(spark, sf_dir, "part").join(F.broadcast(order), F.col("p_partkey") % len(FACTORS) == F.col("i"))
    features = parts.select("layer", F.when(F.size("given") > 0, F.try_element_at("given", (F.col("p_partkey") % F.size("given") + 1).cast("int"))).alias("value"))
    return selection.feature_totals(scored, features).select("variant", "ref", "description", F.array_join("values", "|").alias("values"), "distance", "score", "features", "total")


@query("""SELECT event_id, try_cast(CASE WHEN user_id % 3 = 0 THEN 'x' ELSE event_id::VARCHAR END AS BIGINT) AS result, CASE WHEN user_id % 3 = 0 THEN 'no number' END AS error FROM events""")
def outcomes(spark, sf_dir):
    """Failures as rows."""
    e = table(spark, sf_dir, "events").select("event_id", F.when(F.col("user_id") % 3 == 0, "x").otherwise(F.col("event_id").cast("string")).alias("raw"))
    good, bad = selection.split_by_outcome(e, lambda: F.col("raw").try_cast("long"), "no number")
    return good.drop("raw").unionByName(bad.drop("raw"), allowMissingColumns=True)


@query("""SELECT user_id AS k, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY 1""")
def incremental_state(spark, sf_dir):
    """Four batches of new rows upserted one after the other."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("k"), "event_id", "value")
    state = None
    for i in range(4):
        new = relational.last_per_key(e.where(F.col("event_id") % 4 == i), ["k"], "event_id")
        if state is None:
            state = new
        else:
            newer = new.join(state.select("k", F.col("event_id").alias("_seen")), "k", "left").where("_seen is null or _seen < event_id").drop("_seen")
            state = relational.upsert(state, newer, ["k"])
    return state


_CLASSES = ("healthy_food_outlet", "warehouse", "retail_service_candidate", None, "home_business", "office")


@query(f"""WITH b AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_acctbal > 8000 END AS h, c_acctbal < -500 AS r, {cycled_sql("c_custkey", *_CLASSES)} AS c FROM customer) SELECT k FROM b WHERE coalesce(h, false) OR r OR coalesce(c IN ('healthy_food_outlet', 'retail_service', 'retail_service_candidate', 'food_or_household_retail'), false)""")
def useful_businesses(spark, sf_dir):
    """businesses of other classes go unless a flag keeps them."""
    k = F.col("c_custkey")
    kept = predicates.useful_business(F.when(k % 4 != 0, F.col("c_acctbal") > 8000), F.col("c_acctbal") < -500, cycled(k, *_CLASSES))
    return table(spark, sf_dir, "customer").where(kept).select(k.alias("k"))


@query("""WITH RECURSIVE e AS (SELECT DISTINCT l_orderkey % 40 AS g, (l_partkey % 7)::VARCHAR AS a, (l_partkey % 7 + 1)::VARCHAR AS b FROM lineitem WHERE l_partkey % 7 <> l_orderkey % 5), s AS (SELECT g, a, b, 1 AS n FROM e x WHERE NOT EXISTS (SELECT 1 FROM e y WHERE y.g = x.g AND y.b = x.a) UNION ALL SELECT s.g, s.a, e.b, n + 1 FROM s JOIN e ON e.g = s.g AND e.a = s.b)
SELECT g, a AS first_node, max(n) + 1 AS nodes FROM s GROUP BY g, a""")
def merged_chains(spark, sf_dir):
    """Edges joined where exactly two meet."""
    li = table(spark, sf_dir, "lineitem").where(F.col("l_partkey") % 7 != F.col("l_orderkey") % 5)
    edges = li.select((F.col("l_orderkey") % 40).alias("g"), (F.col("l_partkey") % 7).cast("string").alias("a"), (F.col("l_partkey") % 7 + 1).cast("string").alias("b")).distinct()
    return graph.chains(edges, "g", "a", "b").select("g", F.array_min("nodes").alias("first_node"), F.size("nodes").alias("nodes"))


@query("""WITH RECURSIVE m AS (SELECT l_partkey * 7919 % 23 AS r, l_orderkey * 31 % 19 AS c FROM lineitem GROUP BY ALL HAVING count(*) % 2 = 1), g AS (SELECT i AS r, j AS c FROM range(23) a(i), range(19) b(j)), e AS (SELECT * FROM g ANTI JOIN m USING (r, c)),
o AS (SELECT r, c FROM e WHERE r IN (0, 22) OR c IN (0, 18) UNION SELECT e.r, e.c FROM o JOIN e ON abs(e.r - o.r) + abs(e.c - o.c) = 1)
SELECT r::INTEGER AS "row", c::INTEGER AS col FROM g ANTI JOIN o USING (r, c)""")
def filled_region(spark, sf_dir):
    """The cells that hold an odd number of lines, with all cells that they enclose."""
    cells = table(spark, sf_dir, "lineitem").groupBy((F.col("l_partkey") * 7919 % 23).cast("int").alias("row"), (F.col("l_orderkey") * 31 % 19).cast("int").alias("col")).agg(F.count("*").alias("n"))
    return graph.fill_holes(cells.where("n % 2 = 1").select("row", "col"), 23, 19)


@query("""SELECT true AS known_form, count(*) AS n FROM nation""")
def stamped_rows(spark, sf_dir):
    """Rows with the time they were made at, of which only the form can be compared."""
    from ..functions import dates

    n = table(spark, sf_dir, "nation").withColumn("made", dates.generated_at())
    return n.groupBy(F.col("made").rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z$").alias("known_form")).agg(F.count("*").alias("n"))
