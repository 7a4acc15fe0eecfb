"""Queries of the sources and sinks: tables are written in a form that services and archives give, read back by the source, and must be the tables they were."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import functions as F

from ..functions import geo, text
from ..operators import graph, relational
from ..sources import landed, sinks, table_functions, tiles
from ..sources.scratch import scratch_path, written
from .base import lat, lat_sql, lon, lon_sql, query, table, values
from .function_queries import cycled, cycled_sql


@query(r"""SELECT doc_id, replace(source || ', "' || lang || '"', 'x', '') AS label, coalesce(n_chars::VARCHAR, '') AS size FROM documents""")
def csv_round_trip(spark, sf_dir):
    """Text with commas and quotes, written and read by line."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), F.replace(F.concat("source", F.lit(', "'), "lang", F.lit('"')), F.lit("x"), F.lit("")).alias("label"), F.col("n_chars").cast("string").alias("size"))
    sinks.write_csv(d, path := scratch_path(spark, "csv"))
    return landed.csv_rows(spark, path).select(F.col("doc_id").cast("long").alias("doc_id"), "label", F.coalesce("size", F.lit("")).alias("size"))


@query("""SELECT turn, conv_id, role, text FROM conversations""")
def gzip_csv_round_trip(spark, sf_dir):
    """Compressed documents with line breaks in quotes."""
    c = table(spark, sf_dir, "conversations").select(F.col("turn").cast("string").alias("turn"), F.col("conv_id").cast("string").alias("conv_id"), "role", F.concat("text", F.lit("\nend")).alias("text"))
    sinks.write_csv(c, path := scratch_path(spark, "csvgz"), "gzip")
    back = landed.csv_rows(spark, path, multiline=True)
    return back.select(F.col("turn").cast("long").alias("turn"), F.col("conv_id").cast("long").alias("conv_id"), "role", F.regexp_replace("text", "\nend$", "").alias("text"))


@query("""SELECT year(o_orderdate) AS year, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""")
def exports_of_years(spark, sf_dir):
    """One folder a year, the year from its name."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    o.write.partitionBy("year").csv(path := scratch_path(spark, "years"), header=True)
    back = landed.csv_of_years(spark, path, "o_orderkey bigint, o_totalprice double, year int")
    return back.groupBy("year").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("""SELECT s_suppkey AS k, s_name AS name, (s_suppkey % 9 + 0.5)::DOUBLE AS x FROM supplier""")
def feature_lines(spark, sf_dir):
    """Features by line, written in order and read back."""
    k = F.col("s_suppkey")
    f = table(spark, sf_dir, "supplier").select(k.alias("k"), sinks.feature(sinks.point(k % 9 + F.lit(0.5), F.lit(1.0)), k=k, name=F.col("s_name")).alias("f"))
    sinks.write_feature_lines(f, path := scratch_path(spark, "features"), "f", "k")
    back = landed.geojson(spark, path, "k bigint, name string", lines=True)
    return back.select("k", "name", F.from_json("coordinates", "array<double>")[0].alias("x"))


@query("""SELECT n_nationkey AS k, n_name AS name, 'Polygon' AS kind, 4 AS points FROM nation""")
def feature_collections(spark, sf_dir):
    """A collection as one document, its polygons read back."""
    k = F.col("n_nationkey")
    shape = F.struct(F.lit("Polygon").alias("type"), F.array(F.array(*(F.array(k + F.lit(x), F.lit(y)) for x, y in ((0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0))))).alias("coordinates"))
    f = table(spark, sf_dir, "nation").select(k.alias("k"), sinks.feature(shape, k=k, name=F.col("n_name")).alias("f"))
    sinks.feature_collection(f, "f", "k").write.text(path := scratch_path(spark, "collection"))
    back = landed.geojson(spark, path, "k int, name string")
    parts = landed.polygon_parts(F.col("geometry_type"), F.col("coordinates"))
    return back.where(F.trim(F.coalesce("name", F.lit(""))) != "").select("k", "name", F.col("geometry_type").alias("kind"), F.size(parts[0][0]).alias("points"))


@query("""SELECT o_orderkey AS k, o_orderpriority AS name, 'Point' AS kind, (o_orderkey % 360)::DOUBLE AS x FROM orders""")
def large_collections(spark, sf_dir):
    """All orders as one collection, written in sorted parts and read by ranges of bytes."""
    k = F.col("o_orderkey")
    f = table(spark, sf_dir, "orders").select(k.alias("k"), sinks.feature(sinks.point((k % 360).cast("double"), F.lit(50.0)), k=k, name=F.col("o_orderpriority")).alias("f"))
    sinks.write_feature_collection(f, path := scratch_path(spark, "collection"), "f", "k")
    back = landed.split_geojson(spark, [f"{path}/{part}" for part in ("0-head", "1-features", "2-end")], "k long, name string")
    return back.select("k", "name", F.col("geometry_type").alias("kind"), F.from_json("coordinates", "array<double>")[0].alias("x"))


@query("""SELECT c_custkey, c_name, c_acctbal AS x FROM customer""")
def paged_services(spark, sf_dir):
    """Pages of features, united; their number must be the one that the service counts."""
    c = table(spark, sf_dir, "customer")
    batches = landed.id_batches(c, "c_custkey", 50)
    attributes = F.struct("c_custkey", "c_name")
    features = c.select(F.floor(F.col("c_custkey") / 50).alias("batch"), F.struct(attributes.alias("attributes"), F.struct(F.col("c_acctbal").alias("x"), F.lit(0.0).alias("y")).alias("geometry")).alias("f"))
    pages = features.groupBy("batch").agg(F.collect_list("f").alias("features")).join(batches.select("batch"), "batch")
    pages.select(F.to_json(F.struct("features")).alias("value")).write.text(path := scratch_path(spark, "pages"))
    # A line is a page here, as a file is where pages are landed one by one.
    lines = spark.read.text(path)
    feature = "struct<attributes:struct<c_custkey:bigint,c_name:string>,geometry:struct<x:double,y:double>>"
    rows = lines.select(F.explode(F.from_json("value", f"struct<features:array<{feature}>>")["features"]).alias("f")).select("f.attributes.*", F.col("f.geometry.x").alias("x"))
    return landed.checked_count(rows, c.count())


@query("""SELECT n_nationkey AS code, n_name AS name FROM nation""")
def page_files(spark, sf_dir):
    """A landed page as a file of its own; an error payload would fail."""
    n = table(spark, sf_dir, "nation").select(F.struct(F.struct(F.col("n_nationkey").alias("code"), F.col("n_name").alias("name")).alias("attributes")).alias("f"))
    n.agg(F.collect_list("f").alias("features")).select(F.to_json(F.struct("features")).alias("value")).write.text(path := scratch_path(spark, "page"))  # one page
    return landed.arcgis_pages(spark, path, "code int, name string", geometry=False)


@query("""SELECT r_regionkey AS k, 'metres' AS unit, (r_regionkey * 10.0)::DOUBLE AS x FROM region""")
def esri_arrays(spark, sf_dir):
    """Arrays of attributes and projected geometries."""
    r = table(spark, sf_dir, "region")
    f = r.select(F.struct(F.struct(F.col("r_regionkey").alias("k"), F.lit("metres").alias("unit")).alias("attributes"), F.struct((F.col("r_regionkey") * 10.0).alias("x"), F.lit(5.0).alias("y")).alias("geometry")).alias("f"))
    f.agg(F.collect_list("f").alias("a")).select(F.to_json("a").alias("value")).write.text(path := scratch_path(spark, "esri"))  # one file
    return landed.esri_features(spark, path, "k int, unit string").select("k", "unit", "x")


@query(f"""SELECT c_custkey AS k FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal <= 0 AND {lon_sql("c_custkey")} <= -122.5 AND {lon_sql("c_custkey")} + 1 >= -133.25 AND {lat_sql("c_custkey")} <= 57.25 AND {lat_sql("c_custkey")} + 1 >= 50""")
def server_filters(spark, sf_dir):
    """The conditions and the box of a request, on landed rows with an extent each."""
    k, conditions = F.col("c_custkey"), {"SEGMENT": "BUILDING", "CREDIT": None}
    columns = {"SEGMENT": F.col("c_mktsegment"), "CREDIT": F.when(F.col("c_acctbal") > 0, F.col("c_acctbal"))}
    extent = F.struct(lon(k).alias("xmin"), lat(k).alias("ymin"), (lon(k) + 1).alias("xmax"), (lat(k) + 1).alias("ymax"))
    return table(spark, sf_dir, "customer").where(landed.wfs_matches(columns, conditions, (-133.25, 50, -122.5, 57.25), extent)).select(k.alias("k"))


@query("""SELECT page_id, 'https://maps.example/' || page_id || '/MapServer/0/query' AS url, 't' || (page_id * 17) AS token FROM pages""")
def service_tokens(spark, sf_dir):
    """The token and the address that a page's script holds."""
    script = F.concat(F.lit("<script>var gistoken = 't"), F.col("page_id") * 17, F.lit("'; mapserverUrl='https://maps.example/"), "page_id", F.lit("/MapServer//';</script>"), "html")
    return table(spark, sf_dir, "pages").select("page_id", landed.service_access(script).alias("a")).select("page_id", "a.*")


@query("""SELECT c_mktsegment AS segment, count(*) AS "rows", (SELECT count(*) + count(DISTINCT c_mktsegment) FROM customer) AS copied FROM customer GROUP BY 1""")
def copied_exports(spark, sf_dir):
    """Exports by segment, their rows counted without headers and blank lines, and a copy with its number of lines."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.regexp_replace("c_mktsegment", " ", "-").alias("segment"))
    c.repartition("segment").sortWithinPartitions("segment").write.partitionBy("segment").csv(path := scratch_path(spark, "exports"), header=True)
    lines = sinks.copied(spark, f"{path}/*", scratch_path(spark, "copy"))
    found = landed.exported_rows(spark, f"{path}/*").groupBy(F.regexp_extract("file", "segment=([^/]+)/", 1).alias("segment")).agg(F.sum("rows").alias("rows"))
    return found.withColumn("copied", F.lit(lines).cast("long"))


@query("""SELECT event_id AS id, value AS cloud, 'landsat-' || (8 + event_id % 2) AS platform FROM events WHERE value < 40 AND event_id % 4 < 2""")
def scene_records(spark, sf_dir):
    """Scenes of a catalogue's answers, filtered by nested fields."""
    e = F.col("event_id")
    platform = F.concat(F.lit("landsat-"), F.when(e % 4 < 2, F.lit(8) + e % 2).otherwise(7).cast("string"))
    raw = table(spark, sf_dir, "events").select(F.to_json(F.struct(e.alias("id"), F.struct(F.col("value").alias("cloud"), platform.alias("platform")).alias("properties"))).alias("t"))
    s = raw.select(F.from_json("t", "id bigint, properties struct<cloud:double, platform:string>").alias("s"))
    return s.where("s.properties.cloud < 40 and s.properties.platform in ('landsat-8', 'landsat-9')").select("s.id", "s.properties.cloud", "s.properties.platform")


@query("""SELECT s_suppkey AS id, CASE WHEN s_suppkey % 2 = 0 THEN s_name END AS name FROM supplier""")
def map_elements(spark, sf_dir):
    """Elements with maps of tags."""
    k = F.col("s_suppkey")
    tags = F.when(k % 2 == 0, F.create_map(F.lit("name"), F.col("s_name"))).otherwise(F.create_map(F.lit("shop"), F.lit("x")))
    one = table(spark, sf_dir, "supplier").select(F.to_json(F.struct(F.array(F.struct(F.lit("node").alias("type"), k.alias("id"), F.lit(1.0).alias("lat"), F.lit(2.0).alias("lon"), tags.alias("tags"))).alias("elements"))).alias("t"))
    return one.select(F.explode(landed.overpass_elements(F.col("t"))).alias("e")).select("e.id", F.try_element_at("e.tags", F.lit("name")).alias("name"))


def _zipped(df, by: str, member: str, names: dict[str, str]):
    """(path, length, content): a ZIP file with a CSV member for each value of `by`. A group is one file, so one task's; its rows are packed as they come, and only the file is held."""

    def pack(key: tuple[Any, ...], frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, first = io.BytesIO(), True
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("readme.txt", "x")
            with z.open(member, "w", force_zip64=True) as f:
                for frame in frames:
                    text = frame[list(names)].rename(columns=names).to_csv(index=False, header=first)
                    f.write((("\ufeff" if first else "") + text).encode())
                    first = False
        yield pd.DataFrame([(f"/z/{key[0]}.zip", len(out.getvalue()), out.getvalue())], columns=["path", "length", "content"])

    return df.select(by, *(n for n in names if n != by)).groupBy(by).applyInPandas(pack, "path string, length long, content binary")


@query("""SELECT '/z/' || c_nationkey || '.zip' AS path, c_custkey AS k, c_name AS name, c_mktsegment AS segment FROM customer""")
def zipped_csv(spark, sf_dir):
    """CSV members of archives, streamed from each."""
    zips = _zipped(table(spark, sf_dir, "customer"), "c_nationkey", "stops.txt", {"c_custkey": "k", "c_name": "name", "c_mktsegment": "segment"})
    return landed.archive_csv(zips, r"^stops\.txt$", ["k", "name", "segment"]).select("path", F.col("k").cast("long").alias("k"), "name", "segment")


@query("""SELECT '/z/' || c_nationkey || '.zip' AS path, m AS member, sum(CASE WHEN m = 'stops.txt' THEN 1 ELSE 0 END)::BIGINT + 1 AS lines FROM customer, (VALUES ('readme.txt'), ('stops.txt')) v(m) GROUP BY ALL""")
def archive_table_functions(spark, sf_dir):
    """Members of archives and their lines by table functions that SQL calls for each row."""
    table_functions.register(spark)
    zips = _zipped(table(spark, sf_dir, "customer"), "c_nationkey", "stops.txt", {"c_custkey": "k", "c_name": "name"})
    zips = written(zips.select("path", "content"), "zips")  # read by both
    members = "select z.path, m.member from {zips} z, lateral zip_members(z.content) m"
    lines = "select path, member, count(value) as lines from zip_table_lines(table(select path, content from {zips}), '.txt$') group by all"
    return spark.sql(f"select path, member, lines from ({members}) join ({lines}) using (path, member)", zips=zips)


@query("""WITH e AS (SELECT user_id, event_id, event_type, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER w THEN 1 ELSE 0 END AS b FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)), g AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS g FROM e)
SELECT user_id::VARCHAR AS "key", min(event_id)::VARCHAR AS start, event_type AS "value", count(*) AS n FROM g GROUP BY user_id, g, event_type""")
def partition_runs(spark, sf_dir):
    """Runs of each user's events by a table function over a partitioned and ordered table."""
    table_functions.register(spark)
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return spark.sql("select * from value_runs(table(select * from {events}) partition by user_id order by event_id)", events=events)


@query("""SELECT '/z/' || n_regionkey || '.zip' AS path, m AS member FROM (SELECT DISTINCT n_regionkey FROM nation), (VALUES ('readme.txt'), ('nations.csv')) v(m) UNION ALL SELECT '/z/bad.zip', NULL""")
def archive_listing(spark, sf_dir):
    """Members of archives; one that cannot be read is a row."""
    zips = _zipped(table(spark, sf_dir, "nation"), "n_regionkey", "nations.csv", {"n_name": "name"})
    bad = values(spark, [("/z/bad.zip", 2, b"no")], "path string, length long, content binary")
    return landed.archive_members(zips.unionByName(bad)).select("path", "member")


def workbook(frame: pd.DataFrame) -> bytes:
    """A small workbook with shared and plain values, as a source for workbook_rows."""
    names, shared = list(frame.columns), []
    space = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'

    def cell(row: int, col: int, v) -> str:
        at = f"{chr(65 + col)}{row}"
        if isinstance(v, str):
            shared.append(v.replace("&", "&amp;").replace("<", "&lt;"))
            return f'<c r="{at}" t="s"><v>{len(shared) - 1}</v></c>'
        return f'<c r="{at}"><v>{v}</v></c>'

    rows = [names, *frame.itertuples(index=False)]
    body = "".join(f'<row r="{i}">{"".join(cell(i, j, v) for j, v in enumerate(r))}</row>' for i, r in enumerate(rows, 1))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {space}><sheetData>{body}</sheetData></worksheet>")
        z.writestr("xl/worksheets/sheet2.xml", f"<worksheet {space}><sheetData/></worksheet>")
        z.writestr("xl/sharedStrings.xml", f"<sst {space}>{''.join(f'<si><t>{s}</t></si>' for s in shared)}</sst>")
    return out.getvalue()


@query("""SELECT p_partkey AS k, p_name AS "name", p_size AS size, NULL::VARCHAR AS absent FROM part""")
def workbook_tables(spark, sf_dir):
    """Rows of workbooks by the names in their first row."""

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(frame["p_brand"].iloc[0], workbook(frame[["p_size", "p_partkey", "p_name"]]))], columns=["path", "content"])

    files = table(spark, sf_dir, "part").groupBy("p_brand").applyInPandas(pack, "path string, content binary")
    rows = landed.workbook_rows(files, ["p_partkey", "p_name", "p_size", "absent"])
    return rows.select(F.col("p_partkey").cast("long").alias("k"), F.col("p_name").alias("name"), F.col("p_size").cast("int").alias("size"), "absent")


@query("""SELECT c_custkey AS k, c_name AS facility_name, c_mktsegment AS hazard_rating FROM customer""")
def html_key_values(spark, sf_dir):
    """Labelled values of a page's table."""
    c = F.col
    html = F.concat(F.lit("<table class='x'><tr><th colspan=2>Details</th></tr><tr><td>Facility  Name:</td><td> <b>"), c("c_name"), F.lit("</b></td></tr><tr><td>Hazard-Rating</td><td>"), c("c_mktsegment"), F.lit("</td></tr><tr><td>Hazard rating</td><td>later</td></tr></table>"))
    rows = landed.html_tables(table(spark, sf_dir, "customer").select(c("c_custkey").alias("k"), html.alias("html")), "html")
    pairs = rows.groupBy("k").agg(F.transform(F.array_sort(F.collect_list(F.struct("row_index", "cells"))), lambda r: r["cells"]).alias("cells"))  # the rows of one page
    m = landed.key_values(c("cells"))
    return pairs.select("k", m["facility_name"].alias("facility_name"), m["hazard_rating"].alias("hazard_rating"))


@query("""SELECT o_orderkey, o_custkey AS a, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS b FROM orders""")
def callbacks(spark, sf_dir):
    """The argument of a callback, or plain JSON."""
    k = F.col("o_orderkey")
    inner = F.to_json(F.struct(F.col("o_custkey").alias("a"), F.when(k % 2 == 0, F.col("o_orderstatus")).alias("b")))
    raw = F.when(k % 3 == 0, F.concat(F.lit("cb$.x( "), inner, F.lit(" );"))).when(k % 3 == 1, F.concat(F.lit(" call("), inner, F.lit(")"))).otherwise(inner)
    p = landed.jsonp(raw, "a bigint, b string")
    return table(spark, sf_dir, "orders").select("o_orderkey", p["a"].alias("a"), p["b"].alias("b"))


@query("""WITH c AS (SELECT 'a' || i || '.pdf' AS url, 'numbered' AS m FROM range(1, 13) t(i) UNION SELECT 'a' || lpad(i::VARCHAR, 2, '0') || '.pdf', 'numbered' FROM range(1, 13) t(i) UNION SELECT 'a' || n_nationkey || '.pdf', 'index' FROM nation)
SELECT url, array_to_string(list_sort(list(m)), '+') AS methods FROM c GROUP BY url""")
def discovered_urls(spark, sf_dir):
    """Addresses found in several ways, each with the ways that found it."""
    numbered = landed.candidate_urls(spark, "a", ".pdf", 12).select("url", F.array(F.lit("numbered")).alias("methods"), F.lit(None).cast("string").alias("hint"), F.lit(0).alias("i"))
    index = table(spark, sf_dir, "nation").select(F.concat(F.lit("a"), F.col("n_nationkey").cast("string"), F.lit(".pdf")).alias("url"), F.array(F.lit("index")).alias("methods"), F.col("n_name").alias("hint"), F.lit(1).alias("i"))
    return relational.merge_discoveries(numbered.unionByName(index), "url", "methods", "hint", "i").select("url", F.array_join("methods", "+").alias("methods"))


@query("""SELECT page_id, page_id % 4 = 0 AS ok, CASE page_id % 4 WHEN 0 THEN 200 WHEN 1 THEN 404 END AS status, CASE WHEN page_id % 4 = 0 THEN page_id * 10 END AS content_length, CASE WHEN page_id % 4 > 1 THEN 'timeout' END AS error FROM pages""")
def probes(spark, sf_dir):
    """Outcomes of probes as rows."""
    k = F.col("page_id")
    status = F.when(k % 4 == 0, 200).when(k % 4 == 1, 404)
    length = F.when(k % 4 == 0, (k * 10).cast("string")).when(k % 4 == 1, "n/a")
    o = landed.probe_outcome(status, length, F.when(k % 4 > 1, "timeout"))
    return table(spark, sf_dir, "pages").select("page_id", *(o[f].alias(f) for f in ("ok", "status", "content_length", "error")))


@query(f"""SELECT c_custkey, {cycled_sql("c_custkey", "café €", "plain", "naïve “x”")} AS t FROM customer""")
def charset_fallback(spark, sf_dir):
    """UTF-8, or what windows-1252 reads."""
    k = F.col("c_custkey")
    utf8 = cycled(k, "café €", "plain", "naïve “x”").cast("binary")
    western = F.element_at(F.array(*(F.lit(x.encode("cp1252")) for x in ("café €", "plain", "naïve “x”"))), (k % 3 + 1).cast("int"))
    return table(spark, sf_dir, "customer").select("c_custkey", landed.decoded(F.when(k % 2 == 0, utf8).otherwise(western)).alias("t"))


@query("""SELECT i AS "offset", least(30, (SELECT count(*) FROM customer) - i) AS size, least(30, (SELECT count(*) FROM customer) - i) < 30 AS last FROM range(0, (SELECT count(*) FROM customer), 30) t(i)""")
def page_loop(spark, sf_dir):
    """The pages of a loop that stops at a short one."""
    return landed.paged_offsets(spark, table(spark, sf_dir, "customer").count(), 30).withColumn("last", F.col("size") < 30)


@query("""SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def dimension_join(spark, sf_dir):
    """Names of a static dimension by id."""
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey")).select("c_custkey", "n_name", "r_name")


@query("""WITH RECURSIVE e AS (SELECT DISTINCT 'root' AS parent, p_brand AS child FROM part UNION SELECT DISTINCT p_brand, p_brand || '/' || p_size FROM part UNION SELECT p_brand || '/' || p_size, p_partkey::VARCHAR FROM part), t AS (SELECT 'root' AS id, 0 AS depth UNION ALL SELECT child, depth + 1 FROM t JOIN e ON parent = id) SELECT depth, count(*) AS n FROM t GROUP BY depth""")
def vector_tree(spark, sf_dir):
    """A listing of nested groups as rows."""
    p = table(spark, sf_dir, "part")
    size = F.concat_ws("/", "p_brand", F.col("p_size").cast("string"))
    e = p.select(F.lit("root").alias("parent"), F.col("p_brand").alias("child")).unionByName(p.select(F.col("p_brand").alias("parent"), size.alias("child"))).distinct().unionByName(p.select(size.alias("parent"), F.col("p_partkey").cast("string").alias("child")))
    return graph.flatten_tree(e, values(spark, [("root",)], "id string")).groupBy("depth").agg(F.count("*").alias("n"))


@query("""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'archive' ELSE 'live' END AS downloaded_from, CASE WHEN page_id % 3 = 0 THEN length(url) ELSE length(html) END AS size, left(sha1(url), 12) AS short FROM pages""")
def archived_fallback(spark, sf_dir):
    """What is live, else what is archived, and where it is from."""
    k = F.col("page_id")
    live = F.when(k % 3 != 0, F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", F.when(live.isNotNull(), "live").otherwise("archive").alias("downloaded_from"), F.length(F.coalesce(live, F.col("url"))).alias("size"), text.short_hash(F.col("url")).alias("short"))


@query("""SELECT o_orderpriority AS p, '{"rows":' || count(*) || ',"first":"' || strftime(min(o_orderdate), '%Y-%m-%d') || '","last":"' || strftime(max(o_orderdate), '%Y-%m-%d') || '"}' AS value FROM orders GROUP BY 1""")
def manifests(spark, sf_dir):
    """Counts and ranges of each part as JSON text."""
    d = F.date_format
    rows = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("p")).agg(F.count("*").alias("rows"), d(F.min("o_orderdate"), "yyyy-MM-dd").alias("first"), d(F.max("o_orderdate"), "yyyy-MM-dd").alias("last"))
    return rows.select("p", F.to_json(F.struct("rows", "first", "last")).alias("value"))


@query("""SELECT '[' || n_nationkey || ',"' || n_name || '",' || CASE WHEN n_regionkey > 0 THEN n_regionkey::VARCHAR ELSE 'null' END || ']' AS "row", 'k,n,r' AS fields FROM nation""")
def compact_rows(spark, sf_dir):
    """Rows as arrays of JSON values under short codes."""
    n = table(spark, sf_dir, "nation").withColumn("region", F.when(F.col("n_regionkey") > 0, F.col("n_regionkey")))
    return sinks.row_arrays(n, {"n_nationkey": "k", "n_name": "n", "region": "r"}).select("row", F.array_join("fields", ",").alias("fields"))


@query("""SELECT source, round(sum(n_chars) FILTER (lang = 'en') / nullif(sum(n_chars), 0)::DOUBLE, 4) AS ratio FROM documents GROUP BY source""")
def packed_ratios(spark, sf_dir):
    """Packed sizes as a share of raw ones, four decimals."""
    d = table(spark, sf_dir, "documents").groupBy("source").agg(F.sum(F.when(F.col("lang") == "en", F.col("n_chars"))).alias("packed"), F.sum("n_chars").alias("raw"))
    return d.select("source", sinks.compression_ratio(F.col("raw"), F.col("packed")).alias("ratio"))


@query("""SELECT 'c_acctbal' AS "column" UNION ALL SELECT 'c_custkey' UNION ALL SELECT 'c_nationkey'""")
def number_columns(spark, sf_dir):
    """Columns that hold numbers."""
    from ..functions import parse

    c = table(spark, sf_dir, "customer")
    return values(spark, [(n,) for n in parse.numeric_columns(c)], "column string")


@query("""SELECT c_custkey, (SELECT count(*) FROM customer) AS expected FROM customer""")
def counted_layers(spark, sf_dir):
    """Rows with the number that a service's probe told, landed as one answer; another number would fail."""
    c = table(spark, sf_dir, "customer").select("c_custkey")
    c.agg(F.count("*").alias("count")).select(F.to_json(F.struct("count")).alias("value")).write.text(path := scratch_path(spark, "probe"))
    probe = spark.read.text(path).select(F.from_json("value", "count bigint")["count"].alias("expected"))
    return landed.checked_count(c, probe.first()["expected"]).crossJoin(F.broadcast(probe))  # one row


_WORLD = 512 * 4096
_PX = lambda lon: f"floor(({lon} + 180) / 360 * {_WORLD} + 0.5)::BIGINT"
_PY = lambda lat: f"floor((1 - ln(tan(radians({lat})) + 1 / cos(radians({lat}))) / pi()) / 2 * {_WORLD} + 0.5)::BIGINT"


def _through_archive(spark, shapes, properties, layer, schema, tile_units):
    """Shapes cut into tiles of zoom 9, the tiles written as an archive, read again and taken apart."""
    tiles.write_archive(tiles.tiled(shapes, "parts", properties, [9], layer), path := scratch_path(spark, "tiles"), {"name": layer})
    spark.dataSource.register(tiles.TileArchive)
    return tiles.features(spark.read.format("tile_archive").option("path", path).load(), layer, schema, tile_units)


@query(f"""WITH b AS (SELECT s_suppkey AS k, {lon_sql("s_suppkey")} AS x, {lat_sql("s_suppkey")} AS y, (s_suppkey % 5 + 1)::DOUBLE AS w, (s_suppkey % 3 + 1)::DOUBLE AS h FROM supplier),
q AS (SELECT k, {_PX("x")} AS x0, {_PX("x + w")} AS x1, {_PY("y + h")} AS y0, {_PY("y")} AS y1, {_PX("x + w / 4")} AS hx0, {_PX("x + w / 4 + w / 2")} AS hx1, {_PY("y + h / 4 + h / 2")} AS hy0, {_PY("y + h / 4")} AS hy1 FROM b),
t AS (SELECT *, unnest(range(x0 // 4096, (x1 - 1) // 4096 + 1)) AS tx FROM q), u AS (SELECT *, unnest(range(y0 // 4096, (y1 - 1) // 4096 + 1)) AS ty FROM t),
a AS (SELECT k, tx, ty, (least(x1, (tx + 1) * 4096) - greatest(x0, tx * 4096)) * (least(y1, (ty + 1) * 4096) - greatest(y0, ty * 4096)) - greatest(0, least(hx1, (tx + 1) * 4096) - greatest(hx0, tx * 4096)) * greatest(0, least(hy1, (ty + 1) * 4096) - greatest(hy0, ty * 4096)) AS area FROM u)
SELECT k, tx::INT AS tile_x, ty::INT AS tile_y, area::DOUBLE AS area FROM a WHERE area > 0""")
def tiled_areas(spark, sf_dir):
    """Polygons with holes as vector tiles in an archive, and their areas in each tile, in its units, as read."""
    from .geometry_queries import supplier_boxes

    found = _through_archive(spark, supplier_boxes(spark, sf_dir), ["k"], "areas", "k long", True)
    return found.select("k", "tile_x", "tile_y", geo.multipolygon_area(F.col("parts")).alias("area"))


@query(f"""WITH p AS (SELECT c_custkey AS k, c_mktsegment AS segment, CASE WHEN c_acctbal > 0 THEN c_acctbal::DOUBLE END AS balance, {_PX(lon_sql("c_custkey"))} AS px, {_PY(lat_sql("c_custkey"))} AS py FROM customer)
SELECT k, segment, balance, round(px / {_WORLD}::DOUBLE * 360 - 180, 6) AS lon, round(degrees(atan(sinh(pi() * (1 - 2 * py / {_WORLD}::DOUBLE)))), 6) AS lat FROM p WHERE balance IS NOT NULL""")
def tiled_points(spark, sf_dir):
    """Points with properties as vector tiles in an archive; as read, in degrees, those with a finite value."""
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    place = F.array(F.array(F.array(F.struct(lon(k).alias("x"), lat(k).alias("y")))))
    shapes = c.select(k.alias("k"), F.col("c_mktsegment").alias("segment"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal").cast("double")).alias("balance"), place.alias("parts"))
    found = _through_archive(spark, shapes, ["k", "segment", "balance"], "points", "k long, segment string, balance double", False)
    at = F.col("parts")[0][0][0]
    return found.where("balance is not null").select("k", "segment", "balance", F.round(at["x"], 6).alias("lon"), F.round(at["y"], 6).alias("lat"))
