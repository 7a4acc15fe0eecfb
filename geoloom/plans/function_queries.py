"""Queries of the text, number and date functions, each over a whole table; texts with the forms in question are put together from keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import dates, parse, text
from .base import query, table


def cycled(k: Column, *given) -> Column:
    """One of the given literals by key."""
    return F.element_at(F.array(*map(F.lit, given)), (k % len(given) + 1).cast("int"))


def quoted(x) -> str:
    return "NULL" if x is None else "'" + x.replace("'", "''") + "'" if isinstance(x, str) else str(x)


def cycled_sql(k: str, *given) -> str:
    return f"[{', '.join(map(quoted, given))}][{k} % {len(given)} + 1]"


def _folded(sql: str, pairs, whole: bool = True) -> str:
    return reduce(lambda x, p: rf"regexp_replace({x}, '\b{p[0]}\b', '{p[1]}', 'g')" if whole else f"replace({x}, '{p[0]}', '{p[1]}')", pairs, sql)


_SLUG = "trim(regexp_replace(lower({}), '[^a-z0-9]+', '-', 'g'), '-')"
_COMPANIES = ("The {} Co. Ltd", "{} & Sons Inc", "{} Canada", "{}", "Company of {} Corp.", "BC {} Limited")


@query(rf"""WITH n AS (SELECT c_custkey, replace({cycled_sql("c_custkey", *_COMPANIES)}, '{{}}', c_mktsegment) AS name FROM customer)
SELECT c_custkey, regexp_replace(regexp_replace(regexp_replace({_SLUG.format("name")}, '\b(ltd|limited|inc|corp|corporation|co|company|the|canada|bc|b-c)\b', '', 'g'), '-+', '-', 'g'), '^-|-$', '', 'g') AS name FROM n""")
def business_names(spark, sf_dir):
    """Names without legal forms."""
    name = F.replace(cycled(F.col("c_custkey"), *_COMPANIES), F.lit("{}"), F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").select("c_custkey", text.business_name(name).alias("name"))


_STREETS = ("{} North Main Street", "#{}, Oak  Avenue East", "{} 5th Road & Highway 97", "Unit {} - West Crescent", "{} Northern Boulevard", "Place {} South Drive")


@query(rf"""WITH a AS (SELECT s_suppkey AS k, replace({cycled_sql("s_suppkey", *_STREETS)}, '{{}}', s_suppkey::VARCHAR) AS raw FROM supplier UNION ALL SELECT c_custkey + 1000000, replace({cycled_sql("c_custkey", *_STREETS)}, '{{}}', c_custkey::VARCHAR) FROM customer)
SELECT k, trim(regexp_replace({_folded("lower(raw)", text.ADDRESS_WORDS)}, '[^a-z0-9]+', ' ', 'g')) AS address FROM a""")
def addresses(spark, sf_dir):
    """Addresses of two tables in one form."""
    raw = lambda k: F.replace(cycled(F.col(k), *_STREETS), F.lit("{}"), F.col(k).cast("string"))
    both = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), raw("s_suppkey").alias("raw"))
    both = both.unionByName(table(spark, sf_dir, "customer").select((F.col("c_custkey") + 1_000_000).alias("k"), raw("c_custkey").alias("raw")))
    return both.select("k", text.address(F.col("raw")).alias("address"))


_CROSSINGS = ("Oak Street & {} Road", "{} Road & OAK STREET & TURNING LANE", "1000 TO 2000 {} Highway & Elm Court", "{}. Frontage Road", "Ash Lane & & {} Place")
_ROADS = ["regexp_replace(upper(raw), '[.#]', '', 'g')", *text.ROAD_WORDS, ("TURNING LN", "TURNING LANE")]


@query(rf"""WITH a AS (SELECT s_suppkey, replace({cycled_sql("s_suppkey", *_CROSSINGS)}, '{{}}', s_name) AS raw FROM supplier)
SELECT s_suppkey, array_to_string(list_sort(list_filter(list_transform(string_split({_folded(_ROADS[0], _ROADS[1:])}, '&'), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x NOT IN ('', 'TURNING LANE') AND NOT regexp_matches(x, '[0-9]{{4,}}\s+TO\s+[0-9]{{4,}}'))), '|') AS parts FROM a""")
def crossing_parts(spark, sf_dir):
    """Road names of crossings, sorted."""
    raw = F.replace(cycled(F.col("s_suppkey"), *_CROSSINGS), F.lit("{}"), F.col("s_name"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.array_join(text.intersection_parts(raw), "|").alias("parts"))


_LINKS = (" http://a.org/x/{}.html?q=1", "//b.org:443/p/{}", "/pages/{}-a.pdf", "sub/{}", "HTTPS://c.org:80/{}/", "https://d.org:8080/{}")
_FULL = "CASE WHEN regexp_matches(t, '(?i)^https?://') THEN t WHEN starts_with(t, '//') THEN 'https:' || t WHEN starts_with(t, '/') THEN 'https://base.org' || t ELSE 'https://base.org/dir/' || t END"


@query(rf"""WITH l AS (SELECT page_id, trim(replace({cycled_sql("page_id", *_LINKS)}, '{{}}', page_id::VARCHAR)) AS t FROM pages),
u AS (SELECT page_id, regexp_replace(regexp_replace({_FULL}, '(?i)^http://', 'https://'), '^(https://[^/:]+):(80|443)(/|$)', '\1\3') AS url FROM l)
SELECT page_id, url, regexp_replace(regexp_replace(regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)/?$', 1), '\.[^.]*$', ''), '[^A-Za-z0-9]+', '_', 'g') AS stem FROM u""")
def page_links(spark, sf_dir):
    """Addresses in one form, and the ids they give."""
    link = F.replace(cycled(F.col("page_id"), *_LINKS), F.lit("{}"), F.col("page_id").cast("string"))
    urls = table(spark, sf_dir, "pages").select("page_id", text.absolute_url(link, "https://base.org/dir/").alias("url"))
    return urls.select("page_id", "url", text.url_stem(F.col("url")).alias("stem"))


@query(r"""SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1) AS title, len(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS links, array_to_string(regexp_extract_all(html, 'href="([^"]+)"', 1), ' ') AS targets FROM pages""")
def page_matches(spark, sf_dir):
    """The first group of a pattern, and all matches of another."""
    found = text.all_matches(F.col("html"), 'href="([^"]+)"', 1)
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title"), F.size(found).cast("long").alias("links"), F.array_join(found, " ").alias("targets"))


@query(r"""WITH m AS (SELECT doc_id, regexp_extract_all(text, '(?s).{0,20}@.{0,20}') AS found FROM documents) SELECT doc_id, len(found) AS n, array_to_string(found, '#') AS found FROM m WHERE len(found) > 0""")
def match_contexts(spark, sf_dir):
    """Matches with what stands around them."""
    found = table(spark, sf_dir, "documents").select("doc_id", text.contexts(F.col("text"), "@", 20).alias("found"))
    return found.where(F.size("found") > 0).select("doc_id", F.size("found").cast("long").alias("n"), F.array_join("found", "#").alias("found"))


_TITLES = ("Flood Watch ended for {}, {} River and Lower {}", "{} Advisory: {} including Upper {}.", "High Streamflow Advisory maintained ({}; the {} and X)")


@query(rf"""WITH t AS (SELECT o_orderkey, replace({cycled_sql("o_orderkey", *_TITLES)}, '{{}}', o_orderpriority) AS t FROM orders)
SELECT o_orderkey, array_to_string(list_sort(list_distinct(list_filter(list_transform(string_split_regex(regexp_replace(lower(t), '\b(flood|watch|advisory|ended|maintained|high|streamflow|for|the)\b', ' ', 'g'), '[,;:.()]|\band\b|\bincluding\b'), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: length(x) >= 3))), '|') AS areas FROM t""")
def area_names(spark, sf_dir):
    """Names in a list written as prose, each once."""
    t = F.replace(cycled(F.col("o_orderkey"), *_TITLES), F.lit("{}"), F.col("o_orderpriority"))
    stop = ("flood", "watch", "advisory", "ended", "maintained", "high", "streamflow", "for", "the")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(F.array_sort(text.named_areas(t, stop)), "|").alias("areas"))


@query("""SELECT doc_id, coalesce(nullif(trim(CASE WHEN doc_id % 3 = 0 THEN source WHEN doc_id % 3 = 1 THEN ' ' END), ''), nullif(trim(CASE WHEN contains(t, 'ISSUED') THEN string_split(t, 'ISSUED')[1] END), ''), nullif(trim(left(t, 30)), '')) AS title FROM (SELECT doc_id, source, CASE WHEN doc_id % 2 = 0 THEN lang || ' ISSUED ' || text ELSE text END AS t FROM documents)""")
def titles(spark, sf_dir):
    """A hint, what stands before a marker, or the first characters."""
    k = F.col("doc_id")
    hint = F.when(k % 3 == 0, F.col("source")).when(k % 3 == 1, " ")
    body = F.when(k % 2 == 0, F.concat("lang", F.lit(" ISSUED "), "text")).otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", hint.alias("h"), body.alias("t")).select("doc_id", text.title(F.col("h"), F.col("t"), limit=30).alias("title"))


_PARCELS = ("Vacant Residential Less Than 2 Acres", "Strata-Lot Residence (Condominium)", "2 STY house - Standard", "MH - In MH Park", "Office Building", "Gas Station & Car Wash", "Storage & Warehousing (Open)", "Sawmill", "Works Yards", "Churches & Bible Schools", "Hospitals", "Grain Farm", "Parking Lot", None)
_PARCEL_SQL = " ".join(f"WHEN {' OR '.join(f'contains(d, {quoted(w)})' for w in words)} THEN {quoted(k)}" for k, words in text.PARCEL_CLASSES)


@query(f"""WITH p AS (SELECT p_partkey, lower(coalesce({cycled_sql("p_partkey", *_PARCELS)}, '')) AS d FROM part) SELECT p_partkey, CASE {_PARCEL_SQL} ELSE 'other' END AS class FROM p""")
def parcel_classes(spark, sf_dir):
    """The first class one of whose words is in a description."""
    return table(spark, sf_dir, "part").select("p_partkey", text.keyword_class(cycled(F.col("p_partkey"), *_PARCELS), text.PARCEL_CLASSES).alias("class"))


_TRADES = (
    ("Bob's Plumbing", "Contractor - plumbing", "Out of Town"), ("Green Grocery", "food sales", "Commercial Retail"), ("Corner", "Convenience Store", "Commercial"), ("Acme", "misc", "Banks and other Financial"),
    ("Acme", "truck repair", "Service"), ("Acme", None, "Warehousing"), (None, None, None), ("Farmers Market", "produce", "Home Business"), ("Xerox Cafeteria", "Office", "Other"), ("Delicious", "hotel rooms", "Lodging"),
)
_BUSINESS_SQL = " ".join(f"WHEN {' OR '.join(f'regexp_matches({c}, {quoted(p)})' for c, p in patterns.items())} THEN {quoted(f'{k},{h},{r},{s}'.lower())}" for k, patterns, h, r, s in text.BUSINESS_CLASSES)


@query(f"""WITH r AS (SELECT c_custkey AS k, {", ".join(f"lower(coalesce({cycled_sql('c_custkey', *(t[i] for t in _TRADES))}, '')) AS {n}" for i, n in enumerate(("name", "description", "category")))} FROM customer), t AS (SELECT *, name || ' ' || description || ' ' || category AS text FROM r)
SELECT k, CASE {_BUSINESS_SQL} ELSE 'unclassified_business,false,false,low' END AS class FROM t""")
def business_classes(spark, sf_dir):
    """T16 (licences), F17: the first class whose pattern fits one of three columns."""
    k = F.col("c_custkey")
    found = text.business_class(*(cycled(k, *(t[i] for t in _TRADES)) for i in range(3)))
    return table(spark, sf_dir, "customer").select(k.alias("k"), found.alias("c")).select("k", F.concat_ws(",", *(F.col(f"c.{f}").cast("string") for f in ("category", "healthy_food", "retail_services", "confidence"))).alias("class"))


_TAGS = (("shop", "supermarket"), ("shop", "bakery"), ("amenity", "marketplace"), ("amenity", "cafe"), ("craft", "carpenter"), ("office", "lawyer"), ("amenity", "bench"), ("shop", "books"), ("natural", "tree"))
_POINT_SQL = " ".join(f"WHEN {' OR '.join(f't = {quoted(t)}' + ('' if v is None else f' AND v IN ({', '.join(map(quoted, v))})') for t, v in wanted.items())} THEN {quoted(f'{k},{h},{r},{s}'.lower())}" for k, wanted, h, r, s in text.POINT_CLASSES)


@query(f"""WITH r AS (SELECT s_suppkey AS k, {cycled_sql("s_suppkey", *(t for t, _ in _TAGS))} AS t, {cycled_sql("s_suppkey", *(v for _, v in _TAGS))} AS v FROM supplier), c AS (SELECT CASE {_POINT_SQL} ELSE 'unclassified_osm_poi,false,false,low' END AS class FROM r)
SELECT class, count(*) AS n FROM c GROUP BY class""")
def point_classes(spark, sf_dir):
    """T16 (map points), S08: classes of points by their tags."""
    k = F.col("s_suppkey")
    tags = F.create_map(cycled(k, *(t for t, _ in _TAGS)), cycled(k, *(v for _, v in _TAGS)))
    c = text.point_class(tags)
    classed = table(spark, sf_dir, "supplier").select(F.concat_ws(",", *(c[f].cast("string") for f in ("category", "healthy_food", "retail_services", "confidence"))).alias("class"))
    return classed.groupBy("class").agg(F.count("*").alias("n"))


_DATASETS = ("no2lur_a", "pm25dal__x_", "wtwbm_ava", "wtutv_1", "dtr_avg", "grlan_lsat", "ale_can", "nhx", "aqfpm", "grump_x", "zz_other", "o3chg_8h", "wtlstx")
_FAMILY_SQL = " ".join(f"WHEN regexp_matches(d, '^({'|'.join(p)})') THEN {quoted(k)}" for k, p in text.FAMILIES)
_LABEL_SQL = " ".join(f"WHEN starts_with(d, {quoted(p)}) THEN trim({quoted(label)} || ' ' || trim(substr(d, {len(p) + 1}), '_'))" for p, label in text.DATASET_LABELS)


@query(f"""WITH d AS (SELECT p_partkey, {cycled_sql("p_partkey", *_DATASETS)} AS d FROM part) SELECT p_partkey, CASE {_FAMILY_SQL} ELSE 'other' END AS family, CASE {_LABEL_SQL} ELSE upper(replace(d, '_', ' ')) END AS label FROM d""")
def dataset_families(spark, sf_dir):
    """Families and labels of datasets by their prefixes."""
    d = cycled(F.col("p_partkey"), *_DATASETS)
    return table(spark, sf_dir, "part").select("p_partkey", text.prefix_family(d).alias("family"), text.dataset_label(d).alias("label"))


_RAW = ("12 Elm  St", "Unit 4, 77 Oak Ave V2K 1A1", "3-450 Ash Rd", "#9 Pine Ct", "100 Main St v2n4b5")


@query(rf"""WITH r AS (SELECT s_suppkey AS k, trim(regexp_replace({cycled_sql("s_suppkey", *_RAW)}, '\s+', ' ', 'g')) AS t FROM supplier),
l AS (SELECT k, [t, t || ', BC, Canada', t || ', Town, BC', CASE WHEN regexp_matches(t, '^[0-9]+\s*-\s*[0-9]') THEN regexp_replace(t, '^[0-9]+\s*-\s*', '') ELSE regexp_replace(t, '(?i)^(?:unit|suite|#)\s*[0-9a-z]+[,\s-]+', '') END, trim(regexp_replace(t, '(?i)[, ]*[a-z][0-9][a-z] ?[0-9][a-z][0-9]', ''))] AS l FROM r)
SELECT k, query, (row_number() OVER (PARTITION BY k ORDER BY min(i)) - 1)::INT AS i FROM (SELECT k, unnest(l) AS query, generate_subscripts(l, 1) AS i FROM l) WHERE query <> '' GROUP BY k, query""")
def query_candidates(spark, sf_dir):
    """Queries to try for an address, in order, each once."""
    found = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), text.address_candidates(cycled(F.col("s_suppkey"), *_RAW), "Town", "BC", "Canada").alias("l"))
    return found.select("k", F.posexplode("l").alias("i", "query"))


_TEXTS = ("Released", "", "  ", None)


@query(f"""SELECT c_custkey, concat_ws(' · ', nullif(trim(c_mktsegment), ''), nullif(trim({cycled_sql("c_custkey", *_TEXTS)}), ''), c_name) AS label, coalesce(trim({cycled_sql("c_custkey", *_TEXTS)}), '') AS blank, coalesce(nullif(trim({cycled_sql("c_custkey", *_TEXTS)}), ''), nullif(trim(c_mktsegment), '')) AS first FROM customer""")
def labels_and_blanks(spark, sf_dir):
    """Labels of the parts that are not blank, blanks for nulls, the first that is present."""
    x, seg = cycled(F.col("c_custkey"), *_TEXTS), F.col("c_mktsegment")
    return table(spark, sf_dir, "customer").select("c_custkey", text.joined(" · ", seg, x, F.col("c_name")).alias("label"), parse.null_to_blank(x).alias("blank"), parse.first_present(x, seg).alias("first"))


_FILES = ("/a/no2lur_a_2024-01-31_09-05-00_monthly.zip", "/a/b/GRLAN_AVA_2020-01-01_12-00-00_ANNUAL.zip", "/a/nhacs_ava_2026-05-07_20-31-54_annual.zip", "/x/wtutv.zip", "/x/cbm_monthly.zip", "/x/._dtr_mly_2026-05-07_20-31-54_annual.zip", "/a/aqfpm_01_2026-01-02_03-04-05_annual.zip")


@query(rf"""WITH f AS (SELECT p_partkey AS k, {cycled_sql("p_partkey", *_FILES)} AS path FROM part), n AS (SELECT k, path, string_split(path, '/')[-1] AS name FROM f)
SELECT k, regexp_replace(regexp_replace(name, '\.zip$', ''), '_\d{{4}}-\d{{2}}-\d{{2}}_\d{{2}}-\d{{2}}-\d{{2}}_(annual|monthly)$', '', 'i') AS dataset, coalesce(nullif(lower(regexp_extract(name, '_(annual|monthly)\.zip$', 1, 'i')), ''), 'annual') AS cadence, regexp_matches(path, '^/a/.*\.zip$') AS wanted, regexp_replace(string_split(name, '_')[1], '[0-9]|\.zip$', '', 'g') AS prefix FROM n WHERE NOT starts_with(name, '._')""")
def archive_names(spark, sf_dir):
    """Datasets and cadences from file names, by a glob, without side-car files."""
    f = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), cycled(F.col("p_partkey"), *_FILES).alias("path")).where(~F.element_at(F.split("path", "/"), -1).startswith("._"))
    name = text.archive_name(F.col("path"))
    return f.select("k", name["dataset"].alias("dataset"), name["cadence"].alias("cadence"), F.col("path").rlike(text.glob_regex("/a/*.zip")).alias("wanted"), text.variable_prefix(name["dataset"]).alias("prefix"))


@query("""WITH b AS (SELECT doc_id, n_chars * (doc_id % 7 + 1) ** 9 AS b FROM documents) SELECT doc_id, CASE WHEN b >= 1024 ** 4 THEN printf('%.2f TB', floor(b / 1024 ** 4 * 100 + 0.5) / 100) WHEN b >= 1024 ** 3 THEN printf('%.2f GB', floor(b / 1024 ** 3 * 100 + 0.5) / 100) WHEN b >= 1024 ** 2 THEN printf('%.1f MB', floor(b / 1024 ** 2 * 10 + 0.5) / 10) WHEN b >= 1024 THEN printf('%.1f KB', floor(b / 1024 * 10 + 0.5) / 10) ELSE format('{} B', b::BIGINT) END AS size FROM b""")
def byte_sizes(spark, sf_dir):
    """Sizes as people read them."""
    b = F.col("n_chars") * F.pow(F.col("doc_id") % 7 + 1, F.lit(9.0))
    return table(spark, sf_dir, "documents").select("doc_id", text.byte_size(b).alias("size"))


_MARKS = ("Number of critical violations", "Number of Non-Critical violations", "Inspection date")


@query(f"""SELECT CASE WHEN contains(l, 'non-critical violations') THEN 'non_critical' WHEN contains(l, 'critical violations') THEN 'critical' END AS kind, sum(turn)::BIGINT AS n FROM (SELECT turn, lower({cycled_sql("conv_id", *_MARKS)}) AS l FROM conversations) GROUP BY 1""")
def violation_kinds(spark, sf_dir):
    """Values by a label that may hold another's name."""
    c = table(spark, sf_dir, "conversations").select("turn", text.violation_kind(cycled(F.col("conv_id"), *_MARKS)).alias("kind"))
    return c.groupBy("kind").agg(F.sum("turn").alias("n"))


_NUMBERS = ("", " 7.5 ", "x", "1,234.5 ha", "-9999.0", "NULL", "$1,200.75", None, "NaN", "3e2", "F", "-12")
_LEADING = r"nullif(regexp_extract(replace(s, ',', ''), '^\s*([-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?)', 1), '')"
_DOUBLE = "CASE WHEN isfinite(try_cast({0} AS DOUBLE)) THEN try_cast({0} AS DOUBLE) END"


@query(rf"""WITH n AS (SELECT o_orderkey AS k, {cycled_sql("o_orderkey", *_NUMBERS)} AS s FROM orders)
SELECT k, CASE WHEN trim(s) = '' THEN 0.0 ELSE {_DOUBLE.format("trim(s)")} END AS js, {_DOUBLE.format(_LEADING)} AS lead,
CASE WHEN trim(s) NOT IN ('', 'NULL', '-9999', '-9999.0', '-9999.00') THEN {_DOUBLE.format("trim(s)")} END AS sentinel, CAST(trunc({_DOUBLE.format("regexp_replace(trim(s), '[$,]', '', 'g')")}) AS BIGINT) AS money,
CASE WHEN trim(s) NOT IN ('', 'x', 'F') THEN round_even({_DOUBLE.format("replace(trim(s), ',', '')")}, 2) END AS census FROM n""")
def parsed_numbers(spark, sf_dir):
    """The dialects of numbers in texts."""
    s = cycled(F.col("o_orderkey"), *_NUMBERS)
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), parse.js_number(s).alias("js"), parse.comma_number(s).alias("lead"), parse.sentinel_number(s).alias("sentinel"), parse.money_int(s).alias("money"), parse.census_value(s).alias("census"))


@query(f"""WITH n AS (SELECT o_orderkey AS k, {cycled_sql("o_orderkey", "", None, "x", "4")} AS a, {cycled_sql("o_orderkey // 4", "9", None)} AS b FROM orders)
SELECT k, coalesce(CASE WHEN trim(a) = '' THEN 0.0 ELSE try_cast(a AS DOUBLE) END, CASE WHEN trim(b) = '' THEN 0.0 ELSE try_cast(b AS DOUBLE) END) AS value FROM n""")
def alias_numbers(spark, sf_dir):
    """The first number under several names, whatever their case."""
    k = F.col("o_orderkey")
    df = table(spark, sf_dir, "orders").select(k.alias("k"), cycled(k, "", None, "x", "4").alias("Value_2021"), cycled(F.floor(k / 4).cast("long"), "9", None).alias("SCORE"))
    columns = [parse.find_column(df, "value_2021", "value"), parse.find_column(df, "missing", "score")]
    return df.select("k", parse.first_number(*columns).alias("value"))


@query("""SELECT o_orderkey, CASE WHEN l IS NULL THEN 'grey' ELSE ['white', 'yellow', 'tan', 'orange', 'red', 'brown'][l + 1] END AS colour FROM (SELECT o_orderkey, try_cast(nullif(regexp_extract(o_orderpriority, '[0-5]', 0), '') AS INT) AS l FROM orders)""")
def level_colours(spark, sf_dir):
    """Colours of levels."""
    colours = dict(enumerate(("white", "yellow", "tan", "orange", "red", "brown")))
    return table(spark, sf_dir, "orders").select("o_orderkey", parse.level_colour(parse.first_level(F.col("o_orderpriority")), colours, "grey").alias("colour"))


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE NULL END AS iso, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 2 THEN 'spring' ELSE NULL END AS parsed FROM orders""")
def dates_of_forms(spark, sf_dir):
    """Milliseconds and texts of several forms as dates, other texts as they are."""
    k, d = F.col("o_orderkey") % 4, F.col("o_orderdate").cast("timestamp")
    stamp = F.when(k == 0, F.unix_millis(d).cast("string")).when(k == 1, F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss")).when(k == 2, "none")
    written = F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "M/d/yyyy")).when(k == 2, " spring ")
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.iso_date(stamp).alias("iso"), dates.parse_date(written).alias("parsed"))


_LOCAL = "date_trunc('minute', o_orderdate + INTERVAL (o_orderkey % 1440) MINUTE)"


@query(f"""WITH t AS (SELECT o_orderkey, CASE o_orderkey % 7 WHEN 5 THEN date_trunc('day', o_orderdate) WHEN 6 THEN NULL ELSE {_LOCAL} END AS t FROM orders)
SELECT o_orderkey, strftime(t, '%Y-%m-%d %H:%M') AS "local", year(t) AS year FROM t""")
def bulletin_times(spark, sf_dir):
    """Times of bulletins in five written forms, else from the file's name."""
    k = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("timestamp")
    t = F.date_trunc("minute", F.timestamp_seconds(F.unix_seconds(day) + (k % 1440) * 60))
    form = lambda f: F.date_format(t, f)
    body = F.when(k % 7 == 0, F.concat(F.lit("ISSUED: "), form("h:mm a EEEE, MMMM d, yyyy"))).when(k % 7 == 1, F.concat(F.lit("Issued "), form("MMM d, yyyy"), F.lit(" at "), form("h:mm a"))).when(k % 7 == 2, form("'ISSUED' MMMM d, yyyy HH:mm")).when(k % 7 == 3, form("yyyy-MM-dd HH:mm 'x'"))
    name = F.when(k % 7 == 4, form("'b-'yyyyMMdd'-'HHmm'.pdf'")).when(k % 7 == 5, F.date_format(day, "'b_'yyyy'_'MM'_'dd'.html'")).otherwise("b.pdf")
    found = dates.bulletin_time(F.coalesce(body, F.lit("none")), name)
    return table(spark, sf_dir, "orders").select("o_orderkey", found["local"].alias("local"), found["year"].alias("year"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'undated' ELSE 'instant' END AS "precision", CASE WHEN o_orderkey % 5 <> 0 THEN strftime(o_orderdate, '%Y') END AS bucket_year, CASE WHEN o_orderkey % 5 <> 0 THEN strftime(o_orderdate, '%Y-%m') END AS bucket_month, CASE WHEN o_orderkey % 5 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS bucket_day, CASE o_orderkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE 3 END AS severity FROM orders""")
def timelines(spark, sf_dir):
    """Precision, buckets and the severest level."""
    k = F.col("o_orderkey")
    ts = F.when(k % 5 != 0, F.col("o_orderdate").cast("timestamp"))
    levels = F.when(k % 3 == 0, F.array().cast("array<string>")).when(k % 3 == 1, F.array(F.lit("watch"), F.lit("other"))).otherwise(F.array(F.lit("advisory"), F.lit("warning")))
    return table(spark, sf_dir, "orders").select("o_orderkey", *dates.timeline(ts), dates.severity_rank(levels, {"advisory": 1, "watch": 2, "warning": 3}).alias("severity"))


@query("""SELECT o_orderpriority, least(min(o_orderdate), min(l_shipdate)) AS date_min, greatest(max(o_orderdate), max(l_shipdate)) AS date_max FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""")
def date_ranges(spark, sf_dir):
    """The range of two columns of dates together."""
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    return o.join(li, F.col("l_orderkey") == F.col("o_orderkey"), "left").groupBy("o_orderpriority").agg(*dates.date_range(F.col("o_orderdate"), F.col("l_shipdate")))


@query("""SELECT y AS year, count(o_orderkey) AS n FROM range(1992, 2001) t(y) LEFT JOIN orders ON year(o_orderdate) = y GROUP BY y""")
def years_filled(spark, sf_dir):
    """Orders of each of a range of years, also where there are none."""
    years = spark.range(1).select(F.explode(dates.years(1992, 2000)).alias("year"))
    counted = table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"))
    return years.join(counted, "year", "left").select("year", F.coalesce("n", F.lit(0)).alias("n"))
