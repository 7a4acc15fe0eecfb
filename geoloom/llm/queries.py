"""The registered queries of the training-data operators, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .conversation_repair import damaged, repair_report
from .decontaminate import WINDOW, contamination_digest
from .ego_join import embedding_duplicates
from .hilbert_shards import hilbert_shards
from .language_id import language_digest
from .lexical_search import ranked_search
from .license_scan import COPYRIGHT_LINE, HOLDER_LENGTH, HOLDER_START, HOLDER_WORD, NOTICES, PUNCTUATION, SPELLINGS, license_scan
from .minhash_dedup import near_duplicates
from .pack import best_fit_pack
from .phrase_dedup import repeated_phrase_digest
from .pii import personal_data_digest
from .pivot_search import top_products
from .quality_fm import quality_digest


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_digest(_table(spark, sf_dir, "documents"))


def op3_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data_digest(_table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), size=2, percent=80)


def op7_ego_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_duplicates(_table(spark, sf_dir, "embeddings"))


def op8_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_phrase_digest(_table(spark, sf_dir, "documents"))


def op9_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards(_table(spark, sf_dir, "documents"))


def op10_best_fit_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_pack(_table(spark, sf_dir, "documents"), keep_ids=False)


def op11_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(_table(spark, sf_dir, "embeddings"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations")
    return repair_report(damaged(conversations), conversations)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def queries() -> dict:
    return {k: v for k, v in globals().items() if k.startswith("op")}


def _text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _license_sql() -> str:
    holder = rf"{HOLDER_START}[ \t\r]*({HOLDER_WORD})([ \t\r]+({HOLDER_WORD}))*[ \t\r]*$"
    low = "translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = f"concat(' ', regexp_replace(CASE WHEN regexp_matches({low}, {_text(COPYRIGHT_LINE)}) OR (length(x) <= {HOLDER_LENGTH} AND regexp_matches(x, {_text(holder)})) THEN '' ELSE {low} END, {_text(PUNCTUATION)}, ' ', 'g'), ' ')"
    for old, new in SPELLINGS:
        words = f"replace({words}, ' {old} ', ' {new} ')"
    canon = f"list_filter(list_transform(string_split(coalesce(t, ''), chr(10)), lambda x: trim(regexp_replace({words}, ' +', ' ', 'g'))), lambda y: y <> '')"
    known = ", ".join(f"({_text(k)}, {_text(v)})" for k, v in NOTICES)
    return f"""
WITH known AS (SELECT sha256(array_to_string({canon}, ' ')) AS digest, min(license_id) AS license_id FROM (VALUES {known}) v(license_id, t) GROUP BY 1),
docs AS (SELECT row_number() OVER () AS r, doc_id, {canon} AS lines FROM (SELECT doc_id, text AS t FROM documents)),
line_hits AS (SELECT r, list_sort(list_distinct(list(license_id))) AS ids, count(*) AS n FROM (SELECT r, sha256(unnest(lines)) AS digest FROM docs) JOIN known USING (digest) GROUP BY r),
whole AS (SELECT r, doc_id, sha256(array_to_string(lines, ' ')) AS digest FROM docs)
SELECT doc_id, whole.digest, known.license_id, coalesce(ids, []::VARCHAR[]) AS line_license_ids, coalesce(n, 0) AS n_license_lines
FROM whole LEFT JOIN known ON whole.digest = known.digest LEFT JOIN line_hits USING (r)"""


_WORDS = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

_DECONTAMINATE_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, array_to_string(w[i + 1 : i + {WINDOW}], ' ') AS p FROM (SELECT item_id, w, unnest(range(0, greatest(1, len(w) - {WINDOW - 1}))) AS i FROM b WHERE len(w) > 0)),
o AS (SELECT doc_id, i, n, array_to_string(w[i + 1 : i + n], ' ') AS p FROM (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS i FROM d, (SELECT DISTINCT n FROM p) WHERE len(w) >= n)),
h AS (SELECT doc_id, i, n, item_id FROM o JOIN p USING (n, p)),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM h) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM h) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""

_MINHASH_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i + 1 : i + 2], ' ') AS g FROM (SELECT doc_id, w, unnest(range(0, greatest(1, len(w) - 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
r AS (SELECT doc_id, doc_id AS c FROM d UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id),
m AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, component_id = d.doc_id AS kept FROM d LEFT JOIN n USING (doc_id) JOIN m USING (doc_id)"""

_EGO_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
u AS (SELECT * FROM v WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_sum(list_transform(e, lambda x: x * x)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id, vec_id AS c FROM v UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.vec_id),
m AS (SELECT vec_id, min(c) AS component_id FROM r GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, component_id = vec_id AS kept FROM m LEFT JOIN n USING (vec_id)"""

_PHRASE_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, i, array_to_string(w[i + 1 : i + 50], ' ') AS p FROM (SELECT doc_id, w, unnest(range(0, len(w) - 49)) AS i FROM d WHERE len(w) >= 50)),
f AS (SELECT p, min(doc_id) AS first FROM s GROUP BY p),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM s JOIN f USING (p) WHERE first < doc_id),
k AS (SELECT doc_id, unnest(range(0, len(w))) AS i, unnest(w) AS x FROM d),
t AS (SELECT k.doc_id, count(*) FILTER (g.i IS NOT NULL) AS n_removed, string_agg(x, ' ' ORDER BY k.i) FILTER (g.i IS NULL) AS kept FROM k LEFT JOIN g ON g.doc_id = k.doc_id AND g.i = k.i GROUP BY k.doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN t USING (doc_id)"""


_PIVOT_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)) AS e FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""

_LEXICAL_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_distinct(list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS w FROM benchmark),
i AS (SELECT item_id, unnest(w) AS t FROM b),
k AS (SELECT count(*) FILTER (len(w) > 0) AS n, sum(len(w))::BIGINT AS l FROM d),
p AS (SELECT doc_id, t, count(*) AS tf, any_value(n) AS n FROM (SELECT doc_id, len(w) AS n, unnest(w) AS t FROM d) GROUP BY doc_id, t),
f AS (SELECT t, floor(1000 * ln((2 * n + 2) / (2 * df + 1)))::BIGINT AS w FROM (SELECT t, count(*) AS df FROM p GROUP BY t), k),
s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * p.n * k.n) // k.l))))::BIGINT AS score FROM p JOIN f USING (t) JOIN i USING (t), k GROUP BY item_id, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10"""


def _repair_sql() -> str:
    """The programme with its audits as plain strings, a turn a step; then the audit is replayed. States 1 to 4: nothing, s, u, a."""
    turn, white, steps = (3, 3, 4, 3), "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)", {k: [] for k in range(1, 5)}
    for parent in range(1, 5):
        state = parent
        for k in range(3):
            run = "I" * k
            steps[state].append((parent, 5 * k + 2, run + "D", "true"))
            steps[turn[state - 1]].append((parent, 5 * k + 1, run + "R", "f NOT IN ('blank', 'duplicate')"))
            for initial, to in {1: [("s", 2), ("u", 3)], 2: [("u", 3)], 3: [("a", 4)], 4: [("u", 3)]}[state]:
                steps[to].append((parent, 5 * k, run + "K", f"f NOT IN ('blank', 'duplicate') AND c = '{initial}'"))
            state = turn[state - 1]
    cut = "CASE WHEN f = 'truncated' THEN 5 ELSE 0 END"
    paid = lambda edit: "" if edit[-1] == "D" else f" + {cut}"
    least = lambda options: "list_min(list_filter([" + ", ".join(f"CASE WHEN l[{p}] IS NOT NULL AND {when} THEN {{'k': l[{p}].k + {cost}{paid(edit)}, 'a': l[{p}].a || '{edit}'}} END" for p, cost, edit, when in options) + "], lambda x: x IS NOT NULL))"
    ends = ", ".join(f"CASE WHEN l[{p}] IS NOT NULL THEN {{'k': l[{p}].k + {5 * k}, 'a': l[{p}].a || '{'I' * k}'}} END" for p, k in ((1, 0), (1, 2), (2, 2), (3, 1), (4, 0), (4, 2)))
    key = "concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' '))"
    # The reflected polynomial, a bit a step.
    bits = f"flatten(list_transform(string_split({key}, ''), lambda y: list_transform(range(8), lambda j: (ascii(y)::BIGINT >> j) & 1)))"
    crc = f"xor(list_reduce(list_concat([4294967295::BIGINT], {bits}), lambda r, y: xor(r >> 1, 3988292384 * (xor(r, y) & 1))), 4294967295)"
    return f"""
WITH RECURSIVE o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc} % 20 AS x FROM conversations),
g AS (SELECT conv_id, turn, CASE WHEN x = 4 THEN 'user' ELSE role END AS role, CASE WHEN x = 1 THEN '' WHEN x = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN x = 3 THEN 2 ELSE 1 END)) AS copy FROM o WHERE x <> 0),
e AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen, rtrim(text, {white}) AS z FROM g),
t AS (SELECT conv_id, turn, role, text, i, left(role, 1) AS c, CASE WHEN z = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN right(z, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS f FROM e),
h AS (SELECT conv_id, role, i, coalesce(lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) NOT IN ('su', 'ua', 'au'), false) AS bad FROM t),
n AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (f = 'blank') AS blank, count(*) FILTER (f = 'duplicate') AS duplicate, count(*) FILTER (f = 'truncated') AS truncated, max(i) AS m FROM t GROUP BY conv_id),
q AS (SELECT conv_id, 0::BIGINT AS i, [{{'k': 0, 'a': ''}}, NULL, NULL, NULL] AS l FROM n UNION ALL SELECT q.conv_id, t.i, [{", ".join(least(steps[k]) for k in range(1, 5))}] FROM q JOIN t ON t.conv_id IS NOT DISTINCT FROM q.conv_id AND t.i = q.i + 1),
b AS (SELECT conv_id, list_min(list_filter([{ends}], lambda x: x IS NOT NULL)) AS b FROM q JOIN n USING (conv_id) WHERE q.i = n.m),
w AS (SELECT conv_id, b.k AS cost, b.a AS audit, unnest(string_split(b.a, '')) AS edit, unnest(range(len(b.a))) AS j FROM b),
y AS (SELECT *, count(*) FILTER (edit <> 'I') OVER (PARTITION BY conv_id ORDER BY j) AS i FROM w WHERE edit <> ''),
u AS (SELECT y.conv_id, j, edit, role, text, count(*) OVER (PARTITION BY y.conv_id ORDER BY j) AS place, max(CASE WHEN edit = 'K' AND left(role, 1) = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY y.conv_id) AS led FROM y LEFT JOIN t ON t.conv_id = y.conv_id AND t.i = y.i AND edit <> 'I' WHERE edit <> 'D'),
v AS (SELECT conv_id, string_agg(concat(CASE WHEN edit = 'K' THEN role WHEN (place - led) % 2 = 1 THEN 'user' ELSE 'assistant' END, ':', CASE WHEN edit = 'I' THEN '' ELSE text END), chr(10) ORDER BY j) AS whole FROM u GROUP BY conv_id)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.k, 0)::BIGINT AS cost, coalesce(b.a, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN n USING (conv_id) LEFT JOIN (SELECT conv_id, count(*) FILTER (bad) AS illegal FROM h GROUP BY conv_id) USING (conv_id) LEFT JOIN b USING (conv_id) LEFT JOIN v USING (conv_id)"""


def oracle_sql() -> dict[str, str]:
    return {"op1_license_scan": _license_sql(), "op5_decontaminate": _DECONTAMINATE_SQL, "op6_minhash_dedup": _MINHASH_SQL, "op7_ego_join": _EGO_SQL, "op8_phrase_dedup": _PHRASE_SQL, "op11_pivot_search": _PIVOT_SQL, "op12_conversation_repair": _repair_sql(), "op13_lexical_search": _LEXICAL_SQL}
