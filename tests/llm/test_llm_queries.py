"""The registered queries on the smallest tables against their SQL, and the pipeline stage by stage."""

import math
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from geoloom.llm import decontaminate, minhash_dedup, pii, queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).is_dir(), reason="no test tables here")


def plain(v):
    return ("nan" if math.isnan(v) else f"{v:.6g}" if v else "0") if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        duck.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
    df = queries.queries()[name](spark, DATA)
    cur = duck.execute(queries.oracle_sql()[name])
    names, cols = [d[0] for d in cur.description], sorted(df.columns)
    assert sorted(names) == cols
    want = sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in cur.fetchall())
    assert sorted(tuple(plain(r[c]) for c in cols) for r in df.collect()) == want


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, kept = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        stage(spark, docs, DATA).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        kept[name] = docs.collect()
        if name == "pack":
            assert {r["doc_id"] for r in kept[name]} == {r["doc_id"] for r in before}
        else:
            assert docs.columns == columns and {r["doc_id"] for r in kept[name]} <= {r["doc_id"] for r in before} and kept[name]
        if name == "minhash_dedup":
            sets = {r["doc_id"]: minhash_dedup.shingles(r["text"], 5) for r in before}
            stay = sorted(r["doc_id"] for r in kept[name])
            near = lambda a, b: sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
            assert not any(near(a, b) for a in stay for b in stay if a < b)
            assert all(any(near(i, j) for j in sets if j != i) for i in set(sets) - set(stay))
        if name == "decontaminate":
            windows = {w for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect() for p in [decontaminate.words_of(r["text"])] for w in {tuple(p[i : i + 10]) for i in range(max(1, len(p) - 9))}}
            sizes = {len(w) for w in windows if w}
            hit = {r["doc_id"] for r in before for w in [decontaminate.words_of(r["text"])] if any(tuple(w[i : i + n]) in windows for n in sizes for i in range(len(w) - n + 1))}
            assert {r["doc_id"] for r in kept[name]} == {r["doc_id"] for r in before} - hit
        if name == "pii":
            assert len(kept[name]) == len(before)
            for r in kept[name]:
                assert r["n_chars"] == len(r["text"] or "") and not pii.entities(r["text"] or "")


def test_pipeline_stages_on_awkward_rows(spark, tmp_path):
    """Nulls in every column, empty and long texts, repeated rows, rows of one id with two texts, an empty table."""
    long = " ".join(f"word{i % 977} and the ring of it" for i in range(6000))
    prose = "the quick thing over there with whether and " * 30
    rows = [(0, None, None, None, None), (1, "", "en", "s", 0), (2, long, "en", None, None), (2, long, "en", None, None), (3, prose, "en", "s", 1), (3, prose + "other words at the end", "en", "s", 1), (3, "was nicht zwischen den wagen über uns " * 20, "de", "s", 1), (None, prose, "en", "s", 1), (5, "mail me@example.org " + prose, None, "s", 3), (6, "!!", "de", "s", 2)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for given in (rows, []):
        docs = spark.createDataFrame(given, schema)
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, DATA)
            out.write.parquet(str(tmp_path / f"{len(given)}-{k}"))
            after = spark.read.parquet(str(tmp_path / f"{len(given)}-{k}"))
            if name == "minhash_dedup" and given:
                assert sum(r["doc_id"] == 2 for r in after.collect()) <= 1 and any(r["doc_id"] is None for r in after.collect()) == any(r["doc_id"] is None for r in docs.collect())
            if name != "pack":
                assert after.columns == docs.columns and after.count() <= docs.count()
            docs = after
        assert given or docs.count() == 0
