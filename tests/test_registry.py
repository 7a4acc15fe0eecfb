import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from geoloom.plans import queries as plans

DATA = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, bool) or v is None:
        return repr(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}" if v else "0"
    return str(v)


@pytest.fixture(scope="module")
def duck():
    if not Path(DATA).is_dir():
        pytest.skip("no test tables here")
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for p in Path(DATA).glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_query_equals_sql(spark, duck, name):
    df = plans.queries()[name](spark, DATA)
    cols = sorted(df.columns)
    cur = duck.execute(plans.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in cur.fetchall())
    assert sorted(tuple(plain(r[c]) for c in cols) for r in df.collect()) == want


def test_entry(spark):
    if not Path(DATA).is_dir():
        pytest.skip("no test tables here")
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_whole_queries_leave_no_row_out(spark):
    if not Path(DATA).is_dir():
        pytest.skip("no test tables here")
    rows = {n: [tuple(r) for r in spark.read.parquet(f"{DATA}/{n}.parquet").select(*c).collect()] for n, c in {"customer": ["c_custkey", "c_nationkey"], "supplier": ["s_suppkey", "s_nationkey"], "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_returnflag", "l_suppkey", "l_partkey"], "part": ["p_partkey"]}.items()}
    got = {n: [tuple(r) for r in plans.queries()[n](spark, DATA).collect()] for n in ("key_cascade", "pending_work", "edge_route_offsets", "factor_mask_score")}

    same = {k: [s for s, _ in rows["supplier"] if s == k] for k, _ in rows["customer"]}
    want = [(k, tier, t) for k, n in rows["customer"] for near in [[s for s, m in rows["supplier"] if m == n]] for tier, found in [(1, same[k]) if same[k] else (2, near) if near else (None, [None])] for t in found]
    assert sorted(got["key_cascade"], key=str) == sorted(want, key=str)

    done = {k for k, flag, _, _ in rows["lineitem"] if flag == "R"}
    assert sorted(got["pending_work"]) == sorted((k,) for (k,) in rows["orders"] if k not in done)

    edges = {}
    for _, _, s, p in rows["lineitem"]:
        edges.setdefault(p % 50, set()).add(s)
    assert sorted(got["edge_route_offsets"]) == sorted((e, s, len(v), (i - (len(v) - 1) / 2) * 4 if len(v) > 1 else 0.0) for e, v in edges.items() for i, s in enumerate(sorted(v)))

    cells = {(k % 3, 1.5 if k % 2 == 0 else 2.5, r, c) for (k,) in rows["part"] for r in range(30) for c in range(30) if math.hypot(c + 0.5 - k * 7919 % 3000 / 100, r + 0.5 - k * 104729 % 3000 / 100) <= (1.5 if k % 2 == 0 else 2.5)}
    score = {}
    for factor, _, r, c in cells:
        score[r, c] = score.get((r, c), 0) + factor + 1
    assert sorted(got["factor_mask_score"]) == sorted((r, c, n) for (r, c), n in score.items())
