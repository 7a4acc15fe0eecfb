"""Exact search, repair of conversations and lexical search against brute force, and on awkward tables."""

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.llm import conversation_repair as cr
from geoloom.llm import lexical_search as ls
from geoloom.llm import pivot_search as ps

CLASHES = ("row", "rank", "score", "term", "item", "share", "part", "kind", "known", "digest", "copies", "place")


def clashing(df):
    for name in CLASHES:
        df = df.withColumn(name, F.lit("clash"))
    return df


# Top products


def top_by_hand(rows, best, every):
    """rows: (id, vector or None) in any order; {query row number: [(score, id, row number)]}"""
    used = {}
    for i, (_, v) in enumerate(rows):
        if v is not None and all(x is not None and math.isfinite(x) for x in v) and all(abs(math.floor(x * 1024)) < ps.LIMIT for x in v):
            used[i] = [math.floor(x * 1024) for x in v]
    out = {}
    for i, q in used.items():
        if rows[i][0] is not None and rows[i][0] % every == 0:
            scores = [(sum(a * b for a, b in zip(q, v, strict=True)), rows[j][0]) for j, v in used.items() if j != i and len(v) == len(q)]
            out[i] = sorted(scores, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:best]
    return out


def found_products(df, **more):
    out = {}
    for r in ps.top_products(df, **more).collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("part, group", [(65_536, 64), (16, 4)])
def test_top_products_equal_brute_force(spark, monkeypatch, part, group):
    """One part, and many parts of few vectors, with a third of all rows equal, and clusters that let parts and groups be skipped."""
    monkeypatch.setattr(ps, "LEAST_PART", part)
    monkeypatch.setattr(ps, "PART", part)
    monkeypatch.setattr(ps, "GROUP", group)
    monkeypatch.setattr(ps, "ASKED", 3)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 12)) * 3
    rows = [(i, (centres[i % 6] * (1 + i % 3) + rng.normal(size=12) / 10).astype(np.float32).tolist()) for i in range(240)]
    rows += [(i, [0.25] * 12) for i in range(240, 360)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    want = {rows[i][0]: [(k + 1, *x) for k, x in enumerate(v)] for i, v in top_by_hand(rows, 10, 7).items()}
    assert found_products(df, every=7) == want


def test_top_products_on_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [nan, 1.0]), (3, [None, 1.0]), (4, [inf, 1.0]), (100, [1.0, 2.0]), (5, [1.0, 2.0, 3.0]), (200, [3.0, -1.0, 0.5]), (None, [1.0, 2.0]), (6, []), (300, []), (400, [1e300, 0.0]), (7, [-0.0001, 0.0]), (500, [0.0, 0.0]), (600, [2.6e5, -2.6e5])]
    df = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    want = {rows[i][0]: [(k + 1, *x) for k, x in enumerate(v)] for i, v in top_by_hand(rows, 10, 100).items() if v}
    assert found_products(df) == want
    twice = spark.createDataFrame([(0, [1.0]), (0, [2.0]), (1, [3.0])], "vec_id long, embedding array<double>")
    assert found_products(twice)[0] == [(1, 6144 * 1024 // 2, 1), (1, 6144 * 1024, 1), (2, 2048 * 1024, 0), (2, 2048 * 1024, 0)]
    assert ps.top_products(df.limit(0)).count() == 0 and ps.top_products(spark.createDataFrame([(0, None)], "vec_id long, embedding array<double>")).count() == 0


def test_bounds_skip_work(monkeypatch):
    """Vectors in clusters: a query looks at few of them, and rounding never hides one that ties."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16)) * 300
    vectors = np.concatenate([np.round(c + rng.normal(size=(100, 16)) * 5) for c in centres]).astype(np.int32)
    pivots = ps.choose_pivots(list(vectors[::7]))
    import pyarrow as pa

    far, square = ps.distances(vectors, pivots), (vectors.astype(float) ** 2).sum(1)
    part = ps.Part(np.arange(len(vectors)), pa.array(np.arange(len(vectors))), vectors, far, square, 10)
    seen, products = [], part._products
    monkeypatch.setattr(part, "_products", lambda at, q: (seen.append(len(at)), products(at, q))[1])
    for i in range(0, len(vectors), 97):
        bounds = ps.box_products(far[i : i + 1], square[i : i + 1], part.low, part.high, part.longest)[0]
        scores, places = part.search(i, vectors[i], far[i], square[i], bounds, -math.inf, 10)
        exact = vectors.astype(np.int64) @ vectors[i].astype(np.int64)
        order = [j for j in np.lexsort((np.arange(len(exact)), -exact)) if j != i][:10]
        assert part.rows[places].tolist() == order and scores.tolist() == exact[order].tolist()
    assert sum(seen) < 0.25 * len(range(0, len(vectors), 97)) * len(vectors)


# Conversations


def turns_by_hand(rows):
    """[(turn, role, text)] after damage, in order, with their faults."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows), key=lambda y: (y[0] is not None, y[0] or 0, y[1].encode(), hashlib.sha256(y[2].encode()).digest()))
    seen, out = set(), []
    for t, role, text in rows:
        end = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((t, role, text, fault))
    return out


def repaired_by_hand(rows):
    """Cheapest edits by strings over all states, one turn after the other, inserts as steps of their own."""
    following = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", ())}

    def inserted(best):
        for _ in range(3):
            for state, (cost, audit, made) in list(best.items()):
                to = following[state]
                new = (cost + 5, audit + "I", (*made, ("user" if to == "u" else "assistant", "")))
                best[to] = min(best.get(to, new), new)
        return best

    def reached(best, role, text, fault):
        out = {}
        for state, (cost, audit, made) in best.items():
            options = [(state, 2, "D", ())]
            if fault not in ("blank", "duplicate"):
                stays = 5 * (fault == "truncated")
                to = following[state]
                options.append((to, 1 + stays, "R", (("user" if to == "u" else "assistant", text),)))
                if role[:1] == to or (role[:1] == "s" and state == ""):
                    options.append((role[:1], stays, "K", ((role, text),)))
            for to, price, edit, more in options:
                new = (cost + price, audit + edit, made + more)
                out[to] = min(out.get(to, new), new)
        return out

    for _, role, text, fault in rows:
        best = reached(inserted(best), role, text, fault)
    best = inserted(best)
    return min(best[s] for s in ("", "a") if s in best)


def report_by_hand(rows):
    rows = turns_by_hand(rows)
    cost, audit, made = repaired_by_hand(rows)
    known = [t for t, *_ in rows if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    return (gaps, *(sum(r[3] == k for r in rows) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest())


def test_scripts_of_few_turns_are_the_least_of_all():
    """Every script of up to 5 turns is tried, with up to two inserts at each place; inserts need not be in runs."""
    rng = random.Random(2)

    def tried(turns):
        found = []
        for edits in itertools.product("DKR", repeat=len(turns)):
            for runs in itertools.product(range(3), repeat=len(turns) + 1):
                cost, audit, roles, fine = 0, "", "", True
                for k, (role, fault) in enumerate([*turns, (None, None)]):
                    cost, audit = cost + 5 * runs[k], audit + "I" * runs[k]
                    for _ in range(runs[k]):
                        roles += "a" if roles.endswith("u") else "u"
                    if role is None:
                        break
                    fine &= edits[k] == "D" or fault not in (cr.BLANK, cr.DUPLICATE)
                    cost += {"D": 2, "K": 0, "R": 1}[edits[k]] + (5 if fault == cr.CUT and edits[k] != "D" else 0)
                    audit += edits[k]
                    if edits[k] == "R":
                        roles += "a" if roles.endswith("u") else "u"
                    elif edits[k] == "K":
                        roles += role
                if fine and re.fullmatch("(s?(ua)+)?", roles):
                    found.append((cost, audit))
        return min(found)

    for n in (0, 1, 2, 3, 3, 3, 4, 4):
        turns = [(rng.choice("suuaaax"), rng.choice((0, 0, 0, 0, cr.BLANK, cr.CUT))) for _ in range(n)]
        talk = cr.Conversation(cr.Automaton(), 1)
        for role, fault in turns:
            talk.fact(None, role, fault, True, 1)
        talk.solve()
        assert tried(turns) == (talk.cost, talk.report()[-1]), turns


def test_repairs_equal_strings_turn_by_turn(spark):
    rng = random.Random(11)
    texts = ["Yes.", "No!", "cut off", "", " \t\n", None, "Why?\r\n", "längs …", "a. ", "same."]
    rows = [(c if c else None, rng.choice((None, 1, 2, 3, 5, 9, 9)) if c % 3 else t, rng.choice(("user", "assistant", "user", "assistant", "system", "tool", None, "")), rng.choice((*texts, f"own {c} {t}.", f"own {c} {t}."))) for c in range(60) for t in range(rng.choice((1, 2, 5, 9, 40)))]
    rows += [(99, 0, "system", "Only this."), *[(98, 4, "user", "again.")] * 700]
    df = clashing(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).repartition(7)
    by = {}
    for c, *row in rows:
        by.setdefault(c, []).append(row)
    want = {c: report_by_hand(v) for c, v in by.items()}
    ids = spark.createDataFrame([(7777,), (7777,), (99,)], "conv_id long")
    got = {r["conv_id"]: tuple(r)[1:] for r in cr.repair_report(df, ids).collect()}
    assert got.pop(7777) == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == want
    made = {}
    for r in cr.repaired_turns(df).collect():
        made.setdefault(r["conv_id"], []).append((r["place"], r["edit"], r["role"], r["text"]))
    for c, v in by.items():
        turns = sorted(made.get(c, []))
        assert [t[0] for t in turns] == list(range(len(turns))) and "".join(t[1] for t in turns) == want[c][6].replace("D", "")
        assert hashlib.sha256("\n".join(f"{t[2]}:{t[3]}" for t in turns).encode()).hexdigest() == want[c][7]
        assert re.fullmatch("(s?(ua)+)?", "".join(t[2][0] for t in turns))


def test_damage(spark):
    rows = [(c, t if t != 3 else None, "assistant", f"Text {c}. And {t}! Or?") for c in range(40) for t in range(5)] + [(None, 1, "system", None)]
    want = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        row = (c, t, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text or " ") if kind == 2 else text or " ")
        want += [row] * {0: 0, 3: 2}.get(kind, 1)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted(map(str, (tuple(r) for r in cr.damaged(df).collect()))) == sorted(map(str, want))
    assert cr.repair_report(df.limit(0)).count() == 0 and cr.repaired_turns(df.limit(0)).count() == 0


def test_few_layers():
    """Layers stay few however long a conversation is, so that a number of 16 bits names them."""
    machine, rng, layer = cr.Automaton(), random.Random(1), 0
    for _ in range(200_000):
        layer, _, _ = machine.take(layer, rng.randrange(16))
    assert len(machine.layers) < 1000


# Lexical search


def terms_by_hand(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def ranked_by_hand(docs, items, best=10):
    terms = [terms_by_hand(t) for _, t in docs]
    n, total = sum(bool(t) for t in terms), sum(map(len, terms))
    out = []
    for item, text in items:
        scores = {}
        for w in set(terms_by_hand(text)):
            df = sum(w in t for t in terms)
            weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
            for i, t in enumerate(terms):
                if tf := t.count(w):
                    m = 10 + 90 * len(t) * n // total
                    scores[i] = scores.get(i, 0) + weight * (1_000_000_000 * tf // (1000 * tf + 8 * m))
        order = sorted(((-s, docs[i][0] is None, docs[i][0] or 0) for i, s in scores.items() if s > 0))[:best]
        out += [(item, k + 1, None if null else d, -s) for k, (s, null, d) in enumerate(order)]
    return sorted(out, key=str)


@pytest.mark.parametrize("share, rows, cut", [(4_000_000, 1_000_000, 1 << 20), (20, 0, 7)])
def test_search_equals_brute_force(spark, monkeypatch, share, rows, cut):
    """With one share a term and with many, with a broadcast of the items' terms and without, with texts split at once and in slices."""
    monkeypatch.setattr(ls, "SHARE", share)
    monkeypatch.setattr(ls, "BROADCAST_ROWS", rows)
    monkeypatch.setattr(ls, "SLICE", cut)
    rng = random.Random(4)
    words = ["Über", "naïve", "der", "THE", "a1", "x", "42", *(f"w{i}" for i in range(40))]
    docs = [(i, " ".join(rng.choices(words, k=rng.choice((0, 1, 3, 30, 200)))) + rng.choice(("", "!", " common-word", "\n"))) for i in range(120)]
    docs += [(500 + i, "the same text, of one group") for i in range(30)] + [(None, "over x x"), (None, None), (7, "x"), (8, ""), (9, None)]
    items = [(i, " ".join(rng.choices(words, k=6))) for i in range(9)] + [(9, None), (10, ""), (11, "nothing known"), (12, "x"), (12, "the group"), (None, "common, x")]
    got = ls.ranked_search(clashing(spark.createDataFrame(docs, "doc_id long, text string")).repartition(6), clashing(spark.createDataFrame(items, "item_id long, text string")))
    assert sorted((tuple(r) for r in got.collect()), key=str) == ranked_by_hand(docs, items)


def test_search_of_empty_tables_and_long_texts(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "word " * 300_000 + "a")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert [tuple(r) for r in ls.ranked_search(docs, items).collect()] == ranked_by_hand([(1, "a b c"), (2, "word " * 300_000 + "a")], [(1, "a")])
    assert ls.ranked_search(docs.limit(0), items).count() == 0 and ls.ranked_search(docs, items.limit(0)).count() == 0


def test_lengths_beyond_64_bits(spark):
    sizes = [1, 10**6, 10**9, 5 * 10**9]
    df = spark.createDataFrame([(n,) for n in sizes], "n long").select(ls.relative_length(F.col("n"), 10**11, 10**13).alias("m"))
    assert [r["m"] for r in df.collect()] == [10 + 90 * n * 10**11 // 10**13 for n in sizes]
