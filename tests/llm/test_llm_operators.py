"""Each operator against a brute-force version, a round trip or held-out accuracy, and all of them on awkward tables."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.llm import components as component_search
from geoloom.llm import decontaminate, ego_join, hilbert_shards, language_id, license_digests, license_scan, license_texts, minhash_dedup, pack, phrase_dedup, pii, quality_fm
from geoloom.llm.common import Stage

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("digest", "n_words", "score", "row", "spans", "key", "rep", "label", "shard", "kept")
LONG = " ".join(f"w{i * i % 977}" for i in range(20_000))


def documents(spark, texts, first=0):
    rows = [(first + i, t, None if i % 7 == 3 else "en", f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def sha(words):
    return hashlib.sha256(" ".join(words).encode()).hexdigest()


def components(ids, links):
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def prose(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls in every column, empty, blank, long and repeated texts, repeated rows, one source with most rows."""
    texts = [None, "", "  \n\t ", "!!", "one", "One two", LONG, LONG, "Released under the MIT License.\nmail me@example.org", *["the same line of words again"] * 5]
    rows = [(i, t, None if i % 2 else "de", None if i == 3 else "hot", None if i % 3 else 5) for i, t in enumerate(texts)]
    rows += [(None, "text without an id", "en", "hot", 3), (4, "one", "de", "hot", 5)]
    df = spark.createDataFrame(rows, DOCS)
    for name in CLASHES:
        df = df.withColumn(name, F.lit("clash"))
    return df


def labels_of(spark):
    return spark.createDataFrame([(0, 1, 0), (1, 0, None), (2, None, 1), (None, 1, 1), (4, 1, 0), (4, 0, 0)], "doc_id long, quality int, toxic int").withColumn("y", F.lit("clash"))


def items_of(spark):
    return spark.createDataFrame([(1, "one two"), (2, None), (3, ""), (None, "one"), (3, "the same line")], "item_id long, text string").withColumn("pattern", F.lit("clash"))


def applied(spark):
    return {
        "license": license_scan.license_scan,
        "language": language_id.language_digest,
        "quality": lambda d: quality_fm.quality_digest(d, labels_of(spark)),
        "pii": pii.personal_data_digest,
        "decontaminate": lambda d: decontaminate.contamination_digest(d, items_of(spark)),
        "minhash": lambda d: minhash_dedup.near_duplicates(d, size=2),
        "phrases": phrase_dedup.repeated_phrase_digest,
        "hilbert": hilbert_shards.hilbert_shards,
        "pack": lambda d: pack.best_fit_pack(d, keep_ids=False).where("piece = 0"),
    }


@pytest.mark.parametrize("name", ["license", "language", "quality", "pii", "decontaminate", "minhash", "phrases", "hilbert", "pack"])
def test_awkward_and_empty_tables(spark, awkward, name):
    operator = applied(spark)[name]
    got = operator(awkward)
    ids = sorted((r["doc_id"] for r in got.collect()), key=str)
    assert ids == sorted((r["doc_id"] for r in awkward.select("doc_id").collect()), key=str)
    empty = operator(awkward.limit(0))
    assert empty.columns == got.columns and empty.count() == 0


def test_license_scan_is_brute_force(spark):
    def canonical(line):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in line)
        low = "" if re.search(license_scan.COPYRIGHT_LINE, low) or license_texts.names_holder(line) else low
        words = " " + re.sub(license_scan.PUNCTUATION, " ", low) + " "
        for old, new in license_scan.SPELLINGS:
            words = words.replace(f" {old} ", f" {new} ")
        return re.sub(" +", " ", words).strip(" ")

    def digest(text):
        return sha([c for c in map(canonical, (text or "").split("\n")) if c])

    texts = [None, "", "Copyright (c) 2020 Someone", "# Released under the MIT LICENCE!", "Copyright 2019 A\n" + license_scan.NOTICES[23][1].upper(), "prose\nLicensed under CC BY 4.0.\nmore\n(c) 2001 X", "prose Licensed under CC BY 4.0.", LONG]
    known = {digest(t): k for k, t in sorted(license_scan.NOTICES, reverse=True)}
    got = {r["doc_id"]: r for r in license_scan.license_scan(documents(spark, texts)).collect()}
    for i, t in enumerate(texts):
        hits = [known[d] for line in (t or "").split("\n") if canonical(line) and (d := digest(line)) in known]
        assert (got[i]["digest"], got[i]["license_id"], got[i]["line_license_ids"], got[i]["n_license_lines"]) == (digest(t), known.get(digest(t)), sorted(set(hits)), len(hits))
    assert got[3]["license_id"] == "MIT" and got[4]["license_id"] == "MIT" and got[5]["line_license_ids"] == ["CC-BY-4.0"] and not got[6]["n_license_lines"]


def test_whole_licences_are_known(spark):
    mit = license_scan.NOTICES[23][1]
    bsd = license_texts.short_texts()[4][1]
    unlicense = license_texts.short_texts()[-2][1]
    texts = [f"MIT License\n\nCopyright (c) 2020 Someone\n\n{mit}", f"BSD 3-Clause License\n\nCopyright (c) 2020, Someone\nAll rights reserved.\n\n{bsd}", bsd.replace(", ", ",\n"), f"The Unlicense\n{unlicense}", "ISC License", f"{mit}\nand more", f"The MIT License (MIT)\n\nCopyright Acme Corporation, Inc.\n{mit}", "Copyright by A. Holder & Sons\n" + mit, "Copyright is held\n" + mit]
    names = ["the original author or authors", "OpenJS Foundation and other contributors, https://openjsf.org/", "Joyent, Inc. and other Node contributors.", "Émile Größe <e@example.org> (Paris)", "notice and terms", "Acme " * 2500]
    texts += [f"MIT License\r\n\r\n * Copyright  {x}\r\n{mit}\n---" for x in names]
    got = {r["doc_id"]: (r["license_id"], r["line_license_ids"]) for r in license_scan.license_scan(documents(spark, texts)).collect()}
    assert got == {0: ("MIT", ["MIT"]), 1: ("BSD-3-Clause", ["BSD-3-Clause"]), 2: ("BSD-3-Clause", []), 3: ("Unlicense", ["Unlicense"]), 4: ("ISC", ["ISC"]), 5: (None, []), 6: ("MIT", ["MIT"]), 7: ("MIT", []), 8: (None, []), **{k: ("MIT", ["MIT"]) for k in range(9, 13)}, 13: (None, ["MIT"]), 14: (None, ["MIT"])}


@pytest.mark.parametrize("size", [2_000, 200_000, 10_000_000])
def test_license_scan_survives_long_lines(spark, size):
    """Java's matcher recurses for repeated groups: lines of many words or letters, up to 50 MB, must not reach one."""
    base = spark.createDataFrame([(0, "Copyright ", "Acme "), (1, "Copyright ", "Acme, "), (2, "", "A"), (3, "# Copyright (c) ", "Ab c,"), (4, "Copyright\t", "the "), (5, "licence ", " \t--")], "doc_id long, a string, b string")
    if size > 1_000_000:
        base = base.where("doc_id in (0, 2)")
    docs = base.select("doc_id", F.concat("a", F.repeat("b", F.lit(size)), F.lit("\nReleased under the MIT License.")).alias("text"))
    got = {r["doc_id"]: (r["license_id"], r["line_license_ids"]) for r in license_scan.license_scan(docs).collect()}
    # A holder's line of more than 10,000 characters stays; one with a sign is none of the text.
    want = {i: (None, ["MIT"]) for i in range(6)} | {3: ("MIT", ["MIT"])} | ({4: ("MIT", ["MIT"])} if size < 2_400 else {}) | ({0: ("MIT", ["MIT"])} if 5 * size + 10 <= license_scan.HOLDER_LENGTH else {})
    assert got == {k: want[k] for k in got}


@pytest.mark.skipif(not license_texts.COMMON.is_dir(), reason="no folder of licences here")
def test_licence_digests_are_those_of_the_texts():
    assert {(k, hashlib.sha256(license_texts.canonical(t).encode()).hexdigest()) for k, t in license_texts.variants()} == set(license_digests.DIGESTS)


def held(i, parts, part):
    return zlib.crc32(str(i).encode()) % parts == part


def test_language_is_right_on_held_out_rows_and_blind_to_their_labels(spark):
    rng = random.Random(1)
    words = {"aa": ["schnell", "über", "nicht", "wagen", "zwischen"], "bb": ["quick", "over", "with", "whether", "thing"], "cc": ["rápido", "sobre", "niño", "coche", "ella"]}
    rows = [(i, prose(rng, words[k], 20), k, "s", 1) for i in range(300) for k in [rng.choice(sorted(words))]] + [(900, None, "aa", "s", 1), (901, "12 34", "bb", "s", 1)]
    one = {r["doc_id"]: r for r in language_id.language_digest(spark.createDataFrame(rows, DOCS)).collect()}
    asked = [r for r in rows if held(r[0], 4, 2) and r[0] < 900]
    assert asked and np.mean([one[r[0]]["lang_pred"] == r[2] for r in asked]) > 0.95
    assert all(one[i]["held_out"] == held(i, 4, 2) and 0 <= one[i]["score"] <= 1 for i in one)
    assert one[900]["lang_pred"] == one[901]["lang_pred"] == "und"
    turned = [(i, t, "cc" if held(i, 4, 2) else k, "other", n) for i, t, k, _, n in rows]
    assert {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.language_digest(spark.createDataFrame(turned, DOCS)).collect()} == {i: (r["lang_pred"], r["score"]) for i, r in one.items()}


def test_no_language_is_left_out(spark, monkeypatch):
    rng = random.Random(20)
    stems = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(300)]
    rows = [(3 * k + i, f"{w} {w}{w} {w}", f"l{k:03}", "s", 1) for k, w in enumerate(stems) for i in range(3)] + [(5000, stems[0], "l000", "s", 1)] * 40
    docs = spark.createDataFrame(rows, DOCS)
    model = language_id.fit_language_model(docs, sample=5, epochs=2)
    assert model.languages == sorted({r[2] for r in rows})
    got = language_id.predict_language(docs, model).collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in got]) > 0.9
    monkeypatch.setattr(language_id, "LANGUAGES", 299)
    with pytest.raises(ValueError, match="299"):
        language_id.fit_language_model(docs)


def test_language_features_are_counts_of_all_grams():
    def plain(text):
        letters = "".join(c if c.isalpha() else " " for c in text.lower())
        codes = [32, *(ord(c) for i, c in enumerate(letters) if c != " " or i == 0 or letters[i - 1] != " "), 32]
        counts, mask = {}, (1 << 64) - 1
        for order in language_id.ORDERS:
            for i in range(len(codes) - order + 1):
                h = order
                for c in codes[i : i + order]:
                    h = (h ^ c) * 0x9E3779B97F4A7C15 & mask
                    h ^= h >> 32
                counts[h & (language_id.BUCKETS - 1)] = counts.get(h & (language_id.BUCKETS - 1), 0) + 1
        return counts

    rng = random.Random(8)
    for n in (1, 3, 200, 2_000, 2_800, 30_000):  # below and above the length from which all buckets are counted
        text = "".join(rng.choice("abcdefghij éß  .,1") for _ in range(n)) + "a"
        at, counts = language_id.features(text)
        assert dict(zip(at.tolist(), counts.tolist(), strict=True)) == plain(text) and (np.diff(at) > 0).all()


def test_language_sample_is_bounded_in_bytes(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(i, "".join(rng.choice("abcdefghijklmnop ") for _ in range(400)) + "a" * (i % 2), ("x", "y")[i % 2], "s", 1) for i in range(400)]
    docs = spark.createDataFrame(rows, DOCS)
    sizes = {i: 8 * len(language_id.features(t)[0]) for i, t, *_ in rows}
    seen = []
    learn = language_id.follow_leader
    monkeypatch.setattr(language_id, "follow_leader", lambda model, given, *rest: (seen.append(given), learn(model, given, *rest)))
    for limit in (1 << 30, sum(sizes.values()) // 8):
        language_id.fit_language_model(docs, epochs=1, sample_bytes=limit)
    # Of 400 rows, the 79 at places 5, 10 ... are kept for the temperature; then it is an eighth of all, about.
    assert len(seen[0]) == 321 and 15 <= len(seen[1]) <= 75 and {y for y, *_ in seen[1]} == {0, 1}


def naive_leader(languages, rows, epochs, alpha, beta, l1, l2):
    """Follow-the-regularised-leader, a weight at a time."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(key):
        if abs(z[key]) <= l1:
            return 0.0
        return (math.copysign(l1, z[key]) - z[key]) / ((beta + math.sqrt(n[key])) / alpha + l2)

    for epoch in range(epochs):
        for i in np.random.default_rng(epoch).permutation(len(rows)):
            y, at, x = rows[i]
            keys = [[*((a, k) for a in at), ("bias", k)] for k in range(languages)]
            values = [*x, 1.0]
            w = [[weight(key) for key in own] for own in keys]
            logits = [sum(a * b for a, b in zip(own, values, strict=True)) for own in w]
            e = [math.exp(v - max(logits)) for v in logits]
            for k in range(languages):
                error = e[k] / sum(e) - (k == y)
                for key, v, old in zip(keys[k], values, w[k], strict=True):
                    g = error * v
                    z[key] += g - (math.sqrt(n[key] + g * g) - math.sqrt(n[key])) / alpha * old
                    n[key] += g * g
    return weight


def test_leader_and_pairs_are_those_of_plain_loops():
    rng = np.random.default_rng(21)
    rows = [(int(rng.integers(3)), np.sort(rng.choice(12, 4, replace=False)), rng.random(4)) for _ in range(40)]
    model = language_id.LanguageModel(["a", "b", "c"], np.ones(language_id.BUCKETS), np.zeros((language_id.BUCKETS, 3)), np.zeros(3))
    language_id.follow_leader(model, rows, 2, 0.5, 1.0, 0.02, 0.5)
    weight = naive_leader(3, rows, 2, 0.5, 1.0, 0.02, 0.5)
    assert np.allclose(model.weights[:12], [[weight((a, k)) for k in range(3)] for a in range(12)])
    assert np.allclose(model.bias, [weight(("bias", k)) for k in range(3)]) and (model.weights[:12] == 0).any()
    # A temperature that is best for the scores it is fitted on.
    logits = 4 * rng.normal(size=(200, 3))
    labels = language_id.softmax(logits / 3).cumsum(1)
    labels = (rng.random((200, 1)) > labels).sum(1).clip(0, 2)
    loss = lambda t: -np.log(language_id.softmax(logits / t)[np.arange(200), labels]).mean()
    best = language_id.calibrated(logits, labels)
    assert all(loss(best) <= loss(best * f) + 1e-9 for f in (0.8, 0.95, 1.05, 1.25))


def test_quality_ranks_held_out_rows(spark):
    rng = random.Random(2)
    good, bad = [f"clear{i}" for i in range(40)], [f"spam{i}" for i in range(40)]
    rows, labels = [], []
    for i in range(400):
        y = rng.random() < 0.5
        text = prose(rng, good if y else bad, 30) + ("." if y else " $$$ @@ ##" * 3)
        rows.append((i, text, "en", "s", len(text)))
        labels.append((i, int(y), 0))
    got = {r["doc_id"]: r for r in quality_fm.quality_digest(spark.createDataFrame([*rows, (900, None, None, None, None)], DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    asked = [(got[i]["score"], y) for i, y, _ in labels if held(i, 5, 0)]
    wins = [a > b for a, x in asked for b, y in asked if x > y]
    assert np.mean(wins) > 0.95 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got.values())
    machine = quality_fm.learned([(1, np.array([1, 5, 9]), np.array([0.5, 1.0, 2.0])), (0, np.array([2, 5]), np.array([1.0, 1.0]))], 3, 4, 0.1, 0.0)
    at, x = np.array([1, 5, 9]), np.array([0.5, 1.0, 2.0])
    pairs = sum(machine.factors[at[i]] @ machine.factors[at[j]] * x[i] * x[j] for i in range(3) for j in range(i))
    assert machine.margin(at, x) == pytest.approx(machine.bias + machine.weights[at] @ x + pairs)


def test_entities_are_those_of_plain_patterns():
    rng = random.Random(3)
    patterns = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]

    def valid(kind, x):
        d = re.sub("[^0-9]", "", x)
        if kind == 1:
            return all(int(p) <= 255 for p in x.split("."))
        if kind == 2:
            return 14 <= len(d) <= 19 and sum(int(c) if k % 2 == 0 else sum(map(int, str(2 * int(c)))) for k, c in enumerate(reversed(d))) % 10 == 0
        return kind == 0 or 10 <= len(d) <= 15

    seen = set()
    for n in range(6000):
        text = "".join(rng.choice("ab1.@- " if n % 3 else "0123456789+-. (") for _ in range(rng.randint(0, 40)))
        text += rng.choice(["", " 4111 1111 1111 1111", "x 10.0.0.255.1.2.3.4", " +49 (30) 123-4567", "é a.b@c.d@e.f"])
        want = sorted((m.start(), m.end(), k) for k, p in enumerate(patterns) for m in re.finditer(p, text) if valid(k, m[0]))
        assert sorted(pii.entities(text)) == want
        seen |= {k for _, _, k in want}
    assert seen == {0, 1, 2, 3}


def test_words_that_disclose_are_removed(spark):
    texts = [f"plain words here contact zebra user{i}@mail.org now plain words" for i in range(30)] + ["plain words here now and plain words again"] * 200
    got = pii.sanitise(documents(spark, texts)).collect()
    for r in got:
        assert ("zebra" in r["text"]) == (r["n_email"] == 1)
        if r["n_email"]:
            assert "zebra" not in r["sanitised_text"] and "@" not in r["sanitised_text"] and "<EMAIL>" in r["sanitised_text"] and r["sanitised_text"].startswith("plain words")
            start = r["text"].index("user")
            assert r["base_spans"] == f"email:{start}:{start + r['text'][start:].index(' ')}" and r["base_spans"] in r["spans"]
        else:
            assert r["sanitised_text"] == r["text"] and r["spans"] == ""
    few = pii.sanitise(documents(spark, texts), words_a_pass=1).collect()
    assert sorted((r["doc_id"], r["sanitised_text"]) for r in few) == sorted((r["doc_id"], r["sanitised_text"]) for r in got)


def test_disclosure_is_brute_force(spark):
    rng = random.Random(22)
    common = [f"w{c}" for c in "abcdefgh"]
    people = ["ann@a.org", "bob@b.org", "10.1.2.3"]
    texts = []
    for i in range(120):
        words = [rng.choice(common) for _ in range(rng.randint(5, 90))]
        if rng.random() < 0.5:
            k = rng.randrange(3)
            at = rng.randrange(len(words))
            words[at:at] = [["anna", "bobby", "router"][k], people[k]]
        texts.append(" ".join(words))
    near, wide, least, often = 3, 6, 2, 3
    total, every, by_kind, by_entity, seen = 0, defaultdict(int), defaultdict(lambda: defaultdict(int)), defaultdict(int), defaultdict(lambda: [set() for _ in range(pii.ORDERS)])
    hashed = lambda w: int(pii.words_at(w)[0][0])
    around, near_kind = defaultdict(int), defaultdict(int)
    for t in texts:
        words = [(m[0], m.start(), m.end()) for m in re.finditer("[a-z]+", t)]
        total += len(words)
        for w, _, _ in words:
            every[w] += 1
        places = defaultdict(set)
        for low, high, kind in pii.entities(t):
            before, after = [i for i, w in enumerate(words) if w[2] <= low], [i for i, w in enumerate(words) if w[1] >= high]
            for i in before[-near:] + after[:near]:
                by_kind[words[i][0], kind][t[low:high]] += 1
                near_kind[kind] += 1
            places[t[low:high]] |= set(before[-wide:] + after[:wide])
        for e, own in places.items():
            around[e] += len(own)
            window = [words[i][0] for i in sorted(own)]
            for w in window:
                by_entity[w, e] += 1
                pairs = [(a, b) for a, b in zip(window, window[1:], strict=False) if w not in (a, b)]
                for k, kept in enumerate(seen[w, e]):
                    keys = [int(pii.mixed(pii.mixed(np.array([(hashed(a) * 0x9FB21C651E98DF25 + hashed(b)) % 2**64], np.uint64)) ^ np.uint64(0xA0761D6478BD642F * (k + 1) % 2**64))[0]) for a, b in pairs]
                    kept.add(min(keys, default=0))
    want = {}
    told = lambda n, w, share: min(1.0, math.log2(n / every[w] / share) / -math.log2(share))
    for (w, kind), of in by_kind.items():
        if len(of) >= least:
            want[w] = max(want.get(w, -9), told(sum(of.values()), w, near_kind[kind] / total))
    for (w, e), n in by_entity.items():
        own = max(map(len, seen[w, e]))
        if own >= often and own >= pii.INDEPENDENT * n:
            want[w] = max(want.get(w, -9), told(n, w, around[e] / total) if 2 * n >= every[w] else 0.0)
    got = {r["word"]: r["disclosure"] for r in pii.disclosures(documents(spark, texts), near=near, least=least, wide=wide, least_contexts=often).collect()}
    assert got == {int(pii.words_at(w)[0].astype(np.int64)[0]): pytest.approx(v) for w, v in want.items()}
    assert {"anna", "bobby", "router"} <= set(want) and max(want[w] for w in common if w in want) < min(want[w] for w in ("anna", "bobby", "router"))


def test_names_that_disclose_one_address_are_removed_everywhere(spark):
    rng = random.Random(12)
    common = [f"word{c}" for c in "abcdefghijklmnopqrst"]
    words = lambda n: " ".join(rng.choice(common) for _ in range(n))
    texts = [f"{words(40)} Zelda {words(7)} zq@corp.example {words(40)}" for _ in range(40)] + [words(60) for _ in range(200)] + [f"{words(30)} Zelda {words(30)}"]
    got = pii.sanitise(documents(spark, texts)).collect()
    assert not any("zelda" in r["sanitised_text"].lower() or "@" in r["sanitised_text"] for r in got)
    assert all(r["sanitised_text"] == r["text"] for r in got if 40 <= r["doc_id"] < 240)
    alone = next(r for r in got if r["doc_id"] == 240)
    assert alone["base_spans"] == "" and alone["spans"].count(":") == 2


def test_copies_of_a_passage_are_one_piece_of_evidence(spark):
    """Names in independent contexts of an address disclose it; words of passages with an address that is copied, exactly or nearly, do not."""
    rng = random.Random(31)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(4000)]
    weights = [1 / (i + 10) for i in range(4000)]
    words = lambda n: rng.choices(vocabulary, weights, k=n)
    names, texts = [f"Qname{c}x" for c in "abcdefghij"], []
    for i, name in enumerate(names):
        for _ in range(12):
            texts.append(" ".join([*words(40), name, "Surname", f"box{i}@people.example", *words(40)]))
    for i, copies in enumerate((6, 6, 6, 12, 30, 100)):
        passage = [*words(40), f"desk{i}@office.example", *words(40)]
        for j in range(copies):
            texts.append(" ".join(w if "@" in w or i % 2 == 0 or rng.random() > 0.04 else rng.choice(vocabulary) for w in passage))
    texts += [" ".join(words(80)) for _ in range(400)]
    found = {r["word"] for r in pii.disclosures(documents(spark, texts)).collect() if (r["of_entity"] or 0) >= pii.GENERALISE}
    of = {int(pii.words_at(n)[0].astype(np.int64)[0]) for n in names}
    assert of <= found and len(found - of) <= 1


def test_decontamination_is_brute_force(spark):
    rng = random.Random(4)
    words = ["ab", "b", "c1", "été", "X", "y"]
    texts = [None, "", *(prose(rng, words, rng.randint(0, 60)) for _ in range(40))]
    items = [(0, None), (1, ""), (2, "ab B"), (3, "c1"), *((10 + i, prose(rng, words, rng.randint(3, 14))) for i in range(10)), (11, "x y")]
    items += [(30, " ".join(texts[7].split()[2:14])), (31, "zz qq")]
    split = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    df = decontaminate.decontaminate(documents(spark, texts), spark.createDataFrame(items, "item_id long, text string"), patterns_a_pass=20)
    got = {r["doc_id"]: r for r in df.collect()}
    assert got[7]["n_hit"] >= 10
    for i, t in enumerate(texts):
        own, hit, found = split(t), set(), set()
        for k, item in items:
            w = split(item)
            for p in {tuple(w[j : j + 10]) for j in range(max(1, len(w) - 9))} - {()}:
                for s in range(len(own) - len(p) + 1):
                    if tuple(own[s : s + len(p)]) == p:
                        hit |= set(range(s, s + len(p)))
                        found.add(str(k))
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["item_ids"]) == (len(own), len(hit), sorted(found))


def near_copies(rng, words, groups, size):
    texts = []
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(size)]
        for _ in range(rng.randint(1, 5)):
            own = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 12])):
                own[rng.randrange(len(own))] = rng.choice(words)
            texts.append(" ".join(own))
    return texts


@pytest.mark.parametrize("size", [2, 5])
def test_minhash_components_are_brute_force(spark, size):
    rng = random.Random(5)
    texts = [None, "", " ", "alone", "Alone", *near_copies(rng, [f"v{i}" for i in range(400)], 40, 90)]
    rng.shuffle(texts)
    sets = {i: minhash_dedup.shingles(t, size) for i, t in enumerate(texts)}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = components(sets, links)
    got = {r["doc_id"]: r for r in minhash_dedup.near_duplicates(documents(spark, texts), size=size).collect()}
    assert {i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in got.items()} == {i: (len(sets[i]), want[i], want[i] == i) for i in sets}
    assert len(links) > 20


def test_embedding_links_are_brute_force(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(12, 16))
    rows = []
    for i in range(400):
        x = centres[rng.integers(12)] + rng.normal(size=16) * rng.choice([0.0, 0.1, 0.3])
        rows.append((i, [float(v) for v in x * rng.uniform(0.1, 9)]))
    rows += [(500, None), (501, []), (502, [0.0] * 16), (503, [math.nan] * 16), (504, [None] * 16), (505, [1.0, 2.0]), (506, [2.0, 4.0]), (507, [math.inf] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rep", F.lit(1)).withColumn("label", F.lit(None).cast("int"))
    links = []
    for a, x in rows:
        for b, y in rows:
            if a < b and x and y and len(x) == len(y) and None not in x and None not in y and np.isfinite(x).all() and np.isfinite(y).all() and any(x) and any(y):
                if np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y) >= 0.95:
                    links.append((a, b))
    want, degree = components([i for i, _ in rows], links), defaultdict(int)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    got = ego_join.embedding_duplicates(df, axes=3, leaf=8)
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got.collect()} == {i: (degree[i], want[i], want[i] == i) for i, _ in rows}
    assert len(links) > 400
    assert ego_join.embedding_duplicates(df.limit(0)).count() == 0
    assert ego_join.embedding_duplicates(df.where("vec_id = 500")).first()["kept"]


def test_embedding_without_id_leaves_its_block_alone(spark):
    rng = np.random.default_rng(11)
    near = [[float(v) for v in 1 + 0.01 * rng.normal(size=16)] for _ in range(30)]
    rows = [(None if i % 10 == 4 else i, x) for i, x in enumerate(near)] + [(None, near[0]), (None, near[4]), (None, None), (None, [0.0] * 16)]
    got = ego_join.embedding_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    ids = [i for i, _ in rows if i is not None]
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got if r["vec_id"] is not None} == {i: (len(ids) - 1, 0, i == 0) for i in ids}
    assert [(r["n_links"], r["component_id"], r["kept"]) for r in got if r["vec_id"] is None] == [(0, None, True)] * (len(rows) - len(ids))


def test_minhash_finds_nearly_all_pairs_at_the_threshold(spark):
    rng = random.Random(16)
    words, texts = [f"v{i}" for i in range(5000)], []
    for _ in range(700):
        base = [rng.choice(words) for _ in range(rng.randint(60, 140))]
        own = list(base)
        for k in rng.sample(range(len(base) // 6), round(len(base) * rng.uniform(0.02, 0.05))):
            own[6 * k] = rng.choice(words)
        texts += [" ".join(base), " ".join(own)]
    sets = [minhash_dedup.shingles(t, 2) for t in texts]
    near = {k for k in range(0, len(texts), 2) if 100 * len(sets[k] & sets[k + 1]) >= 80 * len(sets[k] | sets[k + 1])}
    close = {k for k in near if 100 * len(sets[k] & sets[k + 1]) < 86 * len(sets[k] | sets[k + 1])}
    got = {r["doc_id"]: r["component_id"] for r in minhash_dedup.near_duplicates(documents(spark, texts), size=2).collect()}
    found = {k for k in range(0, len(texts), 2) if got[k + 1] == k}
    assert len(close) > 150 and found <= near and len(found) >= 0.99 * len(near) and len(found & close) >= 0.99 * len(close)


def test_minhash_tells_rows_of_one_id_apart(spark):
    rng = random.Random(17)
    one, two = (" ".join(rng.choice("abcdefghijklmnop") + str(rng.randint(0, 99)) for _ in range(80)) for _ in range(2))
    rows = [(5, one), (5, two), (7, two + " more"), (8, one + " more"), (5, one), (9, "other words"), (None, one), (4, None), (4, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    for name in ("digest", "rep", "key", "doc", "c0"):
        docs = docs.withColumn(name, F.lit("clash"))
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in minhash_dedup.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(5, 5, True)] * 3 + [(7, 5, False), (8, 5, False), (9, 9, True), (None, None, True), (4, 4, True), (4, 4, True)], key=str)
    kept = minhash_dedup.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted([(5, one), (5, two), (9, "other words"), (None, one), (4, None), (4, "")], key=str)
    assert minhash_dedup.without_near_duplicates(docs.limit(0)).count() == 0


def test_components_of_long_chains_and_stars(spark, monkeypatch):
    monkeypatch.setattr(component_search, "KEPT_LINKS", 16)
    rng = random.Random(18)
    links = [(i, i + 1) for i in range(300)] + [(1000, 1001 + i) for i in range(200)] + [(2000 + 2 * i, 2001 + 2 * i) for i in range(50)] + [(3, 3)]
    names = list(range(3000))
    rng.shuffle(names)
    links = [(names[a], names[b]) for a, b in links]
    rng.shuffle(links)
    df = spark.createDataFrame(links, "a long, b long").repartition(7)
    got = {r["node"]: r["component"] for r in component_search.connected_components(Stage(spark, "test"), df).collect()}
    want = components({x for e in links for x in e}, links)
    assert {i: got.get(i, i) for i in want} == want


@pytest.mark.parametrize("kind", ["float", "double"])
def test_embedding_rows_are_told_apart_by_their_vectors(spark, kind):
    rng = np.random.default_rng(14)
    near = lambda scale: (scale * (1 + 0.01 * rng.normal(size=8))).astype("<f4" if kind == "float" else "<f8").tolist()
    big, small = (1e30, 1e-30) if kind == "float" else (1e200, 1e-200)
    far = [1.0, -1.0] * 4
    rows = [(1, near(1)), (1, near(1)), (1, near(1)), (2, near(big)), (3, near(small)), (4, far), (4, far), (5, far), (6, near(1)), (6, far), (7, None)]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    for name in ("digest", "component", "place", "copies", "bundle"):
        df = df.withColumn(name, F.lit("clash"))
    got = sorted(tuple(r) for r in ego_join.embedding_duplicates(df, leaf=2).collect())
    assert got == sorted([(1, 5, 1, True)] * 3 + [(2, 5, 1, False), (3, 5, 1, False), (6, 5, 1, False), (4, 3, 4, True), (4, 3, 4, True), (5, 3, 4, False), (6, 3, 4, False), (7, 0, 7, True)])


@pytest.mark.parametrize(("bundles", "kept"), [(1, 10), (5, 1 << 20)])
def test_one_large_group_of_near_vectors(spark, monkeypatch, bundles, kept):
    """All of a group link with all, whether they meet in one bundle or across them."""
    monkeypatch.setattr(ego_join, "BUNDLE_BYTES", 8 * 8 * (601 // bundles + 1))
    monkeypatch.setattr(ego_join, "BUNDLES", 1)
    monkeypatch.setattr(ego_join, "KEPT_LINKS", kept)
    rng = np.random.default_rng(15)
    x = np.concatenate((np.eye(8)[0] + 0.01 * rng.normal(size=(400, 8)), rng.normal(size=(200, 8)), [[-1.0] + [0.0] * 7]))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    y = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = y @ y.T >= 0.95
    links = [(a, b) for a, b in zip(*np.nonzero(near), strict=True) if a < b]
    want = components(range(len(x)), links)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in ego_join.embedding_duplicates(df, leaf=32).collect()}
    assert got == {i: (int(near[i].sum()) - 1, want[i]) for i in range(len(x))} and len(links) > 79_000


@pytest.mark.parametrize(("window", "anchor"), [(5, 2), (50, 8)])
def test_phrases_are_brute_force(spark, window, anchor):
    rng = random.Random(7)
    words = [f"q{i}" for i in range(6 if window == 5 else 3000)]
    shared = [[rng.choice(words) for _ in range(3 * window)] for _ in range(4)]
    texts = [None, "", "a b c"]
    for _ in range(40):
        own = [rng.choice(words) for _ in range(rng.randint(0, 3 * window))]
        if rng.random() < 0.6:
            s, k = rng.choice(shared), rng.randrange(window)
            own[len(own) // 2 : len(own) // 2] = s[k : k + rng.randint(window - 1, 2 * window)]
        texts.append(rng.choice([" ", "\n"]).join(own))
    texts += [texts[10], "  ".join(texts[11].split())]
    first = {}
    split = [(t or "").split() for t in texts]
    for i, w in enumerate(split):
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k : k + window]), i)
    df = phrase_dedup.phrase_duplicates(documents(spark, texts), window=window, anchor=anchor, shard_words=300, task_docs=5, part_words=3 * window // 2)
    got = {r["doc_id"]: r for r in df.collect()}
    removed = 0
    for i, w in enumerate(split):
        gone = {k + j for k in range(len(w) - window + 1) if first[tuple(w[k : k + window])] < i for j in range(window)}
        kept = [x for k, x in enumerate(w) if k not in gone]
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_sha256"]) == (len(w), len(gone), sha(kept))
        assert {k for a, b in got[i]["removed"] for k in range(a, b)} == gone
        removed += bool(gone)
    assert removed > 5


def test_hilbert_curve_is_whole_and_steps_to_neighbours():
    for dims, bits in ((2, 4), (3, 3)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
        order = hilbert_shards.hilbert_index(cells, bits)
        assert sorted(order.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(order)], axis=0)).sum(1) == 1).all()


def test_shards_are_level_and_gapless(spark, tmp_path):
    docs = documents(spark, [None, "", "éé", *(f"text {i % 11}" for i in range(200))])
    sharded = hilbert_shards.hilbert_shards(docs, shards=24)
    rows = sharded.collect()
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    assert sorted(by) == list(range(24)) and all(sorted(v) == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {r["doc_id"]: (len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in docs.collect()}
    ordered = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    assert [r["curve"] for r in ordered] == sorted(r["curve"] for r in rows)
    assert hilbert_shards.manifest(sharded).agg(F.sum("n_rows")).first()[0] == len(rows)
    hilbert_shards.write_shards(docs, sharded, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == len(rows) and back.select("shard").distinct().count() == 24


def test_packing_is_a_round_trip_near_the_bound(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    rng = random.Random(8)
    words = ["Hello", "world,", "café", "e.g.", "x_y", "don't", "İstanbul", "中文", "A1b2", "ßß", "  ", "\n\nnew", "Ångström"]
    texts = [None, "", " ", LONG, *(prose(rng, words, rng.choice([3, 40, 300, 900])) for _ in range(150))]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    rows = pack.best_fit_pack(documents(spark, texts)).collect()
    by, bins = defaultdict(list), defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["piece"])):
        assert r["start"] == len(by[r["doc_id"]]) and r["length"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        by[r["doc_id"]] += r["ids"]
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert by == want
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= pack.LENGTH
    least = pack.least_bins(np.array([r["length"] for r in rows]), pack.LENGTH)
    assert least <= len(bins) <= 1.03 * least + 1


def test_shards_are_runs_of_the_whole_order_and_prune(spark):
    rng = random.Random(19)
    rows = [(i, "x" * rng.choice([0, 3, 40, 500, 9000]), rng.choice(["de", "en", "fr", None]), rng.choice("abcdefgh"), 1) for i in range(600)]
    rows = [(rng.randrange(300), *r[1:]) for r in rows]
    sharded = hilbert_shards.hilbert_shards(spark.createDataFrame(rows, DOCS).repartition(9), shards=24)
    got = sorted(sharded.collect(), key=lambda r: (r["shard"], r["slot"]))
    assert [(r["curve"], r["text_crc32"], r["doc_id"]) for r in got] == sorted((r["curve"], r["text_crc32"], r["doc_id"]) for r in got)
    assert [r["shard"] for r in got] == [p * 24 // 600 for p in range(600)]
    whole = hilbert_shards.hilbert_index(np.array([[r["cell_0"], r["cell_1"], r["cell_2"]] for r in got]), hilbert_shards.BITS)
    assert [r["curve"] for r in got] == whole.tolist()
    # A reader that asks for one label value opens few of the shards.
    told = hilbert_shards.manifest(sharded).collect()
    for value in {r["cell_1"] for r in got}:
        opened = sum(m["min_cell_1"] <= value <= m["max_cell_1"] for m in told)
        assert opened <= 14 and opened >= len({r["shard"] for r in got if r["cell_1"] == value})


def test_crossing_keeps_every_piece_once():
    rng = random.Random(9)
    sizes = [rng.randint(1, 99) for _ in range(200)]
    one, two = (pack.Bins(sizes, 100).fit(x).bins for x in (list(range(200)), list(range(199, -1, -1))))
    for _ in range(20):
        two = pack.crossed(one, two, sizes, 100, rng)
        assert sorted(x for b in two for x in b) == list(range(200)) and all(sum(sizes[x] for x in b) <= 100 for b in two)
    assert len(pack.evolve(sizes, [], 1, 100, 4, 5)) <= len(one)


def test_runs_give_the_ids_of_whole_texts(monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, ends, kept = pack._tokenizer(path)
    ids = lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids
    rng = random.Random(13)
    parts = ["a", "B", "é", "É", "ß", "×", "÷", "'", "'s", "'T", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "|>", " ", "\n", "\t", "\x00", "\x1c", "\x85", "\xa0", "\u3000", "İ", "Σ", "ς", "\u0301", "1", "²", "中", "😀", "-", "!", "_", "ÿ", "Ÿ", "ª", "ﬁ", "don't"]
    texts = ["", None, " ", "\x00", "a\x00b c", "\u0301a b\u0301", "it's d's 's x", "tab\there\r\nnew", "a" * 3000 + " b", "x\u3000y  z", "ΑΣ ΟΔΟΣ", "12 3,4!! ?", "Same same, SAME!!"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    want = [ids(x) for x in texts]
    for chunk in (pack.CHUNK, 40, 40):  # the last time from what is kept, in pieces of a few words
        monkeypatch.setattr(pack, "CHUNK", chunk)
        monkeypatch.setattr(pack.segments, "__defaults__", (chunk,))
        assert [x.tolist() for x in pack.token_ids(texts, path)] == want
    assert all(len(x) <= pack.KEPT_BYTES for x in kept.young)
    # Without marked ends each run takes a call of its own; other rules take whole texts.
    assert pack.run_ids([b"same", b"!!"], tokenizer, np.zeros_like(ends)) == pack.run_ids([b"same", b"!!"], tokenizer, ends) == [np.array(ids(x), "<u4").tobytes() for x in ("same", "!!")]
    other = public_tokenizers.path("byte_bpe_50k.json")
    assert pack._tokenizer(other)[1] is None and [x.tolist() for x in pack.token_ids(["Same two", None], other)] == [Tokenizer.from_file(other).encode(x, add_special_tokens=False).ids for x in ("Same two", "")]
    # Nothing is lost when the generations turn.
    small = pack.Kept(2)
    for word in ("p", "q", "r", "p", "s", "p"):
        small.young.update((x, x) for x in small.missing({word}))
        assert small.young[word] == word


def test_crossing_takes_fewer_bins_than_best_fit():
    won = 0
    for seed in range(6):
        rng = random.Random(seed)
        sizes = []
        for _ in range(20):  # three pieces fill a bin, and only these three
            a = rng.randint(380, 490)
            b = rng.randint(max(250, 510 - a), (1000 - a) // 2)
            sizes += [a, b, 1000 - a - b]
        fitted = pack.Bins(sizes, 1000).fit(list(range(60))).bins
        elites = [pack.evolve(sizes, [], i, 1000, pack.POPULATION, pack.GENERATIONS) for i in range(pack.ISLANDS)]
        best = pack.evolve(sizes, elites, 9, 1000, pack.POPULATION, pack.GENERATIONS)
        assert sorted(x for b in best for x in b) == list(range(60)) and all(sum(sizes[x] for x in b) <= 1000 for b in best)
        assert pack.ideal(sizes, 1000) <= pack.cost(best, sizes, 1000) <= min(pack.cost(e, sizes, 1000) for e in [*elites, fitted])
        won += len(best) < len(fitted)
    assert won == 6
