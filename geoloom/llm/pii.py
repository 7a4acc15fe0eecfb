"""Information-theoretic removal of personal data.

Patterns find the protected entities. Over the whole corpus, words near them are counted together with the kind of
entity, words in a wider window together with the entity itself, and all their other occurrences too; how much of a
kind's or an entity's information a word discloses is its pointwise mutual information with it over its own
information. Words over the upper threshold are removed and those over the lower one generalised, as the entities are:
those that disclose an entity in all texts, those that only disclose a kind in texts that hold entities. Evidence for an
entity counts by independent contexts: copies of a passage, exact or near, are one.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Stage, added, chunks, in_passes, mixed, pick, word_hashes

KINDS = ("email", "ip", "card", "phone")
#: Words on either side of an entity that count as near, and distinct entities a word must be near to be judged.
NEAR, ENTITIES = 3, 5
#: Words on either side of an entity that can disclose itself, in how many contexts a word must be there to be judged, and the share of its occurrences there that these must be. Orders of words by which contexts are told apart.
WIDE, CONTEXTS, INDEPENDENT, ORDERS = 25, 5, 0.25, 3
GENERALISE, REMOVE = 0.8, 0.95
#: Words of one broadcast table; more are searched by further passes, one after the other. Bits of the filter that picks the words to count.
WORDS_A_PASS, FILTER_BITS = 200_000, 20
#: Rows that a task passes on at once.
ROWS = 1 << 16
# Letters and all that is not ASCII make words, A to Z lower-cased.
LETTERS = bytes((b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
# Fixed patterns; those for whole runs of digits cannot start inside one, so none is tried twice.
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
ADDRESS = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def entities(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the protected entities, by start, then kind."""
    found = []
    if "@" in text:
        last = 0
        for m in DOMAIN.finditer(text):
            start = m.start()
            while start > last and text[start - 1] in LOCAL:
                start -= 1
            if start < m.start():
                found.append((start, m.end(), 0))
                last = m.end()
    for m in ADDRESS.finditer(text):
        if all(len(p := x.lstrip("0")) <= 3 and int(p or "0") <= 255 for x in m[0].split(".")):
            found.append((m.start(), m.end(), 1))
    for m in CARD.finditer(text):
        if 14 <= m.end() - m.start() and 14 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
            found.append((m.start(), m.end(), 2))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((m.start(), m.end(), 3))
    return sorted(found, key=lambda x: (x[0], x[2]))


def words_at(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of the words of a text, in code points."""
    data = text.encode("utf-8", "surrogatepass")
    hashes, start, end = word_hashes(data.translate(LETTERS))
    if len(data) != len(text):
        codes = np.frombuffer(data, np.uint8)
        place = np.concatenate(([0], np.cumsum((codes & 0xC0) != 0x80)))
        start, end = place[start], place[end]
    return hashes, start, end


def near_words(start: np.ndarray, end: np.ndarray, low: int, high: int, near: int) -> np.ndarray:
    """Numbers of the words just before and just after a span."""
    before, after = bisect_left(end, low + 1), bisect_left(start, high)
    return np.concatenate((np.arange(max(0, before - near), before), np.arange(after, min(len(start), after + near))))


def contexts(words: np.ndarray) -> list[np.ndarray]:
    """For each order the context of each word of a window: the least pair of neighbours without that word. Copies of a passage, and copies with a few words changed, mostly have one context; windows that share a name or a phrase have different ones in some order."""
    first, second = words[:-1], words[1:]
    with np.errstate(over="ignore"):
        pairs = mixed(first * np.uint64(0x9FB21C651E98DF25) + second)
    out = []
    for k in range(ORDERS):
        keys, seen = mixed(pairs ^ np.uint64((0xA0761D6478BD642F * (k + 1)) & 0xFFFFFFFFFFFFFFFF)), np.zeros(len(words), np.uint64)
        if len(keys):
            at = int(keys.argmin())
            seen[:] = keys[at]
            for w in {int(first[at]), int(second[at])}:
                rest = keys[(first != np.uint64(w)) & (second != np.uint64(w))]
                seen[words == np.uint64(w)] = rest.min() if len(rest) else 0
        out.append(seen.astype(np.int64))
    return out


def _near_counts(at: int, near: int, wide: int):
    """Rows of (word, kind, entity, null, null) for words near entities, and for each order of (word, null, entity, perm, context) for those in the wider window: each word once for each entity, however often that is spelled out there."""
    types = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64())

    def rows(text: str) -> list[tuple]:
        hashes, start, end = words_at(text)
        around, out = {}, []
        for low, high, kind in entities(text):
            entity = int.from_bytes(hashlib.blake2b(text[low:high].encode(), digest_size=8).digest(), "little", signed=True)
            out += [(h, kind, entity, None, None) for h in hashes[near_words(start, end, low, high, near)].astype(np.int64).tolist()]
            around.setdefault(entity, set()).update(near_words(start, end, low, high, wide).tolist())
        for entity, places in around.items():
            if places:
                words = hashes[sorted(places)]
                for k, seen in enumerate(contexts(words)):
                    out += [(h, None, entity, k, c) for h, c in zip(words.astype(np.int64).tolist(), seen.tolist(), strict=True)]
        return out

    def run(batches):
        for batch in batches:
            found = []
            for i, value in enumerate(batch.column(at)):
                text = value.as_py()
                found += rows(text) if text else []
                if found and (len(found) >= ROWS or i == batch.num_rows - 1):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)], ["word", "kind", "entity", "perm", "context"])
                    found = []

    return run


def _all_counts(at: int, shared):
    def run(batches):
        total = 0
        for batch in batches:
            found = []
            for low in range(0, batch.num_rows, 512):
                for _, data, _, _ in chunks(batch.column(at).slice(low, 512).to_pylist(), LETTERS):
                    hashes, _, _ = word_hashes(data)
                    total += len(hashes)
                    found.append(hashes[shared.value[(hashes & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)]])
            words, n = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.astype(np.int64)), pa.array(n.astype(np.int64))], ["word", "n"])
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([total], pa.int64())], ["word", "n"])

    return run


def disclosures(docs: DataFrame, text_col: str = "text", near: int = NEAR, least: int = ENTITIES, wide: int = WIDE, least_contexts: int = CONTEXTS) -> DataFrame:
    """(word, disclosure, of_entity) for the hashes of words near at least so many distinct entities of a kind, or in at least so many independent contexts in the wider window of one entity: the greatest share of a kind's or an entity's information, and of an entity's alone, that the word gives away, 1 if it never occurs elsewhere. A word gives away an entity only if half of its occurrences at least are in the entity's window. Counted over all rows."""
    spark, at = docs.sparkSession, docs.columns.index(text_col)
    stage = Stage(spark, "pii")
    met = stage.table(docs.mapInArrow(_near_counts(at, near, wide), "word long, kind int, entity long, perm int, context long").groupBy("word", "kind", "entity", "perm", "context").agg(F.count("*").alias("n")))
    by_kind = met.where("kind is not null")
    in_order = met.where("kind is null").groupBy("word", "entity", "perm").agg(F.count("*").alias("contexts"), F.sum("n").alias("n"))
    by_entity = stage.table(in_order.groupBy("word", "entity").agg(F.max("contexts").alias("contexts"), F.max("n").alias("n")))
    near_kind = {r["kind"]: r["n"] for r in by_kind.groupBy("kind").agg(F.sum("n").alias("n")).collect()}  # one row a kind
    kinds = by_kind.groupBy("word", "kind").agg(F.count("*").alias("entities"), F.sum("n").alias("n")).where(F.col("entities") >= least)
    around = by_entity.groupBy("entity").agg(F.sum("n").alias("around"))
    owned = by_entity.where((F.col("contexts") >= least_contexts) & (F.col("contexts") >= INDEPENDENT * F.col("n"))).join(around, "entity")
    judged = stage.table(kinds.select("word", "kind", "n", F.lit(None).cast("long").alias("around")).unionByName(owned.select("word", F.lit(None).cast("int").alias("kind"), "n", "around")))
    bits = np.zeros(1 << FILTER_BITS, bool)
    # As many rows as the filter has bits at most.
    bits[[r[0] for r in judged.select(F.col("word").bitwiseAND((1 << FILTER_BITS) - 1).alias("bit")).distinct().collect()]] = True
    counts = stage.table(docs.mapInArrow(_all_counts(at, spark.sparkContext.broadcast(bits)), "word long, n long").groupBy("word").agg(F.sum("n").alias("all")))
    total = counts.where("word is null").agg(F.sum("all")).first()[0] or 1
    of_kind = F.element_at(F.create_map(*(F.lit(v) for k in range(len(KINDS)) for v in (k, near_kind.get(k, 1) / total))), F.col("kind"))
    # The information of an entity grows with the corpus: without a majority, ever commoner words would pass the thresholds.
    share = F.when(F.col("kind").isNull(), F.col("around") / F.lit(total)).otherwise(of_kind)
    gained = F.log2(F.col("n") / F.col("all") / share) / -F.log2(share)
    told = judged.join(counts, "word").select("word", "kind", F.when((share < 1) & (F.col("kind").isNotNull() | (2 * F.col("n") >= F.col("all"))), F.least(gained, F.lit(1.0))).otherwise(0.0).alias("disclosure"))
    return told.groupBy("word").agg(F.max("disclosure").alias("disclosure"), F.max(F.when(F.col("kind").isNull(), F.col("disclosure"))).alias("of_entity"))


def sanitise(docs: DataFrame, text_col: str = "text", near: int = NEAR, entities_least: int = ENTITIES, generalise: float = GENERALISE, remove: float = REMOVE, with_text: bool = True, words_a_pass: int = WORDS_A_PASS) -> DataFrame:
    """docs with more columns at its end: n_email, n_ip, n_card, n_phone, base_spans and spans (kind:start:end by start, then kind, joined by commas; of the patterns, and with the method's own of the kinds `term` and `removed`) and, if wanted, sanitised_text.

    Null texts count as empty and stay null. In texts without entities only words that disclose an entity are changed;
    words inside of entities are left alone.
    Rows may repeat and other columns clash; an empty table gives an empty result.
    """
    spark, at, kept = docs.sparkSession, docs.columns.index(text_col), len(docs.columns)
    stage = Stage(spark, "pii")
    words = stage.table(disclosures(docs, text_col, near, entities_least).where(F.col("disclosure") >= generalise).select("word", (F.col("disclosure") >= remove).alias("remove"), (F.coalesce("of_entity", F.lit(0.0)) >= generalise).alias("everywhere"), (F.coalesce("of_entity", F.lit(0.0)) >= remove).alias("remove_everywhere")))
    passes = max(1, -(-words.count() // words_a_pass))

    def table(k: int) -> dict:
        part = words.where(F.pmod("word", F.lit(passes)) == k) if passes > 1 else words
        return {r[0]: tuple(r[1:]) for r in part.toLocalIterator()}

    schema = added(docs, *((f"n_{x}", T.LongType()) for x in KINDS), ("base_spans", T.StringType()), ("spans", T.StringType()), *[("sanitised_text", T.StringType())] * with_text)
    if passes == 1:
        return docs.mapInArrow(_told(at, kept, with_text, spark.sparkContext.broadcast(table(0))), schema)
    found = in_passes(stage, docs, at, map(table, range(passes)), _search, terms="array<array<long>>")
    return found.mapInArrow(_told(at, kept, with_text, None), schema)


class Terms:
    """Words of a table in texts. table: hash of a word to (whether it is removed near entities, whether it counts in all texts, whether it is removed there)."""

    def __init__(self, table: dict):
        self.table, self.known = table, np.array(sorted(table), np.int64)
        self.alone = np.array([w for w in self.known.tolist() if table[w][1]], np.int64)

    def found(self, text: str, base: list[tuple[int, int, int]]) -> list[list[int]]:
        """[start, end, whether removed] of the terms outside of the entities."""
        wanted, out = self.known if base else self.alone, []
        if text and len(wanted):
            hashes, start, end = words_at(text)
            hashes = hashes.astype(np.int64)
            for i in np.flatnonzero(wanted[np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)] == hashes).tolist():
                low, high = int(start[i]), int(end[i])
                if not any(a < high and low < b for a, b, _ in base):
                    out.append([low, high, int(self.table[int(hashes[i])][0 if base else 2])])
        return out


def _search(table):
    def run(batches):
        terms = Terms(table.value)
        for batch in batches:
            found = [terms.found(text, entities(text)) for x in batch.column(1) for text in [x.as_py() or ""]]
            some = [i for i, x in enumerate(found) if x]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(some, pa.int64())), pa.array([found[i] for i in some], pa.list_(pa.list_(pa.int64())))], ["row", "terms"])

    return run


def _told(at: int, kept: int, with_text: bool, table):
    """The new columns of each row, with terms of the broadcast table or else those that passes found before."""

    def run(batches):
        terms = Terms(table.value) if table else None
        kinds = [pa.int64()] * len(KINDS) + [pa.string()] * (2 + with_text)
        for batch in batches:
            before = None if terms else batch.column(kept).to_pylist()
            rows = []
            for i, value in enumerate(batch.column(at)):
                text = value.as_py() or ""
                base = entities(text)
                rows.append(_result(text, value.as_py() is None, base, terms.found(text, base) if terms else before[i] or [], with_text))
            new = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * len(kinds), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:kept], *new], [f"c{i}" for i in range(kept + len(new))])

    return run


def _result(text: str, null: bool, found: list[tuple[int, int, int]], terms: list[list[int]], with_text: bool) -> tuple:
    every = sorted([*found, *((a, b, len(KINDS) + gone) for a, b, gone in terms)], key=lambda x: (x[0], x[2]))
    names = [*KINDS, "term", "removed"]
    told = lambda spans: ",".join(f"{names[k]}:{a}:{b}" for a, b, k in spans)
    clean = None if null else text
    if with_text and every:
        parts, last = [], 0
        for a, b, k in every:
            if a >= last:
                parts += [text[last:a], "" if names[k] == "removed" else f"<{names[k].upper()}>"]
            last = max(last, b)
        clean = "".join([*parts, text[last:]])
    return (*(sum(k == i for _, _, k in found) for i in range(len(KINDS))), told(found), told(every), *[clean] * with_text)


def personal_data_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns for each document."""
    found = sanitise(pick(docs, doc_id="doc_id", text="text"), with_text=False)
    return found.select("doc_id", *(f"n_{k}" for k in KINDS), F.sha2("base_spans", 256).alias("base_sha256"), "spans")
