"""Benchmark decontamination by Wu-Manber search over words.

The windows of the test items are the patterns; words are the symbols and two consecutive words a block. For each
length of pattern, a shift table tells for each block how far the search may jump, and a block that ends patterns leads
to a bucket of them, told apart by their first block and confirmed by direct comparison of all words.
"""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALNUM_LOWER, Stage, added, in_passes, pick, picked

WINDOW = 10
#: Windows of items in one table; more are searched by further passes, one after the other.
PATTERNS_A_PASS = 400_000


def words_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and all that is not ASCII, lower-cased from A to Z."""
    return (text or "").encode("utf-8", "surrogatepass").translate(ALNUM_LOWER).split()


class WuManber:
    """Finds all occurrences of word sequences of one length."""

    def __init__(self, patterns: dict[tuple[bytes, ...], list[str]]):
        self.m = m = len(next(iter(patterns)))
        self.block = b = min(2, m)
        self.most = m - b + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.bucket: dict[tuple[bytes, ...], dict[tuple[bytes, ...], dict]] = defaultdict(dict)
        for p, items in patterns.items():
            for end in range(b, m + 1):
                key = p[end - b : end]
                self.shift[key] = min(self.shift.get(key, self.most), m - end)
            self.bucket[p[m - b :]].setdefault(p[:b], {})[p] = items

    def find(self, words: list[bytes]):
        """(start, items) of each occurrence, in order."""
        m, b, most, shift, bucket = self.m, self.block, self.most, self.shift.get, self.bucket
        at, n = m, len(words)
        while at <= n:
            key = tuple(words[at - b : at])
            step = shift(key, most)
            if step:
                at += step
                continue
            start = at - m
            if same := bucket[key].get(tuple(words[start : start + b])):
                if (items := same.get(tuple(words[start:at]))) is not None:
                    yield start, items
            at += 1


def patterns_of(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(item_id, pattern): the distinct windows of each item; a shorter item that has words is one window."""

    def rows(batches):
        for batch in batches:
            ids, found = [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text)
                for p in {b" ".join(words[k : k + window]) for k in range(max(1, len(words) - window + 1))} - {b""}:
                    ids.append(i)
                    found.append(p)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(found, pa.binary())], ["item_id", "pattern"])

    items = picked(benchmark, item_id=(id_col, "string"), text=(text_col, "string")).where("item_id is not null")
    return items.mapInArrow(rows, "item_id string, pattern binary").distinct()


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, patterns_a_pass: int = PATTERNS_A_PASS) -> DataFrame:
    """docs with four more columns at its end, n_words, n_hit (words inside any occurrence of a window of an item), item_ids (of the items that occur, as sorted strings) and hit_spans (merged runs of hit words, as arrays of start and end).

    Null and empty texts have no words and no hits, items with neither never occur, rows and items may repeat, and an
    item without id is no item. A column of docs that bears one of the new names keeps its place; callers tell them by
    position. The items' windows go to the tasks by broadcast, patterns_a_pass of (window, item) at most at once: if
    there are more, each pass's hits are written before the next one begins, and meet by row at the end.
    """
    stage = Stage(docs.sparkSession, "patterns")
    patterns = stage.table(patterns_of(benchmark, item_id_col, item_text_col, window))
    passes = max(1, -(-patterns.count() // patterns_a_pass))
    at, kept = docs.columns.index(text_col), len(docs.columns)

    def table(k: int) -> list[tuple[bytes, list[str]]]:
        part = patterns.where(F.pmod(F.xxhash64("pattern", "item_id"), F.lit(passes)) == k) if passes > 1 else patterns
        return [(bytes(r[0]), r[1]) for r in part.groupBy("pattern").agg(F.collect_list("item_id")).toLocalIterator()]

    spans = T.ArrayType(T.ArrayType(T.LongType()))
    schema = added(docs, ("n_words", T.LongType()), ("n_hit", T.LongType()), ("item_ids", T.ArrayType(T.StringType())), ("hit_spans", spans))
    if passes == 1:
        return docs.mapInArrow(_told(at, kept, docs.sparkSession.sparkContext.broadcast(table(0))), schema)
    found = in_passes(stage, docs, at, map(table, range(passes)), _search, spans="array<array<long>>", items="array<string>")
    return found.mapInArrow(_told(at, kept, None), schema)


def engines_of(table: list[tuple[bytes, list[str]]]) -> list[WuManber]:
    by_length: dict[int, dict[tuple[bytes, ...], list[str]]] = defaultdict(dict)
    for p, items in table:
        words = tuple(p.split(b" "))
        by_length[len(words)][words] = items
    return [WuManber(v) for _, v in sorted(by_length.items())]


def occurrences(engines: list[WuManber], words: list[bytes]) -> tuple[list[list[int]], list[str]]:
    """(spans of words, items) of all occurrences."""
    spans, items = [], []
    for engine in engines:
        for start, found in engine.find(words):
            spans.append([start, start + engine.m])
            items += found
    return spans, items


def _search(table):
    def run(batches):
        engines = engines_of(table.value)
        for batch in batches:
            found = [occurrences(engines, words_of(x.as_py())) for x in batch.column(1)]
            some = [i for i, (spans, _) in enumerate(found) if spans]
            columns = [pa.array([found[i][0] for i in some], pa.list_(pa.list_(pa.int64()))), pa.array([sorted(set(found[i][1])) for i in some], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(some, pa.int64())), *columns], ["row", "spans", "items"])

    return run


def _told(at: int, kept: int, table):
    """The new columns of each row, from what the broadcast table's engines find or else from what passes found before."""

    def run(batches):
        engines = engines_of(table.value) if table else []
        for batch in batches:
            before = [(a or [], b or []) for a, b in zip(batch.column(kept).to_pylist(), batch.column(kept + 1).to_pylist(), strict=True)] if not table else None
            counts, hits, items_out, spans_out = [], [], [], []
            for i, value in enumerate(batch.column(at)):
                words = words_of(value.as_py())
                spans, items = before[i] if before else occurrences(engines, words)
                merged: list[list[int]] = []
                for s, e in sorted(spans):
                    if merged and s <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], e)
                    else:
                        merged.append([s, e])
                counts.append(len(words))
                hits.append(sum(e - s for s, e in merged))
                spans_out.append(merged)
                items_out.append(sorted(set(items)))
            new = [pa.array(counts, pa.int64()), pa.array(hits, pa.int64()), pa.array(items_out, pa.list_(pa.string())), pa.array(spans_out, pa.list_(pa.list_(pa.int64())))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:kept], *new], [f"c{i}" for i in range(kept + len(new))])

    return run


def contamination_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's columns for each document."""
    found = decontaminate(pick(docs, doc_id="doc_id", text="text"), benchmark)
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
