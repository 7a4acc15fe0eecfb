"""Substring deduplication with automata of repeated phrases.

Candidate passages come from anchors: the least of the short phrases in each window, which equal windows share. Windows
with an anchor of two documents are grouped by two 64-bit hashes of their words; runs of windows that two documents have
are passages of the first one. Passages are sharded, long ones over several shards, the phrases at regular places in
them compiled to Aho-Corasick automata with pyahocorasick, and every document that shares a window with a shard is
streamed through its automaton; each window around a hit is confirmed by comparing its words with the passage. A
document whose words are a copy of another's is streamed once, by its first row, and loses all in the others.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Stage, mixed, ngram_hashes, picked, powers, word_hashes

WINDOW, ANCHOR = 50, 8
#: Words of passages in one automaton, and documents of one task of a shard.
SHARD_WORDS, TASK_DOCS = 200_000, 400
#: Words of one document after which its passages may go to another shard.
PART_WORDS = 50_000


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def hashes_of(words: list[bytes]) -> np.ndarray:
    return word_hashes(b" ".join(words))[0]


def window_hashes(hashes: np.ndarray, window: int) -> np.ndarray:
    """The hash of each run of `window` words, by differences of one prefix sum."""
    n = len(hashes) - window + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    up, down = powers(len(hashes) + 1)
    with np.errstate(over="ignore"):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * up[: len(hashes)], dtype=np.uint64)))
        return mixed((total[window:] - total[:n]) * down[:n])


def window_anchors(hashes: np.ndarray, window: int, anchor: int) -> np.ndarray:
    """The least phrase hash in each window."""
    if len(hashes) < window:
        return np.zeros(0, np.uint64)
    return np.lib.stride_tricks.sliding_window_view(ngram_hashes(hashes, anchor), window - anchor + 1).min(1)


def runs(starts: np.ndarray, width: int) -> list[tuple[int, int]]:
    """The stretches that intervals of one width from sorted starts cover."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    return list(zip(starts[np.concatenate(([0], cut + 1))].tolist(), (starts[np.concatenate((cut, [len(starts) - 1]))] + width).tolist(), strict=True))


class Phrases:
    """An automaton of the phrases at every half window of the passages, and the passages' windows by hash."""

    def __init__(self, passages: list[tuple[int, list[bytes]]], window: int):
        import ahocorasick

        self.window, self.passages, self.step = window, passages, max(1, window // 2)
        self.size = max(1, self.step // 2)
        self.at: dict[int, list[tuple[int, int]]] = {}
        self.automaton = ahocorasick.Automaton()
        for k, (_, words) in enumerate(passages):
            for i, h in enumerate(window_hashes(hashes_of(words), window).tolist()):
                self.at.setdefault(h, []).append((k, i))
            for i in range(0, len(words) - self.size + 1, self.step):
                self.automaton.add_word((b" " + b" ".join(words[i : i + self.size]) + b" ").decode("latin-1"), True)
        self.automaton.make_automaton()

    def found(self, doc: int, words: list[bytes]) -> np.ndarray:
        """Starts of the windows of words that are windows of a passage of a document with a smaller id."""
        n, window = len(words) - self.window + 1, self.window
        text = b" " + b" ".join(words) + b" "
        ends = np.cumsum([1 + len(w) for w in words])  # the space after each word
        near = np.zeros(len(words) + 1, np.int64)
        for end, _ in self.automaton.iter(text.decode("latin-1")):
            last = int(np.searchsorted(ends, end))
            first = last - self.size + 1
            near[max(0, last - window + 1)] += 1
            near[min(n, first + 1)] -= 1
        places = np.flatnonzero(np.cumsum(near)[:n] > 0)
        if not len(places):
            return places
        hashes = window_hashes(hashes_of(words), window)
        out = []
        for i in places.tolist():
            for k, at in self.at.get(int(hashes[i]), ()):
                first, own = self.passages[k]
                if first < doc and own[at : at + window] == words[i : i + window]:
                    out.append(i)
                    break
        return np.array(out, np.int64)


def phrase_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR, shard_words: int = SHARD_WORDS, task_docs: int = TASK_DOCS, part_words: int = PART_WORDS, with_text: bool = True) -> DataFrame:
    """A row for each row of docs: doc_id, n_words, n_removed, kept_sha256 (of the kept words, joined by one space), removed (merged runs of removed words, as arrays of start and end) and, if wanted, changed_text (the kept words; null where none is removed).

    Removed is each word inside a run of `window` words that also occurs in a document with a smaller id, judged on the
    input. Null and empty texts have no words; texts shorter than a window lose none; equal texts lose all but in the
    row with the least id (rows that repeat that id keep theirs); a null id loses nothing and takes nothing. Extra
    columns are ignored; an empty table gives an empty result.
    """
    stage = Stage(docs.sparkSession, "phrases")
    base = picked(docs, doc_id=(id_col, "long"), text=(text_col, "string"))

    def outlined(batches):
        for batch in batches:
            n, digests, anchors = [], [], []
            for text in batch.column(1):
                words = words_of(text.as_py())
                n.append(len(words))
                digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
                anchors.append(np.unique(window_anchors(hashes_of(words), window, anchor)).astype(np.int64) if len(words) >= window else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(digests, pa.string()), pa.array(anchors, pa.list_(pa.int64()))], ["doc_id", "n_words", "digest", "anchors"])

    outline = stage.table(base.mapInArrow(outlined, "doc_id long, n_words long, digest string, anchors array<long>"))
    able = outline.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= window))
    firsts = stage.table(able.groupBy("digest").agg(F.min(F.struct("doc_id", "anchors")).alias("x")).select("digest", F.col("x.doc_id").alias("doc_id"), "x.anchors"))
    anchored = firsts.select("digest", "doc_id", F.explode("anchors").alias("anchor"))
    recurring = stage.table(anchored.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("anchor"))
    suspects = stage.table(anchored.join(recurring, "anchor").groupBy("doc_id", "digest").agg(F.collect_list("anchor").alias("anchors")))
    stage.drop(recurring)

    def same_text(batches):  # an id may repeat with another text
        for batch in batches:
            keep = [hashlib.sha256(b" ".join(words_of(t.as_py()))).hexdigest() == d.as_py() for t, d in zip(batch.column(1), batch.column(3), strict=True)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    texts = base.join(suspects, "doc_id").select("doc_id", "text", "anchors", "digest").mapInArrow(same_text, "doc_id long, text string, anchors array<long>, digest string")
    texts = stage.table(texts.dropDuplicates(["doc_id", "digest"]))

    # Whole windows with a recurring anchor, confirmed where two documents have them.
    def windows(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                b, found = batch.slice(k, 64), []
                for doc, text, own in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                    hashes = hashes_of(words_of(text))
                    at = np.flatnonzero(np.isin(window_anchors(hashes, window, anchor), np.array(own, np.int64).astype(np.uint64)))
                    h, first = np.unique(window_hashes(hashes, window)[at].astype(np.int64), return_index=True)
                    other = window_hashes(mixed(hashes ^ np.uint64(0x5851F42D4C957F2D)), window)[at[first]].astype(np.int64)
                    found.append((h, other, np.full(len(h), doc), at[first]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], ["h", "g", "doc_id", "at"])

    seen = texts.mapInArrow(windows, "h long, g long, doc_id long, at long")
    confirmed = stage.table(seen.groupBy("h", "g").agg(F.min(F.struct("doc_id", "at")).alias("first"), F.max("doc_id").alias("last")).where("first.doc_id < last").select("h", "g", F.col("first.doc_id").alias("first"), F.col("first.at").alias("at")))
    sources = stage.table(confirmed.groupBy(F.col("first").alias("doc_id")).agg(F.collect_list("at").alias("starts")))

    def passages(batches):
        for batch in batches:
            ids, parts, sizes, found = [], [], [], []
            for doc, text, starts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words, starts = words_of(text), np.unique(starts)
                for part in np.unique(starts // part_words).tolist():
                    for a, b in runs(starts[starts // part_words == part], window):
                        ids.append(doc)
                        parts.append(part)
                        sizes.append(b - a)
                        found.append(b" ".join(words[a:b]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(parts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(found, pa.binary())], ["doc_id", "place", "size", "passage"])

    phrases = stage.table(texts.join(sources, "doc_id").select("doc_id", "text", "starts").mapInArrow(passages, "doc_id long, place long, size long, passage binary"))
    total = phrases.agg(F.sum("size")).first()[0] or 0
    shards = max(1, -(-total // shard_words))
    shard_of = lambda doc, place: F.pmod(F.xxhash64(doc, place), F.lit(shards))

    # Each document goes to the shards that hold a window of it, and crowded shards are dealt to several tasks.
    owners = confirmed.select("h", "g", "first", F.expr(f"at div {part_words}").alias("place"))
    routed = stage.table(seen.join(owners, ["h", "g"]).where("doc_id > first").select("doc_id", shard_of("first", "place").alias("shard")).distinct())
    crowds = stage.table(routed.groupBy("shard").agg(F.ceil(F.count("*") / F.lit(float(task_docs))).cast("long").alias("parts")))
    visits = routed.join(crowds, "shard").select("doc_id", "shard", F.pmod(F.xxhash64("doc_id", "shard"), F.col("parts")).alias("part"))
    documents = texts.select("doc_id", F.col("text").cast("binary").alias("data")).join(visits, "doc_id").select("shard", "part", F.lit(1).alias("kind"), "doc_id", "data")
    patterns = phrases.withColumn("shard", shard_of("doc_id", "place")).join(crowds, "shard").select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"), "doc_id", F.col("passage").alias("data"))

    def streamed(batches):
        key, own, engine = None, [], None
        for batch in batches:
            ids, spans = [], []
            for shard, part, kind, doc, data in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if (shard, part) != key:
                    key, own, engine = (shard, part), [], None
                if kind == 0:
                    own.append((doc, data.split(b" ")))
                    continue
                engine = engine or Phrases(own, window)
                if found := runs(engine.found(doc, data.split()), window):
                    ids.append(doc)
                    spans.append([list(x) for x in found])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64())))], ["doc_id", "spans"])

    both = documents.unionByName(patterns).repartition("shard", "part").sortWithinPartitions("shard", "part", "kind")
    hits = stage.table(both.mapInArrow(streamed, "doc_id long, spans array<array<long>>").groupBy("doc_id").agg(F.flatten(F.collect_list("spans")).alias("spans")))

    def cleaned(batches):
        for batch in batches:
            rows = []
            for doc, digest, text, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = words_of(text)
                gone = np.zeros(len(words), bool)
                for a, b in spans:
                    gone[a:b] = True
                kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
                edge = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
                rows.append((doc, digest, int(gone.sum()), hashlib.sha256(kept).hexdigest(), edge.reshape(-1, 2).tolist(), kept.decode("utf-8", "surrogatepass") if with_text else None))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64())), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 6, kinds, strict=True)], ["doc_id", "digest", "n_removed", "kept_sha256", "removed", "kept_text"])

    changed = stage.table(texts.join(hits, "doc_id").select("doc_id", "digest", "text", "spans").mapInArrow(cleaned, "doc_id long, digest string, n_removed long, kept_sha256 string, removed array<array<long>>, kept_text string"))
    least = firsts.select("digest", F.col("doc_id").alias("first"))
    rows = outline.select("doc_id", "n_words", "digest").join(least, "digest", "left").join(changed, ["doc_id", "digest"], "left")
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    whole = F.array(F.array(F.lit(0).cast("long"), F.col("n_words")))
    out = rows.select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "digest")).alias("kept_sha256"),
        F.when(copy, whole).otherwise(F.coalesce("removed", F.array().cast(T.ArrayType(T.ArrayType(T.LongType()))))).alias("removed"),
        *([F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("changed_text")] if with_text else []),
    )
    return out


def repeated_phrase_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns for each document."""
    return phrase_duplicates(docs, with_text=False).drop("removed")
