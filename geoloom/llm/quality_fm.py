"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

The score adds a weight for each feature and, for each pair of them, the product of two short vectors; by the identity
half of (squared sum minus sum of squares) all pairs cost as much as one pass. It is learned from a bounded,
hash-chosen sample of labelled rows and goes to the tasks by broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACES, added, chunks, pick, picked, word_hashes
from .language_id import held_out_share

WORDS, BINS = 1 << 15, 16
STATISTICS = ("words", "bytes", "word_length", "upper", "digit", "symbol", "stop", "not_ascii", "blank", "repeat", "distinct", "top_word", "lines", "same_lines", "line_length", "declared_length")
SIZE = WORDS + BINS * len(STATISTICS)
#: Labelled rows to learn from, in expectation; a hard limit twice as high bounds what is broadcast.
SAMPLE, FACTORS = 8000, 8
THRESHOLD = 0.3

# Kinds of bytes counted.
KINDS = {
    "upper": range(65, 91), "digit": range(48, 58), "symbol": [ord(c) for c in "#$%&*+<=>@\\^_`{|}~/[]()"], "stop": [ord(c) for c in "!?"], "not_ascii": range(128, 256), "blank": [9, 10, 11, 12, 13, 32],
}
_FLAGS = {k: np.isin(np.arange(256), list(v)) for k, v in KINDS.items()}


def features(texts: list[str | None], declared: list[int | None]):
    """For each text: (feature numbers, their values). Words are told by hash, with equal values of norm 1 for each text; each statistic and the declared length is a bin with value 1."""
    for low, data, first, last in chunks(texts, bytes(range(256))):
        codes = np.frombuffer(data, np.uint8)
        sums = {k: np.concatenate(([0], np.cumsum(f[codes]))) for k, f in _FLAGS.items()}
        words, start, end = word_hashes(data.translate(SPACES))
        a, b = np.searchsorted(start, first), np.searchsorted(start, last)
        same = np.concatenate(([False], words[1:] == words[:-1]))
        for i, (f, e, u, v) in enumerate(zip(first, last, a, b, strict=True)):
            n, size, own = v - u, e - f, words[u:v]
            found, times = np.unique(own, return_counts=True)
            lines = bytes(data[f:e]).split(b"\n")
            part = {k: (s[e] - s[f]) / max(size, 1) for k, s in sums.items()}
            length = declared[low + i]
            values = [
                np.log2(n + 1) / 20, np.log2(size + 1) / 28, (end[u:v] - start[u:v]).sum() / max(n, 1) / 20, part["upper"], part["digit"], part["symbol"], part["stop"], part["not_ascii"], part["blank"],
                same[u + 1 : v].sum() / max(n, 1), len(found) / max(n, 1), times.max(initial=0) / max(n, 1), np.log2(len(lines)) / 14, 1 - len(set(lines)) / len(lines), np.log2(size / len(lines) + 1) / 16, np.log2(max(length or 0, 0) + 1) / 28,
            ]
            bins = np.minimum(BINS - 1, (np.sqrt(np.clip(values, 0, 1)) * BINS).astype(np.int64))
            at = np.unique((found & np.uint64(WORDS - 1)).astype(np.int64))
            yield np.concatenate((at, WORDS + np.arange(len(STATISTICS)) * BINS + bins)), np.concatenate((np.full(len(at), 1 / np.sqrt(max(len(at), 1))), np.ones(len(STATISTICS))))


@dataclass
class FactorisationMachine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def margin(self, at: np.ndarray, x: np.ndarray) -> float:
        v = self.factors[at] * x[:, None]
        return float(self.bias + self.weights[at] @ x + 0.5 * (v.sum(0) ** 2 - (v * v).sum(0)).sum())

    def score(self, at: np.ndarray, x: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.margin(at, x), -30, 30))))


def learned(rows: list[tuple[int, np.ndarray, np.ndarray]], factors: int, epochs: int, rate: float, l2: float, seed: int = 7) -> FactorisationMachine:
    """By AdaGrad on the logistic loss."""
    random = np.random.default_rng(seed)
    share = np.clip(np.mean([y for y, _, _ in rows]), 0.01, 0.99) if rows else 0.5
    m = FactorisationMachine(float(np.log(share / (1 - share))), np.zeros(SIZE), random.normal(0, 0.02, (SIZE, factors)))
    gw, gv, gb = np.full(SIZE, 1e-2), np.full((SIZE, factors), 1e-2), 1e-2
    for _ in range(epochs):
        for i in random.permutation(len(rows)):
            y, at, x = rows[i]
            v = m.factors[at]
            total = x @ v
            error = m.score(at, x) - y
            g = error * x + l2 * m.weights[at]
            h = error * (x[:, None] * total - (x * x)[:, None] * v) + l2 * v
            gb += error * error
            gw[at] += g * g
            gv[at] += h * h
            m.bias -= rate * error / gb**0.5
            m.weights[at] -= rate * g / np.sqrt(gw[at])
            m.factors[at] -= rate * h / np.sqrt(gv[at])
    return m


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", length_col: str | None = "n_chars", sample: int = SAMPLE, factors: int = FACTORS, epochs: int = 6, rate: float = 0.05, l2: float = 1e-4) -> FactorisationMachine:
    """Learns from labels (by id_col; null labels are none, a row labelled twice has the mean) joined to docs. Only the sampled ids, 2 * sample at most, are broadcast."""
    known = picked(labels, doc_id=(id_col, "string"), y=(label_col, "double")).where("doc_id is not null and y is not null")
    n = known.count()
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < min(1.0, sample / max(n, 1)) * 1_000_003).groupBy("doc_id").agg(F.avg("y").alias("y")).limit(2 * sample)
    columns = {"doc_id": (id_col, "string"), "text": (text_col, "string")} | ({"length": (length_col, "long")} if length_col else {})
    texts = picked(docs, **columns)
    texts = texts if length_col else texts.withColumn("length", F.lit(None).cast("long"))

    def encoded(batches):
        for batch in batches:
            ids, text, length, y = (batch.column(i).to_pylist() for i in range(4))
            found = list(features(text, length))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(y, pa.float64()), pa.array([a.astype("<u4").tobytes() for a, _ in found], pa.binary()), pa.array([x.astype("<f4").tobytes() for _, x in found], pa.binary())], ["doc_id", "y", "at", "x"])

    one = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min(F.struct("text", "length", "y")).alias("d")).select("doc_id", "d.*")
    rows = one.mapInArrow(encoded, "doc_id string, y double, at binary, x binary").collect()
    rows = [(int(r["y"] >= 0.5), np.frombuffer(r["at"], "<u4").astype(np.int64), np.frombuffer(r["x"], "<f4").astype(float)) for r in sorted(rows, key=lambda r: r["doc_id"])]
    return learned(rows, factors, epochs, rate, l2)


def score_quality(docs: DataFrame, model: FactorisationMachine, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """docs with one more column at its end, score: the chance of label 1, for null (empty) texts too."""
    at, length_at = docs.columns.index(text_col), docs.columns.index(length_col) if length_col else None
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            length = batch.column(length_at).to_pylist() if length_at is not None else [None] * batch.num_rows
            scores = [shared.value.score(*x) for x in features(batch.column(at).to_pylist(), length)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [f"c{i}" for i in range(batch.num_columns + 1)])

    return docs.mapInArrow(run, added(docs, ("score", T.DoubleType())))


def quality_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The contract's columns for each document, learned from the labels of rows not held out. Rows may repeat, other columns clash; an empty table gives an empty result, no labels a score of 0.5."""
    base = pick(docs, doc_id="doc_id", text="text", n_chars="n_chars")
    base = base.withColumn("n_chars", F.col("n_chars").cast("long"))
    known = pick(labels, doc_id="doc_id", quality="quality").where("doc_id is not null").where(~held_out_share("doc_id", 5, 0))
    model = fit_quality(base, known)
    return score_quality(base, model).select("doc_id", held_out_share("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
