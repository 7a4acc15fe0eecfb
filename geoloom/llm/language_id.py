"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies are counted over all training rows; weights are learned by follow-the-regularised-leader with an
elastic net from a bounded, hash-chosen sample of them, and a temperature makes the scores honest on a part of that
sample kept apart. The model is of a fixed size and goes to the tasks by broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import added, pick, picked

BUCKETS, ORDERS = 1 << 15, (1, 2, 3)
#: Rows of each language that the weights are learned from, in expectation (twice as many at most), and languages of one model: more raise an error, as none may be left out.
SAMPLE_A_LANGUAGE, LANGUAGES = 800, 512
#: Bytes of features of the whole sample, in expectation; each language has an equal share of them.
SAMPLE_BYTES = 128 << 20
UNKNOWN = "und"


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """(buckets of the text's character n-grams, in order; how often each occurs), or None if it has no letters. What is not a letter counts as one space."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return None
    codes = np.where(letter, codes, 32)
    codes = codes[letter | np.concatenate(([True], letter[:-1]))]
    codes = np.concatenate(([32], codes, [32])).astype(np.uint64)
    hashes = []
    for order in ORDERS:
        h = np.full(max(0, len(codes) - order + 1), order, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(order):
                h = (h ^ codes[k : k + len(h)]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(32)
        hashes.append((h & np.uint64(BUCKETS - 1)).astype(np.int64))
    every = np.concatenate(hashes)
    if len(every) < BUCKETS // 4:  # sorting the few is cheaper than a pass over all buckets
        return np.unique(every, return_counts=True)
    counts = np.bincount(every, minlength=BUCKETS)
    at = np.flatnonzero(counts)
    return at, counts[at]


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def vector(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts) * self.idf[at]
        return x / max(np.linalg.norm(x), 1e-12)

    def logits(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.vector(at, counts) @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        found = features(text)
        if found is None or not self.languages:
            return UNKNOWN, 0.0
        p = softmax(self.logits(*found) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def follow_leader(model: LanguageModel, rows: list, epochs: int, alpha: float, beta: float, l1: float, l2: float) -> None:
    """FTRL-proximal with a rate for each weight; l1 keeps rare weights at zero, l2 the rest small."""
    k = len(model.languages)
    z, n, zb, nb = np.zeros((BUCKETS, k)), np.zeros((BUCKETS, k)), np.zeros(k), np.zeros(k)

    def weights(z, n):
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))

    for epoch in range(epochs):
        for i in np.random.default_rng(epoch).permutation(len(rows)):
            y, at, x = rows[i]
            w, b = weights(z[at], n[at]), weights(zb, nb)
            error = softmax(x @ w + b)
            error[y] -= 1
            for g, w_, z_, n_, where in ((x[:, None] * error, w, z, n, at), (error, b, zb, nb, slice(None))):
                old = n_[where]
                z_[where] += g - (np.sqrt(old + g * g) - np.sqrt(old)) / alpha * w_
                n_[where] = old + g * g
    model.weights, model.bias = weights(z, n), weights(zb, nb)


def calibrated(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least cross entropy, by golden section on its logarithm."""
    if not len(labels):
        return 1.0
    loss = lambda t: -np.log(softmax(logits / np.exp(t))[np.arange(len(labels)), labels] + 1e-12).mean()
    low, high, r = -4.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - r * (high - low), low + r * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit_language_model(train: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE_A_LANGUAGE, sample_bytes: int = SAMPLE_BYTES, epochs: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.5) -> LanguageModel:
    """Learns from the rows of train whose label is not null and whose text has letters; rows that repeat an id and a label count once among the sampled ones. A label's share of rows is such that neither the sample's rows nor its bytes are more than given, in expectation: of very long texts fewer are taken."""
    rows = picked(train, doc_id=(id_col, "string"), text=(text_col, "string"), lang=(lang_col, "string")).where("lang is not null and text is not null")
    top = rows.groupBy("lang").count().limit(LANGUAGES + 1).collect()
    if len(top) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} different labels: give a table of languages, or raise LANGUAGES if the driver has the memory")
    languages = sorted(r["lang"] for r in top)
    index = {x: i for i, x in enumerate(languages)}

    def frequencies(batches):
        seen, n, pairs = np.zeros(BUCKETS, np.int64), 0, np.zeros(len(languages), np.int64)
        for batch in batches:
            for text, lang in zip(*batch.columns, strict=True):
                if found := features(text.as_py()):
                    seen[found[0]] += 1
                    n += 1
                    pairs[index[lang.as_py()]] += len(found[0])
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate((at, [-1], -2 - np.arange(len(languages))))), pa.array(np.concatenate((seen[at], [n], pairs)))], ["bucket", "n"])

    counts = {r["bucket"]: r["n"] for r in rows.select("text", "lang").mapInArrow(frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()}  # BUCKETS + LANGUAGES + 1 rows at most
    pairs = {x: counts.pop(-2 - i, 0) for x, i in index.items()}
    idf = np.zeros(BUCKETS)
    n = counts.pop(-1, 0)
    for bucket, df in counts.items():
        idf[bucket] = np.log((1 + n) / (1 + df)) + 1
    model = LanguageModel(languages, idf, np.zeros((BUCKETS, len(languages))), np.zeros(len(languages)))
    if not languages:
        return model

    enough = {r["lang"]: min(1.0, sample / r["count"], sample_bytes / len(languages) / (8 * max(1, pairs[r["lang"]]))) for r in top}
    share = F.element_at(F.create_map(*(F.lit(v) for item in enough.items() for v in item)), F.col("lang"))
    chosen = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < share * 1_000_003)
    chosen = chosen.groupBy("doc_id", "lang").agg(F.min("text").alias("text")).select("doc_id", "text", "lang").limit(2 * sample * len(languages))

    def encoded(batches):
        for batch in batches:
            out = [(i, lang, at.astype("<u4").tobytes(), c.astype("<u4").tobytes()) for i, text, lang in zip(*(c.to_pylist() for c in batch.columns), strict=True) if (found := features(text)) for at, c in [found]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 4, (pa.string(), pa.string(), pa.binary(), pa.binary()), strict=True)], ["doc_id", "lang", "at", "counts"])

    learn, check = [], []
    for r in sorted(chosen.mapInArrow(encoded, "doc_id string, lang string, at binary, counts binary").collect(), key=lambda r: (r["doc_id"] or "", r["lang"], bytes(r["at"]))):
        at, c = np.frombuffer(r["at"], "<u4").astype(np.int64), np.frombuffer(r["counts"], "<u4")
        (check if len(learn) + len(check) and (len(learn) + len(check)) % 5 == 0 else learn).append((index[r["lang"]], at, model.vector(at, c)))
    follow_leader(model, learn, epochs, alpha, beta, l1, l2)
    if check:
        model.temperature = calibrated(np.array([x @ model.weights[at] + model.bias for _, at, x in check]), np.array([y for y, _, _ in check]))
    return model


def predict_language(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """docs with two more columns at its end, lang_pred and score (the calibrated chance of that language; 0 where lang_pred is 'und': texts that are null or have no letters)."""
    at, shared = docs.columns.index(text_col), docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            found = [shared.value.predict(x.as_py()) for x in batch.column(at)]
            lang, score = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())], [f"c{i}" for i in range(batch.num_columns + 2)])

    return docs.mapInArrow(run, added(docs, ("lang_pred", T.StringType()), ("score", T.DoubleType())))


def held_out_share(id_col: str, parts: int, part: int):
    """Whether a row is held out: by the checksum of its id as text. A null id never is."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(parts)) == part, F.lit(False))


def language_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns for each document: languages are learned from the rows not held out. Rows may repeat, other columns clash; an empty table gives an empty result."""
    base = pick(docs, doc_id="doc_id", text="text", lang="lang")
    model = fit_language_model(base.where("doc_id is not null").where(~held_out_share("doc_id", 4, 2)))
    return predict_language(base.select("doc_id", "text"), model).select("doc_id", held_out_share("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")
