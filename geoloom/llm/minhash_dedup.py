"""MinHash near-duplicates with tensored banding.

Each text has two small collections of half keys, each half key made of a few minhashes; a table key is a pair of one
from either collection, so 2 * m half keys give m * m tables. Texts of the same words are one representative. In each bucket the representatives are compared with the one that meets most others, round by round,
and what is still in different components then is compared in full; every link is confirmed on the full sets.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER_SPACES, Stage, added, chunks, ngram_hashes, picked, released, word_hashes
from .components import connected_components

SHINGLE, PERCENT = 5, 80
#: Half keys of either collection, and minhashes of each half key.
HALVES, ROWS = 10, 3
#: Rounds of stars at most before the remaining pairs are compared in full, which also begins when they are fewer than so many for each bucket row.
STAR_ROUNDS, FULL_PAIRS = 2, 2
#: Members of a bucket compared at once; larger buckets are dealt into blocks of about as many.
BLOCK = 256
#: Bits of a parity sketch.
SKETCH_BITS = 4096


def shingles(text: str | None, size: int) -> set[tuple[bytes, ...]]:
    """The distinct runs of `size` words; the whole sequence as one if there are fewer; none without words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER_SPACES).split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def words_digest(text: str | None) -> bytes | None:
    """The digest of a text's words; texts that have the same are copies. None without words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER_SPACES).split()
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest() if words else None


def sketch_rows(texts: list[str | None], size: int, halves: int, rows: int):
    """For each text: (number of shingles, digest of its words or None, half keys of the one and of the other collection)."""
    seeds = np.random.default_rng(20240607).integers(0, 1 << 63, (2, 2 * halves * rows), np.int64).astype(np.uint64)
    for at_text, data, low, high in chunks(texts, LOWER_SPACES):
        words, start, _ = word_hashes(data)
        first, last = np.searchsorted(start, low), np.searchsorted(start, high)
        all_ = ngram_hashes(words, size)
        sets = []
        for f, e in zip(first, last, strict=True):
            x = all_[f : e - size + 1] if e - f >= size else ngram_hashes(words[f:e], e - f) if e > f else words[:0]
            sets.append(np.unique(x))
        counts = np.array([len(x) for x in sets])
        full = np.flatnonzero(counts)
        keys = np.zeros((len(sets), 2 * halves), np.uint64)
        if len(full):
            joined, at = np.concatenate([sets[i] for i in full]), np.concatenate(([0], np.cumsum(counts[full])[:-1]))
            for k in range(2 * halves * rows):
                with np.errstate(over="ignore"):
                    value = (joined ^ seeds[0, k]) * (seeds[1, k] | np.uint64(1))
                    value ^= value >> np.uint64(32)
                    low_ = np.minimum.reduceat(value, at)
                    keys[full, k // rows] = (keys[full, k // rows] * np.uint64(0x9FB21C651E98DF25)) ^ low_
        for i, (n, k) in enumerate(zip(counts.tolist(), keys.astype(np.int64), strict=True)):
            yield n, words_digest(texts[at_text + i]), k[:halves], k[halves:]


def sketches(docs: DataFrame, size: int, halves: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, digest, one, two."""

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                n, digest, one, two = zip(*sketch_rows(part.column(1).to_pylist(), size, halves, rows), strict=True)
                keys = [pa.array([x.tolist() for x in side], pa.list_(pa.int64())) for side in (one, two)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), *keys], ["doc_id", "n_shingles", "digest", "one", "two"])

    return docs.mapInArrow(released(run), "doc_id long, n_shingles long, digest binary, one array<long>, two array<long>")


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Those pairs (a, b) whose sets overlap enough. texts: rep and text of all that are paired."""

    def run(batches):
        last, known = None, set()
        for batch in batches:
            a, b, text_a, text_b = batch.columns
            keep = []
            for i in range(batch.num_rows):
                if a[i] != last:
                    last, known = a[i], shingles(text_a[i].as_py(), size)
                other = shingles(text_b[i].as_py(), size)
                both = len(known & other)
                keep.append(bool(known and other) and 100 * both >= percent * (len(known) + len(other) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], ["a", "b"])

    with_a = pairs.join(texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a")), "a")
    with_b = with_a.join(texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b")), "b")
    return with_b.select("a", "b", "text_a", "text_b").mapInArrow(released(run), "a long, b long")


def table_keys(reps: DataFrame, m: int) -> DataFrame:
    """(rep, n, key): each representative under those of its table keys of which another one has either half too."""
    halves = reps.select("rep", F.col("n_shingles").cast("int").alias("n"), F.posexplode(F.concat("one", "two")).alias("slot", "half"))
    shared = halves.groupBy("slot", "half").agg(F.count("*").alias("members")).where("members > 1").select("slot", "half")
    alive = halves.join(shared, ["slot", "half"]).groupBy("rep", "n").agg(F.collect_list(F.struct("slot", "half")).alias("halves"))  # as many as there are half keys at most
    pairs = F.expr(f"flatten(transform(filter(halves, x -> x.slot < {m}), x -> transform(filter(halves, y -> y.slot >= {m}), y -> xxhash64(x.slot, y.slot, x.half, y.half))))")
    return alive.select("rep", "n", F.explode(pairs).alias("key"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT, halves: int = HALVES, rows: int = ROWS) -> DataFrame:
    """A row for each row of docs: doc_id, n_shingles, component_id (the least id reachable by links), kept (whether that is its own).

    A link joins texts with 100 * intersection >= percent * union of their sets of shingles (runs of `size` words, ASCII
    letters lower-cased; fewer words are one shingle). Texts that are null or without words link with nothing, as does a
    null id, whose component is null. Rows that repeat an id with another text are told apart: each has the component of
    its text. Extra columns are ignored; an empty table gives an empty result. What tensoring cannot meet in any table is
    lost: with the defaults one in some hundreds of the pairs just at the threshold, and hardly any above 85 percent.
    """
    return _near(picked(docs, doc_id=(id_col, "long"), text=(text_col, "string")), size, percent, halves, rows).drop("digest", "component")


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """docs with one row of each group of near-duplicates: that with the least id, of several such that with the least digest of its words, of rows that repeat both any one. Rows without id or words stay."""
    names, flat = docs.columns, docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    doc_id, text = (F.col(f"c{names.index(c)}") for c in (id_col, text_col))
    base = picked(docs, doc_id=(id_col, "long"), text=(text_col, "string"))
    found = _near(base, size, percent, HALVES, ROWS).where("digest is not null")
    first = found.groupBy("component").agg(F.min(F.struct("doc_id", "digest")).alias("x")).select("x.doc_id", "x.digest")

    def digests(batches):
        for whole in batches:
            for low in range(0, whole.num_rows, 512):
                batch = whole.slice(low, 512)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([words_digest(t.as_py()) for t in batch.column(len(names) + 1)], pa.binary())], [f"c{i}" for i in range(len(names) + 3)])

    told = flat.select("*", doc_id.cast("long").alias("doc_id"), text.cast("string").alias("text"))
    told = told.mapInArrow(released(digests), added(told, ("digest", T.BinaryType())))
    told = told.withColumn("digest", F.when(F.col("doc_id").isNotNull(), F.col("digest")))
    loose = told.where("digest is null").select(*flat.columns)
    kept = told.join(first, ["doc_id", "digest"], "left_semi").dropDuplicates(["doc_id", "digest"]).select(*flat.columns)
    return kept.unionByName(loose).toDF(*names)


def _near(base: DataFrame, size: int, percent: int, halves: int, rows: int) -> DataFrame:
    """doc_id, digest (null for rows that link with nothing), component (a number of its own), n_shingles, component_id, kept."""
    stage = Stage(base.sparkSession, "minhash")
    sketched = stage.table(sketches(base, size, halves, rows).withColumn("digest", F.when(F.col("doc_id").isNotNull(), F.col("digest"))))
    reps = sketched.where("digest is not null").groupBy("digest").agg(F.min(F.struct("doc_id", "n_shingles", "one", "two")).alias("x")).select("digest", "x.*")
    reps = stage.table(reps.withColumn("rep", F.monotonically_increasing_id()))

    # Every representative under each of its table keys; buckets of one are of no use.
    keyed = stage.table(table_keys(reps, halves))
    crowded = stage.table(keyed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1"))
    met = keyed.join(crowded, "key")
    hubs = stage.table(met.groupBy("rep").agg(F.sum("members").alias("hub")))
    members = stage.table(met.join(hubs, "rep").select("key", "rep", "n", "hub"))
    stage.drop(crowded, keyed)
    wanted = reps.join(hubs, "rep", "left_semi").select("doc_id", "digest", "rep")

    def same_text(batches):  # an id may repeat with another text
        for batch in batches:
            yield batch.filter(pa.array([words_digest(t.as_py()) == d.as_py() for t, d in zip(batch.column(1), batch.column(2), strict=True)], pa.bool_())).select([0, 1])

    own = base.join(wanted, "doc_id").select("rep", "text", "digest").mapInArrow(released(same_text), "rep long, text string")
    texts = stage.table(own.groupBy("rep").agg(F.min("text").alias("text")))

    links = labels = tested = None
    for turn in range(STAR_ROUNDS + 1):
        # Buckets that still hold several components, and how many pairs across them there are.
        known = members.withColumn("label", F.col("rep")) if labels is None else _labelled(members, labels)
        parts = stage.table(known.groupBy("key", "label").agg(F.count("*").alias("own")))
        open_ = stage.table(parts.groupBy("key").agg(F.count("*").alias("labels"), F.sum("own").alias("n_all"), F.sum(F.col("own") * F.col("own")).alias("squares"), F.max(F.struct("own", "label")).alias("main")).where("labels > 1"))
        across, in_open = open_.agg(F.sum((F.col("n_all") * F.col("n_all") - F.col("squares")) / 2), F.sum("n_all")).first()
        if not across:
            break
        live = stage.table(known.join(open_.select("key"), "key", "left_semi"))
        full = turn == STAR_ROUNDS or across <= FULL_PAIRS * in_open
        near = f"least(n, n_b) * 100 >= {percent} * greatest(n, n_b)"
        if full:
            pairs = _across(stage, live.join(open_.select("key", F.col("main.own").alias("n_main"), (F.col("n_all") - F.col("main.own")).alias("n_rest"), F.col("main.label").alias("main")), "key").select("key", "n_main", "n_rest", "rep", "n", "label", (F.col("label") == F.col("main")).alias("is_main")), texts, size, percent)
        else:
            order = F.struct("spent", F.negative("hub"), "rep")
            live = live.withColumn("spent", F.lit(False)) if tested is None else live.join(tested, ["key", "rep"], "left").withColumn("spent", F.col("used").isNotNull())
            centres = stage.table(live.groupBy("key").agg(F.min_by(F.struct("rep", "n", "label"), order).alias("c")).select("key", F.col("c.rep").alias("a"), F.col("c.n").alias("n_b"), F.col("c.label").alias("label_b")))
            used = centres.select("key", F.col("a").alias("rep"), F.lit(True).alias("used"))
            tested = used if tested is None else tested.unionByName(used)
            pairs = live.join(centres, "key").where("rep != a and label != label_b").where(near).select("a", F.col("rep").alias("b"))
        pairs = stage.table(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        new = stage.table(confirmed(pairs, texts, size, percent))
        links = new if links is None else stage.table(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(new))
        labels = connected_components(stage, links)
        if full:
            break

    of_rep = reps.select("digest", "rep", "doc_id")
    if labels is not None:
        of_rep = of_rep.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    else:
        of_rep = of_rep.withColumn("component", F.col("rep"))
    of_rep = stage.table(of_rep)
    least = stage.table(of_rep.groupBy("component").agg(F.min("doc_id").alias("component_id")))
    of_digest = stage.table(of_rep.join(least, "component").select("digest", "component", "component_id"))
    joined = sketched.select("doc_id", "n_shingles", "digest").join(of_digest, "digest", "left")
    component = F.coalesce("component_id", "doc_id")
    return joined.select("doc_id", "digest", "component", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def parity_sketch(x: np.ndarray) -> bytes:
    """A bit for each part of the hash range: whether an odd number of the set is there. Two sets' sketches differ in no more bits than the sets have members of one alone, so too many bits prove a pair apart."""
    bits = np.bincount((x >> np.uint64(20) & np.uint64(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def _across(stage: Stage, live: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs (a, b) of different labels that meet in a table and that neither sizes nor sketches prove apart.

    live: key, rep, n, label, is_main (whether that is the key's most frequent label), n_main, n_rest (how many of the
    key's rows are of that label, and how many of others). Rows of the main label need not meet each other: blocks of
    theirs meet blocks of the rest, and these each other. So a large group that is already one component costs a row
    for each member, and only what is not proven apart leaves the task that compares it.
    """

    def sketched(batches):
        for batch in batches:
            found = []
            for text in batch.column(1):
                words, _, _ = word_hashes((text.as_py() or "").encode("utf-8", "surrogatepass").translate(LOWER_SPACES))
                found.append(parity_sketch(np.unique(ngram_hashes(words, min(size, max(1, len(words)))))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["rep", "sketch"])

    live = stage.table(live)
    who = live.select("rep").distinct()
    sketch = stage.table(texts.join(who, "rep", "left_semi").select("rep", "text").mapInArrow(released(sketched), "rep long, sketch binary"))
    mains, rests = (F.ceil(F.col(c) / BLOCK).cast("int") for c in ("n_main", "n_rest"))
    dealt = live.join(sketch, "rep").withColumn("mains", mains).withColumn("rests", rests)
    own = dealt.withColumn("block", F.pmod(F.xxhash64("rep"), F.when(F.col("is_main"), F.col("mains")).otherwise(F.col("rests"))).cast("int"))
    sent = ["rep", "n", "label", "sketch"]
    main = own.where("is_main").select("key", F.col("block").alias("low"), F.explode(F.expr("sequence(0, rests - 1)")).alias("high"), F.lit(0).alias("kind"), F.lit(True).alias("first"), *sent)
    rest = own.where("not is_main")
    met = rest.select("key", F.explode(F.expr("sequence(0, mains - 1)")).alias("low"), F.col("block").alias("high"), F.lit(0).alias("kind"), F.lit(False).alias("first"), *sent)
    other = rest.select("*", F.explode(F.expr("sequence(0, rests - 1)")).alias("other"))
    among = other.select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), F.lit(1).alias("kind"), (F.col("block") <= F.col("other")).alias("first"), *sent)
    dealt = main.unionByName(met).unionByName(among)

    def near(group: list) -> tuple[np.ndarray, np.ndarray]:
        first, rep, n, label, bits = zip(*group, strict=True)
        first, rep, n, label = (np.array(c) for c in (first, rep, n, label))
        bits = np.frombuffer(b"".join(bits), np.uint64).reshape(len(rep), -1)
        one = first.all()
        x, y = (np.arange(len(rep)),) * 2 if one else (np.flatnonzero(first), np.flatnonzero(~first))
        low, high = np.minimum(n[x][:, None], n[y]), np.maximum(n[x][:, None], n[y])
        p, q = np.nonzero((label[x][:, None] != label[y]) & (100 * low >= percent * high) & ((rep[x][:, None] < rep[y]) | (not one)))
        p, q = x[p], y[q]
        keep = np.zeros(len(p), bool)
        for k in range(0, len(p), 1 << 14):
            s = slice(k, k + (1 << 14))
            apart = np.bitwise_count(bits[p[s]] ^ bits[q[s]]).sum(1, dtype=np.int64)
            keep[s] = apart * (100 + percent) <= (n[p[s]].astype(np.int64) + n[q[s]]) * (100 - percent)
        return np.minimum(rep[p], rep[q])[keep], np.maximum(rep[p], rep[q])[keep]

    def run(batches):
        key, group = None, []
        for batch in batches:
            found = []
            for *place, first, rep, n, label, bits in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                row = (first, rep, n, label, bits)
                if place != key:
                    if len(group) > 1:
                        found.append(near(group))
                    key, group = place, []
                group.append(row)
            a, b = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2
            both = np.unique(np.stack([a, b]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], ["a", "b"])
        if len(group) > 1:
            a, b = near(group)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return dealt.repartition("key", "kind", "low", "high").sortWithinPartitions("key", "kind", "low", "high").mapInArrow(released(run), "a long, b long")


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    return members.join(labels.select(F.col("node").alias("rep"), F.col("component").alias("label")), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
