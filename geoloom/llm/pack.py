"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

Texts are tokenized and cut into pieces; pieces shorter than a sequence are dealt into buckets of a bounded size. Each
bucket is a packing problem that several islands solve: an island holds a few packings, crosses them by injecting whole
well-filled bins of one parent into another, drops the bins that now hold a document twice and best-fits what they
leave. After each epoch every island gets its neighbour's elite by a shuffle. Last, the poorly filled bins of all
buckets are pooled, dealt anew and packed once more.
"""

from __future__ import annotations

import json
import os
import random
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SPACES, Stage, picked, released

LENGTH = 2048
BUCKET = 4096
ISLANDS, POPULATION, EPOCHS, GENERATIONS = 2, 4, 2, 4
#: Entries of each of the two generations of runs that a Python worker keeps the ids of, bytes of such an entry at most, and bytes of text split at once.
KEPT_RUNS, KEPT_BYTES, CHUNK = 100_000, 64, 2 << 20
#: The rules of a tokenizer under which a text's ids are those of its runs: letters, punctuation, single digits. Others get whole texts.
RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
}
SPACE, LETTER, MARK, DIGIT, ODD = range(5)
#: The kind of each byte. 0xC3 leads the accented letters of Latin-1, which lower-case one to one and which composition leaves as they are.
KIND = np.array([SPACE if b == 32 else LETTER if chr(b).isalpha() and b < 128 or b == 0xC3 else DIGIT if 48 <= b < 58 else MARK if 32 < b < 127 else ODD for b in range(256)], np.uint8)
#: What is one run for the tokenizer too.
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+|[!-/:-@\[-`{-~]+|[0-9]")


class Kept:
    """A dictionary of bounded size: when the young generation is full it becomes the old one, and what is asked for again moves back."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def missing(self, keys: set[str]) -> list[str]:
        """Those of keys that are not kept; all others are in self.young afterwards."""
        if len(self.young) > self.most:
            self.old, self.young = self.young, {}
        out = []
        for k in keys.difference(self.young):
            if k in self.old:
                self.young[k] = self.old[k]
            else:
                out.append(k)
        return out


@lru_cache(1)
def _tokenizer(path: str):
    """The tokenizer; which ids end a run of its splitting rule, or None if it has other rules than RULES; the ids of runs kept from text to text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    told = json.loads(tokenizer.to_str())
    alike = {k: told[k] for k in RULES} == RULES and all(t["content"].startswith("<|") and " " not in t["content"] for t in told["added_tokens"])
    vocabulary = tokenizer.get_vocab()
    ends = np.zeros(max(vocabulary.values()) + 1, bool)
    ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
    return tokenizer, ends if alike else None, Kept(KEPT_RUNS)


def run_ids(keys: list[bytes], tokenizer, ends: np.ndarray) -> list[bytes]:
    """The ids of each run. Plain ones go many in one call, which costs half as much as a call for each; their last ids tell them apart."""
    out = {}
    plain = [k for k in keys if RUN.fullmatch(k)]
    for low in range(0, len(plain), 4096):
        part = plain[low : low + 4096]
        ids = np.array(tokenizer.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)[0].ids, "<u4")
        at, data = (4 * np.flatnonzero(ends[ids]) + 4).tolist(), ids.tobytes()
        if len(at) == len(part):
            out.update(zip(part, (data[i:j] for i, j in zip([0, *at], at)), strict=True))  # noqa: B905
    rest = [k for k in keys if k not in out]
    found = tokenizer.encode_batch_fast([k.decode("utf-8", "replace") for k in rest], add_special_tokens=False) if rest else []
    out.update(zip(rest, (np.array(e.ids, "<u4").tobytes() for e in found), strict=True))
    return [out[k] for k in keys]


def runs_of(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(starts of the runs of data, each with the spaces after it; the bytes, lower-cased). A word with anything that is neither ASCII nor an accented Latin-1 letter, a contraction or the beginning of a special token is one run and keeps its case."""
    codes = np.frombuffer(data, np.uint8)
    kind, low = KIND[codes], np.frombuffer(data.translate(LOWER), np.uint8).copy()
    lead = np.flatnonzero(codes[:-1] == 0xC3)
    after = codes[lead + 1]
    kind[lead + 1] = np.where((after == 0x97) | (after == 0xB7), ODD, LETTER)
    low[lead + 1] += np.where((after >= 0x80) & (after <= 0x9E) & (after != 0x97), 32, 0).astype(np.uint8)
    change = np.ones(len(codes), bool)
    change[1:] = (kind[1:] != SPACE) & ((kind[1:] != kind[:-1]) | (kind[1:] == DIGIT))
    contraction = np.flatnonzero(codes[:-1] == 39)
    special = np.flatnonzero(codes[:-1] == 60)
    odd = np.concatenate((np.flatnonzero(kind == ODD), contraction[kind[contraction + 1] == LETTER], special[codes[special + 1] == 124]))
    if len(odd):
        space = np.flatnonzero(kind == SPACE)
        k = np.unique(np.searchsorted(space, odd))
        first, last = np.concatenate(([0], space + 1))[k], np.concatenate((space, [len(codes)]))[k]
        inside = np.zeros(len(codes) + 1, np.int8)
        inside[first] += 1
        inside[last] -= 1
        whole = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
        change[whole] = False
        change[first] = True
        low[whole] = codes[whole]
    return np.flatnonzero(change), low


def entries(array: pa.BinaryArray) -> list[bytes]:
    """The values of an array without their spaces. None holds a line break."""
    _, ends, data = array.buffers()
    ends, data = np.frombuffer(ends, np.int32)[1 : len(array) + 1], np.frombuffer(data, np.uint8)
    return np.insert(data[: ends[-1]], ends[:-1], 10).tobytes().replace(b" ", b"").split(b"\n") if len(array) else []


def token_ids(texts: list[str | None], path: str) -> list[np.ndarray]:
    """The ids of each text; null counts as empty.

    By RULES the ids of a text are those of its runs of letters, of punctuation and of its digits, lower-cased. Runs
    are found by byte arrays, told apart by Arrow's dictionary and looked up once for each different one.
    """
    tokenizer, ends, kept = _tokenizer(path)
    if ends is None:
        return [np.array(e.ids, "<u4") for e in tokenizer.encode_batch_fast([x or "" for x in texts], add_special_tokens=False)]
    out: list[list[np.ndarray]] = [[] for _ in texts]
    for owners, data, first, last in segments(texts):
        starts, low = runs_of(data)
        words = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(data)).astype(np.int32)), pa.py_buffer(low)]).dictionary_encode()
        keys = entries(words.dictionary)
        fresh = kept.missing(set(keys))
        of = kept.young
        of.update(zip(fresh, run_ids(fresh, tokenizer, ends), strict=True))
        ids = [of[k] for k in keys]
        for k in fresh:
            if len(k) > KEPT_BYTES:
                del of[k]
        # All runs' ids in a row: each takes a stretch of its key's ids.
        flat, sizes = np.frombuffer(b"".join(ids), "<u4"), np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        index = words.indices.to_numpy()
        n, begin = sizes[index], (np.cumsum(sizes, dtype=np.int64) - sizes)[index]
        before = np.concatenate(([0], np.cumsum(n, dtype=np.int64)))
        got = flat[np.repeat(begin - before[:-1], n) + np.arange(before[-1])]
        for i, a, b in zip(owners, before[np.searchsorted(starts, first)].tolist(), before[np.searchsorted(starts, last)].tolist(), strict=True):
            out[i].append(got[a:b])
    return [x[0] if len(x) == 1 else np.concatenate([np.zeros(0, "<u4"), *x]) for x in out]


def segments(texts: list[str | None], most: int = CHUNK):
    """Texts joined by a space, about `most` bytes at once; longer ones are split at spaces: (the text's number, the bytes, start and end in them) of each."""
    owners, parts, size = [], [], 0

    def joined():
        ends = np.cumsum([len(p) + 1 for p in parts])
        return owners, b" ".join(parts) + b" ", ends - [len(p) + 1 for p in parts], ends - 1

    for i, text in enumerate(texts):
        data, at = (text or "").encode("utf-8", "surrogatepass").translate(SPACES), 0
        while at < len(data):
            end = len(data) if len(data) - at <= most else data.rfind(b" ", at, at + most) + 1 or data.find(b" ", at + most) + 1 or len(data)
            owners.append(i)
            parts.append(data[at:end])
            size, at = size + end - at, end
            if size >= most:
                yield joined()
                owners, parts, size = [], [], 0
    if parts:
        yield joined()


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, end_id: int = 0, keep_ids: bool = True) -> DataFrame:
    """The pieces of each row's ids and end_id: doc_id, piece, start, length, ids_crc32 and, if kept, ids."""
    kind = docs.schema[id_col].dataType.simpleString()
    base = picked(docs, doc_id=(id_col, kind), text=(text_col, "string"))
    end, names = np.array([end_id], "<u4"), ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids]

    def cut(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                part = batch.slice(low, 1024)
                at, rows, ids = [], [], []
                for i, data in enumerate(token_ids(part.column(1).to_pylist(), tokenizer_path)):
                    n = len(data) + 1
                    for k in range(0, n, length):
                        own, last = data[k : k + length], k + length >= n
                        crc = zlib.crc32(own)
                        at.append(i)
                        rows.append((k // length, k, min(length, n - k), zlib.crc32(end, crc) if last else crc))
                        if keep_ids:
                            ids.append((np.append(own, end) if last else own).astype(np.int32))
                columns = [part.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True))]
                if keep_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names)

    return base.mapInArrow(released(cut), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids)


def least_bins(sizes: np.ndarray, length: int) -> int:
    """A lower bound of the bins that sizes need: for each limit k, pieces over length - k stand alone, and those over half of it can only share with pieces from k on."""
    count = np.bincount(sizes, minlength=length + 1)[: length + 1]
    n, total = np.cumsum(count), np.cumsum(count * np.arange(length + 1))
    half, k = length // 2, np.arange(1, length // 2 + 1)
    big = n[-1] - n[half]
    room = (n[length - k] - n[half]) * length - (total[length - k] - total[half])
    small = total[half] - total[k - 1]
    return int(max(-(-total[-1] // length), (big + np.maximum(0, -(-(small - room) // length))).max(initial=0)))


class Bins:
    """Bins of pieces; the gaps that bins leave are bits of one number, so the best fit is its lowest bit from a size on."""

    def __init__(self, sizes: list[int], length: int, bins: list[list[int]] = ()):
        self.sizes, self.length, self.bins, self.mask = sizes, length, [list(b) for b in bins], 0
        self.by_gap: list[list[int]] = [[] for _ in range(length + 1)]
        for i, b in enumerate(self.bins):
            self._open(i, length - sum(sizes[x] for x in b))

    def _open(self, i: int, gap: int) -> None:
        self.by_gap[gap].append(i)
        self.mask |= 1 << gap

    def fit(self, items: list[int], blur: random.Random | None = None) -> Bins:
        """Puts each item, largest first (or roughly so, by chance), into the fullest bin that takes it, else into a new one."""
        for x in sorted(items, key=lambda x: (-self.sizes[x] * (blur.uniform(0.5, 1.0) if blur else 1), x)):
            size = self.sizes[x]
            if over := self.mask >> size:
                gap = size + (over & -over).bit_length() - 1
                i = self.by_gap[gap].pop()
                if not self.by_gap[gap]:
                    self.mask &= ~(1 << gap)
                self.bins[i].append(x)
                self._open(i, gap - size)
            else:
                self.bins.append([x])
                self._open(len(self.bins) - 1, self.length - size)
        return self


def cost(bins: list[list[int]], sizes: list[int], length: int) -> tuple[int, float]:
    """Fewer bins are better; of as many, those whose fills differ more."""
    return len(bins), -sum((sum(sizes[x] for x in b) / length) ** 2 for b in bins)


def crossed(one: list[list[int]], two: list[list[int]], sizes: list[int], length: int, random_: random.Random) -> list[list[int]]:
    """one with a run of two's best-filled bins injected; bins that then hold a piece twice are dissolved and the pieces they leave best-fitted, as are those of a few poorly filled bins."""
    full = sorted(two, key=lambda b: -sum(sizes[x] for x in b))
    share = random_.randint(1, max(1, len(full) // 2))
    low = random_.randrange(max(1, len(full) // 2 - share + 1))
    injected = full[low : low + share]
    taken = {x for b in injected for x in b}
    kept, loose = [], []
    for b in one:
        if taken.isdisjoint(b):
            kept.append(b)
        else:
            loose += [x for x in b if x not in taken]
    kept.sort(key=lambda b: -sum(sizes[x] for x in b))
    for _ in range(min(len(kept), random_.randint(1, 4))):
        loose += kept.pop()
    return Bins(sizes, length, [*injected, *kept]).fit(loose).bins


def ideal(sizes: list[int], length: int) -> tuple[int, float]:
    """A cost that no packing beats: as few bins as the bound allows, all but one of them full."""
    full, rest = divmod(sum(sizes), length)
    return least_bins(np.array(sizes), length), -(full + (rest / length) ** 2) - 1e-9


def evolve(sizes: list[int], elites: list[list[list[int]]], seed: int, length: int, population: int, generations: int) -> list[list[int]]:
    """The best packing an island finds in so many generations, from the elites it starts with, or the best fit of all pieces, and best fits of its own. It ends early only where nothing better can be."""
    random_, least = random.Random(seed), ideal(sizes, length)
    value = lambda p: cost(p, sizes, length)
    group = [(value(p), p) for p in elites or [Bins(sizes, length).fit(list(range(len(sizes)))).bins]]
    while len(group) < population:  # the fullest bins stay, the others' pieces are fitted anew in another order
        base = sorted(random_.choice(group)[1], key=lambda b: sum(sizes[x] for x in b))
        loose = base[: random_.randint(1, len(base))]
        new = Bins(sizes, length, base[len(loose) :]).fit([x for b in loose for x in b], random_).bins
        group.append((value(new), new))
    for _ in range(generations):
        group.sort(key=lambda x: x[0])
        if group[0][0] <= least:
            break
        one, two = group[0][1], random_.choice(group[1:])[1]
        group[-2:] = [(value(p), p) for p in (crossed(two, one, sizes, length, random_), crossed(one, two, sizes, length, random_))]
    return min(group, key=lambda x: x[0])[1]


def pack_lengths(sized: DataFrame, length: int = LENGTH, bucket: int = BUCKET, islands: int = ISLANDS, population: int = POPULATION, epochs: int = EPOCHS, generations: int = GENERATIONS) -> DataFrame:
    """(row, sequence_id, offset) for sized: (row, a unique long; length, from 1 to `length`)."""
    stage = Stage(sized.sparkSession, "pack")
    alone = sized.where(F.col("length") >= length).select("row", F.col("row").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    packed, poor = _round(stage, sized.where(F.col("length") < length), 1, length, bucket, islands, population, epochs, generations)
    again, rest = _round(stage, poor, 2, length, bucket, islands, population, epochs, generations, last=True)
    return alone.unionByName(packed).unionByName(again)


def _round(stage: Stage, sized: DataFrame, number: int, length: int, bucket: int, islands: int, population: int, epochs: int, generations: int, last: bool = False) -> tuple[DataFrame, DataFrame]:
    """Packs what is given in buckets of about `bucket` pieces: (what is packed, the pieces of poorly filled bins, unless this is the last round)."""
    buckets = max(1, round(sized.count() / bucket))
    dealt = sized.groupBy(F.pmod(F.xxhash64("row", F.lit(number)), F.lit(buckets)).alias("bucket")).agg(F.sort_array(F.collect_list(F.struct("row", "length"))).alias("pieces"))
    state = dealt.select("bucket", "pieces", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), F.expr("cast(array() as array<array<array<int>>>)").alias("elites"))

    def epoch(turn: int):
        def run(batches):
            for batch in batches:
                best = []
                for b, p, i, elites in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                    best.append(evolve([x["length"] for x in p], elites, hash((b, i, turn)), length, population, generations))
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(best, pa.list_(pa.list_(pa.int32())))], ["bucket", "pieces", "island", "elite"])

        return run

    for turn in range(epochs):
        solved = stage.table(state.repartition("bucket", "island").mapInArrow(epoch(turn), state.drop("elites").withColumn("elite", F.expr("cast(array() as array<array<int>>)")).schema))
        # Every island goes on with its own elite and that of the island before it.
        moved = solved.select("bucket", F.expr(f"(island + 1) % {islands}").alias("island"), F.col("elite").alias("guest"))
        state = solved.join(moved, ["bucket", "island"]).select("bucket", "pieces", "island", F.array("elite", "guest").alias("elites"))
    best = solved.groupBy("bucket").agg(F.min_by(F.struct("pieces", "elite"), F.struct(F.size("elite"), "island")).alias("x")).select("bucket", "x.pieces", "x.elite")

    def places(batches):
        for batch in batches:
            rows = []
            for b, p, bins in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                for i, own in enumerate(bins):
                    at, fill = 0, sum(p[x]["length"] for x in own)
                    for x in own:
                        rows.append((p[x]["row"], -1 - ((number << 61) | (b << 20) | i), at, p[x]["length"], fill))
                        at += p[x]["length"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * 5)], ["row", "sequence_id", "offset", "length", "fill"])

    placed = stage.table(best.mapInArrow(places, "row long, sequence_id long, offset long, length long, fill long"))
    is_poor = F.lit(False) if last else F.col("fill") < 0.97 * length
    return placed.where(~is_poor).select("row", "sequence_id", "offset"), placed.where(is_poor).select("row", "length")


def best_fit_pack(docs: DataFrame, tokenizer_path: str | None = None, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, end_id: int = 0, keep_ids: bool = True) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32, ids if kept, sequence_id, offset.

    A null or empty text is one piece that holds end_id alone. Pieces longer than a sequence do not exist: only texts
    whose ids and end_id exceed `length` are cut, into pieces of that length and a rest. Rows may repeat, each is packed.
    Extra columns are ignored; an empty table gives an empty result.
    """
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")
    stage = Stage(docs.sparkSession, "pieces")
    cut = stage.table(pieces(docs, tokenizer_path, id_col, text_col, length, end_id, keep_ids).withColumn("row", F.monotonically_increasing_id()))
    placed = pack_lengths(cut.select("row", "length"), length)
    return cut.join(placed, "row").drop("row")
