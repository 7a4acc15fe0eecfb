"""Ranked lexical search over term-bucketed postings.

Each document gives one posting for each different term that some item asks for: a filter of the items' terms, of fixed
size, drops the others before anything is shuffled, and the join on the term itself drops what the filter let through.
Postings are dealt out and stored by term, the terms of very many documents in several salted shares, so that document
frequencies and the join with the items' terms need no further shuffle. Scores are whole numbers of a posting; they meet
again by document, where each item's sum is made, and a window keeps the best of each item.
"""

from __future__ import annotations

import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ALNUM_LOWER, Stage, pick, released, word_hashes

#: Results of an item; scale of scores, and the two weights of length and saturation, in hundredths and thousandths.
BEST, SCALE, LENGTH, SATURATION = 10, 1_000_000_000, 90, 8
#: Bits of the filter of wanted terms; documents of which a term's postings stay in one share; terms of items that are broadcast.
FILTER_BITS, SHARE, BROADCAST_ROWS = 20, 4_000_000, 1_000_000
#: Bytes of a text that are split into words at once, and terms that are hashed and passed on at once.
SLICE, TERMS = 1 << 20, 1 << 16


def term_counts(text: bytes) -> Counter:
    """The terms of a text with their numbers: runs of ASCII letters and digits, A to Z lower-cased, and all bytes over 0x7F."""
    data, counts, at = text.translate(ALNUM_LOWER), Counter(), 0
    while at < len(data):
        end = data.find(b" ", at + SLICE)
        end = len(data) if end < 0 else end
        counts.update(data[at:end].split())
        at = end
    return counts


def _bits(terms: list[bytes]) -> np.ndarray:
    found = [word_hashes(b" ".join(terms[i : i + TERMS]))[0] & np.uint64((1 << FILTER_BITS) - 1) for i in range(0, len(terms), TERMS)]
    return np.concatenate(found).astype(np.int64) if found else np.zeros(0, np.int64)


def _item_terms(batches):
    """(item, term, bit) for the different terms of each item."""
    for batch in batches:
        counts = [term_counts(x or b"") for x in batch.column(1).cast(pa.binary()).to_pylist()]
        terms = [t for c in counts for t in c]
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.repeat(np.arange(len(counts)), [len(c) for c in counts]))), pa.array(terms, pa.binary()), pa.array(_bits(terms))], ["item", "term", "bit"])


def _postings(shared):
    """(term, row, doc_id, n, tf) of the terms that the filter knows; with a null term a batch's documents (tf) and terms (n)."""

    def made(batch, first, held, sizes, terms, times):
        """Postings of the documents from number `first` on; held: how many terms each has in terms and times."""
        kept = np.flatnonzero(shared.value[_bits(terms)])
        at = np.repeat(np.arange(len(held)), held)[kept]
        of = pa.array(at + first)
        return pa.RecordBatch.from_arrays([pa.array([terms[i] for i in kept], pa.binary()), batch.column(0).take(of), batch.column(1).take(of), pa.array(np.asarray(sizes, np.int64)[at]), pa.array(np.asarray(times, np.int64)[kept])], ["term", "row", "doc_id", "n", "tf"])

    def run(batches):
        for batch in batches:
            all_terms, documents, first, held, sizes, terms, times = 0, 0, 0, [], [], [], []
            for i, x in enumerate(batch.column(2)):
                counts = term_counts(x.cast(pa.binary()).as_py() or b"")
                sizes.append(counts.total())
                held.append(len(counts))
                terms.extend(counts)
                times.extend(counts.values())
                all_terms, documents = all_terms + sizes[-1], documents + (sizes[-1] > 0)
                if len(terms) >= TERMS or i == batch.num_rows - 1:
                    yield made(batch, first, held, sizes, terms, times)
                    first, held, sizes, terms, times = i + 1, [], [], [], []
            totals = [pa.array([v], t) for v, t in zip((None, None, None, all_terms, documents), (pa.binary(), pa.int64(), batch.schema.field(1).type, pa.int64(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays(totals, ["term", "row", "doc_id", "n", "tf"])

    return released(run)


def relative_length(n: Column, documents: int, terms: int) -> Column:
    """m: 100 for a document of average length, in whole hundredths, rounding down; exact also where a product needs over 64 bits."""
    most = (1 << 63) // (LENGTH * max(documents, 1)) - 1
    wide = F.call_function("div", F.lit(LENGTH * documents).cast("decimal(20,0)") * n.cast("decimal(18,0)"), F.lit(terms).cast("decimal(20,0)"))
    small = F.call_function("div", LENGTH * n * F.lit(documents), F.lit(terms))
    return (100 - LENGTH) + F.when(n <= most, small).otherwise(wide)


def term_score(weight: Column, tf: Column, length: Column) -> Column:
    return weight * F.call_function("div", SCALE * tf, 1000 * tf + SATURATION * length)


def ranked_search(docs: DataFrame, items: DataFrame, best: int = BEST, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): for each row of items the rows of docs with the highest scores above 0, at most `best`, equal scores by ascending doc_id.

    Null and empty texts have no terms: such documents are no results and count nowhere, such items have no results.
    Rows that repeat an id are documents and items of their own; a null doc_id comes after all others of its score. Extra
    columns are ignored. An empty table on either side gives an empty result.
    """
    spark, stage = docs.sparkSession, Stage(docs.sparkSession, "search")
    named = stage.table(pick(items, item_id=item_col, text=item_text).withColumn("item", F.monotonically_increasing_id()))
    wanted = stage.table(named.select("item", F.col("text").cast("string")).mapInArrow(_item_terms, "item long, term binary, bit long"))
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[[r[0] for r in wanted.select("bit").distinct().collect()]] = True  # as many rows as the filter has bits at most
    terms = stage.table(wanted.select("term").distinct().withColumn("word", F.monotonically_increasing_id()))
    of_items = stage.table(wanted.join(terms, "term").select("word", "item"))

    source = pick(docs, doc_id=id_col, text=text_col).select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("string"))
    kind = source.schema["doc_id"].dataType.simpleString()
    found = source.mapInArrow(_postings(spark.sparkContext.broadcast(bits)), f"term binary, row long, doc_id {kind}, n long, tf long")
    shares, buckets = 1 + docs.count() // SHARE, max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    salted = found.withColumn("share", F.pmod("row", F.lit(shares)).cast("int"))
    index = f"postings_{uuid.uuid4().hex}"
    salted.repartition(buckets, "term", "share").write.bucketBy(buckets, "term", "share").sortBy("term", "share").option("path", f"{stage.base}/{index}").saveAsTable(index)
    try:
        postings = spark.table(index)
        total = postings.where("term is null").agg(F.sum("n").alias("terms"), F.sum("tf").alias("documents")).first()
        documents, length = total["documents"] or 0, max(1, total["terms"] or 0)
        postings = postings.where("term is not null")
        counts = postings.groupBy("term", "share").agg(F.count("*").alias("df")).groupBy("term").agg(F.sum("df").alias("df"))
        weight = F.floor(1000 * F.log((2 * documents + 2) / (2 * F.col("df") + 1)))
        known = terms.join(counts, "term").select("term", "word", weight.alias("weight"), F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"))
        score = term_score(F.col("weight"), F.col("tf"), relative_length(F.col("n"), documents, length))
        scored = postings.join(stage.table(known), ["term", "share"]).select("row", "doc_id", "word", score.alias("score")).where("score > 0")
        if of_items.count() <= BROADCAST_ROWS:  # then a document's matches are made and summed where its postings meet
            matches = scored.repartition("row").join(F.broadcast(of_items), "word")
        else:
            matches = scored.join(of_items, "word")
        sums = matches.groupBy("item", "row", "doc_id").agg(F.sum("score").alias("score"))
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
        top = stage.table(sums.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best))
    finally:
        spark.sql(f"drop table if exists {index}")
    return top.join(named.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
