"""The corpus pipeline: five stages over documents, each written as Parquet and read again by the next.

STAGES holds (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame with the columns of
documents, the last one the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm.common import Stage
from geoloom.llm.decontaminate import decontaminate
from geoloom.llm.language_id import UNKNOWN, fit_language_model, held_out_share, predict_language
from geoloom.llm.minhash_dedup import without_near_duplicates
from geoloom.llm.pack import best_fit_pack
from geoloom.llm.pii import sanitise

#: Documents whose language is surer than this stay.
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those whose language the classifier is not sure of. Labels are learned from the rows that op2 learns from."""
    train = docs.where("doc_id is not null").where(~held_out_share("doc_id", 4, 2))
    found = predict_language(docs, fit_language_model(train))
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates, that with the least id: five-word shingles, a similarity of 0.8. Rows that repeat an id are told apart by their texts; a document without id links with none and stays."""
    return without_near_duplicates(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a window of a benchmark item occurs."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("n_hit = 0").select(*docs.columns)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data and the words that disclose it; n_chars follows the text."""
    clean = sanitise(docs).withColumn("text", F.col("sanitised_text"))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2048 tokens."""
    return best_fit_pack(docs, keep_ids=False)


STAGES = [("language_id", language), ("minhash_dedup", near_dedup), ("decontaminate", decontaminated), ("pii", private), ("pack", packed)]

#: Trained and heuristic stages have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    stage, docs = Stage(spark, "pipeline"), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, function in STAGES[:-1]:
        docs = stage.table(function(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
