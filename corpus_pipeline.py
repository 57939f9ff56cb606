"""From raw documents to packed sequences: five stages, each on what the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textcheck.llm import language_id
from textcheck.llm.near_dup import without_near_duplicates
from textcheck.llm.packing import pack_documents
from textcheck.llm.quality_rules import keep_good
from textcheck.llm.suffix_dedup import drop_repeated_passages
from textcheck.session import materialise

#: Least posterior of a language that is kept.
LEAST_SCORE = 0.5
#: Rows of a batch that travels to a Python worker: whole texts, so few at once.
BATCH_ROWS = "1024"


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language; texts that are null or have no letters go."""
    small_batches(spark)
    model = language_id.fit(docs.where(~language_id.held_out("doc_id")))
    # Numbered names, so that no column of the documents meets one of the prediction.
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    sure = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    predicted = language_id.predict(plain, model, text=f"c{docs.columns.index('text')}")
    return predicted.where(sure).drop("lang_pred", "score").toDF(*docs.columns)


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    small_batches(spark)
    return keep_good(docs, public_tokenizers.path("piece_bpe_32k.model"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id."""
    small_batches(spark)
    return without_near_duplicates(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 50 or more words that an earlier document holds."""
    small_batches(spark)
    return drop_repeated_passages(docs, length="n_chars" if "n_chars" in docs.columns else None)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, packed into sequences of at most 4096 tokens."""
    small_batches(spark)
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("quality_rules", apply_quality_rules),
    ("minhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeated_passages),
    ("best_fit_packing", pack_sequences),
]

#: The stages learn models, hash shingles and run tokenizers, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
