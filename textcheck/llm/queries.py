"""The queries of the operators in this subpackage, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textcheck.llm import byte_bpe, fingerprints, language_id, sanitise
from textcheck.llm.hard_negatives import hard_negatives
from textcheck.llm.lm_scores import backoff_scores
from textcheck.llm.near_dup import near_duplicates
from textcheck.llm.packing import pack_documents
from textcheck.llm.periodic_runs import periodic_runs, strongest_run, with_repeats
from textcheck.llm.quality_rules import quality
from textcheck.llm.suffix_dedup import repeated_passages
from textcheck.llm.token_counts import section_counts
from textcheck.llm.token_files import read_token_files, write_token_files
from textcheck.session import new_folder

BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = byte_bpe.encode(_documents(spark, sf_dir), BYTE_RANKS, public_tokenizers.PATTERN)
    return byte_bpe.decode(encoded, BYTE_RANKS).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return fingerprints.edited_fingerprints(docs, fingerprints.fit_lexicon(docs))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_documents(spark, sf_dir))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return section_counts(_documents(spark, sf_dir), BYTE_RANKS, public_tokenizers.PATTERN)


def op5_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff_scores(_documents(spark, sf_dir))


def op6_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark)
    write_token_files(_documents(spark, sf_dir), folder, WORD_BPE)
    return read_token_files(spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(_documents(spark, sf_dir))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_documents(spark, sf_dir), WORD_BPE)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(_documents(spark, sf_dir), PIECES)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    held_out = language_id.held_out("doc_id")
    model = language_id.fit(docs.where(~held_out))
    return language_id.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [sanitise.counted("entities", kind).alias(f"n_{kind}") for kind in sanitise.KINDS]
    return sanitise.sanitise(_documents(spark, sf_dir)).select(
        "doc_id", *counts, F.sha2(sanitise.listed(F.col("entities")), 256).alias("base_sha256"),
        sanitise.listed(F.col("spans")).alias("spans"), F.sha2("sanitised", 256).alias("sanitised_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 50 == 0)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_repeats(_documents(spark, sf_dir)))
    best = strongest_run(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_document_fingerprints": op2_document_fingerprints,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_token_counts": op4_token_counts,
    "op5_lm_scores": op5_lm_scores,
    "op6_token_id_files": op6_token_id_files,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_quality_rules": op9_quality_rules,
    "op10_language_id": op10_language_id,
    "op11_private_data": op11_private_data,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_periodic_runs": op13_periodic_runs,
}

#: SQL counterparts; operators that SQL cannot express are tested against brute force.
ORACLES: dict[str, str] = {}
