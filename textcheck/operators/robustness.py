"""Text perturbations and how predictions react to them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textcheck.constants import PERTURBATIONS, SEED
from textcheck.functions import text as tx
from textcheck.functions.checks import require_columns
from textcheck.operators.prepare import sample_rows
from textcheck.operators.scoring import Scorer


def perturbation(mode: str, text: Column, digests: Column) -> Column:
    """The perturbed text; an unknown mode leaves it as it is."""
    return {
        "lower": lambda: F.lower(text),
        "upper": lambda: F.upper(text),
        "no_punc": lambda: F.regexp_replace(text, tx.PUNCTUATION, " "),
        "extra_ws": lambda: F.regexp_replace(text, r"(?U)\s+", "   "),
        "typo_swap": lambda: tx.typo_swap(digests),
        "typo_keyboard": lambda: tx.typo_keyboard(digests),
    }.get(mode, lambda: text)()


def perturb(df: DataFrame, text_col: str, id_col: str, mode: str, seed: int = SEED,
            out_col: str = "perturbed_text") -> DataFrame:
    """Add the text under one perturbation."""
    require_columns(df, text_col, id_col)
    if not mode.startswith("typo"):
        return df.withColumn(out_col, perturbation(mode, F.col(text_col), F.lit(None)))
    digested = df.withColumn("_digests", tx.word_digests(F.col(text_col), seed, F.col(id_col)))
    return digested.withColumn(
        out_col, perturbation(mode, F.col(text_col), F.col("_digests"))).drop("_digests")


def perturb_all(df: DataFrame, text_col: str, id_col: str,
                modes: Sequence[str] = PERTURBATIONS, seed: int = SEED) -> DataFrame:
    """One row per input row and mode, from one scan; adds ``perturb`` and
    ``perturbed_text``. Keep only the columns you need: all are repeated."""
    require_columns(df, text_col, id_col)
    digested = df.withColumn("_digests", tx.word_digests(F.col(text_col), seed, F.col(id_col)))
    versions = F.array(*[
        F.struct(F.lit(mode).alias("perturb"),
                 perturbation(mode, F.col(text_col), F.col("_digests")).alias("perturbed_text"))
        for mode in modes])
    return digested.select(*df.columns, F.inline(versions))


def robustness_details(df: DataFrame, text_col: str, label_col: str, id_col: str, scorer: Scorer,
                       sample: int | None = None, modes: Sequence[str] = PERTURBATIONS,
                       seed: int = SEED) -> DataFrame:
    """Base and perturbed prediction per row and mode.

    The base prediction is made before the rows are multiplied and travels with
    them, so no join is needed.
    """
    require_columns(df, text_col, label_col, id_col)
    kept = sample_rows(df.select(id_col, text_col, label_col).dropna(
        subset=[text_col, label_col]), sample, id_col, seed)
    base = scorer.predict(kept, text_col, "y_pred_base", "y_prob_base")
    rows = perturb_all(base, text_col, id_col, modes, seed)
    return scorer.predict(rows, "perturbed_text", "y_pred_perturbed", "y_prob_perturbed").select(
        F.col(id_col).alias("id"), F.col(text_col).alias("orig_text"), "perturb",
        "perturbed_text", F.col(label_col).alias("y_true"), "y_pred_base", "y_pred_perturbed",
        "y_prob_base", "y_prob_perturbed")


def robustness_summary(details: DataFrame) -> DataFrame:
    """Per mode: examples, share of changed predictions, mean change of probability."""
    return details.groupBy("perturb").agg(
        F.count("*").alias("n_examples"),
        F.avg((F.col("y_pred_base") != F.col("y_pred_perturbed")).cast("double"))
        .alias("flip_rate"),
        F.avg(F.abs(F.col("y_prob_perturbed") - F.col("y_prob_base"))).alias("avg_conf_change"))
