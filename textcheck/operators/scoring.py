"""Pluggable text scorers, toxicity and identity scores and their summary.

A scorer adds ``label_scores`` (array of (label, score), as a text classifier
would return for all its labels) and predictions (``y_pred``, ``y_prob``). Any
object with ``name``, ``score`` and ``predict`` works, for instance one around
an Arrow ``pandas_udf`` that runs a large model in batches.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Protocol

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textcheck.functions import text as tx
from textcheck.functions.checks import require_columns
from textcheck.functions.ranks import as_features, exact_quantiles
from textcheck.session import materialise


class Scorer(Protocol):
    name: str

    def score(self, df: DataFrame, text_col: str, out_col: str = "label_scores") -> DataFrame: ...

    def predict(self, df: DataFrame, text_col: str, pred_col: str = "y_pred",
                prob_col: str = "y_prob") -> DataFrame: ...


def _label_scores(labels: Sequence[str], scores: Sequence[Column]) -> Column:
    return F.array(*[F.struct(F.lit(label).alias("label"), score.alias("score"))
                     for label, score in zip(labels, scores)])


@dataclass(frozen=True)
class LexiconScorer:
    """Share of words that are in a list; a fixed, explainable stand-in for a model."""

    name: str
    words: tuple[str, ...]
    labels: tuple[str, str] = ("1", "0")
    cut: float = 0.5
    lowercase: bool = True

    def probability(self, text: Column) -> Column:
        def share(words: Column) -> Column:
            hits = F.filter(words, lambda w: w.isin(*self.words))
            return F.when(F.size(words) > 0, F.size(hits) / F.size(words)).otherwise(0.0)

        return tx.once(tx.tokens(text, self.lowercase), share)

    def score(self, df: DataFrame, text_col: str, out_col: str = "label_scores") -> DataFrame:
        require_columns(df, text_col)
        share = df.withColumn("_share", self.probability(F.col(text_col)))
        return share.withColumn(out_col, _label_scores(
            self.labels, [F.col("_share"), 1 - F.col("_share")])).drop("_share")

    def predict(self, df: DataFrame, text_col: str, pred_col: str = "y_pred",
                prob_col: str = "y_prob") -> DataFrame:
        require_columns(df, text_col)
        return df.withColumn(prob_col, self.probability(F.col(text_col))).withColumn(
            pred_col, (F.col(prob_col) >= self.cut).cast("int"))


# Input and output columns of the fitted pipeline.
MODEL_TEXT = "_text"
MODEL_COLUMNS = ("_text", "_words", "_pairs", "_terms", "_counts", "_weighted", "_features",
                 "rawPrediction", "probability", "prediction")


@dataclass(frozen=True)
class ModelScorer:
    """Scores with a fitted Spark ML text pipeline (see ``classify``)."""

    name: str
    model: PipelineModel
    labels: tuple[str, ...] = ("0", "1")

    def _run(self, df: DataFrame, text_col: str) -> DataFrame:
        require_columns(df, text_col)
        return self.model.transform(df.withColumn(
            MODEL_TEXT, F.coalesce(F.col(text_col), F.lit(""))))

    def score(self, df: DataFrame, text_col: str, out_col: str = "label_scores") -> DataFrame:
        array = vector_to_array("probability")
        return self._run(df, text_col).withColumn(out_col, _label_scores(
            self.labels, [array[i] for i in range(len(self.labels))])).drop(*MODEL_COLUMNS)

    def predict(self, df: DataFrame, text_col: str, pred_col: str = "y_pred",
                prob_col: str = "y_prob") -> DataFrame:
        return self._run(df, text_col).withColumns({
            prob_col: vector_to_array("probability")[1],
            pred_col: F.col("prediction").cast("int")}).drop(*MODEL_COLUMNS)


def score_toxicity(df: DataFrame, text_col: str, scorer: Scorer, label: str = "toxic",
                   contains: bool = False, out_col: str = "toxicity") -> DataFrame:
    """Score of the first label equal to (or containing) ``label``, else 0."""
    lowered = lambda entry: F.lower(entry["label"])
    match = (lambda e: F.contains(lowered(e), F.lit(label))) if contains else (
        lambda e: lowered(e) == label)
    scored = scorer.score(df, text_col, "_scores")
    first = F.try_element_at(F.filter("_scores", match), F.lit(1))["score"]
    return scored.withColumn(out_col, F.coalesce(first, F.lit(0.0))).drop("_scores")


def score_column(scorer: Scorer) -> str:
    return scorer.name.split("/")[-1] + "_score"


def score_identity(df: DataFrame, text_col: str, scorers: Sequence[Scorer]) -> DataFrame:
    """One ``<name>_score`` column per scorer: its highest label score."""
    for scorer in scorers:
        highest = F.array_max(F.transform("_scores", lambda e: e["score"]))
        df = scorer.score(df, text_col, "_scores").withColumn(
            score_column(scorer), highest).drop("_scores")
    return df


def top_label(df: DataFrame, text_col: str, scorer: Scorer) -> DataFrame:
    """Best label and its score per row; the first label by name on ties."""
    best = F.array_min(F.transform("_scores", lambda e: F.struct(
        (-e["score"]).alias("minus"), e["label"].alias("label"))))
    return (scorer.score(df, text_col, "_scores").withColumn("_best", best)
            .withColumns({"label": F.col("_best.label"), "score": -F.col("_best.minus")})
            .drop("_scores", "_best"))


def bias_summary(scored: DataFrame, identity_columns: Sequence[str],
                 toxicity_col: str = "toxicity") -> DataFrame:
    """One row: rows scored, mean and exact 95th percentile of toxicity, maxima."""
    require_columns(scored, toxicity_col, *identity_columns)
    # Scoring is the costly part: the scores are written once, the texts are not.
    scored = materialise(scored.select(toxicity_col, *dict.fromkeys(identity_columns)))
    p95 = exact_quantiles(as_features(scored, {"toxicity": F.col(toxicity_col)}), [0.95])
    return scored.agg(
        F.count("*").alias("n_scored"), F.avg(toxicity_col).alias("toxicity_mean"),
        *[F.max(c).alias(f"max_{c}") for c in identity_columns],
    ).withColumn("toxicity_p95", p95.select(F.col("quantiles")[0]).scalar())
