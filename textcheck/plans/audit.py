"""The one-dataset report and the whole audit as a plain driver function."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textcheck.constants import SEED, SIMILARITY_THRESHOLD, TRAIN_FRACTION
from textcheck.operators import (classify, drift, explain, fairness, features, health, prepare,
                                 repair, report, robustness, scoring, similarity)
from textcheck.session import materialise
from textcheck.sources.tables import write_table


def dataset_report(df: DataFrame, text_col: str, label_col: str, id_col: str,
                   attr_col: str | None, toxicity: scoring.Scorer,
                   threshold: float = SIMILARITY_THRESHOLD) -> DataFrame:
    """Health, toxicity, similarity and fairness of one dataset as long rows.

    As a dataset has no predictions yet, the attribute metrics use the constant
    prediction 1.
    """
    found = similarity.similar_texts(df, text_col, id_col, threshold)
    top = scoring.top_label(df.select(id_col, text_col), text_col, toxicity)
    parts = [
        report.metric_rows(health.column_profile(df), "schema", ["n_null", "n_empty"],
                           "column_name", ["column_type"]),
        report.metric_rows(health.exact_duplicate_count(df, text_col), "duplicates",
                           ["exact_duplicates"]),
        report.metric_rows(health.label_distribution(df, label_col), "class_imbalance", ["n"],
                           label_col),
        report.metric_rows(health.label_extremes(df, label_col), "class_imbalance",
                           ["n_most", "n_least"], None, ["most_common", "least_common"]),
        report.metric_rows(top.groupBy("label").agg(
            F.count("*").alias("n"), F.avg("score").alias("mean_score"),
            F.max("score").alias("max_score")), "toxicity",
            ["n", "mean_score", "max_score"], "label"),
        report.metric_rows(similarity.pair_count(found), "similarity", ["n_pairs"]),
    ]
    if attr_col and attr_col in df.columns:
        ones = df.select(label_col, attr_col, F.lit(1).alias("_ones"))
        metrics = fairness.attribute_fairness(ones, label_col, "_ones", attr_col)
        parts.append(report.metric_rows(metrics, "fairness", metrics.columns))
    return report.stack(parts)


def version_metrics(predictions: DataFrame, bias: DataFrame, summary: DataFrame) -> DataFrame:
    """The numbers that are compared between the original and the repaired set."""
    return report.stack([
        report.metric_rows(classify.accuracy(predictions), "model", ["accuracy"]),
        report.metric_rows(classify.weighted_f1(predictions), "model", ["weighted_f1"]),
        report.metric_rows(bias, "bias", ["toxicity_mean", "toxicity_p95"]),
        report.metric_rows(summary, "robustness", ["flip_rate", "avg_conf_change"], "perturb"),
    ])


@dataclass
class Audit:
    """Everything one audit yields."""

    metrics: DataFrame
    plan: DataFrame
    pairs: DataFrame
    predictions: DataFrame
    scorer: scoring.ModelScorer


def run_audit(df: DataFrame, text_col: str, label_col: str, id_col: str, attr_col: str | None,
              toxicity: scoring.Scorer, identity: Sequence[scoring.Scorer],
              train_frac: float = TRAIN_FRACTION, seed: int = SEED,
              threshold: float = SIMILARITY_THRESHOLD, sample: int | None = None,
              out_dir: str | None = None) -> Audit:
    """Prepare, train, score, compare, perturb, explain, repair, report.

    The model is trained on the original and on the repaired training rows and
    measured on the same test rows. With ``out_dir`` the results are written;
    ``sample`` bounds the rows of the robustness check (None: all rows).
    """
    train, test = prepare.prepare_and_split(df, text_col, label_col, id_col, train_frac, seed)
    train, test = materialise(train), materialise(test)
    found = similarity.similar_texts(train, text_col, id_col, threshold)
    pairs = materialise(similarity.pair_table(found))
    repaired = materialise(repair.repair_chain(train, similarity.later_rows(found), label_col, id_col,
                                               seed=seed))
    scored = scoring.score_identity(scoring.score_toxicity(test, text_col, toxicity), text_col,
                                    identity)
    bias = scoring.bias_summary(scored, [scoring.score_column(s) for s in identity])

    parts = [report.with_version(dataset_report(df, text_col, label_col, id_col, attr_col,
                                                toxicity, threshold), "original")]
    results = {}
    for version, rows in zip(report.VERSIONS, (train, repaired)):
        scorer, predictions = classify.train_and_predict(rows, test, text_col, label_col, id_col)
        predictions = materialise(predictions)
        summary = materialise(robustness.robustness_summary(robustness.robustness_details(
            test, text_col, label_col, id_col, scorer, sample, seed=seed)))
        slices = fairness.group_metrics(fairness.tag_protected(predictions, "text"))
        gaps = fairness.fairness_gaps(slices)
        terms, intercept = classify.model_terms(df.sparkSession, scorer.model)
        weights = features.weigh(features.row_terms(rows, text_col, id_col), terms)
        importance = explain.linear_importance(weights, terms, rows.agg(F.count("*")).scalar())
        parts += [report.with_version(part, version) for part in (
            version_metrics(predictions, bias, summary),
            report.metric_rows(classify.classification_report(predictions), "classes",
                               ["precision", "recall", "f1_score", "support"], "label"),
            report.metric_rows(slices, "slices", ["accuracy", "tpr", "selection_rate"], "slice"),
            report.metric_rows(gaps, "slices", gaps.columns),
            report.metric_rows(importance, "importance", ["importance"], "term"))]
        results[version] = (scorer, predictions, summary, gaps)

    scorer, predictions, summary, gaps = results["original"]
    drifted = drift.data_drift(drift.label_sides(train, test), text_col, label_col, id_col,
                               {"text_length": F.length(text_col)})
    parts.append(report.with_version(report.metric_rows(
        drifted.withColumn("key", F.concat_ws("/", "feature", "method")), "drift",
        ["statistic", "p_value"], "key", ["drift"]), "original"))
    plan = repair.repair_plan(health.class_balance(train, label_col), label_col,
                              similarity.pair_count(found), summary, bias, gaps)
    result = Audit(report.stack(parts), plan, pairs, predictions, scorer)
    if out_dir:
        write_audit(result, train, test, repaired, out_dir)
    return result


def write_audit(result: Audit, train: DataFrame, test: DataFrame, repaired: DataFrame,
                out_dir: str) -> None:
    """Parquet tables, the metric table as JSON as well, and the fitted model."""
    for name, rows in {"train": train, "test": test, "train_repaired": repaired,
                       "pairs": result.pairs, "predictions": result.predictions,
                       "plan": result.plan}.items():
        write_table(rows, f"{out_dir}/{name}")
    stamped = report.stamped(result.metrics)
    write_table(stamped, f"{out_dir}/metrics", partition_by=["section"])
    write_table(stamped, f"{out_dir}/metrics_json", "json")
    classify.save_model(result.scorer.model, f"{out_dir}/model")
