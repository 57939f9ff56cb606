"""TF-IDF + logistic regression on Spark ML, predictions and their metrics."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (CountVectorizerModel, ElementwiseProduct, NGram, Normalizer,
                                RegexTokenizer, SQLTransformer)
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textcheck.constants import MAX_FEATURES, MAX_ITERATIONS, TOLERANCE
from textcheck.functions.checks import require_columns
from textcheck.functions.text import TOKEN
from textcheck.operators.features import fit_vocabulary, term_counts
from textcheck.operators.scoring import MODEL_TEXT, ModelScorer, Scorer


ROWS_PER_PARTITION = 20_000


def train_classifier(train: DataFrame, text_col: str, label_col: str, id_col: str,
                     max_features: int = MAX_FEATURES,
                     max_iter: int = MAX_ITERATIONS) -> PipelineModel:
    """L2 logistic regression with C = 1, that is lambda = 1/n on the mean loss.

    The vocabulary comes from one DataFrame aggregate (at most ``max_features``
    rows reach the driver), with ties settled by term, so it does not depend on
    how the rows are spread.
    """
    require_columns(train, text_col, label_col, id_col)
    data = train.select(F.col(id_col).alias("_id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias(MODEL_TEXT),
                        F.col(label_col).cast("double").alias("_label"))
    n_rows = data.count()
    vocabulary = fit_vocabulary(term_counts(data, MODEL_TEXT, "_id"), F.lit(n_rows),
                                max_features).orderBy(F.desc("doc_freq"), "term").collect()
    stages = [
        RegexTokenizer(inputCol=MODEL_TEXT, outputCol="_words", pattern=TOKEN, gaps=False,
                       toLowercase=True),
        NGram(n=2, inputCol="_words", outputCol="_pairs"),
        SQLTransformer(statement="SELECT *, concat(_words, _pairs) AS _terms FROM __THIS__"),
        CountVectorizerModel.from_vocabulary([row["term"] for row in vocabulary],
                                             inputCol="_terms", outputCol="_counts"),
        ElementwiseProduct(inputCol="_counts", outputCol="_weighted",
                           scalingVec=Vectors.dense([row["idf"] for row in vocabulary])),
        Normalizer(inputCol="_weighted", outputCol="_features", p=2.0),
    ]
    vectors = PipelineModel(stages=stages).transform(data).select("_features", "_label")
    # Every optimiser step is one job over all partitions: few rows, few partitions.
    parts = max(1, n_rows // ROWS_PER_PARTITION)
    if parts < vectors.rdd.getNumPartitions():
        vectors = vectors.repartition(parts)
    vectors = vectors.persist()
    try:
        regression = LogisticRegression(
            featuresCol="_features", labelCol="_label", maxIter=max_iter, tol=TOLERANCE,
            regParam=1.0 / max(1, n_rows), elasticNetParam=0.0, standardization=False).fit(vectors)
    finally:
        vectors.unpersist()
    return PipelineModel(stages=[*stages, regression])


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def model_terms(spark: SparkSession, model: PipelineModel) -> tuple[DataFrame, float]:
    """(term, idf, coefficient) of a fitted pipeline, and its intercept.

    One row per vocabulary term, at most ``max_features``.
    """
    counter, scale, regression = model.stages[3], model.stages[4], model.stages[6]
    rows = list(zip(counter.vocabulary, map(float, scale.getScalingVec().toArray()),
                    map(float, regression.coefficients.toArray())))
    return (spark.createDataFrame(rows, "term string, idf double, coefficient double"),
            float(regression.intercept))


def predict(df: DataFrame, text_col: str, scorer: Scorer) -> DataFrame:
    """Class and class-1 probability per row."""
    return scorer.predict(df, text_col)


def predictions_table(df: DataFrame, text_col: str, label_col: str, id_col: str,
                      scorer: Scorer) -> DataFrame:
    """(id, text, y_true, y_pred, y_prob)."""
    require_columns(df, text_col, label_col, id_col)
    return predict(df, text_col, scorer).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"),
        F.col(label_col).alias("y_true"), "y_pred", "y_prob")


def train_and_predict(train: DataFrame, test: DataFrame, text_col: str, label_col: str,
                      id_col: str) -> tuple[ModelScorer, DataFrame]:
    scorer = ModelScorer("classifier", train_classifier(train, text_col, label_col, id_col))
    return scorer, predictions_table(test, text_col, label_col, id_col, scorer)


def accuracy(predictions: DataFrame) -> DataFrame:
    return predictions.agg(
        F.avg((F.col("y_true") == F.col("y_pred")).cast("double")).alias("accuracy"))


def class_scores(predictions: DataFrame) -> DataFrame:
    """Precision, recall, F1, support and hits per class; 0 where undefined.

    The confusion counts are added up first (one shuffle of at most classes²
    rows per task); everything after that works on this small table.
    """
    confusion = predictions.groupBy("y_true", "y_pred").agg(F.count("*").alias("n"))
    hit = F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(
        F.lit(0).cast("bigint"))
    roles = F.array(
        F.struct(F.col("y_true").cast("string").alias("label"), F.col("n").alias("support"),
                 F.lit(0).cast("bigint").alias("predicted"), hit.alias("hits")),
        F.struct(F.col("y_pred").cast("string").alias("label"),
                 F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted"),
                 F.lit(0).cast("bigint").alias("hits")))
    sums = confusion.select(F.inline(roles)).groupBy("label").agg(
        *[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return sums.select(
        "label", ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        ratio(F.col("hits"), F.col("support")).alias("recall"),
        ratio(2 * F.col("hits"), F.col("predicted") + F.col("support")).alias("f1_score"),
        "support", "hits")


def weighted_f1(predictions: DataFrame) -> DataFrame:
    return class_scores(predictions).agg(
        (F.sum(F.col("f1_score") * F.col("support")) / F.sum("support")).alias("weighted_f1"))


def classification_report(predictions: DataFrame) -> DataFrame:
    """One row per class, then accuracy, macro avg and weighted avg."""
    classes = class_scores(predictions)
    names = ["precision", "recall", "f1_score"]
    total = F.sum("support")
    hits = F.sum("hits") / total
    summary = classes.agg(F.array(
        F.struct(F.lit("accuracy").alias("label"), *[hits.alias(c) for c in names],
                 total.alias("support")),
        F.struct(F.lit("macro avg").alias("label"), *[F.avg(c).alias(c) for c in names],
                 total.alias("support")),
        F.struct(F.lit("weighted avg").alias("label"),
                 *[(F.sum(F.col(c) * F.col("support")) / total).alias(c) for c in names],
                 total.alias("support"))).alias("rows"))
    return classes.select("label", *names, "support").unionByName(
        summary.select(F.inline("rows")))
