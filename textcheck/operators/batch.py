"""Scorers that run a model over Arrow batches of texts, and occlusion by a batch of masks.

A model is a small file. It is written to the shared folder, sent with the job, and loaded once
by each Python worker; ``load`` turns its content into an object with ``scores(texts)``, the
scores of all labels, and for occlusion ``without(text)``.
"""

from __future__ import annotations

import json
import math
import os
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textcheck.constants import TOP_TOKENS
from textcheck.functions.checks import require_columns
from textcheck.operators.features import fit_vocabulary, term_counts
from textcheck.operators.scoring import LexiconScorer
from textcheck.session import new_folder


class WordModel:
    """Word lists and word odds over the words of a text (two or more letters, digits, underscores).

    Kind "share": part of the words that are listed. Kind "odds": the logistic function of ``bias``
    and the weights of the distinct words. Both follow from sums over the words of a text, so that
    leaving out a word changes a sum; no text is scored twice.
    """

    def __init__(self, content: str):
        model = json.loads(content)
        self.kind, self.weights = model["kind"], model["weights"]
        self.lowercase, self.bias = model["lowercase"], model.get("bias", 0.0)
        self.word = re.compile(r"\w{2,}")

    def words(self, text: str | None) -> Counter:
        text = text or ""
        return Counter(self.word.findall(text.lower() if self.lowercase else text))

    def _probability(self, pushed: float, size: int) -> float:
        if self.kind == "share":
            return pushed / size if size else 0.0
        # Both forms, so that no exponential overflows.
        z = pushed + self.bias
        return 1 / (1 + math.exp(-z)) if z >= 0 else math.exp(z) / (1 + math.exp(z))

    def _pushes(self, counts: Counter) -> dict[str, float]:
        once = self.kind == "odds"
        return {w: self.weights.get(w, 0.0) * (1 if once else n) for w, n in counts.items()}

    def scores(self, texts: list[str | None]) -> np.ndarray:
        found = []
        for text in texts:
            counts = self.words(text)
            p = self._probability(math.fsum(self._pushes(counts).values()), sum(counts.values()))
            found.append((p, 1 - p))
        return np.array(found, float).reshape(len(found), 2)

    def without(self, text: str | None) -> tuple[float, list[tuple[str, float]]]:
        """The probability of a text, and of the text without each of its words."""
        counts = self.words(text)
        pushes, size = self._pushes(counts), sum(counts.values())
        total = math.fsum(pushes.values())
        return self._probability(total, size), [
            (w, self._probability(total - pushes[w], size - n)) for w, n in counts.items()]


@dataclass(frozen=True)
class BatchScorer:
    """A model in a file that ``SparkContext.addFile`` has sent with the job.

    The first label's score is the probability that ``predict`` reports."""

    name: str
    file: str
    labels: tuple[str, ...] = ("1", "0")
    cut: float = 0.5
    load: Callable[[str], object] = WordModel

    def model(self):
        """For workers: the model from the file sent."""
        with open(SparkFiles.get(os.path.basename(self.file)), encoding="utf-8") as content:
            return self.load(content.read())

    def _all_scores(self, text_col: str):
        scorer = self

        @F.pandas_udf("array<double>")
        def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = scorer.model()
            for texts in batches:
                yield pd.Series(list(model.scores(texts.tolist())), dtype=object)

        return scored(F.col(text_col))

    def score(self, df: DataFrame, text_col: str, out_col: str = "label_scores") -> DataFrame:
        require_columns(df, text_col)
        named = F.transform(F.arrays_zip(F.array(*map(F.lit, self.labels)).alias("label"), F.col("_all").alias("score")),
                            lambda x: F.struct(x["label"].alias("label"), x["score"].alias("score")))
        return df.withColumn("_all", self._all_scores(text_col)).withColumn(out_col, named).drop("_all")

    def predict(self, df: DataFrame, text_col: str, pred_col: str = "y_pred",
                prob_col: str = "y_prob") -> DataFrame:
        require_columns(df, text_col)
        return df.withColumn(prob_col, self._all_scores(text_col)[0]).withColumn(
            pred_col, (F.col(prob_col) >= self.cut).cast("int"))


def send_model(spark: SparkSession, name: str, content: str, **fields) -> BatchScorer:
    """Write a model file to the shared folder and send it with the jobs of the session.

    The file alone is sent, as Spark sends no local folders from a cluster's driver; its name is
    Spark's, which no other file has."""
    folder = new_folder(spark)
    spark.createDataFrame([(content,)], "value string").coalesce(1).write.text(folder)
    (file,) = spark.read.text(folder).inputFiles()
    spark.sparkContext.addFile(file)
    return BatchScorer(name, file, **fields)


def lexicon_scorer(spark: SparkSession, lexicon: LexiconScorer) -> BatchScorer:
    """The same scores as ``lexicon``, by the batch route."""
    content = json.dumps({"kind": "share", "weights": dict.fromkeys(lexicon.words, 1.0),
                          "lowercase": lexicon.lowercase})
    return send_model(spark, lexicon.name, content, labels=lexicon.labels, cut=lexicon.cut)


def fit_word_odds(df: DataFrame, text_col: str, label_col: str, id_col: str, max_terms: int,
                  name: str = "trained/odds", labels: tuple[str, str] = ("1", "0")) -> BatchScorer:
    """Log odds of a 0/1 label per word, from the documents with and without it (naive Bayes).

    The ``max_terms`` most frequent words make up the model; with a and b of n1 positive and n0
    other documents holding a word, its weight is ln((a + 1) / (n1 + 2)) - ln((b + 1) / (n0 + 2)).
    """
    labelled = df.where(F.col(label_col).isNotNull())
    sums = labelled.agg(F.count_if(F.col(label_col) == 1).alias("n1"), F.count_if(F.col(label_col) != 1).alias("n0")).first()
    n1, n0 = sums["n1"], sums["n0"]
    counts = term_counts(labelled, text_col, id_col, bigrams=False)
    kept = fit_vocabulary(counts, F.lit(n1 + n0), max_terms).select("term")
    by_label = counts.join(labelled.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")), "id").join(
        kept, "term", "left_semi").groupBy("term").agg(
        F.count_if(F.col("y") == 1).alias("a"), F.count_if(F.col("y") != 1).alias("b"))
    # max_terms rows.
    weights = {r["term"]: math.log((r["a"] + 1) / (n1 + 2)) - math.log((r["b"] + 1) / (n0 + 2)) for r in by_label.collect()}
    content = json.dumps({"kind": "odds", "weights": weights, "lowercase": True,
                          "bias": math.log((n1 + 1) / (n0 + 1))})
    return send_model(df.sparkSession, name, content, labels=labels)


def _occluded_rows(scorer: BatchScorer, top: int):
    """mapInArrow function: the words whose absence changes a row's probability most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = scorer.model()
        for batch in batches:
            rows: list[int] = []
            out: tuple[list, list, list, list] = ([], [], [], [])
            for i, text in enumerate(batch.column("text").to_pylist()):
                base, masked = model.without(text)
                masked.sort(key=lambda m: (-round(abs(base - m[1]), 9), m[0]))
                for rank, (token, p) in enumerate(masked[:top], 1):
                    rows.append(i)
                    for column, value in zip(out, (token, base, p, rank)):
                        column.append(value)
            kinds = (pa.string(), pa.float64(), pa.float64(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(rows, pa.int64())), *map(pa.array, out, kinds)],
                ["id", "token", "base_prob", "prob_without", "rank"])

    return run


def batch_occlusion(df: DataFrame, text_col: str, id_col: str, scorer: BatchScorer,
                    top: int = TOP_TOKENS) -> DataFrame:
    """(id, token, base_prob, prob_without, change, rank): leave out one word at a time, any batch model.

    The model gets a text once and answers for all its masks; nothing is shuffled, and no text
    without a word is written. Ties go to the smaller word.
    """
    require_columns(df, text_col, id_col)
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["id"], T.StructField("token", T.StringType()),
                           T.StructField("base_prob", T.DoubleType()), T.StructField("prob_without", T.DoubleType()),
                           T.StructField("rank", T.IntegerType())])
    return rows.mapInArrow(_occluded_rows(scorer, top), schema).select(
        "id", "token", "base_prob", "prob_without", (F.col("base_prob") - F.col("prob_without")).alias("change"), "rank")
