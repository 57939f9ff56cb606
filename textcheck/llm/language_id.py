"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textcheck.llm.words import mix, text_slices

#: Buckets of the hashed n-grams, and the lengths of the n-grams.
BUCKETS, ORDERS = 1 << 15, (1, 2, 3)
UNKNOWN = "und"


def _letter_table() -> np.ndarray:
    return np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)


def _grams(texts: pa.Array, letters: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: the bucket of every n-gram of all texts, and the n-grams per text.

    Text is lower-cased; each run of other characters than letters counts as one space.
    An n-gram has a letter and stays in its text.
    """
    lowered = [x.lower() for x in texts.to_pylist()]
    lengths = np.array([len(x) for x in lowered], dtype=np.int64)
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(lowered)), lengths)
    letter = letters[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1] & (owner[1:] == owner[:-1])
    points = np.where(letter, points, np.uint32(32))[keep].astype(np.uint64)
    owner, letter = owner[keep], letter[keep]
    for n in ORDERS:
        count = max(len(points) - n + 1, 0)
        value, some = np.full(count, n, np.uint64), np.zeros(count, bool)
        for i in range(n):
            value = (value << np.uint64(21)) | points[i:i + count]
            some |= letter[i:i + count]
        inside = some & (owner[:count] == owner[n - 1:n - 1 + count])
        bucket = (mix(value[inside]) & np.uint64(BUCKETS - 1)).astype(np.int64)
        yield bucket, np.bincount(owner[:count][inside], minlength=len(lowered))


def _count_rows(languages: list[str]):
    """mapInArrow function: occurrences of each (language, bucket) in a task's batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _letter_table()
        place = {name: i for i, name in enumerate(languages)}
        total = np.zeros(len(languages) * BUCKETS, np.int64)
        for batch, texts in text_slices(batches, "text"):
            label = np.array([place[x] for x in batch.column("lang").to_pylist()], np.int64)
            for bucket, per_text in _grams(texts, letters):
                total += np.bincount(np.repeat(label, per_text) * BUCKETS + bucket,
                                     minlength=len(total))
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], ["cell", "n"])

    return run


class LanguageModel:
    """Log probabilities: languages x buckets, and one log prior per language."""

    def __init__(self, languages: list[str], log_prob: np.ndarray, log_prior: np.ndarray):
        self.languages, self.log_prob, self.log_prior = languages, log_prob, log_prior


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
        rows_per_language: int = 20_000, smoothing: float = 0.5) -> LanguageModel:
    """Fit on the rows with a text and a language.

    ``rows_per_language`` is the documented bound of the fit: where a language has more rows, a
    share of them is taken by a hash of ``key``, so that about as many are read. Counts are
    added up by Spark; at most languages x BUCKETS sums come to the driver.
    """
    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"),
                       F.col(lang).alias("lang")).where("text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    log_prob = np.zeros((len(languages), BUCKETS))
    if languages:
        known = F.create_map(*[F.lit(x) for name in languages
                               for x in (name, max(1, sizes[name] // rows_per_language))])
        chosen = rows.where(F.pmod(F.xxhash64("key"), known[F.col("lang")]) == 0)
        sums = (chosen.select("text", "lang").mapInArrow(_count_rows(languages), "cell long, n long")
                .groupBy("cell").agg(F.sum("n").alias("n")).toPandas())
        log_prob.ravel()[sums["cell"].to_numpy(np.int64)] = sums["n"].to_numpy(np.float64)
    log_prob = np.log((log_prob + smoothing) / (log_prob + smoothing).sum(axis=1, keepdims=True))
    prior = np.array([sizes[name] for name in languages], float)
    return LanguageModel(languages, log_prob.astype(np.float32), np.log(prior / max(prior.sum(), 1)))


def predict(docs: DataFrame, model: LanguageModel, text: str = "text",
            prefix: str = "") -> DataFrame:
    """``docs`` with ``<prefix>lang_pred`` and ``<prefix>score``, the posterior of that language.

    A null text, a text without letters and a model without languages give ``und`` with score 0.
    Equal posteriors go to the language that sorts first.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.languages, model.log_prob, model.log_prior))
    names = (f"{prefix}lang_pred", f"{prefix}score")
    fields = [f for f in docs.schema.fields if f.name not in names]
    kept = docs.select(*[F.col(f"`{f.name}`") for f in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, log_prob, log_prior = shared.value
        letters = _letter_table()
        for batch, texts in text_slices(batches, text):
            total = np.tile(log_prior, (batch.num_rows, 1)) if languages else np.zeros((batch.num_rows, 1))
            n_grams = np.zeros(batch.num_rows, np.int64)
            for bucket, per_text in _grams(texts, letters):
                n_grams += per_text
                filled = np.flatnonzero(per_text)
                starts = (np.cumsum(per_text) - per_text)[filled]
                for i in range(len(languages) if len(bucket) else 0):
                    total[filled, i] += np.add.reduceat(log_prob[i][bucket].astype(np.float64), starts)
            best = total.argmax(axis=1)
            weight = np.exp(total - total.max(axis=1, keepdims=True))
            score = 1.0 / weight.sum(axis=1)
            known = (n_grams > 0) & bool(languages)
            label = [languages[b] if k else UNKNOWN for b, k in zip(best, known)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(label, pa.string()), pa.array(np.where(known, score, 0.0))],
                names=[*batch.schema.names, *names])

    schema = T.StructType([*fields, T.StructField(names[0], T.StringType()),
                           T.StructField(names[1], T.DoubleType())])
    return kept.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id"):
    """True for the fifth of the ids that no model learns from; a null id counts as learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))
