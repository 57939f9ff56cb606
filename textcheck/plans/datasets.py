"""How the given tables play the parts of an audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textcheck.constants import SEED
from textcheck.operators.prepare import flag_train
from textcheck.operators.scoring import LexiconScorer
from textcheck.sources.tables import load_dataset, spread

# Stop words of four languages: their share tells prose from junk.
QUALITY = LexiconScorer(
    name="stopwords", cut=0.12, lowercase=False,
    words=("the", "of", "and", "to", "in", "is", "that", "de", "la", "en", "der", "die",
           "und", "le", "que"))
TOXIC = LexiconScorer(
    name="lexicons/fragments", labels=("toxic", "non-toxic"),
    words=("th", "er", "st", "nd", "ha", "ed", "ou"))
IDENTITY = (
    LexiconScorer(name="lexicons/pronouns", labels=("hate", "other"),
                  words=("he", "she", "it", "this", "el", "la", "der", "elle", "sie")),
    LexiconScorer(name="lexicons/articles", labels=("group", "other"),
                  words=("the", "an", "le", "les", "un", "une", "die", "das", "los")),
)
# A linear model over words and word pairs with fixed coefficients.
COEFFICIENTS = {
    "the": 1.5, "of": -1.0, "and": 0.8, "to": 0.4, "in": -0.3, "is": 1.1, "that": -1.2,
    "de": -0.7, "la": 0.6, "le": 0.5, "der": -0.9, "und": -0.4, "die": 0.7, "que": 0.2,
    "of the": 2.0, "in the": -1.4, "to the": 0.9, "de la": 1.3,
}
# Copies of unit vectors in steps of 1/16 stay far closer than this, other vectors farther.
COARSE_THRESHOLD = 0.95
# Terms of the word-odds model.
ODDS_TERMS = 5_000
# No pair of the given embeddings is closer than this by much.
EMBEDDING_THRESHOLD = 0.4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load_dataset(spark, f"{sf_dir.rstrip('/')}/{name}.parquet", "parquet")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(*columns) if columns else docs


def texts(spark: SparkSession, sf_dir: str, *columns: str | Column) -> DataFrame:
    """Documents for per-text work."""
    return spread(documents(spark, sf_dir, "doc_id", "text", *columns), "doc_id")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled texts with a 0/1 attribute."""
    docs = texts(spark, sf_dir, "lang")
    return docs.join(table(spark, sf_dir, "labels"), "doc_id").withColumn(
        "is_en", (F.col("lang") == "en").cast("int"))


def all_with_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document; the label is null where none is given."""
    return documents(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id", "left")


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flag_train(labelled(spark, sf_dir), "quality", "doc_id", seed=SEED)


def sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows as reference, test rows as current."""
    return flagged(spark, sf_dir).withColumn("is_current", ~F.col("is_train"))


def event_halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the first and second half of the covered time."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    seconds = F.unix_micros(F.col("ts").cast("timestamp"))
    middle = events.agg(((F.min(seconds) + F.max(seconds)) / 2)).scalar()
    return events.withColumn("is_current", seconds > middle)
