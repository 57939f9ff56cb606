"""Cleaning, label handling, splitting and sampling."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textcheck.constants import LONG_LABELS, SEED, SHORT_LABELS, TRAIN_FRACTION
from textcheck.functions import text as tx
from textcheck.functions.checks import require_columns
from textcheck.functions.ranks import flag_by_quota, largest_remainders
from textcheck.functions.seeded import seeded_hash
from textcheck.session import materialise


def clean_text(df: DataFrame, text_col: str, out_col: str | None = None,
               **flags: bool) -> DataFrame:
    require_columns(df, text_col)
    return df.withColumn(out_col or text_col, tx.clean(F.col(text_col), **flags))


def drop_empty_text(df: DataFrame, text_col: str) -> DataFrame:
    require_columns(df, text_col)
    return df.filter(F.length(text_col) > 0)


def empty_text_counts(df: DataFrame, text_col: str, *group: str) -> DataFrame:
    """Rows before and after dropping empty texts."""
    require_columns(df, text_col, *group)
    kept = F.count_if(F.length(text_col) > 0)
    return df.groupBy(*group).agg(
        F.count("*").alias("n_before"), kept.alias("n_after"),
        (F.count("*") - kept).alias("n_dropped"))


def _word_map(words: dict[str, int]) -> Column:
    return F.create_map(*[F.lit(x) for pair in words.items() for x in pair])


def normalize_labels(df: DataFrame, label_col: str) -> DataFrame:
    """Turn string labels into numbers where all of them allow it.

    All positive/negative, else all pos/neg, else all integers; otherwise the
    labels stay as they are. The choice decides the column type, so it is made
    up front by one aggregate over the label column.
    """
    require_columns(df, label_col)
    if not isinstance(df.schema[label_col].dataType, T.StringType):
        return df
    label = F.col(label_col)
    seen = df.agg(
        F.bool_and(F.lower(label).isin(*LONG_LABELS)).alias("long"),
        F.bool_and(F.lower(label).isin(*SHORT_LABELS)).alias("short"),
        F.bool_and(label.try_cast("bigint").isNotNull() | label.isNull()).alias("digits"),
    ).first()
    if seen["long"]:
        number = _word_map(LONG_LABELS)[F.lower(label)].cast("bigint")
    elif seen["short"]:
        number = _word_map(SHORT_LABELS)[F.lower(label)].cast("bigint")
    elif seen["digits"]:
        number = label.cast("bigint")
    else:
        return df
    return df.withColumn(label_col, number)


def coerce_labels(df: DataFrame, label_col: str) -> DataFrame:
    """Map each label word or integer text by itself; fail on anything else."""
    require_columns(df, label_col)
    if isinstance(df.schema[label_col].dataType, T.NumericType):
        return df
    label = F.lower(F.col(label_col))
    number = F.coalesce(_word_map(LONG_LABELS | SHORT_LABELS)[label].cast("bigint"),
                        label.try_cast("bigint"))
    bad = F.raise_error(F.concat(F.lit("cannot turn label into a number: "), label))
    return df.withColumn(label_col, F.when(
        label.isNull() | number.isNotNull(), number).otherwise(bad.cast("bigint")))


def flag_train(df: DataFrame, label_col: str, id_col: str,
               train_frac: float = TRAIN_FRACTION, seed: int = SEED) -> DataFrame:
    """Add ``is_train``: a seeded split with exact sizes per label."""
    require_columns(df, label_col, id_col)
    return flag_by_quota(df, label_col, id_col, seed, "is_train",
                         lambda sizes: largest_remainders(sizes, train_frac))


def stratified_split(df: DataFrame, label_col: str, id_col: str,
                     train_frac: float = TRAIN_FRACTION,
                     seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    flagged = flag_train(df, label_col, id_col, train_frac, seed)
    return (flagged.filter("is_train").drop("is_train"),
            flagged.filter("NOT is_train").drop("is_train"))


def prepare_and_split(df: DataFrame, text_col: str, label_col: str, id_col: str,
                      train_frac: float = TRAIN_FRACTION,
                      seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Clean, drop empty texts, normalise labels, split.

    The cleaned table is written once; the label scan, the split and whatever
    reads the two sides start from it instead of cleaning again.
    """
    require_columns(df, text_col, label_col, id_col)
    cleaned = materialise(clean_text(df, text_col))
    kept = drop_empty_text(cleaned, text_col)
    return stratified_split(normalize_labels(kept, label_col), label_col, id_col,
                            train_frac, seed)


def head_rows(df: DataFrame, n: int | None, id_col: str) -> DataFrame:
    """First ``n`` rows in id order; all rows for None."""
    return df if n is None else df.orderBy(id_col).limit(n)


def drop_null_rows(df: DataFrame, *columns: str) -> DataFrame:
    require_columns(df, *columns)
    return df.select(*columns).dropna()


def sample_rows(df: DataFrame, n: int | None, id_col: str, seed: int = SEED) -> DataFrame:
    """Seeded sample of at most ``n`` rows; planned as a top-k, not a full sort."""
    if n is None:
        return df
    return df.orderBy(seeded_hash(seed, F.col(id_col)), id_col).limit(n)
