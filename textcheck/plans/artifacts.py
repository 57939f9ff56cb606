"""Nested JSON artifacts: one row that holds everything one report says.

Lists inside are bounded by what they show (labels, columns, five rules, the first rows), so the
row is small whatever the size of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textcheck.constants import SIMILARITY_THRESHOLD
from textcheck.operators import fairness, health, scoring, similarity

#: Rows shown of duplicates and of similar pairs.
SHOWN_ROWS, SHOWN_PAIRS = 5, 100


def _listed(rows: DataFrame, *order: str) -> DataFrame:
    """One row: ``items``, all rows as structs, in the order of their first columns."""
    first = [F.col(c) for c in order]
    rest = [F.col(f"`{c}`") for c in rows.columns if c not in order]
    return rows.agg(F.array_sort(F.collect_list(F.struct(*first, *rest))).alias("items"))


def _mapped(rows: DataFrame, key: str, value: Column) -> DataFrame:
    """One row: ``items``, a map from the text of ``key`` (null: "null") to ``value``."""
    entry = F.struct(F.coalesce(F.col(key).cast("string"), F.lit("null")).alias("key"), value.alias("value"))
    return rows.agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("items"))


def _document(parts: dict[str, DataFrame]) -> DataFrame:
    """One row with a column for each part, from frames of one row."""
    out = None
    for name, part in parts.items():
        column = "items" if part.columns == ["items"] else None
        packed = part.select((F.col(column) if column else F.struct("*")).alias(name), F.lit(0).alias("_one"))
        out = packed if out is None else out.join(packed, "_one")
    return out.drop("_one")


def repair_document(plan: DataFrame, balance: DataFrame, label_col: str) -> DataFrame:
    """One row: ``class_balance`` (rows and share per label) and the numbered ``suggestions``."""
    share = F.struct("n", "fraction")
    return _document({"class_balance": _mapped(balance, label_col, share),
                      "suggestions": _listed(plan, "position")})


def dataset_document(df: DataFrame, text_col: str, label_col: str, id_col: str, attr_col: str | None,
                     toxicity: scoring.Scorer, threshold: float = SIMILARITY_THRESHOLD) -> DataFrame:
    """One row: schema, duplicates with their first rows, classes, toxicity, similar pairs, fairness."""
    found = similarity.similar_texts(df, text_col, id_col, threshold)
    top = scoring.top_label(df.select(id_col, text_col), text_col, toxicity)
    profile = F.struct("column_type", "n_null", "n_empty")
    parts = {
        "schema": _mapped(health.column_profile(df), "column_name", profile),
        "exact_duplicates": health.exact_duplicate_count(df, text_col),
        "duplicate_rows": _listed(health.duplicate_rows(df, text_col, id_col, SHOWN_ROWS), id_col),
        "class_distribution": _mapped(health.label_distribution(df, label_col), label_col, F.col("n")),
        "class_extremes": health.label_extremes(df, label_col),
        "toxicity": _mapped(top.groupBy("label").agg(
            F.count("*").alias("n"), F.avg("score").alias("mean_score"), F.max("score").alias("max_score")),
            "label", F.struct("n", "mean_score", "max_score")),
        "similarity": similarity.pair_count(found),
        "similar_pairs": _ranked_pairs(similarity.pair_preview(found, SHOWN_PAIRS)),
    }
    if attr_col and attr_col in df.columns:
        ones = df.select(label_col, attr_col, F.lit(1).alias("_ones"))
        parts["fairness"] = fairness.attribute_fairness(ones, label_col, "_ones", attr_col)
    return _document(parts)


def _ranked_pairs(pairs: DataFrame) -> DataFrame:
    """The preview, best pairs first: sorted by the similarity negated, which then goes."""
    items = F.array_sort(F.collect_list(F.struct((-F.col("similarity")).alias("minus"), "idx1", "idx2", "text1", "text2")))
    return pairs.agg(F.transform(items, lambda p: F.struct(
        p["idx1"].alias("idx1"), p["idx2"].alias("idx2"), (-p["minus"]).alias("similarity"),
        p["text1"].alias("text1"), p["text2"].alias("text2"))).alias("items"))


def write_document(document: DataFrame, path: str) -> None:
    """The one row as a JSON file, stamped with the time of writing."""
    document.withColumn("generated_at", F.current_timestamp()).coalesce(1).write.mode("overwrite").json(path)
