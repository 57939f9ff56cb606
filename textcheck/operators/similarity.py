"""Near-duplicate pairs over TF-IDF and embedding cosine; train/test leakage.

Rows with the same vector form one group, and groups are compared instead of rows. Pairs of
groups are found, verified and reduced in one place each (``text_pairs``, ``vector_pairs``):
numbers of pairs, links per row, leaks and previews are linear in the rows, however many rows
are alike. Only ``pair_table`` and ``leakage_pairs`` list the pairs of groups themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textcheck.constants import PREFIX_CHARS, SIMILARITY_THRESHOLD
from textcheck.functions import text as tx
from textcheck.functions.checks import require_columns
from textcheck.functions.skew import join_by_key
from textcheck.operators.text_pairs import TextPairs, text_pairs, text_vectors
from textcheck.operators.vector_pairs import BlockPairs, HashPairs, block_pairs, hash_pairs
from textcheck.session import discard, materialise

NEAR = "idx1 long, idx2 long, similarity double"
LINKS = ("rep long, first_partner long, similarity double, earlier_rows long, linked_rows long, "
         "linked_train_rows long")


def _listed(pairs: dict) -> Iterator[pa.RecordBatch]:
    names = ["idx1", "idx2", "similarity"]
    yield pa.RecordBatch.from_arrays([pa.array(pairs[c]) for c in names], names)


def _linked(pairs: dict) -> Iterator[pa.RecordBatch]:
    """Per row of a block: its smallest earlier partner, the best similarity to an earlier one,
    and the rows of its earlier and of all partners."""
    reps, at = np.unique(np.concatenate([pairs["idx1"], pairs["idx2"]]), return_inverse=True)
    early, late = np.split(at, 2)
    size = len(reps)
    first = np.full(size, np.iinfo(np.int64).max)
    np.minimum.at(first, late, pairs["idx1"])
    best = np.full(size, -np.inf)
    np.maximum.at(best, late, pairs["similarity"])
    rows = [np.zeros(size, np.int64) for _ in range(3)]
    np.add.at(rows[0], late, pairs["copies1"])
    np.add.at(rows[1], late, pairs["copies1"])
    np.add.at(rows[1], early, pairs["copies2"])
    np.add.at(rows[2], late, pairs["train_rows1"])
    np.add.at(rows[2], early, pairs["train_rows2"])
    none = ~np.isfinite(best)
    yield pa.RecordBatch.from_arrays(
        [pa.array(reps), pa.array(first, mask=none), pa.array(best, mask=none), *map(pa.array, rows)],
        ["rep", "first_partner", "similarity", "earlier_rows", "linked_rows", "linked_train_rows"])


def _leading(n: int) -> Callable:
    """The first ``n`` pairs of a block by (rounded similarity desc, idx1, idx2)."""

    def reduce(pairs: dict) -> Iterator[pa.RecordBatch]:
        pairs = pairs | {"similarity": np.round(pairs["similarity"], 6)}
        order = np.lexsort((pairs["idx2"], pairs["idx1"], -pairs["similarity"]))[:n]
        yield from _listed({c: v[order] for c, v in pairs.items()})

    return reduce


@dataclass
class SimilarGroups:
    """``rows`` (id, key, text), ``groups`` (key, rep, copies, text) and the ``search`` for pairs
    of group representatives, which is prepared when the object is made."""

    rows: DataFrame
    groups: DataFrame
    search: TextPairs | BlockPairs | HashPairs | None

    def reduced(self, reduce: Callable, schema: str) -> DataFrame:
        if self.search is None:
            return self.rows.sparkSession.createDataFrame([], schema)
        return self.search.reduced(reduce, schema)

    @property
    def batch_rows(self) -> int | None:
        """Rows that the search sends to a worker at once."""
        return self.search.batch_rows if self.search else None

    @cached_property
    def near(self) -> DataFrame:
        """(idx1, idx2, similarity) of all similar pairs of representatives."""
        return materialise(self.reduced(_listed, NEAR), self.batch_rows)

    @cached_property
    def links(self) -> DataFrame:
        """One row for each representative with a similar group: smallest earlier partner, best
        similarity to an earlier one, rows of earlier partners, of all, and training rows of all."""
        return materialise(self.reduced(_linked, LINKS).groupBy("rep").agg(
            F.min("first_partner").alias("first_partner"), F.max("similarity").alias("similarity"),
            *[F.sum(c).alias(c) for c in ("earlier_rows", "linked_rows", "linked_train_rows")]), self.batch_rows)


def _text_rows(df: DataFrame, text_col: str, id_col: str, *keep: str) -> DataFrame:
    """Rows with a vector key, the digest of the sorted words, and the words as numbers."""
    require_columns(df, text_col, id_col, *keep)
    words = F.sort_array(tx.tokens(F.col(text_col)))
    listed = df.select(F.col(id_col).alias("id"),
                       F.substring(text_col, 1, PREFIX_CHARS).alias("text"), words.alias("words"), *keep)
    key = F.unhex(F.sha2(F.array_join("words", " "), 256))
    return materialise(listed.select("id", "text", key.alias("key"), F.transform(
        "words", lambda w: F.xxhash64(w)).alias("terms"), *keep))


def _grouped(rows: DataFrame, train_flag: str | None, *payload: str) -> DataFrame:
    """(key, rep, copies, train_rows, text, payload): one row for each key, from its first row."""
    train = F.count_if(train_flag) if train_flag else F.lit(0)
    counted = rows.groupBy("key").agg(F.min("id").alias("rep"), F.count("*").alias("copies"),
                                      train.cast("bigint").alias("train_rows"))
    return materialise(counted.join(rows.select(F.col("id").alias("rep"), "text", *payload), "rep"))


def similar_texts(df: DataFrame, text_col: str, id_col: str,
                  threshold: float = SIMILARITY_THRESHOLD,
                  train_flag: str | None = None) -> SimilarGroups:
    """Groups of rows with equal words and the search for group pairs with cosine >= threshold.

    Words are told apart by their 64-bit hashes; ids are unique. Terms are many times the rest: they are
    deleted as soon as the vectors are written."""
    listed = _text_rows(df, text_col, id_col, *([train_flag] if train_flag else []))
    rows = materialise(listed.drop("terms"))
    groups = _grouped(rows.filter(F.col("key") != F.unhex(F.sha2(F.lit(""), 256))), train_flag)
    n_docs = rows.count()
    vectors = text_vectors(listed.filter(F.size("terms") > 0), groups, n_docs, threshold)
    discard(listed)
    return SimilarGroups(rows, groups, text_pairs(vectors, groups, n_docs, threshold))


def _vector_groups(df: DataFrame, vector_col: str, id_col: str, text: Column | None) -> tuple[DataFrame, DataFrame]:
    require_columns(df, vector_col, id_col)
    prefix = F.substring(text, 1, PREFIX_CHARS) if text is not None else F.lit(None).cast("string")
    vector = F.col(vector_col)
    length = F.aggregate(vector, F.lit(0.0), lambda a, v: a + v * v)
    rows = df.select(
        F.col(id_col).alias("id"), prefix.alias("text"), vector.alias("vector"),
        F.unhex(F.sha2(vector.cast("string"), 256)).alias("key")).filter(length > 0)
    return rows.drop("vector"), _grouped(rows, None, "vector")


def similar_vectors(df: DataFrame, vector_col: str, id_col: str, text: Column | None = None,
                    threshold: float = SIMILARITY_THRESHOLD) -> SimilarGroups:
    """Groups of equal vectors and the exact search for group pairs with cosine >= threshold."""
    rows, groups = _vector_groups(df, vector_col, id_col, text)
    return SimilarGroups(rows, groups.drop("vector"), block_pairs(groups, threshold))


def hashed_vectors(df: DataFrame, vector_col: str, id_col: str, text: Column | None = None,
                   threshold: float = SIMILARITY_THRESHOLD, **tables: int) -> SimilarGroups:
    """As similar_vectors, by hash tables: every pair is true, a few may be missing."""
    rows, groups = _vector_groups(df, vector_col, id_col, text)
    return SimilarGroups(rows, groups.drop("vector"), hash_pairs(groups, threshold, **tables))


def linked_rows(found: SimilarGroups) -> DataFrame:
    """(id, class_id, n_links): every row, the first row of its group, and the number of other rows
    that are equal or similar to it."""
    sizes = found.groups.join(found.links.select("rep", "linked_rows"), "rep", "left").select(
        "key", F.col("rep").alias("class_id"), "copies",
        (F.col("copies") - 1 + F.coalesce("linked_rows", F.lit(0))).alias("n_links"))
    known = join_by_key(found.rows.select("id", "key"), sizes, "key", "copies").select("id", "class_id", "n_links")
    return found.rows.select("id").join(known, "id", "left").select(
        "id", F.coalesce("class_id", "id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def later_rows(found: SimilarGroups) -> DataFrame:
    """(idx1, idx2, similarity): one row for each row idx2 that is equal or similar to an earlier
    one, with its smallest such partner and the best similarity to one."""
    best = found.groups.join(found.links, "rep", "left").select(
        "key", "rep", "copies", F.least("rep", "first_partner").alias("first"), "first_partner",
        "similarity").where("copies > 1 OR first_partner IS NOT NULL")
    met = join_by_key(found.rows.select("id", "key"), best, "key", "copies")
    copy = F.col("id") != F.col("rep")
    return met.where(copy | F.col("first_partner").isNotNull()).select(
        F.when(copy, F.col("first")).otherwise(F.col("first_partner")).alias("idx1"),
        F.col("id").alias("idx2"), F.when(copy, F.lit(1.0)).otherwise(F.col("similarity")).alias("similarity"))


def pair_table(found: SimilarGroups) -> DataFrame:
    """(idx1, idx2, similarity, copies1, copies2, text1, text2), idx1 < idx2.

    A later copy appears next to the first row of its group with similarity 1;
    a pair of groups appears through their first rows.
    """
    again = found.groups.filter("copies > 1").withColumnRenamed("text", "text1")
    copies = (
        join_by_key(found.rows.withColumnRenamed("text", "text2"), again.select(
            "key", "rep", "text1", "copies"), "key", "copies")
        .filter(F.col("id") != F.col("rep"))
        .select(F.col("rep").alias("idx1"), F.col("id").alias("idx2"),
                F.lit(1.0).alias("similarity"), F.col("copies").alias("copies1"),
                F.col("copies").alias("copies2"), "text1", "text2")
    )
    return with_group_info(found, "copies", "text").select(*copies.columns).unionByName(copies)


def with_group_info(found: SimilarGroups, *names: str, near: DataFrame | None = None) -> DataFrame:
    """Near pairs with columns of both groups, suffixed 1 and 2."""
    out = found.near if near is None else near
    for side in ("1", "2"):
        info = found.groups.select(F.col("rep").alias(f"idx{side}"),
                                   *[F.col(n).alias(f"{n}{side}") for n in names])
        out = out.join(info, f"idx{side}")
    return out


def tfidf_pairs(df: DataFrame, text_col: str, id_col: str,
                threshold: float = SIMILARITY_THRESHOLD) -> DataFrame:
    return pair_table(similar_texts(df, text_col, id_col, threshold))


def embedding_pairs(df: DataFrame, vector_col: str, id_col: str, text: Column | None = None,
                    threshold: float = SIMILARITY_THRESHOLD) -> DataFrame:
    return pair_table(similar_vectors(df, vector_col, id_col, text, threshold))


def pair_count(found: SimilarGroups) -> DataFrame:
    """Pairs of single rows at or above the threshold, from group sizes and links."""
    inside = found.groups.select((F.col("copies") * (F.col("copies") - 1) / 2)
                                 .cast("bigint").alias("n"))
    across = found.links.join(found.groups.select("rep", "copies"), "rep").select(
        (F.col("copies") * F.col("earlier_rows")).alias("n"))
    return inside.unionByName(across).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_pairs"))


def pair_preview(found: SimilarGroups, n: int = 100) -> DataFrame:
    """First ``n`` single-row pairs by (similarity desc, idx1, idx2).

    The first pair of a group (or pair of groups) comes before its other pairs,
    so only the first ``n`` groups count, and in each only the first ``n`` + 1
    members. Spark keeps that many per key before it shuffles.
    """
    size = F.round("similarity", 6)
    order = [F.desc(size), F.col("idx1"), F.col("idx2")]
    member_rank = F.row_number().over(Window.partitionBy("key").orderBy("id"))
    members = found.rows.select("id", "key", "text").withColumn("rank", member_rank).filter(
        F.col("rank") <= n + 1)
    second = members.filter("rank = 2").select("key", F.col("id").alias("idx2"))
    inside = found.groups.join(second, "key").select(
        F.col("rep").alias("idx1"), "idx2", F.lit(1.0).alias("similarity"),
        F.col("key").alias("key1"), F.col("key").alias("key2"))
    near = materialise(found.reduced(_leading(n), NEAR).orderBy(*order).limit(n), found.batch_rows)
    across = with_group_info(found, "key", near=near).select(*inside.columns)
    # n rows with at most n + 1 members on either side.
    leading = F.broadcast(inside.unionByName(across).orderBy(*order).limit(n).select(
        "key1", "key2", "similarity"))
    one = members.select(F.col("key").alias("key1"), F.col("id").alias("a"), F.col("text").alias("ta"))
    two = members.select(F.col("key").alias("key2"), F.col("id").alias("b"), F.col("text").alias("tb"))
    listed = leading.join(one, "key1").join(two, "key2").filter(
        (F.col("key1") != F.col("key2")) | (F.col("a") < F.col("b")))
    ahead = F.col("a") < F.col("b")
    return listed.select(
        F.least("a", "b").alias("idx1"), F.greatest("a", "b").alias("idx2"), "similarity",
        F.when(ahead, F.col("ta")).otherwise(F.col("tb")).alias("text1"),
        F.when(ahead, F.col("tb")).otherwise(F.col("ta")).alias("text2"),
    ).orderBy(*order).limit(n)


def _leaks(found: SimilarGroups) -> DataFrame:
    """Near pairs and single groups in which training and test rows meet."""
    both = found.groups.withColumn("test_rows", F.col("copies") - F.col("train_rows"))
    inside = both.filter("train_rows > 0 AND test_rows > 0").select(
        F.col("rep").alias("idx1"), F.col("rep").alias("idx2"), F.lit(1.0).alias("similarity"),
        (F.col("train_rows") * F.col("test_rows")).alias("n_leaks"))
    wide = with_group_info(SimilarGroups(found.rows, both, None), "train_rows", "test_rows", near=found.near)
    one = F.col("train_rows2") * F.col("test_rows1")
    two = F.col("train_rows1") * F.col("test_rows2")
    across = wide.filter(one + two > 0).select("idx1", "idx2", "similarity", (one + two).alias("n_leaks"))
    return inside.unionByName(across)


def leakage_pairs(flagged: DataFrame, text_col: str, id_col: str, train_flag: str = "is_train",
                  threshold: float = SIMILARITY_THRESHOLD) -> DataFrame:
    """Exact (idx1 = idx2) and near copies shared by training and test rows.

    ``n_leaks`` counts the (training row, test row) pairs behind each line.
    """
    found = similar_texts(flagged, text_col, id_col, threshold, train_flag)
    return _leaks(found).select("idx1", "idx2", "similarity", "n_leaks")


def leakage_free_test(flagged: DataFrame, text_col: str, id_col: str,
                      train_flag: str = "is_train",
                      threshold: float = SIMILARITY_THRESHOLD) -> DataFrame:
    """Test rows without an exact or near copy among the training rows."""
    found = similar_texts(flagged, text_col, id_col, threshold, train_flag)
    leaking = found.groups.join(found.links.select("rep", "linked_train_rows"), "rep", "left").where(
        F.col("train_rows") + F.coalesce("linked_train_rows", F.lit(0)) > 0).select("key", "copies")
    leaked = join_by_key(found.rows.filter(f"NOT {train_flag}").select("id", "key"),
                         leaking, "key", "copies").select(F.col("id").alias(id_col))
    return flagged.filter(f"NOT {train_flag}").join(leaked, id_col, "left_anti")
