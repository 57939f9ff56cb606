"""Ranks, running totals, quantiles and exact row quotas without a single-task window.

The shared idea: rows are spread over partitions by ranges of the order, counted per partition,
and a window opens only inside a partition; what comes before a partition is a sum over the few
rows of a table with one row for each.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textcheck.functions.seeded import HASH_BITS, seeded_hash
from textcheck.session import materialise

QUOTA_BITS = 16


def _spread(df: DataFrame, *order: str | Column) -> DataFrame:
    """Rows with ``_part``: the number of the range of ``order`` they lie in, written once, so that
    all that follows sees the same ranges."""
    return materialise(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))


def ranked(df: DataFrame, *order: str | Column, name: str = "rank") -> DataFrame:
    """Add the place of each row in ``order``, from 1; rows should differ in it."""
    spread = _spread(df, *order)
    # One row for each partition.
    before = spread.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return spread.withColumn("_within", within).join(F.broadcast(before), "_part").select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("_before") + F.col("_within")).alias(name))


def running_counts(values: DataFrame, count_cols: Sequence[str]) -> DataFrame:
    """Counts per distinct value, with running totals up to and with the value.

    ``values`` is (feature, value, *count_cols) with 0/1 (or larger) counts. Rows
    with equal values are added up first, so a value that fills a third of the
    table is one row afterwards. Adds ``<count>_upto`` and ``<count>_all``.
    """
    grouped = _spread(values.groupBy("feature", "value").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in count_cols]), "feature", "value")
    earlier = Window.partitionBy("feature").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("feature")
    # One row for each partition, and one more for each feature that begins inside of one.
    offsets = grouped.groupBy("feature", "_part").agg(*[F.sum(c).alias(c) for c in count_cols]).select(
        "feature", "_part",
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in count_cols],
        *[F.sum(c).over(whole).alias(f"{c}_all") for c in count_cols])
    inside = Window.partitionBy("feature", "_part").orderBy("value").rowsBetween(
        Window.unboundedPreceding, 0)
    running = grouped.select(
        "*", *[F.sum(c).over(inside).alias(f"{c}_in") for c in count_cols])
    return running.join(F.broadcast(offsets), ["feature", "_part"]).select(
        "feature", "value", *count_cols,
        *[(F.col(f"{c}_before") + F.col(f"{c}_in")).alias(f"{c}_upto") for c in count_cols],
        *[f"{c}_all" for c in count_cols])


def largest_remainders(sizes: DataFrame, frac: float) -> DataFrame:
    """(group, n, take): ``floor(frac * total)`` rows shared out in proportion to ``n``; what
    rounding leaves over goes to the largest remainders, then null and the smallest groups."""
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()["total"]
    wanted = int(frac * total)
    share = F.col("n") / F.lit(max(total, 1)) * F.lit(wanted)
    shared = sizes.select("group", "n", F.floor(share).alias("whole"),
                          (F.floor(share) - share).alias("short"))
    shared = materialise(shared)
    spare = wanted - (shared.agg(F.sum("whole")).first()[0] or 0)
    return ranked(shared, "short", F.col("group").isNotNull(), "group").select(
        "group", "n", (F.col("whole") + (F.col("rank") <= spare).cast("bigint")).alias("take"))


def flag_by_quota(df: DataFrame, group: str, id_col: str, seed: int, flag: str,
                  quota: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Mark an exact number of rows of every group, chosen by seeded hash.

    ``quota`` turns (group, n) into (group, n, take); ids are unique, and there may be any number
    of groups. The hash range is cut into 2**16 buckets. Bucket counts tell in which bucket a
    group's quota ends, and only the rows of that bucket (about 1/65536 of the
    group) are ranked. What comes out is one cut (hash, id) per group, so that
    marking the rows is a comparison. Rules and edges are written first, so that Spark knows their
    size: it broadcasts small ones, and splits the rows of a hot group where it has to shuffle.
    """
    hashed = seeded_hash(seed, F.col(id_col))
    slim = materialise(df.select(F.col(group).alias("group"), F.col(id_col).alias("_id"),
                                 hashed.alias("_hash")))
    sizes = materialise(slim.groupBy("group").agg(F.count("*").alias("n")))
    takes = materialise(quota(sizes).select("group", "n", F.col("take").cast("bigint").alias("take")))
    part = takes.where("take > 0 AND take < n").select(F.col("group").alias("_key"), "take")
    cuts = _cuts(slim, part)
    same = F.col("_key").eqNullSafe(F.col("group"))
    rules = materialise(takes.where("take > 0").join(cuts, same, "left").select(
        F.col("group").alias("_group"), "_cut_hash", "_cut_id", (F.col("take") >= F.col("n")).alias("_whole")))
    chosen = F.col("_whole") | (hashed < F.col("_cut_hash")) | (
        (hashed == F.col("_cut_hash")) & (F.col(id_col) <= F.col("_cut_id")))
    return df.join(rules, F.col(group).eqNullSafe(F.col("_group")), "left").select(
        *df.columns, F.coalesce(chosen, F.lit(False)).alias(flag))


def _cuts(slim: DataFrame, takes: DataFrame) -> DataFrame:
    """(_key, _cut_hash, _cut_id): the last row within each quota."""
    bucketed = slim.withColumn("_bucket", F.shiftright("_hash", HASH_BITS - QUOTA_BITS))
    upto = Window.partitionBy("group").orderBy("_bucket")
    edges = materialise(
        bucketed.groupBy("group", "_bucket").agg(F.count("*").alias("_n"))
        .withColumn("_upto", F.sum("_n").over(upto))
        .join(takes, F.col("group").eqNullSafe(F.col("_key")))
        .filter((F.col("_upto") >= F.col("take")) & (F.col("_upto") - F.col("_n") < F.col("take")))
        .select("_key", F.col("_bucket").alias("_edge"),
                (F.col("take") - F.col("_upto") + F.col("_n")).alias("_left"))
    )
    order = Window.partitionBy("_key").orderBy("_hash", "_id")
    # One edge per group.
    return bucketed.join(edges, F.col("group").eqNullSafe(F.col("_key"))
                         & (F.col("_bucket") == F.col("_edge"))).withColumn(
        "_rank", F.row_number().over(order)).filter(F.col("_rank") == F.col("_left")).select(
        "_key", F.col("_hash").alias("_cut_hash"), F.col("_id").alias("_cut_id"))


def exact_quantiles(values: DataFrame, probs: Sequence[float]) -> DataFrame:
    """(feature, quantiles): exact quantiles with linear interpolation."""
    counted = running_counts(
        values.filter(F.col("value").isNotNull())
        .select("feature", F.col("value").cast("double").alias("value"), F.lit(1).alias("n")),
        ["n"])

    def at_rank(rank: Column) -> Column:
        held = (F.col("n_upto") - F.col("n") <= rank) & (rank < F.col("n_upto"))
        return F.max(F.when(held, F.col("value")))

    picks, names = [], []
    for i, prob in enumerate(probs):
        place = (F.col("n_all") - 1) * F.lit(float(prob))
        low = F.floor(place)
        picks += [at_rank(low).alias(f"low_{i}"), at_rank(F.ceil(place)).alias(f"high_{i}"),
                  F.max(place - low).alias(f"part_{i}")]
        names.append(F.col(f"low_{i}") + (F.col(f"high_{i}") - F.col(f"low_{i}"))
                     * F.col(f"part_{i}"))
    return counted.groupBy("feature").agg(*picks).select(
        "feature", F.array(*names).alias("quantiles"))


def as_features(df: DataFrame, columns: dict[str, Column], *keep: str) -> DataFrame:
    """Long (feature, value) rows from named numeric columns, in one scan."""
    entries = F.array(*[F.struct(F.lit(name).alias("feature"),
                                 col.cast("double").alias("value"))
                        for name, col in columns.items()])
    return df.select(*keep, F.inline(entries))
