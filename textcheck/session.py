"""Session settings and reliable materialisation."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: With it, the files of a query's shuffles go when the query ends.
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "textcheck", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators count on.

    ``master`` and ``shuffle_partitions`` are left to the cluster unless given.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir``, which all executors share.

    Only a local session without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        shared = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
            "spark.checkpoint.dir", None)
        if not shared:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            shared = os.path.join(tempfile.mkdtemp(prefix="textcheck-"), "checkpoints")
        context.setCheckpointDir(shared)
    return context.getCheckpointDir()


def new_folder(spark: SparkSession) -> str:
    """A fresh path in the shared folder; what is written there goes when the session ends."""
    folder = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return f"{folder}/table"


@contextmanager
def small_batches(spark: SparkSession, rows: int | None) -> Iterator[None]:
    """While it lasts, what is written sends at most ``rows`` rows to a Python worker at once."""
    before = spark.conf.get(BATCH_CONF)
    if rows:
        spark.conf.set(BATCH_CONF, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        if rows:
            spark.conf.set(BATCH_CONF, before)


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """While it lasts, the shuffle files of a query that is run go when it ends."""
    before = spark.conf.get(CLEANUP_CONF, "false")
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP_CONF, before)


def materialise(df: DataFrame, batch_rows: int | None = None, **options: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and go on from the files.

    For frames that several branches of one plan read: the work before them is
    done once, later scans read only their columns, and a lost executor costs a
    re-read, not a re-run of the lineage. What was shuffled for them goes once they
    are written. ``batch_rows``: see ``small_batches``; ``options`` are those of the
    Parquet writer.
    """
    spark, folder = df.sparkSession, new_folder(df.sparkSession)
    with small_batches(spark, batch_rows), short_lived_shuffles(spark):
        df.write.options(**options).parquet(folder)
    out = spark.read.schema(df.schema).parquet(folder)
    out.scratch_folder = folder
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the files of frames from ``materialise`` that nothing reads any more."""
    for df in frames:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.scratch_folder)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
