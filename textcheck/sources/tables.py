"""Reading and writing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def load_dataset(spark: SparkSession, path: str, fmt: str | None = None,
                 schema: T.StructType | str | None = None, multi_line: bool = True) -> DataFrame:
    """Read a CSV (with header), JSON or Parquet table; ``fmt`` follows the end of the path.

    Without ``schema`` the types of a CSV file are inferred, which reads the file
    once more; give a schema or use Parquet for large inputs. Quoted cells may
    hold line breaks, so one CSV file is read by one task: keep files moderate, or
    say ``multi_line=False`` where no cell has any, and files are split.
    """
    name = path.rstrip("/").rsplit("/", 1)[-1].lower().removesuffix(".gz")
    fmt = fmt or next((kind for kind in ("csv", "json") if name.endswith(f".{kind}")), "parquet")
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        return reader.options(header=True, multiLine=multi_line, escape='"',
                              inferSchema=schema is None).csv(path)
    return reader.format(fmt).load(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give every core work where a table has fewer splits than the cluster cores.

    Text expressions are CPU work, and a small table may be one split. A table of
    many splits is left alone, so large inputs are never shuffled here.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)


def dataset_shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(F.count("*").alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("bigint"))


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: list[str] | None = None) -> None:
    """Write a table; Parquet unless told otherwise."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.options(header=True, escape='"').csv(path)
    else:
        writer.format(fmt).save(path)

