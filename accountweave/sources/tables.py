"""Reading and writing tables by path.

A table that is replaced whole is kept in versions (see ``versions``): ``read_table`` opens the one that counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accountweave.sources import versions


def read_path(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet table at ``path``, its current version where it has versions."""
    return spark.read.parquet(versions.current(spark, path) or path)


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A Parquet table; a missing one is Spark's own PATH_NOT_FOUND error."""
    return read_path(spark, f"{base}/{name}")


def first_table_or_empty(spark: SparkSession, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    """The first of the candidate paths that exists, else an empty table with ``schema``."""
    for path in paths:
        try:
            return read_path(spark, path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return spark.createDataFrame([], schema)


def write_counted(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "errorifexists",
    sort_by: Sequence[str] = (),
    bloom: Sequence[str] = (),
    **options: str,
) -> int:
    """Write Parquet files and return the number of rows, observed as they are written: no second job counts them.

    With ``partition_by`` the rows are brought together by partition value, so that each partition is written as a few
    files rather than by every task; large partitions are split again at run time. With ``sort_by`` files (of a
    partition) are sorted, without partitions they hold ranges too, so that bounds on these columns skip files and row
    groups. ``bloom`` columns get bloom filters, for equality on columns that the files are not sorted by.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
        df = df.sortWithinPartitions(*partition_by, *sort_by) if sort_by else df
    elif sort_by:
        df = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
    seen = Observation("rows written")
    writer = df.observe(seen, F.count(F.lit(1)).alias("row_count")).write.mode(mode).options(**options)
    for column in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return seen.get["row_count"]


def write_table(
    df: DataFrame,
    base: str,
    name: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    stamp: str | None = None,
    sort_by: Sequence[str] = (),
    bloom: Sequence[str] = (),
) -> int:
    """Write a Parquet table and return its row count (see ``write_counted``).

    ``overwrite`` writes a new version and lets it count once it is whole; the version before may be read meanwhile, by
    ``df`` too. ``append`` adds to the current version. ``stamp`` names a column that gets the time of the run.
    """
    spark, table = df.sparkSession, f"{base}/{name}"
    if stamp:
        df = df.withColumn(stamp, F.current_timestamp())
    if mode == "append":
        return write_counted(df, versions.current(spark, table) or table, partition_by, mode, sort_by, bloom)
    if mode != "overwrite":
        raise ValueError(f"mode must be overwrite or append, got {mode!r}")
    folder = versions.new_version(table)
    row_count = write_counted(df, folder, partition_by, sort_by=sort_by, bloom=bloom)
    versions.publish(spark, table, folder)
    return row_count


def write_mart(
    df: DataFrame,
    base: str,
    name: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    sort_by: Sequence[str] = (),
    bloom: Sequence[str] = (),
) -> int:
    return write_table(df, base, name, partition_by, mode, "gold_processed_at", sort_by, bloom)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)
