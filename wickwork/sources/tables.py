"""Stored tables: Parquet datasets, partitioned by day where they are large."""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wickwork.operators.latest import dedupe_latest
from wickwork.session import staged

log = logging.getLogger(__name__)


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Count rows, for the log, during the write instead of in a pass of its own."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _exists(spark: SparkSession, path: str) -> bool:
    """Asked of the path's own file system: a failing read would fill the log with stack traces."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """Scan of a stored table; None, with a warning, when it does not exist yet."""
    if not _exists(spark, path):
        log.warning("table %s does not exist yet", path)
        return None
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)


def _write(df: DataFrame, path: str, by: str | None, overwrite: str) -> int:
    """REBALANCE gathers a partition's rows into well-sized files, and lets AQE
    split a day that is far larger than the others over several tasks."""
    df, seen = _counted(df.hint("rebalance", by) if by else df)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", overwrite)
    (writer.partitionBy(by) if by else writer).parquet(path)
    return seen.get["rows"]


def write_table(df: DataFrame, path: str, by: str | None = None) -> int:
    """Replace the whole table; returns the rows written."""
    return _write(df, path, by, "static")


def write_partitions(df: DataFrame, path: str, by: str = "rate_date") -> int:
    """Replace only the partitions that `df` has rows for; returns the rows written."""
    return _write(df, path, by, "dynamic")


def days_held(df: DataFrame, by: str, start: dt.date, end: dt.date) -> set[dt.date]:
    """Days of the range that have rows; no more than the calendar has."""
    return {row[by] for row in df.where(F.col(by).between(F.lit(start), F.lit(end))).select(by).distinct().collect()}


def empty_days(stored: DataFrame, path: str, days: set[dt.date], by: str = "rate_date") -> None:
    """Leave the given days of a stored table without rows. Other days are not touched."""
    none = stored.sparkSession.createDataFrame([], stored.drop(by).schema)
    for day in sorted(days):
        none.write.mode("overwrite").parquet(f"{path}/{by}={day}")


def merge_days(df: DataFrame, path: str, keys: list[str], by: str = "rate_date") -> int:
    """Add late rows to days that are already stored; the later load of a key wins.

    Replacing a day with a part of it would drop the rest of the day, so the stored
    rows of those days, and of no others, are read and written again. The merged days
    are staged first, so the table is never read while it is replaced.
    """
    spark = df.sparkSession
    stored = read_table(spark, path)
    if stored is None:
        return write_partitions(dedupe_latest(df, keys), path, by)
    days = [row[by] for row in df.select(by).distinct().collect()]  # no more than the calendar has
    merged = dedupe_latest(stored.where(F.col(by).isin(days)).unionByName(df), keys)
    return write_partitions(staged(merged, "merged-days"), path, by)


def partition_inventory(df: DataFrame, by: str = "rate_date") -> DataFrame:
    """Sorted days that a frame or table holds."""
    return df.select(by).distinct().orderBy(by)


def missing_days(df: DataFrame, start: dt.date, end: dt.date, by: str = "rate_date") -> DataFrame:
    """Days from `start` through `end` without a single row."""
    calendar = df.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))).alias(by)
    )
    return calendar.join(df.select(by).distinct(), by, "left_anti").orderBy(by)


def preview(df: DataFrame, rows: int = 100) -> DataFrame:
    """A few rows to look at."""
    return df.limit(rows)
