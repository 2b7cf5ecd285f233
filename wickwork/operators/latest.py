"""Latest version of each row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedupe_latest(df: DataFrame, keys: list[str], order_col: str = "ingested_at") -> DataFrame:
    """One row per key: the one loaded last.

    The remaining columns break ties, so a rerun gives the same row. Spark
    limits each group to one row before the shuffle as well as after it, so a
    key with very many copies sends one row per task.
    """
    rest = [c for c in df.columns if c not in keys and c != order_col]
    newest = Window.partitionBy(*keys).orderBy(F.desc(order_col), *[F.desc(c) for c in rest])
    return df.withColumn("_version", F.row_number().over(newest)).where("_version = 1").drop("_version")


def latest_known(df: DataFrame, keys: list[str], order_col: str = "ingested_at") -> DataFrame:
    """`dedupe_latest` for rows with a complete key; rows that lack a part of it are all kept."""
    complete = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    return dedupe_latest(df.where(complete), keys, order_col).unionByName(df.where(~complete))
