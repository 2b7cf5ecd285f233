"""Days stored in buckets by key: late rows meet stored ones without moving them.

A bucketed table is a catalog table over Parquet files, with a folder per day and in it a
file per bucket, the bucket following from the key alone. Spark knows that rows of one key
lie in one bucket, so deduplication, merges and joins on the key run bucket by bucket.
Only late rows are shuffled, once, when they are dealt to the same buckets.

The number of buckets is fixed when a table is made: choose it so that a bucket of a day
has some 128 MB. Many versions of a key do not stay in a bucket: each merge leaves one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickwork.operators.latest import dedupe_latest
from wickwork.session import new_folder

BUCKETS = 64


def create_bucketed(df: DataFrame, table: str, path: str, keys: list[str], buckets: int = BUCKETS, by: str = "rate_date") -> DataFrame:
    """A new table of `df`, which may hold several versions of a key; returns its scan."""
    dealt = df.repartition(buckets, *keys)  # the function of the buckets: a task writes one of them
    writer = dealt.write.partitionBy(by).bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", path).mode("errorifexists").saveAsTable(table)
    return df.sparkSession.table(table)


def buckets_of(spark: SparkSession, table: str) -> int:
    """How many buckets the table was made with."""
    told = {row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    return int(told["Num Buckets"])


def merged(late: DataFrame, table: str, keys: list[str], by: str = "rate_date", order_col: str = "ingested_at") -> DataFrame:
    """The days of `late` with its rows in them, the later load of a key winning; not yet written.

    `late` is a bucketed table of the same keys and number of buckets: nothing is shuffled.
    Equal loads are told apart as in `dedupe_latest`. Rows without a whole key meet no other.
    This is a join, not a union: Spark 4.1 declares a union of bucketed scans to be bucketed,
    but puts their columnar partitions one after the other, so versions of a key would not meet.
    """
    stored = late.sparkSession.table(table)
    days = [row[by] for row in late.select(by).distinct().collect()]  # no more than the calendar has
    rest = [c for c in stored.columns if c not in keys and c != order_col]

    def versions(df: DataFrame, name: str) -> DataFrame:
        return dedupe_latest(df, keys, order_col).select(*keys, F.struct(order_col, *rest).alias(name))

    old, new = versions(stored.where(F.col(by).isin(days)), "_old"), versions(late, "_new")
    both = old.join(new, keys, "full").select(*keys, F.greatest("_old", "_new").alias("_best"))
    return both.select(*keys, "_best.*").select(*stored.columns)


def merge_bucketed(df: DataFrame, table: str, keys: list[str], by: str = "rate_date") -> DataFrame:
    """Add late rows to the days of a bucketed table; returns the table's scan.

    The rows are dealt to buckets first, in the shared folder, which also computes them only once. Days
    are replaced when the whole write has succeeded: the files that are read stay until then.
    """
    spark = df.sparkSession
    buckets = buckets_of(spark, table)
    folder = new_folder(spark, "late")
    name = "late_" + folder.rsplit("-", 1)[1]
    late = create_bucketed(df, name, folder, keys, buckets, by)
    try:
        out = merged(late, table, keys, by)  # in the table's order of columns, as an insert goes by place
        mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        try:
            out.write.insertInto(table, overwrite=True)
        finally:
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.table(table)
