"""Small helpers of the operators in this folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickwork.session import staged

__all__ = ["read", "staged", "components"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """(node, root) of every node of `edges` (a, b), the root being the smallest node it reaches.

    Alternates large-star and small-star steps until the edges are stars. Hot nodes do
    not gather in a task: minima are merged in the tasks, and joins split skewed keys.
    Each round is written to the shared folder, so a lost executor repeats one round.
    """
    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum("b")).first())

    now = staged(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "edges"
    )
    seen = state(now)
    for _ in range(rounds):
        if not seen[0]:
            break
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()
        small_min = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(small_min, "a")
            .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b").where("a > b").distinct()
        )
        now = staged(small, "edges")
        before, seen = seen, state(now)
        if before == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
    if seen[0]:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
