"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a cluster should run with. Sizes are left to AQE: it splits skewed
# join and rebalance partitions and merges small ones at run time.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Recording the Python line of every column costs more than building small plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """Session with the recommended settings; `conf` keys use '__' for '.'."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = RECOMMENDED | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Day and hour boundaries are UTC, whatever zone the session came with."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by spark.checkpoint.dir.

    Only a local session may go without it; it then gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="wickwork-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """Unused path below the shared folder."""
    return f"{shared_dir(spark)}/wickwork/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder once and return a scan of what was written.

    Used where a result feeds several branches: they then share one computation,
    lost executors cannot undo it, each branch reads only its own columns, and
    join planning sees the real file size instead of a guess.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_by(df: DataFrame, name: str, by: list[str]) -> DataFrame:
    """`staged`, in a folder per value of a few columns with few values."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
