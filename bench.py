"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the number of local cores. Each
query runs from the given tables to its last row. `daily_fact_x50` repeats the
events over 50 times as many series, to load the resample with more than a demo.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickwork.operators import facts
from wickwork.plans import contract
from wickwork.session import build_session, staged
from wickwork.sources.events import candles_from_events

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "bronze_parse_binance", "bronze_parse_poloniex", "backfill_equals_daily_loads",
    "silver_hourly", "silver_dedupe_latest", "silver_quality",
    "dim_date", "dim_datetime", "dim_exchange", "dim_symbol",
    "fact_market_hourly", "fact_hourly_summary", "fact_market_daily", "fact_daily_summary",
    "hour_completeness", "daily_equals_hourly", "fk_orphans",
    "accumulated_return", "index_base_100", "rank_by_return",
    "cross_exchange_price", "top_volatile_days", "warehouse_refresh",
]
COPIES = 50


def _finish(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def _timed(job: Callable[[], DataFrame]) -> float:
    start = time.perf_counter()
    _finish(job())
    return round(time.perf_counter() - start, 3)


def _copied_hours(spark: SparkSession) -> DataFrame:
    """Hourly fact rows of the events, repeated as further symbols. Not timed."""
    candles = candles_from_events(spark.read.parquet(f"{SF_DIR}/events.parquet"))
    opened = F.timestamp_millis("open_time_ms")
    copy = F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))).alias("copy")
    prices = {f"{f}_price": F.col(f).cast("decimal(18,8)") for f in ("open", "high", "low", "close")}
    rows = candles.select("*", copy).select(
        F.hash("symbol", "copy").alias("symbol_id"),
        F.when(F.col("exchange") == "binance", 1).otherwise(2).alias("exchange_id"),
        opened.alias("datetime_id"),
        *[c.alias(n) for n, c in prices.items()],
        F.col("volume").cast("decimal(18,8)").alias("volume"),
        "trade_count",
        F.timestamp_millis("close_time_ms").alias("close_time"),
        opened.alias("ingested_at"),
    )
    return staged(rows, "copied-hours")


def main() -> None:
    spark = build_session(
        "wickwork-bench", f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    _finish(contract.run("silver_profile", spark, SF_DIR))  # starts the engine
    times = {n: _timed(lambda n=n: contract.run(n, spark, SF_DIR)) for n in HEADLINE}
    hours = _copied_hours(spark)
    times[f"daily_fact_x{COPIES}"] = _timed(lambda: facts.daily_fact(hours))
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
