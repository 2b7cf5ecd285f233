"""Hourly and daily facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wickwork import constants as C
from wickwork.functions.candle import pct_change
from wickwork.operators.numbering import previous_in_order

SERIES = ["exchange_id", "symbol_id"]
HOURLY_KEY = [*SERIES, "datetime_id"]
DAILY_KEY = [*SERIES, "date_id"]


def hourly_fact(
    silver: DataFrame, exchanges: DataFrame, symbols: DataFrame, datetimes: DataFrame
) -> DataFrame:
    """Silver rows with the keys of their dimensions, and the change within the hour.

    Rows without a match in a dimension are left out; `orphans` reports them.
    Exchanges are as many as there are configured feeds, so they are broadcast; a
    shuffle on so few values would put all rows into a handful of tasks. The other
    joins are not hinted. Staged or read from tables, those dimensions have a known
    size: Spark broadcasts a small one and joins a large one by sort and merge, where
    AQE splits the rows of a hot key.
    """
    return (
        silver.join(F.broadcast(exchanges), silver["exchange"] == exchanges["exchange_name"])
        .join(symbols, silver["symbol"] == symbols["symbol_name"])
        .join(datetimes.select("datetime_id"), silver["open_time"] == datetimes["datetime_id"])
        .withColumn("variation_1h_pct", pct_change(F.col("close"), F.col("open")))
        .withColumnsRenamed({
            "open": "open_price", "high": "high_price", "low": "low_price", "close": "close_price",
        })
        .select(*C.HOURLY_COLUMNS)
    )


def resample(candles: DataFrame, keys: list[str], time_col: str) -> DataFrame:
    """Merge the candles of each key into one.

    First open, highest high, lowest low, last close, summed volume and trades.
    One hash aggregate: opening and closing are taken by time, with no window and
    no self-join, and each task merges its own candles before the shuffle.
    """
    return candles.groupBy(*keys).agg(
        F.min_by("open_price", time_col).alias("open_price"),
        F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"),
        F.max_by("close_price", time_col).alias("close_price"),
        F.sum("volume").alias("volume"),
        F.sum("trade_count").alias("trade_count"),
        F.max_by("close_time", time_col).alias("close_time"),
        F.max("ingested_at").alias("ingested_at"),
    )


def daily_candles(hourly: DataFrame) -> DataFrame:
    """One candle per series and day, without variations."""
    by_day = hourly.withColumn("date_id", F.to_date("datetime_id"))
    return resample(by_day, DAILY_KEY, "datetime_id")


def previous(df: DataFrame, column: str, out: str, keys: list[str], order_col: str) -> DataFrame:
    """The column's value in the row before, within each key.

    One task holds a key's rows, so the order must be a bounded one: a daily
    series has one row per day and stays below a few thousand rows. For longer
    series there is `previous_in_order`.
    """
    before = Window.partitionBy(*keys).orderBy(order_col)
    return df.withColumn(out, F.lag(column).over(before))


def with_variations(daily: DataFrame) -> DataFrame:
    """Change within the day, and against the close of the previous day that has data."""
    lagged = previous(daily, "close_price", "_prev_close", SERIES, "date_id")
    return lagged.withColumns({
        "variation_daily_pct": pct_change(F.col("close_price"), F.col("open_price")),
        "variation_prev_day_pct": pct_change(F.col("close_price"), F.col("_prev_close")),
    }).select(*C.DAILY_COLUMNS)


def daily_fact(hourly: DataFrame) -> DataFrame:
    """One row per series and day, from the hourly fact."""
    return with_variations(daily_candles(hourly))


def with_prev_gap(daily: DataFrame) -> DataFrame:
    """Days since the previous row of the series: 1 where no day is missing."""
    lagged = previous(daily, "date_id", "_prev_date", SERIES, "date_id")
    return lagged.withColumn(
        "prev_date_gap_days", F.date_diff("date_id", "_prev_date")
    ).drop("_prev_date")


def with_previous_hour(hourly: DataFrame) -> DataFrame:
    """Change against the close of the previous hour that has data, and how many hours ago that was.

    An hourly series has no useful bound, so it is not gathered in one task.
    """
    before = {"prev_close_price": "close_price", "_prev_hour": "datetime_id"}
    lagged = previous_in_order(hourly, before, SERIES, "datetime_id")
    return lagged.withColumns({
        "variation_prev_hour_pct": pct_change(F.col("close_price"), F.col("prev_close_price")),
        "prev_gap_hours": F.timestamp_diff("HOUR", F.col("_prev_hour"), F.col("datetime_id")),
    }).drop("_prev_hour")


def with_processed_at(fact: DataFrame) -> DataFrame:
    """Planned attribute: when the fact row was computed."""
    return fact.withColumn("processed_at", F.current_timestamp())
