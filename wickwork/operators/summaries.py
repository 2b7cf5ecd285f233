"""Small stored levels above the facts, and what is answered from them alone.

`day_cells` has a few rows per day: counts, sums, and bitmaps of the exchanges and symbols
seen. Bitmaps of several days merge by OR, so distinct counts over any days are exact, and a
refresh of one day replaces that day's cells only. `month_candles` has one row per series
and month; a period is made of the months that lie wholly in it and of days at its two ends.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickwork.functions.candle import pct_change
from wickwork.operators.facts import SERIES

_MEMBERS = {"exchange": "exchange_id", "symbol": "symbol_id"}


def day_cells(fact: DataFrame, variations: dict[str, str], moment: str, hour: str | None = None) -> DataFrame:
    """One row per `date_id` and 32,768 exchange and symbol keys.

    `moment` gives the first and last time of a cell; of each column in `variations` (short name:
    column) its sum and number of values are kept. With `hour`, a timestamp of whole hours,
    the hours seen are bits of one number. NULL keys are counted as rows, not as members.
    """
    buckets = [F.bitmap_bucket_number(key).alias(f"{name}_bucket") for name, key in _MEMBERS.items()]
    members = [F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias(f"{name}s") for name, key in _MEMBERS.items()]
    sums = [c for name, column in variations.items() for c in (F.sum(column).alias(f"{name}_sum"), F.count(column).alias(f"{name}_rows"))]
    hours = F.bit_or(F.call_function("shiftleft", F.lit(1), F.hour(hour))) if hour else F.lit(None).cast("int")
    return fact.groupBy("date_id", *buckets).agg(
        F.count(F.lit(1)).alias("total_records"), *members, hours.alias("hours"),
        F.min(moment).alias("first_moment"), F.max(moment).alias("last_moment"), *sums,
    ).withColumn("hours", F.coalesce("hours", F.lit(0)))


def hourly_cells(hourly: DataFrame) -> DataFrame:
    with_day = hourly if "date_id" in hourly.columns else hourly.withColumn("date_id", F.to_date("datetime_id"))
    return day_cells(with_day, {"variation": "variation_1h_pct"}, "close_time", "datetime_id")


def daily_cells(daily: DataFrame) -> DataFrame:
    return day_cells(daily, {"daily": "variation_daily_pct", "prev_day": "variation_prev_day_pct"}, "close_time")


def _distinct(cells: DataFrame, name: str) -> Column:
    """Members seen in any cell; one bitmap per 32,768 keys is merged, whatever the rows."""
    merged = cells.groupBy(f"{name}_bucket").agg(F.bitmap_count(F.bitmap_or_agg(f"{name}s")).alias("members"))
    return merged.agg(F.coalesce(F.sum("members"), F.lit(0))).scalar()


def _average(name: str) -> Column:
    return F.round(F.sum(f"{name}_sum") / F.nullif(F.sum(f"{name}_rows"), F.lit(0)), 2)


def hourly_summary_of(cells: DataFrame) -> DataFrame:
    """`quality.hourly_summary` from the cells of the hourly fact. Stage or store the cells."""
    hours = cells.groupBy("date_id").agg(F.bit_count(F.bit_or("hours")).alias("hours")).agg(F.sum("hours")).scalar()
    whole = cells.agg(
        F.coalesce(F.sum("total_records"), F.lit(0)).alias("total_records"), F.min("first_moment").alias("min_datetime"),
        F.max("last_moment").alias("max_datetime"), _average("variation").alias("avg_variation_pct"),
    )
    return whole.select(
        "total_records", _distinct(cells, "exchange").alias("distinct_exchanges"), _distinct(cells, "symbol").alias("distinct_symbols"),
        F.coalesce(hours, F.lit(0)).cast("bigint").alias("distinct_datetimes"), "min_datetime", "max_datetime", "avg_variation_pct",
    )


def daily_summary_of(cells: DataFrame) -> DataFrame:
    """`quality.daily_summary` from the cells of the daily fact."""
    whole = cells.agg(
        F.coalesce(F.sum("total_records"), F.lit(0)).alias("total_records"), F.count_distinct("date_id").alias("distinct_dates"),
        F.min("date_id").alias("min_date"), F.max("date_id").alias("max_date"),
        _average("daily").alias("avg_variation_daily"), _average("prev_day").alias("avg_variation_prev_day"),
    )
    return whole.select(
        "total_records", _distinct(cells, "exchange").alias("distinct_exchanges"), _distinct(cells, "symbol").alias("distinct_symbols"),
        "distinct_dates", "min_date", "max_date", "avg_variation_daily", "avg_variation_prev_day",
    )


def range_profile_of(days: DataFrame) -> DataFrame:
    """`quality.range_profile` from `dims.series_days`."""
    return days.agg(
        F.min("rate_date").alias("min_date"), F.max("rate_date").alias("max_date"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_rows"),
        F.count_distinct("rate_date").alias("distinct_dates"), F.count_distinct("symbol").alias("distinct_symbols"),
    )


# Months ---------------------------------------------------------------------

_PIECE = [*SERIES, "first_day", "last_day", "first_close", "last_close", "volume", "trade_count"]


def month_candles(daily: DataFrame) -> DataFrame:
    """One row per series and month: first and last day with data and their closes, volume and trades."""
    month = F.trunc("date_id", "month").alias("month")
    return daily.groupBy(*SERIES, month).agg(
        F.min("date_id").alias("first_day"), F.max("date_id").alias("last_day"),
        F.min_by("close_price", "date_id").alias("first_close"), F.max_by("close_price", "date_id").alias("last_close"),
        F.sum("volume").alias("volume"), F.sum("trade_count").alias("trade_count"),
    )


def whole_months(start: dt.date, end: dt.date) -> tuple[dt.date, dt.date]:
    """First day of the first month that lies wholly in the period, and the first day after the last such month."""
    low = start if start.day == 1 else (start.replace(day=1) + dt.timedelta(days=31)).replace(day=1)
    return low, (end + dt.timedelta(days=1)).replace(day=1)


def period_pieces(daily: DataFrame, months: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Rows that make up the period for each series: its whole months, and the days before and after them.

    Both bounds reach the scans, so of a table partitioned by `date_id` at most two months
    of partitions are read, however long the period.
    """
    day, low, high = F.col("date_id"), *whole_months(start, end)
    inside = day.between(F.lit(start), F.lit(end))
    if low < high:
        inside &= (day < F.lit(low)) | (day >= F.lit(high))
    days = daily.where(inside).select(
        *SERIES, day.alias("first_day"), day.alias("last_day"), F.col("close_price").alias("first_close"),
        F.col("close_price").alias("last_close"), "volume", "trade_count",
    )
    if low >= high:
        return days
    return days.unionByName(months.where((F.col("month") >= F.lit(low)) & (F.col("month") < F.lit(high))).select(*_PIECE))


def return_of(pieces: DataFrame) -> DataFrame:
    """`metrics.accumulated_return` from the pieces of a period."""
    ends = pieces.groupBy(*SERIES).agg(
        F.min_by("first_close", "first_day").alias("first_price"), F.max_by("last_close", "last_day").alias("last_price")
    )
    return ends.withColumn("return_pct", pct_change(F.col("last_price"), F.col("first_price")))


def volume_of(pieces: DataFrame) -> DataFrame:
    """`metrics.volume_traded` from the pieces of a period."""
    return pieces.groupBy(*SERIES).agg(F.sum("volume").alias("volume"), F.sum("trade_count").alias("trade_count"))


def index_base_100_of(daily: DataFrame, pieces: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """`metrics.index_base_100` over a part of the period: the base comes from the pieces of the whole one."""
    base = pieces.groupBy(*SERIES).agg(F.min_by("first_close", "first_day").alias("base_price"))
    index = F.col("close_price") / F.nullif(F.col("base_price"), F.lit(0)) * 100
    shown = daily.where(F.col("date_id").between(F.lit(start), F.lit(end)))
    return shown.join(base, SERIES).select(*SERIES, "date_id", "close_price", "base_price", index.alias("index_100"))
