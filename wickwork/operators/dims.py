"""Dimensions of the star schema.

Everything the dimensions need is in the series profile: one row per exchange
and symbol, taken in one pass over silver. Stage the profile, then build the four
dimensions from it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickwork import constants as C
from wickwork.functions.calendar import calendar_parts, hour_period, is_business_hour, month_flags
from wickwork.operators.numbering import number_names


def series_days(silver: DataFrame) -> DataFrame:
    """Rows and times of each exchange, symbol and day: 24 times fewer rows than silver."""
    return silver.groupBy("exchange", "symbol", "rate_date").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("open_time").alias("min_open_time"),
        F.max("close_time").alias("max_close_time"),
    )


def profile_of_days(days: DataFrame) -> DataFrame:
    """Rows, days and hours covered by each exchange and symbol."""
    return days.groupBy("exchange", "symbol").agg(
        F.sum("row_count").alias("row_count"),
        F.min("rate_date").alias("min_date"),
        F.max("rate_date").alias("max_date"),
        F.date_trunc("hour", F.min("min_open_time")).alias("min_hour"),
        F.date_trunc("hour", F.max("max_close_time")).alias("max_hour"),
    )


def series_profile(silver: DataFrame) -> DataFrame:
    """The profile straight from silver, in one aggregate."""
    single = silver.select(
        "exchange", "symbol", "rate_date", F.lit(1).cast("bigint").alias("row_count"),
        F.col("open_time").alias("min_open_time"), F.col("close_time").alias("max_close_time"),
    )
    return profile_of_days(single)


def key_dim(profile: DataFrame, source: str, key: str, name: str, stored: DataFrame | None = None) -> DataFrame:
    """Distinct names with a surrogate key, numbered alphabetically from 1.

    Members of a stored dimension keep their keys, also when they have no rows any more.
    New names are numbered after its largest key, so facts that are stored stay valid.
    """
    names = profile.select(F.col(source).alias(name)).where(F.col(name).isNotNull()).distinct()
    if stored is None:
        return number_names(names, name, key).select(key, name)
    largest = stored.agg(F.coalesce(F.max(key), F.lit(0)).alias(key)).scalar()
    new = number_names(names.join(stored, name, "left_anti"), name, key)
    return stored.select(key, name).unionByName(new.select((F.col(key) + largest).alias(key), name))


def exchange_dim(profile: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    return key_dim(profile, "exchange", "exchange_id", "exchange_name", stored)


def symbol_dim(profile: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    return key_dim(profile, "symbol", "symbol_id", "symbol_name", stored)


def _months(bounds: DataFrame) -> DataFrame:
    """One row per month that the bounds touch. No rows when the bounds are NULL.

    Days and hours are then spread month by month, so no array ever holds more
    than one month of them, however far the bounds lie apart.
    """
    first, last = F.trunc("first", "month"), F.trunc("last", "month")
    return bounds.withColumn("month", F.explode(F.sequence(first, last, F.expr("interval 1 month"))))


def days_between(bounds: DataFrame, *keep: str) -> DataFrame:
    """Every day from `first` through `last` (dates) of each row, as `date_id`."""
    low = F.greatest(F.col("first"), F.col("month"))
    high = F.least(F.col("last"), F.last_day("month"))
    days = F.sequence(low, high, F.expr("interval 1 day"))
    return _months(bounds).select(*keep, F.explode(days).alias("date_id"))


def hours_between(bounds: DataFrame) -> DataFrame:
    """Every hour from `first` through `last` (timestamps), as `datetime_id`."""
    low = F.greatest(F.col("first"), F.col("month").cast("timestamp"))
    high = F.least(F.col("last"), F.add_months("month", 1).cast("timestamp") - F.expr("interval 1 hour"))
    hours = F.sequence(low, high, F.expr("interval 1 hour"))
    return _months(bounds).select(F.explode(hours).alias("datetime_id"))


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("created_at", F.current_timestamp())


def _bounds(
    profile: DataFrame, low: str, high: str, start: Column | None, end: Column | None
) -> DataFrame:
    """Range of the data, one row; a given bound replaces the one of the data."""
    first = F.min(low) if start is None else start
    last = F.max(high) if end is None else end
    # The count keeps this an aggregate, with one row, when both bounds are given.
    return profile.agg(first.alias("first"), last.alias("last"), F.count(F.lit(1)).alias("series"))


def date_dim(profile: DataFrame, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """One row per day from the first through the last day of the data."""
    day = F.col("date_id")
    parts = calendar_parts(day)
    first, last = (None if bound is None else F.lit(bound) for bound in (start, end))
    return _stamped(days_between(_bounds(profile, "min_date", "max_date", first, last)).select(
        "date_id",
        day.alias("date"),
        F.date_format(day, C.DATE_LABEL).alias("date_label"),
        *[c.alias(n) for n, c in parts.items()],
    ))


def datetime_dim(profile: DataFrame, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """One row per hour from the first opening through the last closing hour.

    Given bounds are whole days: from 00h of `start` through 23h of `end`.
    """
    hour = F.col("datetime_id")
    parts = calendar_parts(hour)
    first = None if start is None else F.lit(start).cast("timestamp")
    last = None if end is None else F.lit(end).cast("timestamp") + F.expr("interval 23 hours")
    tail = ["year_month", "day_of_week", "day_of_week_name", "is_weekend"]
    return _stamped(hours_between(_bounds(profile, "min_hour", "max_hour", first, last)).select(
        "datetime_id",
        F.to_date(hour).alias("date_id"),
        hour.alias("datetime"),
        F.date_format(hour, C.HOUR_LABEL).alias("datetime_label"),
        *[c.alias(n) for n, c in parts.items() if n not in tail],
        F.hour(hour).alias("hour"),
        *[parts[n].alias(n) for n in tail],
        hour_period(F.hour(hour)).alias("hour_period"),
    ))


# Planned attributes -------------------------------------------------------

def with_month_flags(dates: DataFrame) -> DataFrame:
    """Month edges, month name and ISO week of each day."""
    return dates.withColumns(month_flags(F.col("date_id")))


def with_business_hour(datetimes: DataFrame) -> DataFrame:
    return datetimes.withColumn("is_business_hour", is_business_hour(F.hour("datetime_id")))


def with_asset(symbols: DataFrame) -> DataFrame:
    """Full name and category of the base asset; NULL for an asset not listed."""
    assets = symbols.sparkSession.createDataFrame(
        C.ASSETS, "asset string, asset_name string, category string"
    )
    base = F.substring_index("symbol_name", "_", 1)
    return symbols.withColumn("asset", base).join(F.broadcast(assets), "asset", "left").select(
        *symbols.columns, "asset_name", "category"
    )


def with_active(exchanges: DataFrame) -> DataFrame:
    return exchanges.withColumn("is_active", F.col("exchange_name").isin(C.ACTIVE_EXCHANGES))
