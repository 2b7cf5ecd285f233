"""Business metrics over the daily fact. Prices are never mixed across exchanges."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickwork.functions.candle import pct_change, volatility_pct
from wickwork.operators.facts import SERIES
from wickwork.operators.numbering import rank_descending


def in_period(daily: DataFrame, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Rows of the chosen days; the bounds reach the scan."""
    if start is not None:
        daily = daily.where(F.col("date_id") >= F.lit(start))
    if end is not None:
        daily = daily.where(F.col("date_id") <= F.lit(end))
    return daily


def named(df: DataFrame, exchanges: DataFrame, symbols: DataFrame) -> DataFrame:
    """Add exchange and symbol names. Exchanges are as many as there are configured feeds."""
    return df.join(F.broadcast(exchanges), "exchange_id").join(symbols, "symbol_id")


def current_price(daily: DataFrame) -> DataFrame:
    """Last available close of each series, and its day."""
    return daily.groupBy(*SERIES).agg(
        F.max_by("close_price", "date_id").alias("current_price"),
        F.max("date_id").alias("price_date"),
    )


def accumulated_return(daily: DataFrame) -> DataFrame:
    """Change from the first to the last close of each series, in percent."""
    ends = daily.groupBy(*SERIES).agg(
        F.min_by("close_price", "date_id").alias("first_price"),
        F.max_by("close_price", "date_id").alias("last_price"),
    )
    return ends.withColumn("return_pct", pct_change(F.col("last_price"), F.col("first_price")))


def index_base_100(daily: DataFrame) -> DataFrame:
    """Each close relative to the first close of its series, times 100.

    The first close comes from an aggregate that is joined back. A window would
    hold a whole series in one task; here AQE may split a long one.
    """
    first = daily.groupBy(*SERIES).agg(F.min_by("close_price", "date_id").alias("base_price"))
    index = F.col("close_price") / F.nullif(F.col("base_price"), F.lit(0)) * 100
    return daily.join(first, SERIES).select(
        *SERIES, "date_id", "close_price", "base_price", index.alias("index_100")
    )


def volume_traded(daily: DataFrame) -> DataFrame:
    """Volume and trades of each series in the period."""
    return daily.groupBy(*SERIES).agg(
        F.sum("volume").alias("volume"), F.sum("trade_count").alias("trade_count")
    )


def rank_by_return(daily: DataFrame) -> DataFrame:
    """Series ranked by accumulated return, best first."""
    return rank_descending(accumulated_return(daily), "return_pct", "return_rank")


def available_until(daily: DataFrame) -> DataFrame:
    """Last day with data."""
    return daily.agg(F.max("date_id").alias("available_until"))


def cross_exchange_price(
    daily: DataFrame, dates: DataFrame, exchanges: DataFrame, symbols: DataFrame,
    symbol: str, start: dt.date, end: dt.date,
) -> DataFrame:
    """One symbol's daily close and volume on each exchange."""
    return (
        named(in_period(daily, start, end), exchanges, symbols.where(F.col("symbol_name") == symbol))
        .join(dates.select("date_id", "date"), "date_id")
        .select("date", "symbol_name", "exchange_name", "close_price", "volume")
        .orderBy("date", "exchange_name")
    )


def top_volatile(
    daily: DataFrame, dates: DataFrame, exchanges: DataFrame, symbols: DataFrame,
    n: int = 5, start: dt.date | None = None, end: dt.date | None = None,
) -> DataFrame:
    """The n days with the widest range relative to their opening price."""
    swing = volatility_pct(F.col("high_price"), F.col("low_price"), F.col("open_price"))
    return (
        named(in_period(daily, start, end), exchanges, symbols)
        .join(dates.select("date_id", "date"), "date_id")
        .select("date", "symbol_name", "exchange_name", swing.alias("volatility_pct"), "volume")
        .orderBy(F.desc_nulls_last("volatility_pct"), "date", "symbol_name", "exchange_name")
        .limit(n)
    )


def day_peaks(daily: DataFrame) -> DataFrame:
    """The largest volatility of each day: a stored level that tells which days a top list can come from."""
    swing = volatility_pct(F.col("high_price"), F.col("low_price"), F.col("open_price"))
    return daily.groupBy("date_id").agg(F.max(swing).alias("peak"))


def top_volatile_by_peaks(
    daily: DataFrame, peaks: DataFrame, dates: DataFrame, exchanges: DataFrame, symbols: DataFrame,
    n: int = 5, start: dt.date | None = None, end: dt.date | None = None,
) -> DataFrame:
    """`top_volatile`, reading at most n days of the daily fact.

    Days are taken from the largest peak down, earlier ones first among equals, until there are
    n. Each gives a row as high as its peak, and every row of the days left out stands behind
    all of these: its value is at most its day's peak, and at equal values its day is later. So
    the reading may stop there, also with ties at the border.
    """
    highest = in_period(peaks, start, end).orderBy(F.desc_nulls_last("peak"), "date_id").limit(n)
    days = [r.date_id for r in highest.collect()]
    return top_volatile(daily.where(F.col("date_id").isin(days)), dates, exchanges, symbols, n)
