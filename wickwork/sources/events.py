"""Candles from the `events` table, in the form the two exchanges deliver them.

Each event is taken as one trade: the event type gives the asset, the parity of
the user gives the exchange, the value is the price and also the traded volume.
A type without a fixed asset is an asset of its own; events without a type are none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickwork import constants as C

# Asset for each event type.
_ASSETS = {"click": "BTC", "view": "ETH", "purchase": "SOL", "signup": "ADA", "error": "LINK"}
_HOUR_MS = 3_600_000


def _trade_order(ts: Column, event_id: Column) -> Column:
    """Order by time, then event id, as one fixed-width number.

    A struct would say the same, but aggregates ordered by a struct must sort
    their whole input; with a number they hash and pre-aggregate in place.
    """
    micros = F.unix_micros(ts.cast("timestamp")).cast("decimal(18,0)")
    return micros * F.expr("10000000000000000000BD") + event_id


def candles_from_events(events: DataFrame) -> DataFrame:
    """Hourly candles with an exchange column, prices as text. One scan, one shuffle.

    Rows are grouped by what the table holds; names are given to the few candles
    that come out, not to every event.
    """
    order = _trade_order(F.col("ts"), F.col("event_id"))
    # UTC hours by arithmetic: cheaper per event than calendar functions.
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    opened = millis - F.pmod(millis, F.lit(_HOUR_MS))
    hourly = (
        events.where("event_type IS NOT NULL")
        .groupBy((F.col("user_id") % 2 == 0).alias("on_binance"), "event_type", opened.alias("open_time_ms"))
        .agg(
            F.min_by("value", order).alias("open"),
            F.max("value").alias("high"),
            F.min("value").alias("low"),
            F.max_by("value", order).alias("close"),
            F.sum(F.col("value").cast(C.PRICE_TYPE)).alias("volume"),
            F.count(F.lit(1)).alias("trade_count"),
        )
    )
    known = F.create_map(*[F.lit(x) for pair in _ASSETS.items() for x in pair])
    asset = F.coalesce(F.try_element_at(known, F.col("event_type")), F.upper("event_type"))
    on_binance = F.col("on_binance")
    return hourly.select(
        F.when(on_binance, C.BINANCE).otherwise(C.POLONIEX).alias("exchange"),
        F.concat(asset, F.when(on_binance, "USDT").otherwise("_USDT")).alias("symbol"),
        F.when(on_binance, C.BINANCE_INTERVAL).otherwise(C.POLONIEX_INTERVAL).alias("interval"),
        "open_time_ms",
        (F.col("open_time_ms") + (_HOUR_MS - 1)).alias("close_time_ms"),
        *[F.col(f).cast(C.PRICE_TYPE).cast("string").alias(f) for f in C.PRICE_FIELDS],
        "trade_count",
    )


def landing_time(open_time_ms: Column) -> Column:
    """A candle is loaded at the start of the day after it opened."""
    next_day = F.date_add(F.to_date(F.timestamp_millis(open_time_ms)), 1)
    return next_day.cast("timestamp")


def payloads_from_candles(candles: DataFrame) -> DataFrame:
    """Raw landed rows: one JSON array per exchange, symbol and day.

    A group holds at most 24 candles.
    """
    opened, closed = F.col("open_time_ms"), F.col("close_time_ms")

    def text(name: str) -> Column:
        return F.coalesce(F.concat(F.lit('"'), F.col(name), F.lit('"')), F.lit("null"))

    trades = F.col("trade_count")

    def other(position: int) -> Column:
        """A field without a source in events: the trades, a point and the position."""
        return F.concat(F.lit('"'), trades, F.lit(f'.{position}"'))

    binance = [opened, text("open"), text("high"), text("low"), text("close"), text("volume"),
               closed, other(7), trades, other(9), other(10)]
    poloniex = [text("low"), text("high"), text("open"), text("close"), other(4), text("volume"),
                other(6), other(7), trades, closed, other(10), text("interval"),
                opened, closed]

    def array(parts: list[Column]) -> Column:
        return F.concat(F.lit("["), F.concat_ws(",", *[p.cast("string") for p in parts]), F.lit("]"))

    candle = F.when(F.col("exchange") == C.BINANCE, array(binance)).otherwise(array(poloniex))
    days = candles.groupBy(
        "exchange", "symbol", landing_time(opened).alias("landed_at")
    ).agg(F.array_sort(F.collect_list(F.struct(opened.alias("at"), candle.alias("candle")))).alias("day"))
    return days.select(
        "exchange", "symbol",
        F.concat(F.lit("["), F.concat_ws(",", F.col("day.candle")), F.lit("]")).alias("payload"),
        "landed_at",
    )
