"""Column expressions over candle fields. All are built-in, code-generated functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wickwork import constants as C


def normalize_symbol(symbol: Column) -> Column:
    """'BTCUSDT' -> 'BTC_USDT'; NULL when the pair has no known quote currency."""
    return F.when(symbol.rlike(C.BINANCE_PAIR), F.regexp_replace(symbol, C.BINANCE_PAIR, "$1_$2"))


def canonical_symbol(exchange: Column, symbol: Column) -> Column:
    """Pair name shared by all exchanges. Poloniex already uses it."""
    return F.when(exchange == C.BINANCE, normalize_symbol(symbol)).otherwise(symbol)


def price(text: Column) -> Column:
    """Text to fixed point; NULL when malformed or too large, so a bad row can be set aside."""
    return text.try_cast(C.PRICE_TYPE)


def seconds_from_millis(millis: Column) -> Column:
    """Epoch milliseconds to a timestamp of whole seconds."""
    return F.date_trunc("second", F.timestamp_millis(millis))


def date_from_millis(millis: Column) -> Column:
    return F.to_date(F.timestamp_millis(millis))


def pct_change(value: Column, base: Column) -> Column:
    """(value - base) / base in percent; NULL on a zero base."""
    return (value - base) / F.nullif(base, F.lit(0)) * 100


def volatility_pct(high: Column, low: Column, open_: Column) -> Column:
    """Day range relative to the opening price, in percent; NULL on a zero opening."""
    return (high - low) / F.nullif(open_, F.lit(0)) * 100


def breaks_ohlc(open_: Column, high: Column, low: Column, close: Column) -> Column:
    """High must be the largest and low the smallest of the four. NULL prices never break it."""
    return (high < low) | (high < open_) | (high < close) | (low > open_) | (low > close)


def breaks_time(open_time: Column, close_time: Column) -> Column:
    """A candle needs both times, and must close after it opens."""
    return open_time.isNull() | close_time.isNull() | (close_time <= open_time)
