from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.helpers import utc
from wickwork.functions import calendar, candle


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("raw, wanted", [
    ("BTCUSDT", "BTC_USDT"), ("SOLUSDC", "SOL_USDC"), ("ETHBTC", "ETH_BTC"),
    ("BTCEUR", None), ("1INCHUSDT", None), ("btcusdt", None), (None, None), ("", None),
])
def test_symbols_are_normalized(spark, raw, wanted):
    assert value(spark, candle.normalize_symbol(F.lit(raw).cast("string"))) == wanted


def test_poloniex_symbol_stays(spark):
    assert value(spark, candle.canonical_symbol(F.lit("poloniex"), F.lit("ANY"))) == "ANY"


@pytest.mark.parametrize("text, wanted", [
    ("10.5", "10.50000000"), ("0.123456785", "0.12345679"), ("1E-3", "0.00100000"),
    ("9999999999.99999999", "9999999999.99999999"), ("12345678901.5", None), ("abc", None),
])
def test_price(spark, text, wanted):
    got = value(spark, candle.price(F.lit(text)))
    assert got == (None if wanted is None else Decimal(wanted))


def test_milliseconds_are_dropped(spark):
    got = value(spark, candle.seconds_from_millis(F.lit(1704067199999)).cast("string"))
    assert got == "2023-12-31 23:59:59"


def test_change_on_zero_base_is_null(spark):
    number = F.lit("5").cast("decimal(18,8)")
    zero = F.lit("0").cast("decimal(18,8)")
    assert value(spark, candle.pct_change(number, zero)) is None
    assert value(spark, candle.volatility_pct(number, zero, zero)) is None
    assert value(spark, candle.pct_change(F.lit("5.5").cast("decimal(18,8)"), number)) == Decimal(10)


def test_change_keeps_fifteen_digits(spark):
    one, three = (F.lit(n).cast("decimal(18,8)") for n in ("1", "3"))
    got = spark.range(1).select(candle.pct_change(one, three).alias("x"))
    assert got.dtypes == [("x", "decimal(38,15)")]


@pytest.mark.parametrize("ohlc, wanted", [
    ((10, 12, 9, 11), False), ((10, 8, 9, 11), True), ((13, 12, 9, 11), True),
    ((10, 12, 11, 11), True), ((10, 12, 9, 8), True), ((10, 10, 10, 10), False),
])
def test_ohlc_invariant(spark, ohlc, wanted):
    assert value(spark, candle.breaks_ohlc(*map(F.lit, ohlc))) is wanted


def test_null_price_breaks_nothing(spark):
    none = F.lit(None).cast("int")
    assert not value(spark, F.coalesce(candle.breaks_ohlc(F.lit(10), none, F.lit(9), F.lit(11)), F.lit(False)))


def test_time_invariant(spark):
    a, b = F.lit(utc("2024-01-01")), F.lit(utc("2024-01-02"))
    none = F.lit(None).cast("timestamp")
    checks = [(a, b, False), (b, a, True), (a, a, True), (none, b, True), (a, none, True)]
    assert [value(spark, candle.breaks_time(x, y)) for x, y, _ in checks] == [w for *_, w in checks]


def test_hour_periods(spark):
    got = spark.range(24).select(calendar.hour_period(F.col("id")).alias("p")).collect()
    assert [r.p for r in got] == ["Dawn"] * 6 + ["Morning"] * 6 + ["Afternoon"] * 6 + ["Night"] * 6


def test_weekday_names(spark):
    day = F.expr("date_add(date'2024-01-07', cast(id as int))")  # a Sunday
    got = spark.range(7).select(
        F.dayofweek(day).alias("n"), calendar.day_name(day).alias("d"), calendar.is_weekend(day).alias("w")
    ).collect()
    assert [tuple(r) for r in got] == [
        (1, "Sunday", True), (2, "Monday", False), (3, "Tuesday", False), (4, "Wednesday", False),
        (5, "Thursday", False), (6, "Friday", False), (7, "Saturday", True),
    ]


def test_business_hours(spark):
    got = spark.range(24).where(calendar.is_business_hour(F.col("id"))).collect()
    assert [r.id for r in got] == list(range(9, 18))
