from __future__ import annotations

from decimal import Decimal

import pytest

from tests.helpers import bronze, bronze_row, millis, rows
from wickwork import constants as C
from wickwork import schemas
from wickwork.operators import quality, silver
from wickwork.operators.latest import dedupe_latest


def counts(df, rules):
    return {r.rule: r.violations for r in quality.quality_report(df, rules).collect()}


def load_counts(frame):
    return counts(silver.judged(frame), quality.load_rules())


def test_schema_and_values(spark):
    good, bad = silver.to_silver(bronze(spark, [bronze_row("2024-01-01 05:00:00", v="0")]))
    assert [(f.name, f.dataType) for f in good.schema] == [(f.name, f.dataType) for f in schemas.SILVER]
    got = good.first()
    assert (got.symbol, got.close, got.volume) == ("BTC_USDT", Decimal(11), 0)
    assert good.selectExpr("cast(open_time as string)", "cast(close_time as string)").first() == (
        "2024-01-01 05:00:00", "2024-01-01 05:59:59")
    assert bad.isEmpty()


def test_exchanges_are_united(spark):
    one = bronze(spark, [bronze_row("2024-01-01 05:00:00")]).drop("exchange")
    two = bronze(spark, [bronze_row("2024-01-01 05:00:00", symbol="BTC_USDT")]).drop("exchange")
    good, _ = silver.to_silver({C.BINANCE: one, C.POLONIEX: two.select(*reversed(two.columns))})
    assert rows(good, "exchange", "symbol", "interval") == [
        ("binance", "BTC_USDT", "1h"), ("poloniex", "BTC_USDT", "1h")]


def test_unusable_rows_are_set_aside_whole(spark):
    frame = bronze(spark, [
        bronze_row("2024-01-01 00:00:00"),
        bronze_row("2024-01-01 01:00:00", symbol="BTCEUR"),
        bronze_row("2024-01-01 02:00:00", o="abc", h="12345678901.5"),
        bronze_row("2024-01-01 03:00:00", symbol="1INCHUSDT", v="?"),
    ])
    good, bad = silver.to_silver(frame)
    assert good.count() == 1
    assert rows(bad, "symbol", "open", "problems") == [
        ("1INCHUSDT", "10", ["unmatched_symbol", "malformed_volume"]),
        ("BTCEUR", "10", ["unmatched_symbol"]),
        ("BTCUSDT", "abc", ["malformed_open", "malformed_high"]),
    ]
    got = load_counts(frame)
    assert (got["rejected"], got["unmatched_symbol"], got["malformed_open"]) == (3, 2, 1)


def test_missing_values_stay_and_are_counted(spark):
    frame = bronze(spark, [bronze_row("2024-01-01 00:00:00", h=None), bronze_row("2024-01-01 01:00:00", symbol=None)])
    good, bad = silver.to_silver(frame)
    assert (good.count(), bad.count()) == (2, 0)
    got = counts(good, quality.silver_rules())
    assert (got["null_high"], got["null_symbol"], got["invalid_ohlc"]) == (1, 1, 0)
    required = counts(frame, quality.bronze_rules())
    assert (required["missing_high"], required["missing_symbol"], required["missing_low"]) == (1, 1, 0)


@pytest.mark.parametrize("fault, rule", [
    (dict(h="8"), "invalid_ohlc"),
    (dict(low="10.5"), "invalid_ohlc"),
    (dict(close_ms=millis("2024-01-01 00:00:00")), "invalid_time"),
    # Less than a second apart is no time apart once milliseconds are dropped.
    (dict(close_ms=millis("2024-01-01 00:00:00") + 999), "invalid_time"),
])
def test_gates(spark, fault, rule):
    good = silver.usable(bronze(spark, [bronze_row("2024-01-01 00:00:00", **fault)]))
    report = quality.quality_report(good, quality.silver_rules())
    with pytest.raises(quality.QualityError, match=f"{rule}: 1 of 1"):
        quality.enforce(report)


def test_reports_do_not_stop(spark):
    frame = bronze(spark, [bronze_row("2024-01-01 10:30:00", v=None)])
    lines = quality.enforce(quality.quality_report(silver.usable(frame), quality.silver_rules()))
    assert {r.rule for r in lines if r.violations} == {"null_volume", "off_grid_time"}


def test_set_aside_rows_do_not_trip_gates(spark):
    frame = bronze(spark, [bronze_row("2024-01-01 00:00:00", h="1", v="bad")])
    assert load_counts(frame)["invalid_ohlc"] == 0


def test_empty_input_passes(spark):
    report = quality.quality_report(silver.judged(bronze(spark, [])), quality.load_rules())
    assert all(r.violations == 0 for r in quality.enforce(report))


def test_second_load_of_a_day_wins(spark):
    frame = bronze(spark, [
        bronze_row("2024-01-01 00:00:00", v="1"),
        bronze_row("2024-01-01 00:00:00", v="2", loaded="2024-02-02 00:00:00"),
        bronze_row("2024-01-01 01:00:00", v="3"),
    ])
    latest = dedupe_latest(silver.usable(frame), silver.SILVER_KEY).orderBy("open_time").collect()
    assert [r.volume for r in latest] == [2, 3]
    assert latest[0].ingested_at > latest[1].ingested_at
