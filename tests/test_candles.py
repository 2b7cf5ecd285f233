from __future__ import annotations

import datetime as dt

import pytest
from tests.helpers import bronze, bronze_row, rows, utc
from wickwork import constants as C
from wickwork import schemas
from wickwork.sources import candles

BINANCE_DAY = ('[[1704067200000,"10.5","12","9.75","11.25","340.5",1704070799999,"3700.1",42,"100","1090"],'
               '[1704070800000,"11","13","10","12","1",1704074399999,"12",1,"0","0"]]')
POLONIEX_DAY = ('[["9.75","12","10.5","11.25","3700.1","340.5","1090","100",42,1704070799999,"10.9",'
                '"HOUR_1",1704067200000,1704070799999]]')


def raw(spark, *lines):
    return spark.createDataFrame([(*line, utc("2024-01-02")) for line in lines], schemas.RAW)


@pytest.fixture
def both(spark):
    return raw(spark, ("binance", "BTCUSDT", BINANCE_DAY), ("poloniex", "BTC_USDT", POLONIEX_DAY))


def test_both_layouts_give_the_same_candle(both):
    fields = ["open", "high", "low", "close", "volume", "open_time_ms", "close_time_ms", "trade_count"]
    wanted = ("10.5", "12", "9.75", "11.25", "340.5", 1704067200000, 1704070799999, 42)
    assert rows(candles.parse_candles(both, candles.BINANCE), *fields)[0] == wanted
    assert rows(candles.parse_candles(both, candles.POLONIEX), *fields) == [wanted]


def test_bronze_schema(both):
    for layout in candles.LAYOUTS.values():
        made = candles.to_bronze(both, layout).schema
        assert [(f.name, f.dataType) for f in made] == [(f.name, f.dataType) for f in schemas.BRONZE]


def test_intervals_stay_as_delivered(both):
    got = [rows(candles.to_bronze(both, layout), "interval")[0][0] for layout in candles.LAYOUTS.values()]
    assert got == ["1h", "HOUR_1"]


def test_wide_row(both):
    got = candles.parse_candles(both, candles.POLONIEX, wide=True).first()
    assert (got.quote_asset_volume, got.taker_buy_quote_volume, got.taker_buy_base_volume) == ("3700.1", "1090", "100")
    assert candles.align(candles.stamp(candles.parse_candles(both, candles.POLONIEX, wide=True)),
                         C.BRONZE_COLUMNS).columns == C.BRONZE_COLUMNS


def test_what_cannot_be_loaded_is_set_aside_with_its_reason(spark):
    landed = raw(
        spark, ("binance", "BTCUSDT", '[["1704067200000", "1"'), ("binance", "ETHUSDT", None), ("binance", "ADAUSDT", "[]"),
        ("binance", "SOLUSDT", '[["x","1"]]'), ("binance", "BTCUSDT", BINANCE_DAY), ("poloniex", "BTC_USDT", None),
    )
    assert sorted(rows(candles.set_aside(landed, candles.BINANCE), "symbol", "reason")) == [
        ("ADAUSDT", "empty_payload"), ("BTCUSDT", "unreadable_payload"), ("ETHUSDT", "missing_payload"),
        ("SOLUSDT", "unreadable_open_time"),
    ]
    kept = candles.load_days(landed, candles.BINANCE, dt.date(2024, 1, 1))
    assert rows(kept.select("symbol").distinct()) == [("BTCUSDT",)]
    both = candles.stored_fates(candles.sort_out(landed))
    assert rows(candles.rejects(both).where("exchange = 'poloniex'"), "reason") == [("missing_payload",)]
    assert rows(candles.bronze_days(both, candles.BINANCE, dt.date(2024, 1, 1), dt.date(2024, 1, 1))) == rows(kept)


def test_a_payload_keeps_its_good_candles(spark):
    odd = raw(spark, ("binance", "BTCUSDT", '[[1704067200000,"1",2.50],5,null,["x"],{"a":1}]'), ("binance", "ETHUSDT", '{"code":-1}'),
              ("other", "BTCUSDT", "{oops"))
    fates = candles.sort_out(odd)
    assert sorted(rows(fates, "symbol", "fate", "open", "high"), key=str) == [
        ("BTCUSDT", "kept", "1", "2.5"), *[("BTCUSDT", "unreadable_open_time", None, None)] * 4,
        ("ETHUSDT", "unreadable_payload", None, None)]


def test_a_load_parses_each_payload_once_and_bounds_landing_times(spark, tmp_path, both, monkeypatch):
    from pyspark.sql import functions as F

    from tests.helpers import executed
    from wickwork.plans.refresh import Warehouse, load_bronze

    plans = []
    whole = candles.stored_fates
    monkeypatch.setattr("wickwork.plans.refresh.stored_fates", lambda df: plans.append(executed(df)) or whole(df))
    for name in ("from_json", "parse_json"):
        monkeypatch.setattr(F, name, lambda *a: 1 / 0)  # nothing else reads JSON
    both.write.parquet(str(tmp_path / "landed"))
    stored = spark.read.schema(both.schema).parquet(str(tmp_path / "landed"))
    house, day = Warehouse(spark, str(tmp_path / "house")), dt.date(2024, 1, 1)
    assert load_bronze(stored, house, day, day, landed_until=dt.date(2024, 1, 3)) == {"bronze_rejected": 0, "bronze_binance": 2, "bronze_poloniex": 1}
    [plan] = plans
    assert plan.count("parseJson") == 1 and "Exchange" not in plan
    assert "GreaterThanOrEqual(landed_at," in plan and "LessThan(landed_at," in plan


def test_short_or_malformed_candle_gives_nulls(spark):
    odd = raw(spark, ("binance", "BTCUSDT", '[[1704067200000,"1"],["x","1","2","1","1","5",7]]'))
    got = rows(candles.parse_candles(odd, candles.BINANCE), "open_time_ms", "open", "volume", "trade_count")
    assert got == [(1704067200000, "1", None, None)]
    assert rows(candles.set_aside(odd, candles.BINANCE), "reason") == [("unreadable_open_time",)]


def test_stamp_defaults_to_the_landing_time_or_now(both):
    parsed = candles.parse_candles(both, candles.BINANCE)
    got = candles.stamp(parsed).first()
    assert got.rate_date == dt.date(2024, 1, 1)
    assert got.ingested_at == got.landed_at
    got = candles.stamp(parsed.drop("landed_at")).first()
    assert abs(got.ingested_at.timestamp() - dt.datetime.now().timestamp()) < 300


def test_day_slice_bounds(spark):
    frame = bronze(spark, [bronze_row(t) for t in (
        "2023-12-31 23:00:00", "2024-01-01 00:00:00", "2024-01-01 23:00:00", "2024-01-02 00:00:00")])
    one = candles.day_slice(frame, dt.date(2024, 1, 1))
    two = candles.day_slice(frame, dt.date(2024, 1, 1), dt.date(2024, 1, 2))
    assert (one.count(), two.count()) == (2, 3)


def test_day_slice_defaults_to_yesterday(spark):
    yesterday = candles.previous_day()
    assert yesterday == dt.datetime.now(dt.UTC).date() - dt.timedelta(days=1)
    frame = bronze(spark, [bronze_row(f"{yesterday} 05:00:00"), bronze_row("2024-01-01 05:00:00")])
    assert rows(candles.day_slice(frame), "rate_date") == [(yesterday,)]


def test_symbols_are_limited(spark):
    lines = [("binance", s, BINANCE_DAY) for s in ("BTCUSDT", "DOGEUSDT")]
    day = dt.date(2024, 1, 1)
    assert candles.load_days(raw(spark, *lines), candles.BINANCE, day).select("symbol").distinct().count() == 2
    chosen = candles.load_days(raw(spark, *lines), candles.BINANCE, day, symbols=["DOGEUSDT"])
    assert rows(chosen.select("symbol").distinct()) == [("DOGEUSDT",)]


def test_union_matches_names(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    assert rows(candles.union_days([a, a.select("s", "n"), a])) == [(1, "x")] * 3


def test_date_filter_reaches_the_stored_partitions(spark, tmp_path):
    frame = bronze(spark, [bronze_row(f"2024-01-0{d} 00:00:00") for d in range(1, 6)])
    frame.write.partitionBy("rate_date").parquet(str(tmp_path / "t"))
    sliced = candles.day_slice(spark.read.parquet(str(tmp_path / "t")), dt.date(2024, 1, 2))
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(rate_date" in plan
    assert "GreaterThanOrEqual(open_time_ms" in plan
    assert sliced.select("rate_date").distinct().count() == 1
