"""The whole run: repeatable, the same day by day as at once, and of the known size."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.helpers import rows, utc
from wickwork import constants as C
from wickwork import schemas
from wickwork.operators import quality
from wickwork.plans.refresh import Warehouse, refresh_warehouse
from wickwork.sources.candles import EmptyLoad
from wickwork.sources.events import payloads_from_candles

TABLES = ["silver_hourly", "dim_exchange", "dim_symbol", "dim_date", "dim_datetime",
          "fact_market_hourly", "fact_market_daily"]
LOADED = "landed_at"


def grid(spark, days, assets=("BTC", "ETH"), start="2024-01-01"):
    """Payloads of a full grid: every asset on both exchanges for every hour."""
    hours = spark.range(days * 24).select(
        (F.col("id") * 3_600_000 + F.lit(int(utc(start).timestamp()) * 1000)).alias("open_time_ms"))
    asset = F.explode(F.array(*map(F.lit, assets))).alias("asset")
    exchange = F.explode(F.array(F.lit(C.BINANCE), F.lit(C.POLONIEX))).alias("exchange")
    base = F.xxhash64("open_time_ms", "asset", "exchange") % 50 + 100
    step = F.xxhash64("asset", "open_time_ms") % 10
    candles = hours.select("*", asset).select("*", exchange).select(
        "exchange",
        F.concat("asset", F.when(F.col("exchange") == C.BINANCE, "USDT").otherwise("_USDT")).alias("symbol"),
        F.when(F.col("exchange") == C.BINANCE, "1h").otherwise("HOUR_1").alias("interval"),
        "open_time_ms", (F.col("open_time_ms") + 3_599_999).alias("close_time_ms"),
        base.cast("string").alias("open"), (base + 20).cast("string").alias("high"),
        (base - 20).cast("string").alias("low"), (base + step).cast("string").alias("close"),
        F.lit("1.5").alias("volume"), F.lit(2).cast("bigint").alias("trade_count"),
    )
    return payloads_from_candles(candles)


def stored(spark, root):
    house = Warehouse(spark, str(root))
    tables = {t: house.read(t) for t in TABLES}
    return {t: rows(df.select(*sorted(c for c in df.columns if c not in ("created_at", "processed_at")))) for t, df in tables.items()}


def symbols(*assets):
    return {C.BINANCE: [f"{a}USDT" for a in assets], C.POLONIEX: [f"{a}_USDT" for a in assets]}


def day(n):
    return dt.date(2024, 1, n)


def test_day_by_day_equals_all_at_once(spark, tmp_path):
    raw = grid(spark, 3).cache()
    for n in (1, 3, 2):  # the middle day comes late
        refresh_warehouse(spark, raw, str(tmp_path / "daily"), day(n), day(n), ingested_at=LOADED)
    refresh_warehouse(spark, raw, str(tmp_path / "once"), day(1), day(3), ingested_at=LOADED)
    assert stored(spark, tmp_path / "daily") == stored(spark, tmp_path / "once")


def test_new_symbol_follows_the_stored_ones_even_when_a_run_breaks_off(spark, tmp_path, monkeypatch):
    from wickwork.plans import refresh

    raw = grid(spark, 2, ("AAA", "BTC")).cache()
    root, both = str(tmp_path), symbols("AAA", "BTC")
    refresh_warehouse(spark, raw, root, day(1), day(1), symbols("BTC"), LOADED)
    first = files_of(tmp_path, "fact_market_hourly")
    with monkeypatch.context() as broken:
        broken.setattr(refresh, "refresh_facts", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            refresh_warehouse(spark, raw, root, day(2), day(2), both, LOADED)
    refresh_warehouse(spark, raw, root, day(2), day(2), both, LOADED)
    assert stored(spark, root)["dim_symbol"] == [(1, "BTC_USDT"), (2, "AAA_USDT")]
    kept = files_of(tmp_path, "fact_market_hourly")
    assert all(kept.get(p) == at for p, at in first.items())  # the first day's files are the same
    refresh_warehouse(spark, raw, root, day(1), day(1), both, LOADED)

    def by_name():
        house = Warehouse(spark, root)
        return rows(house.read("fact_market_daily").join(house.read("dim_symbol"), "symbol_id"),
                    "symbol_name", "exchange_id", "date_id", "close_price", "variation_prev_day_pct")

    got = by_name()
    root = str(tmp_path / "once")
    refresh_warehouse(spark, raw, root, day(1), day(2), both, LOADED)
    assert got == by_name() and len(got) == 8


def test_lost_dimension_makes_the_facts_anew(spark, tmp_path):
    from wickwork.sources.tables import write_table

    raw = grid(spark, 2, ("AAA", "BTC")).cache()
    house = Warehouse(spark, str(tmp_path))
    refresh_warehouse(spark, raw, house.root, day(1), day(1), symbols("BTC"), LOADED)
    refresh_warehouse(spark, raw, house.root, day(1), day(1), ingested_at=LOADED)
    write_table(house.read("dim_symbol").limit(0), house.path("dim_symbol"))  # what a dying overwrite leaves
    refresh_warehouse(spark, raw, house.root, day(2), day(2), ingested_at=LOADED)
    refresh_warehouse(spark, raw, str(tmp_path / "once"), day(1), day(2), ingested_at=LOADED)
    assert stored(spark, tmp_path) == stored(spark, tmp_path / "once")


def test_without_days_yesterday_is_loaded(spark, tmp_path):
    from wickwork.sources.candles import previous_day

    yesterday = previous_day()
    raw = grid(spark, 3, ("BTC",), start=str(yesterday - dt.timedelta(days=1)))
    refresh_warehouse(spark, raw, str(tmp_path), ingested_at=LOADED)
    assert {r[-1] for r in rows(Warehouse(spark, str(tmp_path)).read("silver_hourly").select("rate_date"))} <= {
        yesterday, yesterday + dt.timedelta(days=1)}  # midnight may pass meanwhile


def checks(spark, root, **wanted):
    lines = Warehouse(spark, str(root)).read("checks").where(" AND ".join(f"{k} = '{v}'" for k, v in wanted.items()))
    return rows(lines, "rule", "subject", "total_rows", "violations")


def test_checks_of_a_run_are_stored_by_its_last_day(spark, tmp_path):
    raw = grid(spark, 4, ("BTC",)).where("NOT (symbol = 'BTCUSDT' AND landed_at = TIMESTAMP'2024-01-04')").cache()
    refresh_warehouse(spark, raw, str(tmp_path), day(1), day(3), ingested_at=LOADED)
    refresh_warehouse(spark, raw, str(tmp_path), day(4), day(4), ingested_at=LOADED)
    assert [v for *_, v in checks(spark, tmp_path, rule="missing_day", last_day="2024-01-03")] == [1, 0]
    assert checks(spark, tmp_path, rule="missing_day", last_day="2024-01-04") == [
        ("missing_day", "bronze_binance", 1, 0), ("missing_day", "bronze_poloniex", 1, 0)]
    assert checks(spark, tmp_path, rule="series_gap", last_day="2024-01-04") == [("series_gap", "silver_hourly", 8, 1)]
    assert checks(spark, tmp_path, rule="missing_hour", last_day="2024-01-03") == [("missing_hour", "silver_hourly", 144, 24)]
    assert checks(spark, tmp_path, rule="missing_hour", last_day="2024-01-04") == [("missing_hour", "silver_hourly", 48, 0)]


def test_checks_see_altered_tables_and_stop_on_repeated_keys(spark, tmp_path):
    from wickwork.plans.refresh import refresh_checks
    from wickwork.session import staged
    from wickwork.sources.tables import write_table

    house = Warehouse(spark, str(tmp_path))
    refresh_warehouse(spark, grid(spark, 1, ("BTC",)), house.root, day(1), day(1), ingested_at=LOADED)
    daily = staged(house.read("fact_market_daily"), "daily")
    write_table(daily.withColumn("volume", (F.col("volume") + 1).cast("decimal(28,8)")), house.path("fact_market_daily"), "date_id")
    write_table(staged(house.read("dim_symbol"), "symbols").limit(0), house.path("dim_symbol"))
    refresh_checks(house, day(1), day(1))
    assert checks(spark, tmp_path, rule="daily_not_sum_of_hours") == [("daily_not_sum_of_hours", "fact_market_daily", 2, 2)]
    assert checks(spark, tmp_path, rule="orphan", subject="dim_symbol") == [("orphan", "dim_symbol", 48, 48)]
    write_table(daily.unionByName(daily), house.path("fact_market_daily"), "date_id")
    with pytest.raises(quality.QualityError, match="duplicate_key: 2 of 4"):
        refresh_checks(house, day(1), day(1))


def test_empty_day_stops_the_run(spark, tmp_path):
    with pytest.raises(EmptyLoad):
        refresh_warehouse(spark, grid(spark, 1), str(tmp_path), day(5), day(5))


def test_failed_gate_leaves_silver_alone(spark, tmp_path):
    raw = grid(spark, 1).cache()
    refresh_warehouse(spark, raw, str(tmp_path), day(1), day(1), ingested_at=LOADED)
    before = stored(spark, tmp_path)
    broken = raw.withColumn(
        "payload", F.regexp_replace("payload", r'"(\d+)","(\d+)","(\d+)","(\d+)","1.5"', '"$1","$3","$2","$4","1.5"'))
    with pytest.raises(quality.QualityError, match="invalid_ohlc"):
        refresh_warehouse(spark, broken, str(tmp_path), day(1), day(1), ingested_at=LOADED)
    assert stored(spark, tmp_path) == before


def test_rejected_rows_are_kept_until_the_day_is_clean(spark, tmp_path):
    raw = grid(spark, 2).cache()
    bad = raw.withColumn("payload", F.regexp_replace("payload", r'"1\.5"', '"many"'))
    got = refresh_warehouse(spark, raw.where("symbol <> 'BTCUSDT'").unionByName(bad.where("symbol = 'BTCUSDT'")),
                            str(tmp_path), day(1), day(2), ingested_at=LOADED)
    assert got["silver_rejected"] == 48 and got["silver_hourly"] == 3 * 48
    aside = str(tmp_path / "silver_rejected")
    assert rows(spark.read.parquet(aside).select("symbol", "problems").distinct()) == [("BTCUSDT", ["malformed_volume"])]
    got = refresh_warehouse(spark, raw, str(tmp_path), day(2), day(2), ingested_at=LOADED)
    assert got["silver_rejected"] == 0
    assert rows(spark.read.parquet(aside).select("rate_date").distinct()) == [(day(1),)]


def test_known_table_sizes(spark, tmp_path):
    """Five symbols on two exchanges for 201 days."""
    assets = tuple(a for a, *_ in C.ASSETS)
    raw = grid(spark, 201, assets)
    written = refresh_warehouse(spark, raw, str(tmp_path), day(1), day(1) + dt.timedelta(days=200), ingested_at=LOADED)
    assert written == {
        "bronze_binance": 24_120, "bronze_poloniex": 24_120, "silver_hourly": 48_240,
        "bronze_rejected": 0, "silver_rejected": 0, "fact_market_hourly": 48_240, "fact_market_daily": 2_010,
    }
    read = spark.read.parquet
    sizes = {t: read(str(tmp_path / t)).count() for t in TABLES if t.startswith("dim")}
    assert sizes == {"dim_exchange": 2, "dim_symbol": 5, "dim_date": 201, "dim_datetime": 4_824}
    silver = read(str(tmp_path / "silver_hourly"))
    assert silver.select("rate_date").distinct().count() == 201
    assert {(f.name, f.dataType) for f in silver.schema} == {(f.name, f.dataType) for f in schemas.SILVER}


def test_correction_with_fewer_trades_wins_and_a_bad_first_version_stops_nothing(spark, tmp_path):
    raw = grid(spark, 1, ("BTC",)).cache()
    early, late = F.lit(utc("2024-01-02")), F.lit(utc("2024-01-03"))
    bad = raw.withColumn("payload", F.regexp_replace("payload", '"low":|"9[0-9]"', '"9999"')).withColumn("landed_at", early)
    good = raw.withColumn("landed_at", late)
    refresh_warehouse(spark, bad.unionByName(good), str(tmp_path / "both"), day(1), day(1))
    refresh_warehouse(spark, good, str(tmp_path / "one"), day(1), day(1))
    assert stored(spark, tmp_path / "both") == stored(spark, tmp_path / "one")


def test_subset_rerun_keeps_the_other_pairs(spark, tmp_path):
    raw = grid(spark, 1, ("BTC", "ETH")).cache()
    refresh_warehouse(spark, raw, str(tmp_path), day(1), day(1), ingested_at=LOADED)
    whole = stored(spark, tmp_path)
    refresh_warehouse(spark, raw, str(tmp_path), day(1), day(1), symbols("BTC"), LOADED)
    assert stored(spark, tmp_path) == whole


def test_daily_facts_survive_a_write_that_breaks_off(spark, tmp_path, monkeypatch):
    from wickwork.plans import refresh

    raw = grid(spark, 3, ("BTC",)).cache()
    refresh_warehouse(spark, raw, str(tmp_path), day(1), day(3), ingested_at=LOADED)
    whole = stored(spark, tmp_path)
    real = refresh.tables.write_table

    def breaks(df, path, by="rate_date"):
        if path.endswith("fact_market_daily"):
            real(df.limit(0), path, by)  # what a dying overwrite leaves
            raise OSError("lost")
        return partly(df, path, by)

    partly = refresh.tables.write_partitions
    monkeypatch.setattr(refresh.tables, "write_partitions", breaks)
    with pytest.raises(OSError):
        refresh_warehouse(spark, raw, str(tmp_path), day(3), day(3), ingested_at=LOADED)
    monkeypatch.undo()
    refresh_warehouse(spark, raw, str(tmp_path), day(3), day(3), ingested_at=LOADED)
    assert stored(spark, tmp_path) == whole


def files_of(root, table):
    return {p: p.stat().st_mtime_ns for p in (root / table).rglob("*.parquet")}


def test_one_day_leaves_the_other_days_files_alone(spark, tmp_path):
    raw = grid(spark, 4, ("BTC",)).cache()
    late = raw.where("landed_at = TIMESTAMP'2024-01-03'").withColumn(  # the second day, corrected
        "payload", F.regexp_replace("payload", r'"(\d+)","(\d+)","(\d+)","\d+","1\.5"', '"$1","$2","$3","$1","1.5"'))
    refresh_warehouse(spark, raw, str(tmp_path / "a"), day(1), day(4), ingested_at=LOADED)
    before = files_of(tmp_path / "a", "fact_market_daily")
    refresh_warehouse(spark, late, str(tmp_path / "a"), day(2), day(2), ingested_at=LOADED)
    kept = {p.parent.name for p in files_of(tmp_path / "a", "fact_market_daily").keys() & before.keys()}
    assert kept == {"date_id=2024-01-01", "date_id=2024-01-04"}
    changed = raw.where("landed_at <> TIMESTAMP'2024-01-03'").unionByName(late)
    refresh_warehouse(spark, changed, str(tmp_path / "b"), day(1), day(4), ingested_at=LOADED)
    assert stored(spark, tmp_path / "a") == stored(spark, tmp_path / "b")


def test_a_series_with_gaps_gets_its_own_next_day(spark, tmp_path):
    raw = grid(spark, 4, ("BTC", "ETH"))
    raw = raw.where("NOT (symbol LIKE 'ETH%' AND landed_at IN (TIMESTAMP'2024-01-03', TIMESTAMP'2024-01-04'))").cache()
    for n in (1, 3, 4, 2):
        refresh_warehouse(spark, raw, str(tmp_path / "a"), day(n), day(n), ingested_at=LOADED)
    refresh_warehouse(spark, raw, str(tmp_path / "b"), day(1), day(4), ingested_at=LOADED)
    assert stored(spark, tmp_path / "a") == stored(spark, tmp_path / "b")


def test_a_wholly_rejected_day_leaves_silver_and_facts(spark, tmp_path):
    raw = grid(spark, 3, ("BTC",)).cache()
    refresh_warehouse(spark, raw, str(tmp_path / "a"), day(1), day(3), ingested_at=LOADED)
    bad = raw.withColumn("payload", F.regexp_replace("payload", r'"1\.5"', '"many"'))
    got = refresh_warehouse(spark, bad, str(tmp_path / "a"), day(2), day(2), ingested_at=LOADED)
    assert got["silver_rejected"] == 48 and got["silver_hourly"] == 0
    others = raw.where("landed_at <> TIMESTAMP'2024-01-03'")
    refresh_warehouse(spark, others, str(tmp_path / "b"), day(1), day(3), ingested_at=LOADED)
    assert stored(spark, tmp_path / "a") == stored(spark, tmp_path / "b")


def test_rejects_of_a_landing_day_leave_with_their_faults(spark, tmp_path):
    from wickwork.plans.refresh import load_bronze

    raw = grid(spark, 3, ("BTC",)).cache()
    bad = raw.withColumn("payload", F.when((F.col("landed_at") != F.lit(utc("2024-01-02"))) & (F.col("exchange") == C.BINANCE), "{oops").otherwise(F.col("payload")))
    early = raw.withColumn("landed_at", F.col("landed_at") - F.expr("interval 1 hour"))
    house = Warehouse(spark, str(tmp_path))

    def faulty():
        return rows(house.read("bronze_rejected"), "landed_on", "reason")

    load_bronze(bad.unionByName(early), house, day(1), day(3))
    assert faulty() == [(day(3), "unreadable_payload"), (day(4), "unreadable_payload")]
    load_bronze(raw, house, day(2), day(2), landed_until=day(3))  # the fourth is not looked at
    assert faulty() == [(day(4), "unreadable_payload")]
    load_bronze(raw.where(F.col("landed_at") == F.lit(utc("2024-01-03"))), house, day(2), day(2))
    assert faulty() == [(day(4), "unreadable_payload")]  # nothing of that day was landed again
    load_bronze(raw, house, day(3), day(3))
    assert faulty() == []
