"""Checksums, peaks of days, and the stored tables by name."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import executed, rows
from tests.test_refresh import day, grid
from wickwork.operators import facts, metrics, quality
from wickwork.plans import views
from wickwork.plans.refresh import Warehouse, refresh_warehouse
from wickwork.session import staged
from wickwork.sources import tables

FIRST = dt.date(2024, 1, 20)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Hourly rows of 60 days and what they add up to, by day."""
    root = str(tmp_path_factory.mktemp("facts"))
    hourly = spark.range(60 * 24 * 4).selectExpr(
        "cast(id % 2 + 1 AS int) AS exchange_id", "cast(id % 4 + 1 AS int) AS symbol_id",
        "TIMESTAMP'2024-01-20' + make_interval(0, 0, 0, 0, cast(id div 4 AS int)) AS datetime_id",
        "cast(CASE WHEN id % 9 > 0 THEN id % 31 END AS decimal(18,8)) AS volume", "id % 5 AS trade_count",
    ).withColumn("date_id", F.to_date("datetime_id"))
    tables.write_table(hourly, f"{root}/hourly", "date_id")
    hourly = spark.read.parquet(f"{root}/hourly")
    return hourly, hourly.groupBy(*facts.DAILY_KEY).agg(F.sum("volume").alias("volume"), F.sum("trade_count").alias("trade_count"))


def test_equal_facts_have_equal_checksums_and_an_altered_day_is_read_alone(stored, tmp_path):
    hourly, daily = stored
    left = staged(quality.hourly_checksums(hourly), "sums")
    assert quality.differing_days(left, staged(quality.day_checksums(daily), "sums")) == []
    assert quality.reconcile_differing(hourly, daily, left, staged(quality.day_checksums(daily), "sums")).count() == 0
    at = FIRST + dt.timedelta(days=33)
    hit = (F.col("date_id") == F.lit(at)) & (F.col("symbol_id") == 3)
    # Two changes that leave the sums of the day as they are.
    moved = F.when(hit, 1).when((F.col("date_id") == F.lit(at)) & (F.col("symbol_id") == 1), -1).otherwise(0)
    altered = daily.withColumn("trade_count", F.col("trade_count") + moved)
    tables.write_table(altered, str(tmp_path / "daily"), "date_id")
    altered = hourly.sparkSession.read.parquet(str(tmp_path / "daily"))
    right = staged(quality.day_checksums(altered), "sums")
    assert quality.differing_days(left, right) == [at]
    found = quality.reconcile_differing(hourly, altered, left, right)
    assert sorted((r.symbol_id, r.hours_trades - r.day_trades) for r in found.collect()) == [(1, 1), (3, -1)]
    plan = executed(found)
    assert plan.count(f"PartitionFilters: [isnotnull(date_id") + plan.count("PartitionFilters: [(date_id") >= 2
    assert plan.count(f"= {at}") >= 2


def test_a_lost_or_added_key_is_found(stored):
    hourly, daily = stored
    left = staged(quality.hourly_checksums(hourly), "sums")
    lost = daily.where("NOT (symbol_id = 2 AND date_id = DATE'2024-02-01')")
    assert quality.differing_days(left, staged(quality.day_checksums(lost), "sums")) == [dt.date(2024, 2, 1)]
    more = daily.unionByName(daily.limit(1).withColumn("date_id", F.lit(dt.date(2025, 1, 1))))
    assert quality.differing_days(left, staged(quality.day_checksums(more), "sums")) == [dt.date(2025, 1, 1)]
    assert len(quality.differing_days(left, staged(quality.day_checksums(daily.limit(0)), "sums"))) == 60


def test_top_days_read_few_partitions_and_keep_ties(spark, tmp_path):
    rnd = random.Random(9)
    data = [(s, 1, FIRST + dt.timedelta(days=d), 10, 10 + rnd.choice([0, 1, 1, 2, 3]), 10, None if rnd.random() < 0.1 else rnd.choice([10, 10, 0]), d)
            for d in range(40) for s in range(1, 4)]
    types = "symbol_id int, exchange_id int, date_id date, close_price int, high_price int, low_price int, open_price int, volume int"
    tables.write_table(spark.createDataFrame(data, types), str(tmp_path / "daily"), "date_id")
    daily = spark.read.parquet(str(tmp_path / "daily"))
    dates = daily.select("date_id", F.col("date_id").alias("date")).distinct()
    exchanges = spark.createDataFrame([(1, "x")], "exchange_id int, exchange_name string")
    symbols = spark.createDataFrame([(1, "c"), (2, "b"), (3, "a")], "symbol_id int, symbol_name string")
    peaks = staged(metrics.day_peaks(daily), "peaks")
    start, end = FIRST + dt.timedelta(days=3), FIRST + dt.timedelta(days=35)
    for n, period in ((1, ()), (5, ()), (7, (start, end)), (40, ()), (200, ()), (5, (end, start))):
        got = metrics.top_volatile_by_peaks(daily, peaks, dates, exchanges, symbols, n, *period)
        assert got.collect() == metrics.top_volatile(daily, dates, exchanges, symbols, n, *period).collect()
    few = metrics.top_volatile_by_peaks(daily, peaks, dates, exchanges, symbols, 5)
    assert "PartitionFilters: [date_id" in executed(few) and " IN (" in executed(few).split("PartitionFilters: [date_id", 1)[1][:80]


def test_stored_tables_by_name(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    assert views.register_views(house, "none_") == []
    refresh_warehouse(spark, grid(spark, 3, ("BTC", "ETH")), house.root, day(1), day(3), ingested_at="landed_at")
    names = views.register_views(house, "v_")
    assert {"v_fact_market_daily", "v_dim_date", "v_series_gaps", "v_daily_peaks"} <= set(names)
    published = views.publish(house, "market")
    assert views.publish(house, "market") == published  # again, as after a refresh
    for table in ("fact_market_daily", "fact_market_hourly", "dim_symbol", "series_days"):
        found = spark.table(f"market.{table}")
        assert rows(found, *sorted(found.columns)) == rows(house.read(table), *sorted(found.columns)) == rows(spark.table(f"v_{table}"), *sorted(found.columns))
    spark.sql("USE market")
    try:
        daily, exchanges, symbols = (house.read(t) for t in ("fact_market_daily", "dim_exchange", "dim_symbol"))
        some = metrics.in_period(daily, day(1), day(2))
        pairs = {
            "current_price": metrics.current_price(daily), "accumulated_return": metrics.accumulated_return(some),
            "index_base_100": metrics.index_base_100(some), "volume_traded": metrics.volume_traded(some),
            "rank_by_return": metrics.rank_by_return(some),
            "daily_variation": some.select(*facts.SERIES, "date_id", "variation_daily_pct", "variation_prev_day_pct"),
        }
        period = dict(start=day(1), end=day(2), symbol="BTC_USDT", n=3)
        for name, plain in pairs.items():
            got = views.metric(spark, name, **period)
            wanted = metrics.named(plain, exchanges, symbols)
            assert rows(got, *sorted(got.columns)) == rows(wanted, *sorted(got.columns)), name
        dates = house.read("dim_date")
        for name, wanted in (
            ("data_available_until", metrics.available_until(daily)),
            ("cross_exchange_price", metrics.cross_exchange_price(daily, dates, exchanges, symbols, "BTC_USDT", day(1), day(2))),
            ("top_volatile_days", metrics.top_volatile(daily, dates, exchanges, symbols, 3, day(1), day(2))),
        ):
            assert views.metric(spark, name, **period).collect() == wanted.collect(), name
    finally:
        spark.sql("USE default")
        spark.sql("DROP DATABASE market CASCADE")
