from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.helpers import bronze, bronze_row, executed, hourly, rows
from wickwork import schemas
from wickwork.operators import dims, facts, metrics, numbering, quality, silver


def star(spark, *bronze_rows):
    source = silver.usable(bronze(spark, list(bronze_rows)))
    profile = dims.series_profile(source)
    return source, dims.exchange_dim(profile), dims.symbol_dim(profile), dims.datetime_dim(profile)


def shape(schema):
    return [(f.name, f.dataType) for f in schema]


def test_hourly_fact(spark):
    fact = facts.hourly_fact(*star(spark, bronze_row("2024-01-01 00:00:00"), bronze_row("2024-01-01 01:00:00", o="0", low="0")))
    assert shape(fact.schema) == shape(schemas.HOURLY)
    assert rows(fact, "symbol_id", "exchange_id", "variation_1h_pct") == [(1, 1, Decimal(10)), (1, 1, None)]
    assert "processed_at" in facts.with_processed_at(fact).columns


def test_off_grid_and_unknown_rows_are_left_out_and_reported(spark):
    source, exchanges, symbols, datetimes = star(
        spark, bronze_row("2024-01-01 00:00:00"), bronze_row("2024-01-01 10:30:00"),
        bronze_row("2024-01-01 02:00:00", exchange="elsewhere", symbol="X"))
    known = exchanges.where("exchange_name = 'binance'")
    assert facts.hourly_fact(source, known, symbols, datetimes).count() == 1
    assert rows(quality.orphan_report(source, known, symbols, datetimes)) == [
        ("dim_datetime", 1, 1), ("dim_exchange", 1, 1), ("dim_symbol", 0, 0)]
    assert rows(quality.orphans(source, "exchange", known, "exchange_name")) == [("elsewhere", 1)]


def test_daily_fact(spark):
    got = facts.daily_fact(hourly(spark, [
        (1, 1, "2024-01-01 05:00:00", 10, 15, 9, 11, 2, 3),
        (1, 1, "2024-01-01 02:00:00", 8, 12, 7, 9, 1, 2),
        (1, 1, "2024-01-02 00:00:00", 11, 11, 11, 22, 1, 1),
        (1, 1, "2024-01-04 00:00:00", 0, 44, 0, 44, 1, 1),
        (2, 1, "2024-01-04 00:00:00", 5, 5, 5, 5, 1, 1),
    ]))
    assert shape(got.schema) == shape(schemas.DAILY)
    day = {(r.symbol_id, r.date_id.day): r for r in got.collect()}
    first = day[1, 1]
    assert (first.open_price, first.high_price, first.low_price, first.close_price) == (8, 15, 7, 11)
    assert (first.volume, first.trade_count, first.variation_daily_pct) == (3, 5, Decimal("37.5"))
    assert str(first.close_time) == str(first.ingested_at + dt.timedelta(seconds=3599))
    assert first.variation_prev_day_pct is None and day[2, 4].variation_prev_day_pct is None
    assert day[1, 2].variation_prev_day_pct == 100
    # Day 3 is missing: day 4 is compared with day 2. Its opening is zero.
    assert day[1, 4].variation_prev_day_pct == 100 and day[1, 4].variation_daily_pct is None
    gaps = {(r.symbol_id, r.date_id.day): r.prev_date_gap_days for r in facts.with_prev_gap(got).collect()}
    assert gaps == {(1, 1): None, (1, 2): 1, (1, 4): 2, (2, 4): None}


def random_hours(spark, seed=3):
    rng = random.Random(seed)
    made = []
    for symbol in (1, 2, 3):
        for hour in range(24 * 12):
            if rng.random() < 0.8:
                low, *mid, high = sorted(rng.randint(0, 50) for _ in range(4))
                at = dt.datetime(2024, 1, 1) + dt.timedelta(hours=hour)
                made.append((symbol, rng.choice((1, 2)), str(at), mid[0], high, low, mid[1], rng.randint(0, 9), 1))
    return hourly(spark, made)


def test_daily_properties(spark):
    hours = random_hours(spark)
    daily = facts.daily_fact(hours)
    o, h, low, c = (F.col(f"{n}_price") for n in ("open", "high", "low", "close"))
    assert daily.where((h < low) | (h < o) | (h < c) | (low > o) | (low > c)).isEmpty()
    assert quality.duplicates(daily, facts.DAILY_KEY).isEmpty()
    report = quality.reconcile_report(hours, daily).first()
    assert report.mismatched_keys == 0 and report.compared_keys == daily.count()


def test_reconcile_finds_differences(spark):
    hours = random_hours(spark)
    daily = facts.daily_fact(hours)
    wrong = daily.where("date_id <> date'2024-01-02'").withColumn(
        "volume", F.when(F.col("date_id") == "2024-01-03", F.col("volume") + 1).otherwise(F.col("volume")))
    bad = quality.reconcile_daily(hours, wrong).where(~F.col("matches"))
    assert {r.date_id.day for r in bad.select("date_id").distinct().collect()} == {2, 3}


def test_hot_series_resamples_without_a_window(spark):
    """One series with nearly all rows: its candles are merged before the shuffle."""
    hours = random_hours(spark).withColumn("symbol_id", F.when(F.col("symbol_id") < 3, 1).otherwise(2))
    plan = executed(facts.daily_candles(hours))
    assert "SortAggregate" not in plan and "Window" not in plan and "Join" not in plan
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_min_by" in plan


def test_metrics(spark):
    daily = facts.daily_fact(hourly(spark, [
        (1, 1, "2024-01-01 00:00:00", 10, 20, 5, 10, 1, 1),
        (1, 1, "2024-01-02 00:00:00", 10, 12, 9, 15, 2, 1),
        (1, 2, "2024-01-02 00:00:00", 10, 12, 9, 11, 2, 1),
        (2, 1, "2024-01-01 00:00:00", 4, 4, 4, 4, 7, 2),
        (2, 1, "2024-01-03 00:00:00", 4, 8, 4, 8, 7, 2),
        (3, 1, "2024-01-01 00:00:00", 0, 1, 0, 0, 7, 2),
    ]))
    assert rows(metrics.current_price(daily), "exchange_id", "symbol_id", "current_price") == [
        (1, 1, 15), (1, 2, 8), (1, 3, 0), (2, 1, 11)]
    returns = rows(metrics.accumulated_return(daily), "exchange_id", "symbol_id", "return_pct")
    assert returns == [(1, 1, 50), (1, 2, 100), (1, 3, None), (2, 1, 0)]
    ranks = rows(metrics.rank_by_return(daily), "return_rank", "symbol_id", "exchange_id")
    assert ranks == [(1, 2, 1), (2, 1, 1), (3, 1, 2), (4, 3, 1)]
    index = rows(metrics.index_base_100(daily), "symbol_id", "date_id", "index_100")
    assert (1, dt.date(2024, 1, 2), Decimal(150)) in index and (2, dt.date(2024, 1, 1), Decimal(100)) in index
    assert rows(metrics.volume_traded(daily), "exchange_id", "symbol_id", "volume")[0] == (1, 1, 3)
    assert metrics.available_until(daily).first()[0] == dt.date(2024, 1, 3)
    assert metrics.in_period(daily, dt.date(2024, 1, 2), dt.date(2024, 1, 2)).count() == 2


def test_most_volatile_days_and_price_comparison(spark):
    daily = facts.daily_fact(hourly(spark, [
        (s, x, f"2024-01-0{d} 00:00:00", 10, 10 + s * d, 9, 10, 1, 1)
        for s in (1, 2) for x in (1, 2) for d in (1, 2, 3)
    ]))
    exchanges = spark.createDataFrame([(1, "binance"), (2, "poloniex")], "exchange_id int, exchange_name string")
    symbols = spark.createDataFrame([(1, "BTC_USDT"), (2, "ETH_USDT")], "symbol_id int, symbol_name string")
    dates = daily.select("date_id", F.col("date_id").alias("date")).distinct()
    top = metrics.top_volatile(daily, dates, exchanges, symbols, 3).collect()
    assert [(r.date.day, r.symbol_name, r.exchange_name) for r in top] == [
        (3, "ETH_USDT", "binance"), (3, "ETH_USDT", "poloniex"), (2, "ETH_USDT", "binance")]
    assert "TakeOrderedAndProject" in executed(metrics.top_volatile(daily, dates, exchanges, symbols, 3))
    both = metrics.cross_exchange_price(
        daily, dates, exchanges, symbols, "BTC_USDT", dt.date(2024, 1, 2), dt.date(2024, 1, 3)).collect()
    assert [(r.date.day, r.exchange_name) for r in both] == [
        (2, "binance"), (2, "poloniex"), (3, "binance"), (3, "poloniex")]


def test_gaps_and_completeness(spark):
    made = [bronze_row(f"2024-01-0{d} {h:02}:00:00") for d in (1, 2, 4) for h in range(24)]
    made += [bronze_row("2024-01-01 00:00:00", symbol="ETHUSDT")]
    source = silver.usable(bronze(spark, made))
    profile = dims.series_profile(source)
    gaps = rows(quality.date_gaps(source, profile), "symbol", "rate_date")
    assert [(s, d.day) for s, d in gaps] == [("BTC_USDT", 3), ("ETH_USDT", 2), ("ETH_USDT", 3), ("ETH_USDT", 4)]
    assert rows(quality.gap_report(source, profile), "symbol", "calendar_days", "missing_days") == [
        ("BTC_USDT", 4, 1), ("ETH_USDT", 4, 3)]
    short = rows(quality.hour_completeness(source, profile).where("missing_hours > 0"), "symbol", "rate_date", "missing_hours")
    assert [(s, d.day, n) for s, d, n in short] == [
        ("BTC_USDT", 3, 24), ("ETH_USDT", 1, 23), ("ETH_USDT", 2, 24), ("ETH_USDT", 3, 24), ("ETH_USDT", 4, 24)]
    listed_late = silver.usable(bronze(spark, made[24:48] + [bronze_row("2024-01-04 00:00:00", symbol="ETHUSDT")]))
    own_days = quality.hour_completeness(listed_late, dims.series_profile(listed_late))
    assert rows(quality.hour_summary(own_days), "symbol", "days", "complete_days", "missing_hours") == [
        ("BTC_USDT", 3, 1, 48), ("ETH_USDT", 1, 0, 23)]


def test_duplicates(spark):
    frame = spark.createDataFrame([(1,), (1,), (1,), (2,), (3,), (3,)], "k int")
    assert rows(quality.duplicates(frame, ["k"])) == [(1, 3), (3, 2)]
    assert quality.duplicate_report(frame, ["k"], "t").first() == ("t", 2, 3)


def test_quality_profile_counts_zero_volume(spark):
    fact = facts.hourly_fact(*star(spark, bronze_row("2024-01-01 00:00:00", v="0"), bronze_row("2024-01-01 01:00:00", h=None)))
    got = quality.quality_profile(fact, quality.hourly_rules()).first()
    assert (got.total_rows, got.invalid_volume, got.null_high, got.invalid_high_low) == (2, 1, 1, 0)


def test_summaries(spark):
    hours = random_hours(spark).withColumn("variation_1h_pct", F.lit("1.005").cast("decimal(38,15)"))
    got = quality.hourly_summary(hours).first()
    assert (got.total_records, got.distinct_exchanges, got.distinct_symbols) == (hours.count(), 2, 3)
    assert quality.daily_summary(facts.daily_fact(hours)).first().distinct_dates == 12


@pytest.fixture
def several_ranges(spark):
    """Small ranges are put together at run time; here they stay as they are dealt."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_previous_row_of_a_long_series_comes_from_any_range(spark, several_ranges):
    """One series has nearly all rows, so it lies in every range; others have one row or a NULL order."""
    frame = spark.range(20_000).selectExpr(
        "CASE WHEN id % 50 = 0 THEN id ELSE 7 END AS symbol_id", "CASE WHEN id % 9 = 0 THEN NULL ELSE 1 END AS exchange_id",
        "CASE WHEN id <> 101 THEN id END AS at", "id * 3 AS v")
    got = numbering.previous_in_order(frame, {"before": "v", "at_before": "at"}, ["exchange_id", "symbol_id"], "at")
    wanted = facts.previous(facts.previous(frame, "v", "before", ["exchange_id", "symbol_id"], "at"),
                            "at", "at_before", ["exchange_id", "symbol_id"], "at")
    assert rows(got) == rows(wanted)
    ranges = numbering.dealt(frame, "exchange_id", "symbol_id", "at").where("symbol_id = 7")
    sizes = [r["count"] for r in ranges.groupBy("_bucket").count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 20_000 / 3
    assert numbering.previous_in_order(frame.limit(0), {"before": "v"}, ["symbol_id"], "at").count() == 0


def test_both_forms_of_the_previous_day_agree(spark, several_ranges):
    daily = spark.range(3000).selectExpr("cast(id % 6 AS int) AS symbol_id", "cast(id % 2 AS int) AS exchange_id",
                                         "date_add(DATE'2020-01-01', cast(id * id % 2999 AS int)) AS date_id").distinct()
    got = numbering.previous_in_order(daily, {"_prev_date": "date_id"}, facts.SERIES, "date_id").selectExpr(
        "symbol_id", "exchange_id", "date_id", "date_diff(date_id, _prev_date) AS prev_date_gap_days")
    assert rows(got) == rows(facts.with_prev_gap(daily), *got.columns)


@pytest.mark.parametrize("values", ["id % 3", "1", "NULL", "CASE WHEN id % 5 > 0 THEN id % 4 END", "id"])
def test_ranks_over_ties_do_not_meet_in_one_task(spark, several_ranges, values):
    frame = spark.range(20_000).selectExpr("id", f"cast({values} AS bigint) AS v")
    ranked = numbering.rank_descending(frame, "v", "n")
    got = sorted(((r.v is None, -(r.v or 0)), r.n) for r in ranked.collect())
    first = {}
    for place, (v, _) in enumerate(got, 1):
        first.setdefault(v, place)
    assert got == [(v, first[v]) for v, _ in got]
    dealt = numbering.dealt(frame, F.desc_nulls_last("v"), F.xxhash64("id")).groupBy("_bucket").count()
    assert max(r["count"] for r in dealt.collect()) < 20_000 / 3
    assert numbering.rank_descending(frame.limit(0), "v", "n").count() == 0
