from __future__ import annotations

import datetime as dt
import random

import pytest

from tests.helpers import bronze, bronze_row, rows
from wickwork.operators import dims, numbering, quality, silver


def silver_of(spark, *bronze_rows):
    return silver.usable(bronze(spark, list(bronze_rows)))


@pytest.fixture
def night(spark):
    """22h on day 1 through 03h on day 2."""
    times = ["2024-01-31 22:00:00", "2024-01-31 23:00:00", "2024-02-01 03:00:00"]
    return silver_of(spark, *[bronze_row(t) for t in times])


def test_calendar_of_a_partial_day(night):
    profile = dims.series_profile(night)
    assert rows(dims.date_dim(profile), "date_label") == [("01/02/2024",), ("31/01/2024",)]
    hours = dims.datetime_dim(profile)
    assert hours.count() == 6
    assert rows(hours, "datetime_label", "hour_period")[0] == ("01/02/2024 00:00", "Dawn")
    checks = {r.dimension: r for r in quality.dim_completeness(dims.date_dim(profile), hours, night).collect()}
    assert all(c.total_records == c.expected_records for c in checks.values())
    assert checks["dim_datetime"].min_value == "2024-01-31 22:00:00"


def test_missing_hour_shows_in_completeness(night):
    profile = dims.series_profile(night)
    holey = dims.datetime_dim(profile).where("hour <> 1")
    checks = {r.dimension: r for r in quality.dim_completeness(dims.date_dim(profile), holey, night).collect()}
    assert (checks["dim_datetime"].total_records, checks["dim_datetime"].expected_records) == (5, 6)


def test_empty_silver_gives_empty_calendars(spark):
    profile = dims.series_profile(silver_of(spark))
    assert dims.date_dim(profile).count() == dims.datetime_dim(profile).count() == 0
    assert dims.symbol_dim(profile).count() == 0


def test_fixed_calendar_range(night):
    profile = dims.series_profile(night)
    bounds = dt.date(2024, 1, 1), dt.date(2027, 12, 31)
    assert dims.date_dim(profile, *bounds).count() == 1461
    hours = dims.datetime_dim(profile, *bounds)
    assert hours.count() == 1461 * 24
    ends = hours.selectExpr("cast(min(datetime_id) as string)", "cast(max(datetime_id) as string)").first()
    assert tuple(ends) == ("2024-01-01 00:00:00", "2027-12-31 23:00:00")


def test_calendar_columns(night):
    profile = dims.series_profile(night)
    assert dims.date_dim(profile).columns == [
        "date_id", "date", "date_label", "year", "quarter", "month", "day", "year_month",
        "day_of_week", "day_of_week_name", "is_weekend", "created_at"]
    assert dims.datetime_dim(profile).columns == [
        "datetime_id", "date_id", "datetime", "datetime_label", "year", "quarter", "month", "day",
        "hour", "year_month", "day_of_week", "day_of_week_name", "is_weekend", "hour_period", "created_at"]


def test_month_flags(night):
    got = rows(dims.with_month_flags(dims.date_dim(dims.series_profile(night))),
               "date_label", "is_month_start", "is_month_end", "month_name", "week_of_year")
    assert got == [("01/02/2024", True, False, "February", 5), ("31/01/2024", False, True, "January", 5)]


def test_keys_follow_the_alphabet_and_shift(spark):
    first = [bronze_row("2024-01-01 00:00:00", symbol=s, exchange="poloniex") for s in ("BTC_USDT", "ETH_USDT")]
    new = bronze_row("2024-01-01 00:00:00", symbol="AAA_USDT", exchange="poloniex")
    nameless = bronze_row("2024-01-01 00:00:00", symbol=None, exchange="poloniex")
    before = dims.symbol_dim(dims.series_profile(silver_of(spark, *first)))
    after = dims.symbol_dim(dims.series_profile(silver_of(spark, *first, new, nameless)))
    assert rows(before) == [(1, "BTC_USDT"), (2, "ETH_USDT")]
    assert rows(after) == [(1, "AAA_USDT"), (2, "BTC_USDT"), (3, "ETH_USDT")]
    assert after.dtypes[0] == ("symbol_id", "int")


def test_name_list(spark):
    frame = spark.createDataFrame([(2, "b"), (1, "a")], "id int, name string")
    assert quality.name_list(frame, "name").first() == (2, ["a", "b"])


def test_numbers_equal_brute_force(spark):
    rng = random.Random(7)
    alphabet = "AB01_éßЖ中😀"
    names = {"".join(rng.choices(alphabet, k=rng.randint(0, 5))) for _ in range(2000)}
    frame = spark.createDataFrame([(n,) for n in names], "name string").repartition(5)
    got = {r.name: r.n for r in numbering.number_names(frame, "name", "n").collect()}
    assert got == {n: i for i, n in enumerate(sorted(names, key=lambda s: s.encode()), 1)}


def test_ranks_equal_brute_force(spark):
    rng = random.Random(8)
    values = [None] * 3 + [rng.choice([0.0, 0.5, -100.0, 20_000.0, 30_000.0, rng.uniform(-200, 20_000)])
                           for _ in range(2000)]
    frame = spark.createDataFrame(list(enumerate(values)), "id int, v double").repartition(5)
    got = {r.id: r.n for r in numbering.rank_descending(frame, "v", "n").collect()}
    known = [v for v in values if v is not None]
    above = {v: sum(k > v for k in known) for v in set(known)}
    assert got == {i: (above[v] if v is not None else len(known)) + 1 for i, v in enumerate(values)}


def test_planned_attributes(spark):
    symbols = spark.createDataFrame([(1, "LINK_USDT"), (2, "XYZ_BTC")], "symbol_id int, symbol_name string")
    assert rows(dims.with_asset(symbols)) == [
        (1, "LINK_USDT", "Chainlink", "Oracle"), (2, "XYZ_BTC", None, None)]
    exchanges = spark.createDataFrame([(1, "binance"), (2, "closed")], "exchange_id int, exchange_name string")
    assert rows(dims.with_active(exchanges)) == [(1, "binance", True), (2, "closed", False)]
