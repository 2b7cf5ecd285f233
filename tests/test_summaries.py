"""The small levels above the facts against the plain forms over the facts."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import executed, rows
from wickwork.operators import metrics, quality, summaries
from wickwork.session import staged
from wickwork.sources import tables


def facts_of(spark, n=4000):
    """Rows of both facts: keys far apart, beyond one bitmap and missing."""
    symbol = "CASE WHEN id % 11 = 0 THEN NULL WHEN id % 3 = 0 THEN 32768 WHEN id % 3 = 1 THEN 32769 ELSE id * 977 END"
    return spark.range(n).selectExpr(
        f"cast({symbol} AS int) AS symbol_id", "cast(id % 3 + 1 AS int) AS exchange_id",
        "timestamp_seconds(1700000400 + id * 3600 * 5) AS datetime_id", "cast(id % 17 - 8 AS decimal(38,15)) AS variation_1h_pct",
        "cast(CASE WHEN id % 5 > 0 THEN id % 13 END AS decimal(38,15)) AS variation_daily_pct",
        "cast(NULL AS decimal(38,15)) AS variation_prev_day_pct",
    ).withColumns({"close_time": F.col("datetime_id") + F.expr("interval 3599 seconds"), "date_id": F.to_date("datetime_id")})


@pytest.mark.parametrize("n", [0, 1, 4000])
def test_summaries_of_cells_are_those_of_the_facts(spark, n):
    fact = facts_of(spark, n)
    got = summaries.hourly_summary_of(staged(summaries.hourly_cells(fact.drop("date_id")), "cells"))
    wanted = quality.hourly_summary(fact)
    assert rows(got, *sorted(got.columns)) == rows(wanted, *sorted(got.columns))
    got = summaries.daily_summary_of(staged(summaries.daily_cells(fact), "cells"))
    wanted = quality.daily_summary(fact)
    assert rows(got, *sorted(got.columns)) == rows(wanted, *sorted(got.columns))


def test_cells_of_days_can_be_replaced(spark, tmp_path):
    fact, path = facts_of(spark), str(tmp_path / "cells")
    day = fact.agg(F.min("date_id")).first()[0] + dt.timedelta(days=3)
    tables.write_table(summaries.hourly_cells(fact.withColumn("symbol_id", F.when(F.col("date_id") != day, F.col("symbol_id")).otherwise(5))), path, "date_id")
    tables.write_partitions(summaries.hourly_cells(fact.where(F.col("date_id") == day)), path, "date_id")
    got = summaries.hourly_summary_of(spark.read.parquet(path))
    assert rows(got, *sorted(got.columns)) == rows(quality.hourly_summary(fact), *sorted(got.columns))


@pytest.fixture(scope="module")
def ten_years(spark, tmp_path_factory):
    daily = spark.range(6 * 3650).selectExpr(
        "cast(id % 3 AS int) AS symbol_id", "cast(id % 2 AS int) AS exchange_id", "date_add(DATE'2014-01-01', cast(id / 6 AS int)) AS date_id",
        "cast(xxhash64(id) % 1000 AS decimal(18,8)) AS close_price", "cast(id % 91 AS decimal(28,8)) AS volume", "id % 7 AS trade_count",
    ).where("xxhash64(id, 1) % 4 > 0 AND NOT (symbol_id = 1 AND month(date_id) IN (2, 3))")
    root = tmp_path_factory.mktemp("years")
    # A folder a year is enough here: what matters is which rows are read.
    daily.withColumn("year", F.year("date_id")).write.partitionBy("year").parquet(str(root / "daily"))
    stored = spark.read.parquet(str(root / "daily")).drop("year")
    tables.write_table(summaries.month_candles(stored), str(root / "months"), "month")
    return stored, spark.read.parquet(str(root / "months"))


def test_periods_from_months_equal_those_from_days(ten_years):
    daily, months = ten_years
    rnd = random.Random(4)
    periods = [(dt.date(2015, 3, 1), dt.date(2015, 3, 31)), (dt.date(2015, 3, 2), dt.date(2015, 4, 29)), (dt.date(2013, 5, 5), dt.date(2030, 1, 1)),
               (dt.date(2016, 12, 31), dt.date(2017, 1, 1)), (dt.date(2016, 2, 29), dt.date(2016, 2, 29)), (dt.date(2040, 1, 1), dt.date(2041, 1, 1))]
    for _ in range(4):
        start = dt.date(2014, 1, 1) + dt.timedelta(days=rnd.randrange(3000))
        periods.append((start, start + dt.timedelta(days=rnd.randrange(900))))
    for start, end in periods:
        plain, pieces = metrics.in_period(daily, start, end), summaries.period_pieces(daily, months, start, end)
        for got, wanted in ((summaries.return_of(pieces), metrics.accumulated_return(plain)), (summaries.volume_of(pieces), metrics.volume_traded(plain))):
            assert rows(got) == rows(wanted, *got.columns), (start, end)


def test_a_long_period_reads_months_and_the_days_at_its_ends(ten_years):
    daily, months = ten_years
    pieces = summaries.period_pieces(daily, months, dt.date(2014, 1, 15), dt.date(2023, 11, 20))
    assert pieces.count() < 6 * (118 + 40)
    plan = executed(pieces)
    assert "PartitionFilters: [isnotnull(month" in plan and "< 2014-02-01) OR (date_id" in plan


def test_gap_intervals(spark):
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    present = {("a", "X"): [0, 1, 5, 6, 4000], ("a", "Y"): [3], ("b", "X"): [0, 4000], ("b", "Z"): list(range(10))}
    days = spark.createDataFrame([(*s, day(n), 24) for s, own in present.items() for n in own], "exchange string, symbol string, rate_date date, row_count long")
    profile = days.groupBy("exchange", "symbol").agg(F.min("rate_date").alias("min_date"), F.max("rate_date").alias("max_date"))
    got = rows(quality.gap_intervals(days, profile))
    wanted = []
    for s, own in present.items():
        edges = [-1, *own, 4001]
        wanted += [(*s, day(a + 1), day(b - 1), b - a - 1) for a, b in zip(edges, edges[1:]) if b - a > 1]
    assert got == sorted(wanted, key=repr)
    assert quality.gap_intervals(days.limit(0), profile.limit(0)).count() == 0
    assert "Generate" not in executed(quality.gap_intervals(days, profile))
