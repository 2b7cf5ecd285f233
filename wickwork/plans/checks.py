"""Checks of the stored tables after a refresh, as lines of one table.

A line names the rule, the table it looks at, what it looked at and what broke the rule.
Tables are read for the given days only. Gaps, hours and calendars come from the summary
per series and day and from the dimensions, which are small next to any fact.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickwork.operators import dims, facts, quality, silver
from wickwork.sources.candles import LAYOUTS

COLUMNS = ["rule", "subject", "severity", "total_rows", "violations"]


def _line(df: DataFrame, rule: str, subject: Column | str, total: Column, violations: Column,
          severity: str = quality.REPORT) -> DataFrame:
    """Lines from rows or, when `total` and `violations` aggregate, one line over all rows."""
    named = F.lit(subject) if isinstance(subject, str) else subject
    whole = {"total_rows": total, "violations": violations}
    return df.select(
        F.lit(rule).alias("rule"), named.alias("subject"), F.lit(severity).alias("severity"),
        *[F.coalesce(c.cast("bigint"), F.lit(0).cast("bigint")).alias(n) for n, c in whole.items()],
    )


def _profile(df: DataFrame, subject: str, rules: list[quality.Rule]) -> DataFrame:
    return quality.quality_report(df, rules).withColumn("subject", F.lit(subject)).select(*COLUMNS)


def _repeated(df: DataFrame, keys: list[str], subject: str) -> DataFrame:
    """Rows beyond the first of each key."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return _line(sizes, "duplicate_key", subject, F.sum("rows"), F.sum(F.col("rows") - 1), quality.GATE)


def _missing_hours(days: DataFrame, start: dt.date, end: dt.date, expected: int = 24) -> DataFrame:
    """Hours without a row in the days, of each series from its first day on."""
    inside = F.col("rate_date").between(F.lit(start), F.lit(end))
    series = days.groupBy("exchange", "symbol").agg(
        F.min("rate_date").alias("listed"), F.sum(F.when(inside, F.col("row_count")).otherwise(0)).alias("found")
    )
    due = F.greatest(F.date_diff(F.lit(end), F.greatest("listed", F.lit(start))) + 1, F.lit(0)) * expected
    return _line(series, "missing_hour", "silver_hourly", F.sum(due), F.sum(due - F.col("found")))


def check_lines(read: Callable[[str], DataFrame], start: dt.date, end: dt.date) -> DataFrame:
    """(rule, subject, severity, total_rows, violations); `read` gives a stored table by its name."""

    def held(table: str, by: str) -> DataFrame:
        return read(table).where(F.col(by).between(F.lit(start), F.lit(end)))

    lines = []
    wanted = F.lit((end - start).days + 1)
    for exchange in LAYOUTS:
        table = f"bronze_{exchange}"
        bronze = held(table, "rate_date")
        lines.append(_profile(bronze, table, quality.bronze_rules()))
        lines.append(_line(bronze, "missing_day", table, wanted, wanted - F.count_distinct("rate_date")))

    rows, hourly, daily = held("silver_hourly", "rate_date"), held("fact_market_hourly", "date_id"), held("fact_market_daily", "date_id")
    lines.append(_profile(hourly, "fact_market_hourly", quality.hourly_rules()))
    lines += [
        _repeated(rows, silver.SILVER_KEY, "silver_hourly"),
        _repeated(hourly, facts.HOURLY_KEY, "fact_market_hourly"),
        _repeated(daily, facts.DAILY_KEY, "fact_market_daily"),
    ]

    exchanges, symbols, dates, datetimes = (read(f"dim_{d}") for d in ("exchange", "symbol", "date", "datetime"))
    every = rows.agg(F.count(F.lit(1)).alias("rows")).scalar()
    orphans = quality.orphan_report(rows, exchanges, symbols, datetimes)
    lines.append(_line(orphans, "orphan", F.col("dimension"), every, F.col("orphan_rows")))

    days = read("series_days")
    gaps = quality.gap_report(days, dims.profile_of_days(days))
    lines.append(_line(gaps, "series_gap", "silver_hourly", F.sum("calendar_days"), F.sum("missing_days")))
    lines.append(_missing_hours(days, start, end))
    calendars = quality.dim_completeness(dates, datetimes, days).where(F.col("dimension").startswith("dim_"))
    expected = F.col("expected_records")
    lines.append(_line(calendars, "missing_member", F.col("dimension"), expected, expected - F.col("total_records")))

    sums = quality.reconcile_report(hourly, daily)
    lines.append(_line(sums, "daily_not_sum_of_hours", "fact_market_daily", F.col("compared_keys"), F.col("mismatched_keys")))
    return reduce(DataFrame.unionByName, lines)
