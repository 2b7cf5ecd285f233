"""Data-quality checks. Counts come from one pass over the data wherever they can."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from wickwork import constants as C
from wickwork.functions.candle import breaks_ohlc, breaks_time
from wickwork.operators.dims import days_between
from wickwork.operators.facts import DAILY_KEY, previous
from wickwork.operators.silver import problems

GATE, REPORT = "gate", "report"
REQUIRED = ["symbol", "open_time_ms", "close_time_ms", *C.PRICE_FIELDS]


class QualityError(AssertionError):
    """A gating rule found violations."""


@dataclass(frozen=True)
class Rule:
    """A named test for bad rows; a NULL test counts as no violation."""

    name: str
    severity: str
    bad: Column


def bronze_rules() -> list[Rule]:
    """Required fields of a landed candle."""
    return [Rule(f"missing_{f}", REPORT, F.col(f).isNull()) for f in REQUIRED]


def typing_rules() -> list[Rule]:
    """Reasons for setting bronze rows aside, over `silver.judged` rows."""
    return [Rule(name, REPORT, F.col(name)) for name in ("rejected", *problems())]


def silver_rules() -> list[Rule]:
    """NULLs are reported; impossible prices and times stop the write."""
    nulls = ["symbol", *C.PRICE_FIELDS]
    return [
        *[Rule(f"null_{f}", REPORT, F.col(f).isNull()) for f in nulls],
        Rule("invalid_ohlc", GATE, breaks_ohlc(*[F.col(f) for f in C.PRICE_FIELDS[:4]])),
        Rule("invalid_time", GATE, breaks_time(F.col("open_time"), F.col("close_time"))),
        Rule("off_grid_time", REPORT, F.col("open_time") != F.date_trunc("hour", "open_time")),
    ]


def load_rules() -> list[Rule]:
    """Everything to know before silver is written, over `silver.judged` rows.

    Rows that are set aside do not count against silver.
    """
    kept = ~F.col("rejected")
    return [*typing_rules(), *[Rule(r.name, r.severity, kept & r.bad) for r in silver_rules()]]


def hourly_rules() -> list[Rule]:
    """Profile of the hourly fact. Nothing here stops a write."""
    open_, high, low, close = (F.col(f"{f}_price") for f in C.PRICE_FIELDS[:4])
    tests = {
        "null_open": open_.isNull(),
        "null_high": high.isNull(),
        "null_low": low.isNull(),
        "null_close": close.isNull(),
        "invalid_volume": F.col("volume").isNull() | (F.col("volume") <= 0),
        "invalid_high_low": high < low,
        "invalid_high_open": high < open_,
        "invalid_high_close": high < close,
        "invalid_low_open": low > open_,
        "invalid_low_close": low > close,
    }
    return [Rule(name, REPORT, test) for name, test in tests.items()]


def quality_profile(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row: `total_rows` and the violations of each rule."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"), *[F.count_if(r.bad).alias(r.name) for r in rules]
    )


def quality_report(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per rule: rule, severity, total_rows, violations."""
    lines = F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"),
                 "total_rows", F.col(r.name).alias("violations"))
        for r in rules
    ])
    return quality_profile(df, rules).select(F.inline(lines))


def enforce(report: DataFrame) -> list[Row]:
    """The report's lines, one per rule; raises when a gating rule was violated."""
    lines = report.collect()
    failed = [r for r in lines if r.severity == GATE and r.violations]
    if failed:
        raise QualityError(", ".join(f"{r.rule}: {r.violations} of {r.total_rows}" for r in failed))
    return lines


# Profiles and summaries ---------------------------------------------------

def rows_by(df: DataFrame, *keys: str) -> DataFrame:
    """Rows and covered days per key."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("rate_date").alias("min_date"),
        F.max("rate_date").alias("max_date"),
    ).orderBy(*keys)


def range_profile(bronze: DataFrame) -> DataFrame:
    """One row: covered days, rows, distinct days and symbols.

    Rows are counted per day and symbol first, so the two distinct counts see
    that small result and not the table.
    """
    cells = bronze.groupBy("rate_date", "symbol").agg(F.count(F.lit(1)).alias("rows"))
    return cells.agg(
        F.min("rate_date").alias("min_date"),
        F.max("rate_date").alias("max_date"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.count_distinct("rate_date").alias("distinct_dates"),
        F.count_distinct("symbol").alias("distinct_symbols"),
    )


def name_list(dim: DataFrame, name: str) -> DataFrame:
    """Number of members of a dimension and their sorted names. For small dimensions."""
    return dim.agg(
        F.count(F.lit(1)).alias("total"), F.array_sort(F.collect_list(name)).alias("names")
    )


def _rounded_avg(column: str) -> Column:
    return F.round(F.avg(column), 2)


def hourly_summary(hourly: DataFrame) -> DataFrame:
    """One row over the hourly fact.

    The three distinct counts are merged within each task: what is shuffled is one
    row per task and distinct exchange, symbol and hour, not the fact.
    """
    return hourly.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct("exchange_id").alias("distinct_exchanges"),
        F.count_distinct("symbol_id").alias("distinct_symbols"),
        F.count_distinct("datetime_id").alias("distinct_datetimes"),
        F.min("close_time").alias("min_datetime"),
        F.max("close_time").alias("max_datetime"),
        _rounded_avg("variation_1h_pct").alias("avg_variation_pct"),
    )


def daily_summary(daily: DataFrame) -> DataFrame:
    """One row over the daily fact."""
    return daily.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct("exchange_id").alias("distinct_exchanges"),
        F.count_distinct("symbol_id").alias("distinct_symbols"),
        F.count_distinct("date_id").alias("distinct_dates"),
        F.min("date_id").alias("min_date"),
        F.max("date_id").alias("max_date"),
        _rounded_avg("variation_daily_pct").alias("avg_variation_daily"),
        _rounded_avg("variation_prev_day_pct").alias("avg_variation_prev_day"),
    )


def dim_completeness(dates: DataFrame, datetimes: DataFrame, silver: DataFrame) -> DataFrame:
    """Actual and expected rows of both calendars, next to the days of silver."""

    def line(df: DataFrame, label: str, column: str, total: Column, expected: Column) -> DataFrame:
        return df.agg(
            F.lit(label).alias("dimension"),
            total.alias("total_records"),
            F.min(column).cast("string").alias("min_value"),
            F.max(column).cast("string").alias("max_value"),
            expected.cast("bigint").alias("expected_records"),
        )

    every = F.count(F.lit(1))
    days = F.date_diff(F.max("date_id"), F.min("date_id")) + 1
    hours = F.timestamp_diff("HOUR", F.min("datetime_id"), F.max("datetime_id")) + 1
    distinct_days = F.count_distinct("rate_date")
    return (
        line(dates, "dim_date", "date_id", every, days)
        .unionByName(line(datetimes, "dim_datetime", "datetime_id", every, hours))
        .unionByName(line(silver, "Silver reference", "rate_date", distinct_days, distinct_days))
    )


# Relations between tables -------------------------------------------------

def orphans(fact: DataFrame, column: str, dim: DataFrame, key: str) -> DataFrame:
    """Values of a fact column that the dimension lacks, with their number of rows.

    Rows are counted per value before the join, so a hot value is one row in it.
    """
    used = fact.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    return used.join(dim.select(F.col(key).alias(column)), column, "left_anti")


def orphan_report(
    silver: DataFrame, exchanges: DataFrame, symbols: DataFrame, datetimes: DataFrame
) -> DataFrame:
    """One row per dimension: values and rows of silver without a match in it."""
    links = [
        ("dim_exchange", "exchange", exchanges, "exchange_name"),
        ("dim_symbol", "symbol", symbols, "symbol_name"),
        ("dim_datetime", "open_time", datetimes, "datetime_id"),
    ]
    lines = [
        orphans(silver, column, dim, key).agg(
            F.lit(label).alias("dimension"),
            F.count(F.lit(1)).alias("orphan_values"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("orphan_rows"),
        )
        for label, column, dim, key in links
    ]
    first, *rest = lines
    for line in rest:
        first = first.unionByName(line)
    return first


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that more than one row carries."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def duplicate_report(df: DataFrame, keys: list[str], table: str) -> DataFrame:
    """One row: repeated keys of a table and the rows beyond the first of each."""
    return duplicates(df, keys).agg(
        F.lit(table).alias("table_name"),
        F.count(F.lit(1)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("surplus_rows"),
    )


def series_calendar(profile: DataFrame, since_listed: bool = False) -> DataFrame:
    """Every series on every day from the first through the last day of the whole table.

    With `since_listed`, each series starts on its own first day.
    """
    bounds = profile.agg(F.min("min_date").alias("first"), F.max("max_date").alias("last"))
    first = F.col("min_date") if since_listed else bounds.select("first").scalar()
    ranged = profile.select(
        "exchange", "symbol", first.alias("first"), bounds.select("last").scalar().alias("last")
    )
    return days_between(ranged, "exchange", "symbol").withColumnRenamed("date_id", "rate_date")


def date_gaps(silver: DataFrame, profile: DataFrame) -> DataFrame:
    """Days on which a series has no row at all."""
    present = silver.select("exchange", "symbol", "rate_date").distinct()
    return series_calendar(profile).join(present, ["exchange", "symbol", "rate_date"], "left_anti")


def gap_report(silver: DataFrame, profile: DataFrame) -> DataFrame:
    """One row per series: days of the calendar and days without a row.

    Counts only, so no calendar is laid out: the days of the range less those present.
    """
    length = profile.agg((F.date_diff(F.max("max_date"), F.min("min_date")) + 1).cast("bigint").alias("days"))
    present = silver.groupBy("exchange", "symbol").agg(F.count_distinct("rate_date").alias("present"))
    return profile.select("exchange", "symbol", length.scalar().alias("calendar_days")).join(
        present, ["exchange", "symbol"], "left"
    ).select(
        "exchange", "symbol", "calendar_days",
        (F.col("calendar_days") - F.coalesce(F.col("present"), F.lit(0))).alias("missing_days"),
    )


def gap_intervals(days: DataFrame, profile: DataFrame) -> DataFrame:
    """Runs of days without a row: exchange, symbol, first_missing, last_missing, missing_days.

    `days` has one row per series and day (`dims.series_days`). A gap lies between two days that
    follow one another in a series, or at either end of the days of the whole table, so
    no calendar is laid out: a gap of ten years is one row.
    """
    bounds = profile.agg(F.min("min_date").alias("first"), F.max("max_date").alias("last"))
    first, last = (bounds.select(c).scalar() for c in ("first", "last"))
    present = days.select("exchange", "symbol", "rate_date")
    between = previous(present, "rate_date", "_before", ["exchange", "symbol"], "rate_date").select(
        "exchange", "symbol", F.date_add("_before", 1).alias("first_missing"), F.date_sub("rate_date", 1).alias("last_missing")
    )
    ends = present.groupBy("exchange", "symbol").agg(F.min("rate_date").alias("listed"), F.max("rate_date").alias("seen"))
    before = ends.select("exchange", "symbol", first.alias("first_missing"), F.date_sub("listed", 1).alias("last_missing"))
    after = ends.select("exchange", "symbol", F.date_add("seen", 1).alias("first_missing"), last.alias("last_missing"))
    runs = between.unionByName(before).unionByName(after).where(F.col("first_missing") <= F.col("last_missing"))
    return runs.withColumn("missing_days", F.date_diff("last_missing", "first_missing") + 1)


def hour_completeness(silver: DataFrame, profile: DataFrame, expected: int = 24) -> DataFrame:
    """Rows of each series and day, from its first day on, against the hours of a day.

    Absent days have 0 rows.
    """
    counted = silver.groupBy("exchange", "symbol", "rate_date").agg(F.count(F.lit(1)).alias("found"))
    found = F.coalesce(F.col("found"), F.lit(0))
    days = series_calendar(profile, since_listed=True)
    return days.join(counted, ["exchange", "symbol", "rate_date"], "left").select(
        "exchange", "symbol", "rate_date",
        found.alias("hours"),
        F.lit(expected).alias("expected_hours"),
        (F.lit(expected) - found).alias("missing_hours"),
    )


def hour_summary(completeness: DataFrame) -> DataFrame:
    """One row per series over `hour_completeness`: days, complete days and missing hours."""
    return completeness.groupBy("exchange", "symbol").agg(
        F.count(F.lit(1)).alias("days"),
        F.count_if(F.col("missing_hours") == 0).alias("complete_days"),
        F.sum("missing_hours").alias("missing_hours"),
    )


def reconcile_daily(hourly: DataFrame, daily: DataFrame) -> DataFrame:
    """Sums of the hours next to the daily row, per key that either table has."""
    summed = _keyed_hours(hourly).withColumnsRenamed({"volume": "hours_volume", "trade_count": "hours_trades"})
    stored = daily.select(*DAILY_KEY, F.col("volume").alias("day_volume"), F.col("trade_count").alias("day_trades"))
    same = F.col("hours_volume").eqNullSafe(F.col("day_volume")) & F.col("hours_trades").eqNullSafe(F.col("day_trades"))
    return summed.join(stored, DAILY_KEY, "full_outer").withColumn("matches", same)


def reconcile_report(hourly: DataFrame, daily: DataFrame) -> DataFrame:
    """One row: compared keys and those whose totals differ."""
    return reconcile_daily(hourly, daily).agg(
        F.count(F.lit(1)).alias("compared_keys"),
        F.count_if(~F.col("matches")).alias("mismatched_keys"),
    )


# Checksums by month, day and key ---------------------------------------------

def _keyed_hours(hourly: DataFrame) -> DataFrame:
    return hourly.withColumn("date_id", F.to_date("datetime_id")).groupBy(*DAILY_KEY).agg(
        F.sum("volume").alias("volume"), F.sum("trade_count").alias("trade_count"))


def day_checksums(keyed: DataFrame) -> DataFrame:
    """One row per day: its keys, an order-free hash over keys and totals, and the sums.

    `keyed` has one row per series and day, as the daily fact. Checksums of more days come
    from those of each: hashes by XOR, the rest by addition.
    """
    totals = [F.col("volume").cast("decimal(38,8)"), F.col("trade_count").cast("bigint")]
    return keyed.groupBy("date_id").agg(
        F.count(F.lit(1)).alias("keys"), F.bit_xor(F.xxhash64(*DAILY_KEY, *totals)).alias("hash"),
        F.sum(totals[0]).alias("volume"), F.sum(totals[1]).alias("trades"),
    )


def hourly_checksums(hourly: DataFrame) -> DataFrame:
    """`day_checksums` of what the hours of each series and day add up to."""
    return day_checksums(_keyed_hours(hourly))


def _differing(left: DataFrame, right: DataFrame, by: Column) -> DataFrame:
    """Values of `by` for which the checksums of the two sides are not the same."""
    def rolled(side: DataFrame, name: str) -> DataFrame:
        return side.groupBy(by.alias("part")).agg(F.struct(
            F.sum("keys"), F.bit_xor("hash"), F.sum("volume"), F.sum("trades")).alias(name))

    both = rolled(left, "l").join(rolled(right, "r"), "part", "full_outer")
    return both.where(~F.col("l").eqNullSafe(F.col("r"))).select("part")


def differing_days(left: DataFrame, right: DataFrame) -> list[dt.date]:
    """Days whose checksums differ, looked for only in months whose checksums differ.

    No more than the calendar has. Both sides are stored checksums, partitioned by day or small.
    """
    months = [r.part for r in _differing(left, right, F.trunc("date_id", "month")).collect()]
    if not months:
        return []
    in_months = F.trunc("date_id", "month").isin(months)
    return sorted(r.part for r in _differing(left.where(in_months), right.where(in_months), F.col("date_id")).collect())


def reconcile_differing(hourly: DataFrame, daily: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """The keys of `reconcile_daily` that do not match, from the days whose checksums differ alone.

    `hourly` and `daily` are stored by `date_id`; of both only the partitions of those days are read.
    """
    wanted = F.col("date_id").isin(differing_days(left, right))
    return reconcile_daily(hourly.where(wanted), daily.where(wanted)).where(~F.col("matches")).drop("matches")
