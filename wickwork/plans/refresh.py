"""One ordered run from landed payloads to the star schema.

Bronze, then silver, then dimensions, then hourly facts, then daily facts, then checks.
Every stage reads what the stage before it stored.
"""

from __future__ import annotations

import datetime as dt
import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickwork import schemas
from wickwork.operators import dims, facts, metrics, quality, silver, summaries
from wickwork.operators.latest import dedupe_latest, latest_known
from wickwork.plans.checks import check_lines
from wickwork.session import pin_utc, staged
from wickwork.sources import tables
from wickwork.sources.candles import (
    LAYOUTS, EmptyLoad, bronze_days, landed_between, previous_day, rejects, sort_out, stored_fates,
)

log = logging.getLogger(__name__)


KEYED = ("dim_exchange", "dim_symbol")
BRONZE_KEY = ["symbol", "open_time_ms"]


@dataclass(frozen=True)
class Warehouse:
    """The stored tables below one root."""

    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def find(self, table: str) -> DataFrame | None:
        """The table, or None before its first write."""
        name = table.removeprefix("fact_keys_")
        schema = schemas.STORED.get(name, schemas.BRONZE if name.startswith("bronze_") else None)
        found = tables.read_table(self.spark, self.path(table), schema)
        return found if found is None or schema is None else found.select(*schema.names)

    def read(self, table: str) -> DataFrame:
        found = self.find(table)
        if found is None:
            raise LookupError(f"table {table} has not been written")
        return found


def _days(df: DataFrame, by: str, start: dt.date, end: dt.date) -> DataFrame:
    """Rows of the days; on a stored table whole partitions are skipped."""
    return df.where(F.col(by).between(F.lit(start), F.lit(end)))


def _clear(house: Warehouse, table: str, by: str, start: dt.date, end: dt.date, present: set[dt.date],
           among: set[dt.date] | None = None) -> None:
    """Empty the table's days of the range (of those in `among`) that should have no rows any more."""
    stored = house.find(table)
    if stored is not None:
        gone = tables.days_held(stored, by, start, end) - present
        if among is not None:
            gone &= among
        tables.empty_days(stored, house.path(table), gone, by)


def load_bronze(
    raw: DataFrame, house: Warehouse, start: dt.date, end: dt.date,
    symbols: dict[str, list[str]] | None = None, ingested_at: Column | str | None = None,
    landed_until: dt.date | None = None,
) -> dict[str, int]:
    """Land the days in each exchange's bronze table; a rerun replaces them.

    What has landed is read and parsed once, for all exchanges. With a list of symbols for
    an exchange, only their candles are replaced. What cannot be loaded goes to
    bronze_rejected, by landing day, with its reason; a landing day that was read again and
    has no faults any more leaves it.
    """
    rows = {}
    fates = stored_fates(sort_out(landed_between(raw, start, landed_until)))
    aside = rejects(fates).withColumn("landed_on", F.to_date("landed_at"))
    rows["bronze_rejected"] = tables.write_partitions(aside, house.path("bronze_rejected"), "landed_on")
    last = landed_until or dt.date.max
    if house.find("bronze_rejected") is not None:
        again = tables.days_held(fates.select(F.to_date("landed_at").alias("landed_on")), "landed_on", start, last)
        faulty = tables.days_held(aside, "landed_on", start, last) if rows["bronze_rejected"] else set()
        _clear(house, "bronze_rejected", "landed_on", start, last, faulty, again)
    for exchange, layout in LAYOUTS.items():
        wanted = (symbols or {}).get(exchange)
        days = bronze_days(fates, layout, start, end, wanted, ingested_at)
        table = f"bronze_{exchange}"
        if wanted:
            rows[table] = tables.merge_days(days, house.path(table), BRONZE_KEY)
        else:
            rows[table] = tables.write_partitions(days, house.path(table))
        if not rows[table]:
            raise EmptyLoad(f"no rows for {exchange} {start}..{end}")
    return rows


def refresh_silver(house: Warehouse, start: dt.date, end: dt.date) -> dict[str, int]:
    """Type and check the days, stop on a failed gate, then replace them in silver.

    Only the latest version of each candle is judged: what a correction has replaced
    cannot stop a run.

    A day of which no row is left leaves silver, and later the facts. Two passes over the
    days' bronze: all counts, then the write. Rows that cannot be typed cost two more, only
    when there are any.
    """
    bronze = latest_known(silver.unify({
        exchange: _days(house.read(f"bronze_{exchange}"), "rate_date", start, end)
        for exchange in LAYOUTS
    }), ["exchange", *BRONZE_KEY])
    checks = quality.quality_report(silver.judged(bronze), quality.load_rules())
    counts = {line.rule: line.violations for line in quality.enforce(checks)}
    log.info("silver %s..%s: %s", start, end, counts)

    good, aside = silver.to_silver(bronze)
    latest = dedupe_latest(good, silver.SILVER_KEY)
    written = tables.write_partitions(latest, house.path("silver_hourly"))
    bad_days = tables.days_held(aside, "rate_date", start, end) if counts["rejected"] else set()
    if bad_days:
        _clear(house, "silver_hourly", "rate_date", start, end, tables.days_held(good, "rate_date", start, end))
        tables.write_partitions(aside, house.path("silver_rejected"))
    _clear(house, "silver_rejected", "rate_date", start, end, bad_days)
    return {"silver_hourly": written, "silver_rejected": counts["rejected"]}


def refresh_dims(house: Warehouse, start: dt.date, end: dt.date, calendar: tuple[dt.date, dt.date] | None = None) -> None:
    """Bring the four dimensions up to date; known names keep their keys.

    Only the given days of silver are read. The other days come from the stored
    summary that has one row per series and day. The calendars cover the data, or the days
    of `calendar`, with their planned attributes.
    """
    rows = _days(house.read("silver_hourly"), "rate_date", start, end)
    tables.write_partitions(dims.series_days(rows), house.path("series_days"))
    _clear(house, "series_days", "rate_date", start, end, tables.days_held(rows, "rate_date", start, end))
    profile = staged(dims.profile_of_days(house.read("series_days")), "profile")
    for name, build in zip(KEYED, (dims.exchange_dim, dims.symbol_dim)):
        stored = house.find(name)
        # Staged, since it is replaced by what is built from it.
        tables.write_table(build(profile, None if stored is None else staged(stored, name)), house.path(name))
    days = calendar or (None, None)
    tables.write_table(dims.with_month_flags(dims.date_dim(profile, *days)), house.path("dim_date"))
    tables.write_table(dims.with_business_hour(dims.datetime_dim(profile, *days)), house.path("dim_datetime"))


def _facts_use_current_keys(house: Warehouse) -> bool:
    """Whether the stored facts were built with keys that still mean the same."""
    for name in KEYED:
        used = house.find(f"fact_keys_{name}")
        if used is None or used.isEmpty() or not used.join(house.read(name), used.columns, "left_anti").isEmpty():
            return False
    return True


def _neighbours(house: Warehouse, start: dt.date, end: dt.date) -> DataFrame:
    """Each series' last day with data before the range, and its first one after it.

    They come from the summary with one small row per series and day.
    """
    day = F.col("rate_date")
    series = house.read("series_days").groupBy("exchange", "symbol").agg(
        F.max(F.when(day < F.lit(start), day)).alias("before"),
        F.min(F.when(day > F.lit(end), day)).alias("after"),
    )
    exchanges, symbols = (house.read(t) for t in KEYED)
    return series.join(exchanges, series["exchange"] == exchanges["exchange_name"]).join(
        symbols, series["symbol"] == symbols["symbol_name"]
    ).select(*facts.SERIES, "before", "after")


def _daily_days(house: Warehouse, start: dt.date, end: dt.date) -> DataFrame:
    """The days' daily facts, and the later days whose variation depends on them.

    Of the stored daily fact, only partitions with a series' neighbouring day are read.
    On a later one, the rows that directly follow the range get a new variation, the
    others stay as they are.
    """
    near = staged(_neighbours(house, start, end), "neighbours")
    dates = [r.day for r in near.select(F.explode(F.array_compact(F.array("before", "after"))).alias("day"))
             .distinct().collect()]  # no more than the calendar has
    stored = house.read("fact_market_daily").where(F.col("date_id").isin(dates))
    candles = facts.daily_candles(_days(house.read("fact_market_hourly"), "date_id", start, end))
    fresh = facts.with_processed_at(facts.with_variations(candles.unionByName(stored.select(*candles.columns))))
    inside = F.col("date_id").between(F.lit(start), F.lit(end))

    follows = near.where("after IS NOT NULL").select(*facts.SERIES, F.col("after").alias("date_id"))
    later = stored.where(F.col("date_id") > F.lit(end))
    return fresh.where(inside).unionByName(
        fresh.join(follows, facts.DAILY_KEY, "left_semi")
    ).unionByName(later.join(follows, facts.DAILY_KEY, "left_anti"))


def _refresh_levels(house: Warehouse, start: dt.date, end: dt.date, present: set[dt.date], daily: DataFrame | None) -> None:
    """The small levels above the facts: cells and peaks per day, candles per month. `daily`: the days that were
    written; None: all. A month is made again from the days that are stored of it."""
    write = tables.write_table if daily is None else tables.write_partitions
    hourly, stored = house.read("fact_market_hourly"), house.read("fact_market_daily")
    if daily is None:
        daily, touched = stored, stored
    else:
        hourly = _days(hourly, "date_id", start, end)
        first, last = start.replace(day=1), (end.replace(day=1) + dt.timedelta(days=31)).replace(day=1) - dt.timedelta(days=1)
        touched = _days(stored, "date_id", first, last)
    write(summaries.hourly_cells(hourly), house.path("hourly_cells"), "date_id")
    write(summaries.daily_cells(daily), house.path("daily_cells"), "date_id")
    write(metrics.day_peaks(daily), house.path("daily_peaks"), "date_id")
    months = summaries.month_candles(touched)
    write(months, house.path("fact_market_monthly"), "month")
    if touched is not stored:
        for table in ("hourly_cells", "daily_cells", "daily_peaks"):
            _clear(house, table, "date_id", start, end, present)
        _clear(house, "fact_market_monthly", "month", first, last, tables.days_held(
            touched.select(F.trunc("date_id", "month").alias("month")), "month", first, last))


def refresh_facts(house: Warehouse, start: dt.date, end: dt.date) -> dict[str, int]:
    """Hourly, then daily facts.

    While keys keep their meaning, only the given days are computed and written, and of
    the daily fact the days that directly follow them in a series. The record of the keys
    in use is emptied before a fact is touched and written last, so a run that broke off
    anywhere in between is made good by the next, which builds anew.
    """
    anew = not _facts_use_current_keys(house) or house.find("fact_market_daily") is None
    exchanges, symbols, datetimes = (house.read(t) for t in (*KEYED, "dim_datetime"))
    for name, dim in zip(KEYED, (exchanges, symbols)):
        tables.write_table(dim.limit(0), house.path(f"fact_keys_{name}"))

    silver_rows = house.read("silver_hourly")
    write = tables.write_table if anew else tables.write_partitions
    hourly = facts.with_processed_at(facts.hourly_fact(
        silver_rows if anew else _days(silver_rows, "rate_date", start, end), exchanges, symbols, datetimes
    )).withColumn("date_id", F.to_date("datetime_id"))
    hourly_rows = write(hourly, house.path("fact_market_hourly"), "date_id")
    present = tables.days_held(silver_rows, "rate_date", start, end)
    if not anew:
        _clear(house, "fact_market_hourly", "date_id", start, end, present)

    if anew:
        daily = facts.with_processed_at(facts.daily_fact(house.read("fact_market_hourly")))
    else:
        daily = staged(_daily_days(house, start, end), "daily")
    daily_rows = write(daily, house.path("fact_market_daily"), "date_id")
    if not anew:
        _clear(house, "fact_market_daily", "date_id", start, end, present)
    _refresh_levels(house, start, end, present, None if anew else daily)
    for name, dim in zip(KEYED, (exchanges, symbols)):
        tables.write_table(dim, house.path(f"fact_keys_{name}"))
    return {"fact_market_hourly": hourly_rows, "fact_market_daily": daily_rows}


def refresh_checks(house: Warehouse, start: dt.date, end: dt.date) -> None:
    """Store the gaps of all series, and the checks of the days under their last day; then stop on a failed gate."""
    days = house.read("series_days")
    tables.write_table(quality.gap_intervals(days, dims.profile_of_days(days)), house.path("series_gaps"))
    lines = check_lines(house.read, start, end)
    tables.write_partitions(
        lines.withColumns({"first_day": F.lit(start), "last_day": F.lit(end)}), house.path("checks"), "last_day"
    )
    quality.enforce(_days(house.read("checks"), "last_day", end, end))


def refresh_warehouse(
    spark: SparkSession, raw: DataFrame, root: str, start: dt.date | None = None, end: dt.date | None = None,
    symbols: dict[str, list[str]] | None = None, ingested_at: Column | str | None = None,
    landed_until: dt.date | None = None, calendar: tuple[dt.date, dt.date] | None = None,
) -> dict[str, int]:
    """Load the days and bring every table up to date; returns rows written per table.

    Without days it loads yesterday (UTC), without an end one day; with `landed_until`, only from
    what had landed by the end of that day. The calendars cover the days of the data, or
    of `calendar`. Safe to repeat: each stage replaces whole days or whole tables. Ends
    with the checks of what is stored.
    """
    start = start or previous_day()
    end = end or start
    house = Warehouse(pin_utc(spark), root)
    written = load_bronze(raw, house, start, end, symbols, ingested_at, landed_until)
    written |= refresh_silver(house, start, end)
    refresh_dims(house, start, end, calendar)
    written |= refresh_facts(house, start, end)
    refresh_checks(house, start, end)
    return written
