"""Queries of the driver contract, each over the whole `events` table.

The given tables hold no candles, so every query starts from `candles_from_events`.
A query stages silver once where it needs it more than once. It also stages the
dimensions it joins: a scan has a known size, so Spark broadcasts a dimension only
after checking it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wickwork import constants as C
from wickwork.operators import dims, facts, metrics, quality, silver, summaries
from wickwork.operators.latest import dedupe_latest
from wickwork.operators.numbering import rank_descending
from wickwork.plans import views
from wickwork.plans.refresh import KEYED, Warehouse, load_bronze, refresh_warehouse
from wickwork.session import new_folder, pin_utc, staged
from wickwork.sources import candles as feed
from wickwork.sources import buckets, tables
from wickwork.sources.events import candles_from_events, landing_time, payloads_from_candles

# Where a range of days begins after the data's first day, and how long it is or how far it ends before the last.
SLICE_FROM, SLICE_DAYS = dt.timedelta(days=9), dt.timedelta(days=2)
PERIOD_MARGIN = dt.timedelta(days=5)


def plain(df: DataFrame) -> DataFrame:
    """Values that compare across engines: times without zone, decimals as numbers."""

    def edge(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.DecimalType):
            wide = field.dataType.scale > 8
            column = (F.round(column, 6) if wide else column).cast("double")
        return column.alias(field.name)

    return df.select(*[edge(f) for f in df.schema.fields])


@dataclass
class Case:
    """Tables of one query run, built when first used."""

    spark: SparkSession
    sf_dir: str

    @cached_property
    def candles(self) -> DataFrame:
        return candles_from_events(self.spark.read.parquet(f"{self.sf_dir}/events.parquet"))

    @cached_property
    def raw(self) -> DataFrame:
        return payloads_from_candles(self.candles)

    @cached_property
    def bronze(self) -> DataFrame:
        """Bronze rows of both exchanges, tagged."""
        stamped = feed.stamp(self.candles, landing_time(F.col("open_time_ms")))
        return feed.align(stamped, ["exchange", *C.BRONZE_COLUMNS])

    @cached_property
    def bronze_tables(self) -> dict[str, DataFrame]:
        """Bronze as it is stored: one table per exchange. Events are read once."""
        path = new_folder(self.spark, "bronze")
        self.bronze.write.partitionBy("exchange").parquet(path)
        return {e: self.spark.read.parquet(f"{path}/exchange={e}") for e in feed.LAYOUTS}

    @cached_property
    def silver_rows(self) -> DataFrame:
        """Silver for a query that reads it once."""
        return silver.usable(self.bronze)

    @cached_property
    def silver(self) -> DataFrame:
        return staged(self.silver_rows, "silver")

    @cached_property
    def profile(self) -> DataFrame:
        return staged(dims.series_profile(self.silver), "profile")

    @cached_property
    def exchanges(self) -> DataFrame:
        return staged(dims.exchange_dim(self.profile), "exchanges")

    @cached_property
    def symbols(self) -> DataFrame:
        return staged(dims.symbol_dim(self.profile), "symbols")

    @cached_property
    def dates(self) -> DataFrame:
        return staged(dims.date_dim(self.profile), "dates")

    @cached_property
    def datetimes(self) -> DataFrame:
        return staged(dims.datetime_dim(self.profile), "datetimes")

    @cached_property
    def hourly(self) -> DataFrame:
        return facts.hourly_fact(self.silver, self.exchanges, self.symbols, self.datetimes)

    @cached_property
    def daily(self) -> DataFrame:
        return facts.daily_fact(self.hourly)

    def range_of_days(self) -> tuple[dt.date, dt.date]:
        day = F.to_date("ts")
        events = self.spark.read.parquet(f"{self.sf_dir}/events.parquet")
        return tuple(events.agg(F.min(day), F.max(day)).first())

    def few_days(self) -> tuple[dt.date, dt.date]:
        start = self.range_of_days()[0] + SLICE_FROM
        return start, start + SLICE_DAYS

    def period(self) -> tuple[dt.date, dt.date]:
        """All days but the first and last few."""
        first, last = self.range_of_days()
        return first + PERIOD_MARGIN, last - PERIOD_MARGIN


REGISTRY: dict[str, Callable[[Case], DataFrame]] = {}


def query(build: Callable[[Case], DataFrame]) -> Callable[[Case], DataFrame]:
    REGISTRY[build.__name__] = build
    return build


# Bronze -------------------------------------------------------------------

@query
def bronze_parse_binance(case: Case) -> DataFrame:
    return feed.to_bronze(case.raw, feed.BINANCE, "landed_at")


@query
def bronze_parse_poloniex(case: Case) -> DataFrame:
    return feed.to_bronze(case.raw, feed.POLONIEX, "landed_at")


@query
def bronze_wide_poloniex(case: Case) -> DataFrame:
    return feed.parse_candles(case.raw, feed.POLONIEX, wide=True)


@query
def bronze_day_slice(case: Case) -> DataFrame:
    return feed.load_days(case.raw, feed.BINANCE, *case.few_days(), ingested_at="landed_at")


@query
def bronze_symbol_subset(case: Case) -> DataFrame:
    return feed.load_days(
        case.raw, feed.POLONIEX, *case.few_days(), symbols=["BTC_USDT", "ETH_USDT"], ingested_at="landed_at"
    )


@query
def bronze_profile_by_symbol(case: Case) -> DataFrame:
    return quality.rows_by(case.bronze, "symbol")


@query
def bronze_range_profile(case: Case) -> DataFrame:
    return quality.range_profile(case.bronze)


@query
def bronze_required_fields(case: Case) -> DataFrame:
    """Bronze in which each required field is missing in one hour of every day."""
    hour = F.hour(F.timestamp_millis("open_time_ms"))
    holes = case.bronze.withColumns({f: F.when(hour != at, F.col(f)) for at, f in enumerate(quality.REQUIRED)})
    return quality.quality_report(holes, quality.bronze_rules())


@query
def bronze_rejected(case: Case) -> DataFrame:
    """Payloads with a fault on four days of the month: what is set aside, and what is kept."""
    day, payload = F.dayofmonth("landed_at"), F.col("payload")
    timeless = F.regexp_replace(payload, r"\b\d{13}\b", "null")
    raw = case.raw.withColumn("payload", F.when(day == 4, None).when(day == 5, "[]").when(
        day == 6, "{oops").when(day == 7, timeless).otherwise(payload))
    return feed.sort_out(raw).groupBy("exchange", F.col("fate").alias("reason")).agg(F.count(F.lit(1)).alias("items"))


@query
def bronze_partition_inventory(case: Case) -> DataFrame:
    return tables.partition_inventory(case.bronze)


@query
def bronze_missing_days(case: Case) -> DataFrame:
    """History load into a range two days wider than the data at either end."""
    first, last = case.range_of_days()
    margin = dt.timedelta(days=2)
    return tables.missing_days(case.bronze, first - margin, last + margin)


@query
def empty_load_stops(case: Case) -> DataFrame:
    """Loads of a day before the data, of its first and last day, and of a day after it: which stop for want of rows."""
    house = Warehouse(case.spark, new_folder(case.spark, "warehouse"))
    raw = staged(case.raw, "raw")
    first, last = case.range_of_days()
    margin = dt.timedelta(days=2)
    outcomes = []
    for day in (first - margin, first, last, last + margin):
        try:
            written = load_bronze(raw, house, day, day, ingested_at="landed_at", landed_until=day + dt.timedelta(days=1))
            outcomes.append((day, False, sum(written.values())))
        except feed.EmptyLoad:
            outcomes.append((day, True, 0))
    return case.spark.createDataFrame(outcomes, "day date, stopped boolean, rows long")


@query
def load_of_yesterday(case: Case) -> DataFrame:
    """The data moved so that its last day is yesterday, loaded without naming a day."""
    last = case.range_of_days()[1]
    # Taken once: the day may change while the query runs.
    yesterday = feed.previous_day()
    moved = (yesterday - last).days * 86_400_000
    shifted = case.candles.withColumns({c: F.col(c) + moved for c in ("open_time_ms", "close_time_ms")})
    loaded = feed.load_days(payloads_from_candles(shifted), feed.BINANCE, ingested_at="landed_at")
    back = (F.col("open_time_ms") - moved).alias("open_time_ms")
    return loaded.select("symbol", back, "open", "close", "volume", "trade_count")


@query
def missing_table_warns(case: Case) -> DataFrame:
    """A table before its first write, and after it: whether it is found, and its rows."""
    path = new_folder(case.spark, "days")
    before = tables.read_table(case.spark, path)
    tables.write_partitions(case.bronze, path)
    after = tables.read_table(case.spark, path)
    found = after.agg(F.lit("after").alias("state"), F.lit(True).alias("found"), F.count(F.lit(1)).alias("rows"))
    return found.union(case.spark.createDataFrame([("before", before is not None, 0)], found.schema))


@query
def partition_overwrite_idempotent(case: Case) -> DataFrame:
    """The same days written twice, then read back."""
    path = new_folder(case.spark, "twice")
    once = staged(case.bronze, "bronze")
    tables.write_partitions(once, path)
    tables.write_partitions(once, path)
    return case.spark.read.parquet(path).groupBy("rate_date").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("trade_count").alias("trades")
    )


@query
def backfill_equals_daily_loads(case: Case) -> DataFrame:
    """A history load in two ranges, a rerun of one day, and a late partial day.

    The stored table must hold what one load of everything would have given.
    """
    first, last = case.range_of_days()
    middle = first + (last - first) // 2
    raw = staged(case.raw, "raw")
    path = new_folder(case.spark, "history")

    def load(start: dt.date, end: dt.date, symbols: list[str] | None = None) -> DataFrame:
        # All candles of a day have landed by the day after.
        return feed.load_days(raw, feed.BINANCE, start, end, symbols, "landed_at", end + dt.timedelta(days=1))

    tables.write_partitions(load(first, middle), path)
    tables.write_partitions(load(middle + dt.timedelta(days=1), last), path)
    tables.write_partitions(load(middle, middle), path)
    tables.merge_days(load(last, last, ["BTCUSDT"]), path, ["symbol", "open_time_ms"])
    return feed.align(case.spark.read.parquet(path), C.BRONZE_COLUMNS)


@query
def bucketed_merge(case: Case) -> DataFrame:
    """Bronze in buckets by key; of the last day BTCUSDT lands again with one trade more, and all pairs from an older load."""
    _, last = case.range_of_days()
    keys = ["symbol", "open_time_ms"]
    path = new_folder(case.spark, "bucketed")
    table = "bronze_" + path.rsplit("-", 1)[1]
    once = case.bronze_tables[C.BINANCE]
    day = once.where(F.col("rate_date") == F.lit(last))
    newer = day.where("symbol = 'BTCUSDT'").withColumns({
        "trade_count": F.col("trade_count") + 1, "ingested_at": F.col("ingested_at") + F.expr("interval 1 day")})
    older = day.withColumns({"trade_count": F.lit(0).cast("long"), "ingested_at": F.col("ingested_at") - F.expr("interval 1 day")})
    buckets.create_bucketed(once, table, path, keys, 8)
    buckets.merge_bucketed(newer.unionByName(older), table, keys)
    case.spark.sql(f"DROP TABLE {table}")  # the entry; the files stay
    return case.spark.read.parquet(path).select("rate_date", *keys, "open", "close", "volume", "trade_count")


# Silver -------------------------------------------------------------------

@query
def silver_hourly(case: Case) -> DataFrame:
    usable, _ = silver.to_silver(case.bronze_tables)
    return usable


@query
def silver_dedupe_latest(case: Case) -> DataFrame:
    """Binance loaded again a day later with one trade more; the later load wins."""
    once = staged(case.bronze, "bronze")
    again = once.where(F.col("exchange") == C.BINANCE).withColumns({
        "trade_count": F.col("trade_count") + 1,
        "ingested_at": F.col("ingested_at") + F.expr("interval 1 day"),
    })
    return dedupe_latest(silver.usable(once.unionByName(again)), silver.SILVER_KEY)


def _faulty(bronze: DataFrame) -> DataFrame:
    """Bronze with a known fault in some hours of every day."""
    hour = F.hour(F.timestamp_millis("open_time_ms"))
    swapped = hour == 3
    return bronze.withColumns({
        "high": F.when(swapped, F.col("low")).when(hour == 5, "12345678901.5").otherwise(F.col("high")),
        "low": F.when(swapped, F.col("high")).otherwise(F.col("low")),
        "close_time_ms": F.when(hour == 4, F.col("open_time_ms") - 1).otherwise(F.col("close_time_ms")),
        "volume": F.when(hour == 6, F.lit(None)).otherwise(F.col("volume")),
        "symbol": F.when(hour == 7, F.replace("symbol", F.lit("USDT"), F.lit("EUR"))).otherwise(F.col("symbol")),
        "open": F.when(hour == 13, "n/a").otherwise(F.col("open")),
    })


@query
def silver_quality(case: Case) -> DataFrame:
    """All load checks over faulty bronze."""
    return quality.quality_report(silver.judged(_faulty(case.bronze)), quality.load_rules())


@query
def silver_rejected(case: Case) -> DataFrame:
    aside = silver.rejected(_faulty(case.bronze))
    return aside.select(
        "exchange", "symbol", "open", "high", "open_time_ms",
        F.concat_ws(",", "problems").alias("problems"),
    )


@query
def silver_profile(case: Case) -> DataFrame:
    return quality.rows_by(case.silver_rows, "symbol", "exchange")


# Dimensions ---------------------------------------------------------------

@query
def dim_date(case: Case) -> DataFrame:
    return dims.date_dim(dims.series_profile(case.silver_rows)).drop("created_at")


@query
def dim_datetime(case: Case) -> DataFrame:
    return dims.datetime_dim(dims.series_profile(case.silver_rows)).drop("created_at")


@query
def dim_calendar_fixed_range(case: Case) -> DataFrame:
    """Days and hours of a calendar of given bounds, a month wider than the data at either end."""
    first, last = case.range_of_days()
    bounds = first - dt.timedelta(days=31), last + dt.timedelta(days=31)
    days, hours = dims.date_dim(case.profile, *bounds), dims.datetime_dim(case.profile, *bounds)
    counted = hours.groupBy("date_id").agg(F.count(F.lit(1)).alias("hours"))
    return days.join(counted, "date_id").select("date_id", "year_month", "is_weekend", "hours")


@query
def dim_exchange(case: Case) -> DataFrame:
    return dims.exchange_dim(staged(dims.series_profile(case.silver_rows), "profile"))


@query
def dim_symbol(case: Case) -> DataFrame:
    return dims.symbol_dim(staged(dims.series_profile(case.silver_rows), "profile"))


@query
def dim_symbol_preview(case: Case) -> DataFrame:
    return tables.preview(dim_symbol(case))


@query
def dim_exchange_list(case: Case) -> DataFrame:
    listed = quality.name_list(dim_exchange(case), "exchange_name")
    return listed.withColumn("names", F.concat_ws(",", "names"))


@query
def dim_completeness(case: Case) -> DataFrame:
    return quality.dim_completeness(case.dates, case.datetimes, case.silver)


@query
def calendar_flags(case: Case) -> DataFrame:
    flagged = dims.with_month_flags(dims.date_dim(dims.series_profile(case.silver_rows)))
    return flagged.select("date_id", "is_month_start", "is_month_end", "month_name", "week_of_year")


@query
def business_hours(case: Case) -> DataFrame:
    flagged = dims.with_business_hour(dims.datetime_dim(dims.series_profile(case.silver_rows)))
    return flagged.select("datetime_id", "hour", "is_business_hour")


@query
def dim_attributes(case: Case) -> DataFrame:
    """Planned attributes of symbols and exchanges, for each series."""
    pairs = case.profile.select("exchange", "symbol", "row_count")
    symbols, exchanges = dims.with_asset(case.symbols), dims.with_active(case.exchanges)
    return (
        pairs.join(symbols, pairs["symbol"] == symbols["symbol_name"])
        .join(exchanges, pairs["exchange"] == exchanges["exchange_name"])
        .select("exchange_name", "is_active", "symbol_name", "asset_name", "category", "row_count")
    )


# Facts --------------------------------------------------------------------

@query
def fact_market_hourly(case: Case) -> DataFrame:
    return case.hourly


@query
def fact_hourly_quality(case: Case) -> DataFrame:
    """The hourly fact with a fault of each kind in some hours of every day."""
    hour = F.hour("datetime_id")
    faulty = case.hourly.withColumns({
        "open_price": F.when(hour != 0, F.col("open_price")),
        "high_price": F.when(hour == 6, F.col("low_price") - 1).when(hour != 1, F.col("high_price")),
        "low_price": F.when(hour == 7, F.col("high_price") + 1).when(hour != 2, F.col("low_price")),
        "close_price": F.when(hour != 3, F.col("close_price")),
        "volume": F.when(hour == 5, 0).when(hour != 4, F.col("volume")),
    })
    return quality.quality_profile(faulty, quality.hourly_rules())


@query
def fact_hourly_summary(case: Case) -> DataFrame:
    return quality.hourly_summary(case.hourly)


@query
def fact_market_daily(case: Case) -> DataFrame:
    return case.daily


@query
def fact_daily_summary(case: Case) -> DataFrame:
    return quality.daily_summary(case.daily)


@query
def hourly_summary_of_cells(case: Case) -> DataFrame:
    """The summary of the hourly fact from bitmaps and sums per day, not from the fact."""
    return summaries.hourly_summary_of(staged(summaries.hourly_cells(case.hourly), "cells"))


@query
def daily_summary_of_cells(case: Case) -> DataFrame:
    return summaries.daily_summary_of(staged(summaries.daily_cells(case.daily), "cells"))


@query
def range_profile_of_days(case: Case) -> DataFrame:
    return summaries.range_profile_of(staged(dims.series_days(case.silver_rows), "days"))


@query
def daily_prev_gap(case: Case) -> DataFrame:
    """The daily fact without every fifth day."""
    gaps = facts.with_prev_gap(case.daily.where(F.dayofmonth("date_id") % 5 != 0))
    return gaps.select("exchange_id", "symbol_id", "date_id", "prev_date_gap_days")


@query
def hourly_prev_change(case: Case) -> DataFrame:
    """The hourly fact without every seventh hour of the day."""
    kept = case.hourly.where(F.hour("datetime_id") % 7 != 0)
    return facts.with_previous_hour(kept).select(
        "exchange_id", "symbol_id", "datetime_id", "prev_close_price", "variation_prev_hour_pct", "prev_gap_hours"
    )


@query
def warehouse_refresh(case: Case) -> DataFrame:
    """The whole refresh into new tables, and again for the last day; then the daily fact."""
    root = new_folder(case.spark, "warehouse")
    raw = staged(case.raw, "raw")
    first, last = case.range_of_days()
    refresh_warehouse(case.spark, raw, root, first, last, ingested_at="landed_at")
    refresh_warehouse(case.spark, raw, root, last, last, ingested_at="landed_at", landed_until=last + dt.timedelta(days=1))
    return Warehouse(case.spark, root).read("fact_market_daily").drop("processed_at")


@query
def refresh_subset(case: Case) -> DataFrame:
    """A full refresh, then the last day again for one pair: no other pair is lost."""
    root = new_folder(case.spark, "warehouse")
    raw = staged(case.raw, "raw")
    first, last = case.range_of_days()
    refresh_warehouse(case.spark, raw, root, first, last, ingested_at="landed_at")
    some = {C.BINANCE: ["BTCUSDT"], C.POLONIEX: ["BTC_USDT"]}
    refresh_warehouse(case.spark, raw, root, last, last, some, "landed_at")
    return Warehouse(case.spark, root).read("fact_market_daily").drop("processed_at")


@query
def refresh_with_corrections(case: Case) -> DataFrame:
    """Every payload landed an hour earlier with highs and lows exchanged; the later one counts."""
    root = new_folder(case.spark, "warehouse")
    candles = staged(case.candles, "candles")
    swapped = candles.withColumns({"high": F.col("low"), "low": F.col("high")})
    early = payloads_from_candles(swapped).withColumn("landed_at", F.col("landed_at") - F.expr("interval 1 hour"))
    raw = staged(early.unionByName(payloads_from_candles(candles)), "raw")
    refresh_warehouse(case.spark, raw, root, *case.range_of_days())
    return Warehouse(case.spark, root).read("fact_market_daily").drop("processed_at")


@query
def refresh_after_break(case: Case) -> DataFrame:
    """A refresh whose write of the daily fact broke off, made good by one of the last day."""
    house = Warehouse(case.spark, new_folder(case.spark, "warehouse"))
    raw = staged(case.raw, "raw")
    first, last = case.range_of_days()
    refresh_warehouse(case.spark, raw, house.root, first, last, ingested_at="landed_at")
    for table in (*[f"fact_keys_{d}" for d in KEYED], "fact_market_daily"):
        tables.write_table(house.read(table).limit(0), house.path(table))
    refresh_warehouse(case.spark, raw, house.root, last, last, ingested_at="landed_at")
    return house.read("fact_market_daily").drop("processed_at")


@query
def refresh_new_pairs(case: Case) -> DataFrame:
    """A refresh of some pairs, then one of all: first names keep their keys, others follow."""
    house = Warehouse(case.spark, new_folder(case.spark, "warehouse"))
    raw = staged(case.raw, "raw")
    first, last = case.range_of_days()
    some = {C.BINANCE: ["ETHUSDT", "SOLUSDT"], C.POLONIEX: ["ETH_USDT"]}
    refresh_warehouse(case.spark, raw, house.root, first, first, some, "landed_at")
    refresh_warehouse(case.spark, raw, house.root, first, last, ingested_at="landed_at")
    return house.read("fact_market_daily").drop("processed_at")


@query
def refresh_levels(case: Case) -> DataFrame:
    """A full refresh, then some days in the middle again: what the small levels above the facts say,
    and how many rows of the facts were computed since the first refresh began."""
    house = Warehouse(case.spark, new_folder(case.spark, "warehouse"))
    raw = staged(case.raw, "raw")
    began = dt.datetime.now(dt.UTC)
    refresh_warehouse(case.spark, raw, house.root, *case.range_of_days(), ingested_at="landed_at")
    refresh_warehouse(case.spark, raw, house.root, *case.few_days(), ingested_at="landed_at")

    def line(level: str, summary: DataFrame, fact: str) -> DataFrame:
        recent = house.read(fact).agg(F.count_if(F.col("processed_at") >= F.lit(began))).scalar()
        return summary.select(
            F.lit(level).alias("level"), "total_records", "distinct_exchanges", "distinct_symbols", recent.alias("processed_rows")
        )

    months = house.read("fact_market_monthly")
    monthly = months.agg(
        F.sum("trade_count").alias("total_records"), F.count_distinct("exchange_id").alias("distinct_exchanges"),
        F.count_distinct("symbol_id").alias("distinct_symbols"),
    )
    return (
        line("hourly", summaries.hourly_summary_of(house.read("hourly_cells")), "fact_market_hourly")
        .unionByName(line("daily", summaries.daily_summary_of(house.read("daily_cells")), "fact_market_daily"))
        .unionByName(monthly.select(F.lit("monthly trades").alias("level"), "*", F.lit(None).cast("bigint").alias("processed_rows")))
    )


@query
def refresh_checks(case: Case) -> DataFrame:
    """The checks of a refresh: a day of one exchange, an hour of one pair and some fields are missing."""
    house = Warehouse(case.spark, new_folder(case.spark, "warehouse"))
    opened = F.timestamp_millis("open_time_ms")
    day, hour = F.dayofmonth(opened), F.hour(opened)
    holes = case.candles.where(
        ~((F.col("exchange") == C.BINANCE) & (day == 11)) & ~((F.col("symbol") == "BTC_USDT") & (hour == 3))
    ).withColumns({"open": F.when(hour != 9, F.col("open")), "volume": F.when(hour != 6, F.col("volume"))})
    raw = staged(payloads_from_candles(holes), "raw")
    refresh_warehouse(case.spark, raw, house.root, *case.range_of_days(), ingested_at="landed_at")
    return house.read("checks")


# Relations between tables -------------------------------------------------

def _thinned(silver: DataFrame) -> DataFrame:
    """Silver without every fifth day of one pair and without the first days of another."""
    day = F.dayofmonth("rate_date")
    gap = (F.col("symbol") == "BTC_USDT") & (day % 5 == 0)
    unlisted = (F.col("symbol") == "ETH_USDT") & (day < 4)
    return silver.where(~gap & ~unlisted)


@query
def fk_orphans(case: Case) -> DataFrame:
    """Silver against dimensions that each lack some of their members."""
    return quality.orphan_report(
        case.silver,
        case.exchanges.where(F.col("exchange_name") != C.POLONIEX),
        case.symbols.where(F.col("symbol_name") != "LINK_USDT"),
        case.datetimes.where(F.col("hour") != 3),
    )


@query
def key_duplicates(case: Case) -> DataFrame:
    """Binance loaded twice into one silver frame, and the facts built from clean silver."""
    twice = case.silver.unionByName(case.silver.where(F.col("exchange") == C.BINANCE))
    return (
        quality.duplicate_report(twice, silver.SILVER_KEY, "silver_twice")
        .unionByName(quality.duplicate_report(case.hourly, facts.HOURLY_KEY, "fact_market_hourly"))
        .unionByName(quality.duplicate_report(case.daily, facts.DAILY_KEY, "fact_market_daily"))
    )


@query
def date_gaps(case: Case) -> DataFrame:
    return quality.gap_report(_thinned(case.silver), case.profile)


@query
def gap_intervals(case: Case) -> DataFrame:
    """Runs of missing days of every series, as intervals."""
    return quality.gap_intervals(dims.series_days(_thinned(case.silver)), case.profile)


@query
def hour_completeness(case: Case) -> DataFrame:
    thinned = _thinned(case.silver)
    return quality.hour_completeness(thinned, staged(dims.series_profile(thinned), "profile"))


@query
def hour_completeness_summary(case: Case) -> DataFrame:
    return quality.hour_summary(hour_completeness(case))


@query
def daily_equals_hourly(case: Case) -> DataFrame:
    """The hourly fact against a daily one with a changed volume on one day of the month and without another."""
    day, volume = F.dayofmonth("date_id"), F.col("volume")
    altered = case.daily.where(day != 11).withColumn("volume", F.when(day == 10, volume + 1).otherwise(volume))
    return quality.reconcile_report(case.hourly, altered)


@query
def altered_days(case: Case) -> DataFrame:
    """Stored facts of which one day was altered in one series and another lost a key: the keys that do
    not match, found by checksums of months, then of days, then in those days alone."""
    root = new_folder(case.spark, "facts")
    tables.write_table(case.hourly.withColumn("date_id", F.to_date("datetime_id")), f"{root}/hourly", "date_id")
    first = case.range_of_days()[0]
    changed, lost = F.lit(first + dt.timedelta(days=4)), F.lit(first + dt.timedelta(days=12))
    hourly, series = case.spark.read.parquet(f"{root}/hourly"), (F.col("symbol_id") == 1) & (F.col("exchange_id") == 1)
    altered = facts.daily_fact(hourly).where(~(series & (F.col("date_id") == lost))).withColumn(
        "trade_count", F.col("trade_count") + F.when(series & (F.col("date_id") == changed), 1).otherwise(0))
    tables.write_table(altered, f"{root}/daily", "date_id")
    daily = case.spark.read.parquet(f"{root}/daily")
    sums = [staged(s, "sums") for s in (quality.hourly_checksums(hourly), quality.day_checksums(daily))]
    return quality.reconcile_differing(hourly, daily, *sums)


# Metrics ------------------------------------------------------------------

def _named(case: Case, rows: DataFrame) -> DataFrame:
    return metrics.named(rows, case.exchanges, case.symbols).drop("exchange_id", "symbol_id")


@query
def current_price(case: Case) -> DataFrame:
    return _named(case, metrics.current_price(case.daily))


@query
def accumulated_return(case: Case) -> DataFrame:
    return _named(case, metrics.accumulated_return(metrics.in_period(case.daily, *case.period())))


@query
def index_base_100(case: Case) -> DataFrame:
    return _named(case, metrics.index_base_100(metrics.in_period(case.daily, *case.period())))


@query
def volume_traded(case: Case) -> DataFrame:
    return _named(case, metrics.volume_traded(metrics.in_period(case.daily, *case.period())))


def _odd_periods(case: Case) -> dict[str, tuple[dt.date, dt.date]]:
    """Periods that end within months, take in a whole one, and start with one."""
    first, last = case.range_of_days()
    day = dt.timedelta(days=1)
    return {"within": case.period(), "around": (first - 20 * day, last + 45 * day), "from first": (first, last + 2 * day),
            "one day": (first + 7 * day, first + 7 * day)}


def _over_periods(case: Case, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    daily = staged(case.daily, "daily")
    months = staged(summaries.month_candles(daily), "months")
    return feed.union_days([
        _named(case, build(summaries.period_pieces(daily, months, *days))).withColumn("period", F.lit(label))
        for label, days in _odd_periods(case).items()
    ])


@query
def return_over_periods(case: Case) -> DataFrame:
    """Accumulated returns over odd periods, from whole months and the days at both ends."""
    return _over_periods(case, summaries.return_of)


@query
def volume_over_periods(case: Case) -> DataFrame:
    return _over_periods(case, summaries.volume_of)


@query
def index_of_last_days(case: Case) -> DataFrame:
    """The base-100 index of the last days of a period, with the base from months and days of the whole one."""
    start, end = _odd_periods(case)["around"]
    daily = staged(case.daily, "daily")
    pieces = summaries.period_pieces(daily, staged(summaries.month_candles(daily), "months"), start, end)
    last = case.range_of_days()[1]
    return _named(case, summaries.index_base_100_of(daily, pieces, last - dt.timedelta(days=4), end))


@query
def rank_by_return(case: Case) -> DataFrame:
    return _named(case, metrics.rank_by_return(metrics.in_period(case.daily, *case.period()))).select(
        "return_rank", "exchange_name", "symbol_name", "return_pct"
    )


@query
def rank_by_active_days(case: Case) -> DataFrame:
    """Series ranked by the days they have data on, with very many ties, and those of one pair without a number."""
    days = dims.series_days(case.silver_rows).groupBy("exchange", "symbol").agg(F.count(F.lit(1)).alias("days"))
    ranked = days.withColumn("days", F.when(F.col("symbol") != "LINK_USDT", F.col("days")))
    return rank_descending(ranked, "days", "days_rank")


@query
def rank_by_trades(case: Case) -> DataFrame:
    """Every series and day ranked by its trades: long runs of equal values, and days without a number."""
    trades = F.when(F.dayofmonth("date_id") % 10 != 0, F.col("trade_count"))
    return rank_descending(case.daily.select("exchange_id", "symbol_id", "date_id", trades.alias("trades")), "trades", "trades_rank")


@query
def data_available_until(case: Case) -> DataFrame:
    return metrics.available_until(case.daily)


@query
def cross_exchange_price(case: Case) -> DataFrame:
    return metrics.cross_exchange_price(
        case.daily, case.dates, case.exchanges, case.symbols, "BTC_USDT", *case.period()
    )


@query
def top_volatile_days(case: Case) -> DataFrame:
    return metrics.top_volatile(case.daily, case.dates, case.exchanges, case.symbols, 5, *case.period())


@query
def top_volatile_by_peaks(case: Case) -> DataFrame:
    """The most volatile days from the stored days whose largest volatility is highest."""
    path = new_folder(case.spark, "daily")
    tables.write_table(case.daily, path, "date_id")
    daily = case.spark.read.schema(case.daily.schema).parquet(path)
    peaks = staged(metrics.day_peaks(daily), "peaks")
    return metrics.top_volatile_by_peaks(daily, peaks, case.dates, case.exchanges, case.symbols, 5, *case.period())


# Metrics as SQL -------------------------------------------------------------

def _sql_metric(name: str) -> Callable[[Case], DataFrame]:
    def build(case: Case) -> DataFrame:
        named_tables = {"fact_market_daily": staged(case.daily, "daily"), "dim_exchange": case.exchanges,
                        "dim_symbol": case.symbols, "dim_date": case.dates}
        for table, df in named_tables.items():
            df.createOrReplaceTempView(table)
        start, end = case.period()
        return views.metric(case.spark, name, start=start, end=end, symbol="BTC_USDT", n=5)

    build.__name__ = f"sql_{name}"
    return build


for _name in views.METRICS:
    query(_sql_metric(_name))


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build one query; its result is not computed yet."""
    return plain(REGISTRY[name](Case(pin_utc(spark), sf_dir)))
