"""Landed candle payloads to bronze rows.

A payload is a JSON array of candle arrays for one symbol. `sort_out` parses each landed
payload once, for all exchanges, and tells the fate of what it holds: candles that are
kept, and the reason for everything else. A load stores that once, in a folder per
fate and exchange, and makes both bronze and the rejects from it, so a load of years is
the same few jobs as a load of one day.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickwork import constants as C
from wickwork.functions.candle import date_from_millis
from wickwork.session import staged_by

_LONG_FIELDS = ("open_time_ms", "close_time_ms", "trade_count")
_CANDLES_TYPE = "array<array<string>>"
#: Fates of what has landed.
KEPT, MISSING, UNREADABLE, EMPTY, TIMELESS = "kept", "missing_payload", "unreadable_payload", "empty_payload", "unreadable_open_time"


@dataclass(frozen=True)
class Layout:
    """Where an exchange puts each field in its candle array."""

    exchange: str
    positions: dict[str, int]
    interval: str
    symbols: list[str]
    extra_positions: dict[str, int] = field(default_factory=dict)


BINANCE = Layout(C.BINANCE, C.BINANCE_POSITIONS, C.BINANCE_INTERVAL, C.BINANCE_SYMBOLS)
POLONIEX = Layout(
    C.POLONIEX, C.POLONIEX_POSITIONS, C.POLONIEX_INTERVAL, C.POLONIEX_SYMBOLS,
    C.POLONIEX_WIDE_POSITIONS,
)
LAYOUTS = {layout.exchange: layout for layout in (BINANCE, POLONIEX)}


class EmptyLoad(RuntimeError):
    """A load returned no rows."""


def _positions(layout: Layout, wide: bool) -> dict[str, int]:
    return layout.positions | (layout.extra_positions if wide else {})


def _field(name: str, layouts: list[Layout], wide: bool) -> Column:
    """A candle's field by the layout of its exchange; NULL where the exchange has none."""
    value = F.lit(None).cast("string")
    for layout in layouts:
        at = _positions(layout, wide).get(name)
        own = F.get("candle", F.lit(at)) if at is not None else F.lit(layout.interval if name == "interval" else None)
        value = F.when(F.col("exchange") == layout.exchange, own).otherwise(value)
    return value.try_cast("bigint") if name in _LONG_FIELDS else value


def sort_out(raw: DataFrame, layouts: list[Layout] | None = None, wide: bool = False) -> DataFrame:
    """One row per landed candle of the layouts' exchanges, prices kept as text, and one per
    payload without any: exchange, symbol, landed_at, fate and the candle's fields.

    The fate is `kept`, or why a row cannot be loaded whatever the days: the payload is missing,
    unreadable (no JSON array) or empty, or a candle's opening time cannot be read, so that
    it belongs to no day; a candle that is no array has none. Any other field that is missing
    or not a number becomes NULL and is caught by the required-field check.
    Each payload is parsed once, into a VARIANT. Nothing is shuffled.
    """
    layouts = list(LAYOUTS.values()) if layouts is None else layouts
    parsed = raw.where(F.col("exchange").isin([layout.exchange for layout in layouts])).select(
        "exchange", "symbol", "landed_at", F.col("payload").isNull().alias("missing"),
        F.try_variant_get(F.try_parse_json("payload"), "$", _CANDLES_TYPE).alias("candles"),
    )
    candles = parsed.select(
        "exchange", "symbol", "landed_at", "missing",
        F.size("candles").alias("size"), F.explode_outer("candles").alias("candle"),
    )
    names = list(dict.fromkeys(name for layout in layouts for name in [*_positions(layout, wide), "interval"]))
    fields = candles.select(
        "exchange", "symbol", "landed_at", "missing", "size", *[_field(name, layouts, wide).alias(name) for name in names]
    )
    fate = (
        F.when(F.col("missing"), MISSING)
        .when(F.coalesce(F.col("size"), F.lit(-1)) < 0, UNREADABLE)
        .when(F.col("size") == 0, EMPTY)
        .when(F.col("open_time_ms").isNull(), TIMELESS)
        .otherwise(KEPT)
    )
    return fields.select("exchange", "symbol", "landed_at", fate.alias("fate"), *names)


def stored_fates(sorted_rows: DataFrame) -> DataFrame:
    """`sort_out` rows written once, in a folder per fate and exchange: a reader of the rejects,
    or of one exchange, opens no other files."""
    return staged_by(sorted_rows, "landed", ["fate", "exchange"])


def kept_candles(fates: DataFrame, layout: Layout) -> DataFrame:
    """The loadable candles of one exchange."""
    return fates.where((F.col("fate") == KEPT) & (F.col("exchange") == layout.exchange)).drop("fate", "exchange")


def rejects(fates: DataFrame) -> DataFrame:
    """What a load leaves out: exchange, symbol, landed_at, reason."""
    return fates.where(F.col("fate") != KEPT).select("exchange", "symbol", "landed_at", F.col("fate").alias("reason"))


def parse_candles(raw: DataFrame, layout: Layout, wide: bool = False) -> DataFrame:
    """One row per loadable candle of the layout's exchange, prices kept as text."""
    candles = kept_candles(sort_out(raw, [layout], wide), layout)
    if wide:
        candles = candles.withColumns({
            "open_time": F.timestamp_millis("open_time_ms"), "close_time": F.timestamp_millis("close_time_ms"),
        })
    return candles.select(*[c for c in candles.columns if c != "landed_at"], "landed_at")


def set_aside(raw: DataFrame, layout: Layout) -> DataFrame:
    """What a load of one exchange leaves out."""
    return rejects(sort_out(raw, [layout]))


def stamp(candles: DataFrame, ingested_at: Column | str | None = None) -> DataFrame:
    """Add the version time and the UTC day that partitions the table.

    Unless given, the version is the landing time, so that a correction that lands later
    wins; rows without one get the current time.
    """
    if ingested_at is None:
        now = F.current_timestamp()
        loaded = F.coalesce("landed_at", now) if "landed_at" in candles.columns else now
    else:
        loaded = F.col(ingested_at) if isinstance(ingested_at, str) else ingested_at
    return candles.withColumns(
        {"ingested_at": loaded, "rate_date": date_from_millis(F.col("open_time_ms"))}
    )


def align(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exactly the target columns, in the target order."""
    return df.select(*columns)


def to_bronze(raw: DataFrame, layout: Layout, ingested_at: Column | str | None = None) -> DataFrame:
    """Parse, stamp and align one exchange's payloads."""
    return align(stamp(parse_candles(raw, layout), ingested_at), C.BRONZE_COLUMNS)


def previous_day() -> dt.date:
    """Default target of the daily load: yesterday in UTC."""
    return dt.datetime.now(dt.UTC).date() - dt.timedelta(days=1)


def _millis(day: dt.date) -> int:
    return int(dt.datetime.combine(day, dt.time(), dt.UTC).timestamp()) * 1000


def day_slice(
    df: DataFrame,
    start: dt.date | None = None,
    end: dt.date | None = None,
    symbols: list[str] | None = None,
) -> DataFrame:
    """Candles that open from `start` through `end` (default: yesterday only).

    The bounds are literals, so they reach the Parquet scan; on a stored table
    the partition column is bounded too and whole days are skipped.
    """
    start = start or previous_day()
    end = end or start
    opened = F.col("open_time_ms")
    df = df.where((opened >= _millis(start)) & (opened < _millis(end + dt.timedelta(days=1))))
    if "rate_date" in df.columns:
        df = df.where(F.col("rate_date").between(F.lit(start), F.lit(end)))
    return df.where(F.col("symbol").isin(symbols)) if symbols else df


def union_days(frames: list[DataFrame]) -> DataFrame:
    """All rows of frames with the same columns, matched by name.

    A history load does not need it: one scan over the range yields all days.
    """
    return reduce(DataFrame.unionByName, frames)


def landed_between(raw: DataFrame, start: dt.date, until: dt.date | None = None) -> DataFrame:
    """Payloads that can hold candles of the days from `start` on, by landing time.

    A payload cannot hold a candle that opens after it landed, so older payloads are skipped in
    the scan, before any JSON is parsed. With `until`, so are those that landed after that
    day: a rerun of an old day need not parse everything landed since. Rows without a
    landing time may hold anything.
    """
    def midnight(day: dt.date) -> Column:
        return F.lit(dt.datetime.combine(day, dt.time(), dt.UTC))

    landed = F.col("landed_at")
    inside = landed >= midnight(start)
    if until is not None:
        inside &= landed < midnight(until + dt.timedelta(days=1))
    return raw.where(landed.isNull() | inside)


def load_days(
    raw: DataFrame,
    layout: Layout,
    start: dt.date | None = None,
    end: dt.date | None = None,
    symbols: list[str] | None = None,
    ingested_at: Column | str | None = None,
    landed_until: dt.date | None = None,
) -> DataFrame:
    """Bronze rows of a day or a range of one exchange: daily load, rerun and history are one call.

    All landed symbols are loaded unless a list is given. `landed_until` is the last
    landing day to look at; without it all that has landed since counts.
    """
    start = start or previous_day()
    bronze = to_bronze(landed_between(raw, start, landed_until), layout, ingested_at)
    return day_slice(bronze, start, end, symbols)


def bronze_days(
    fates: DataFrame, layout: Layout, start: dt.date, end: dt.date,
    symbols: list[str] | None = None, ingested_at: Column | str | None = None,
) -> DataFrame:
    """`load_days` from stored `sort_out` rows."""
    return day_slice(align(stamp(kept_candles(fates, layout), ingested_at), C.BRONZE_COLUMNS), start, end, symbols)
