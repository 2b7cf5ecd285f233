"""Schemas of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

from wickwork import constants as C

_TEXT, _LONG, _INT = T.StringType(), T.LongType(), T.IntegerType()
_TIME, _DAY, _FLAG = T.TimestampType(), T.DateType(), T.BooleanType()
_PRICE, _VOLUME, _PCT = T.DecimalType(18, 8), T.DecimalType(28, 8), T.DecimalType(38, 15)


def _table(columns: list[str], types: dict[str, T.DataType], default: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(c, types.get(c, default)) for c in columns])


RAW = _table(["exchange", "symbol", "payload", "landed_at"], {"landed_at": _TIME}, _TEXT)

BRONZE = _table(
    C.BRONZE_COLUMNS,
    {"close_time_ms": _LONG, "open_time_ms": _LONG, "trade_count": _LONG,
     "ingested_at": _TIME, "rate_date": _DAY},
    _TEXT,
)

REJECTED = _table(
    ["exchange", "symbol", "landed_at", "reason", "landed_on"], {"landed_at": _TIME, "landed_on": _DAY}, _TEXT
)

SILVER = _table(
    C.SILVER_COLUMNS,
    {"exchange": _TEXT, "symbol": _TEXT, "interval": _TEXT, "trade_count": _LONG,
     "close_time": _TIME, "open_time": _TIME, "rate_date": _DAY, "ingested_at": _TIME},
    _PRICE,
)

HOURLY = _table(
    C.HOURLY_COLUMNS,
    {"symbol_id": _INT, "exchange_id": _INT, "datetime_id": _TIME, "trade_count": _LONG,
     "variation_1h_pct": _PCT, "close_time": _TIME, "ingested_at": _TIME},
    _PRICE,
)

DAILY = _table(
    C.DAILY_COLUMNS,
    {"symbol_id": _INT, "exchange_id": _INT, "date_id": _DAY, "volume": _VOLUME,
     "trade_count": _LONG, "variation_daily_pct": _PCT, "variation_prev_day_pct": _PCT,
     "close_time": _TIME, "ingested_at": _TIME},
    _PRICE,
)

_PROCESSED = T.StructField("processed_at", _TIME)
HOURLY_STORED = T.StructType([*HOURLY.fields, _PROCESSED, T.StructField("date_id", _DAY)])
DAILY_STORED = T.StructType([*DAILY.fields, _PROCESSED])

GAPS = _table(
    ["exchange", "symbol", "first_missing", "last_missing", "missing_days"],
    {"first_missing": _DAY, "last_missing": _DAY, "missing_days": _INT}, _TEXT,
)

SERIES_DAYS = _table(
    ["exchange", "symbol", "row_count", "min_open_time", "max_close_time", "rate_date"],
    {"row_count": _LONG, "min_open_time": _TIME, "max_close_time": _TIME, "rate_date": _DAY},
    _TEXT,
)

CHECKS = _table(
    ["rule", "subject", "severity", "total_rows", "violations", "first_day", "last_day"],
    {"total_rows": _LONG, "violations": _LONG, "first_day": _DAY, "last_day": _DAY}, _TEXT,
)

EXCHANGES = _table(["exchange_id", "exchange_name"], {"exchange_id": _INT}, _TEXT)
SYMBOLS = _table(["symbol_id", "symbol_name"], {"symbol_id": _INT}, _TEXT)

# Stored tables by name. A given schema saves reading one from the files.
STORED = {
    "bronze_rejected": REJECTED,
    "silver_hourly": SILVER,
    "series_days": SERIES_DAYS,
    "dim_exchange": EXCHANGES,
    "dim_symbol": SYMBOLS,
    "fact_market_hourly": HOURLY_STORED,
    "fact_market_daily": DAILY_STORED,
    "series_gaps": GAPS,
    "checks": CHECKS,
}
