"""Small frames for tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

HOUR_MS = 3_600_000
BRONZE = ("exchange string, symbol string, interval string, open string, high string, low string, "
          "close string, volume string, trade_count long, open_time_ms long, close_time_ms long, "
          "ingested_at timestamp, rate_date date")
HOURLY = ("symbol_id int, exchange_id int, datetime_id timestamp, open_price decimal(18,8), "
          "high_price decimal(18,8), low_price decimal(18,8), close_price decimal(18,8), "
          "volume decimal(18,8), trade_count long, close_time timestamp, ingested_at timestamp")


def utc(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.UTC)


def millis(text: str) -> int:
    return int(utc(text).timestamp() * 1000)


def bronze_row(at: str, symbol="BTCUSDT", exchange="binance", o="10", h="12", low="9", c="11", v="5",
               trades=3, close_ms=None, loaded="2024-02-01 00:00:00"):
    opened = millis(at)
    closed = opened + HOUR_MS - 1 if close_ms is None else close_ms
    return (exchange, symbol, "1h", o, h, low, c, v, trades, opened, closed, utc(loaded), utc(at).date())


def bronze(spark, rows):
    return spark.createDataFrame(rows, BRONZE)


def hourly(spark, rows):
    """Rows of (symbol_id, exchange_id, time, open, high, low, close, volume, trades)."""
    made = spark.createDataFrame(
        [(s, x, utc(t), *map(str, prices), n) for s, x, t, *prices, n in rows],
        "symbol_id int, exchange_id int, datetime_id timestamp, o string, h string, l string, "
        "c string, v string, trade_count long",
    )
    names = dict(o="open_price", h="high_price", l="low_price", c="close_price", v="volume")
    return made.select(
        "symbol_id", "exchange_id", "datetime_id",
        *[F.col(k).cast("decimal(18,8)").alias(n) for k, n in names.items()], "trade_count",
        (F.col("datetime_id") + F.expr("interval 3599 seconds")).alias("close_time"),
        F.col("datetime_id").alias("ingested_at"),
    )


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def executed(df) -> str:
    """The physical plan as Spark prints it."""
    return df._jdf.queryExecution().executedPlan().toString()
