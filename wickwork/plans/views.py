"""The stored tables by name, and the business metrics as SQL over these names.

`register_views` gives a session a temporary view of every stored table; `publish` puts them
into the catalog as tables over the files that are there, so other sessions find them by
name. The statements below then run as they are, with their values as named parameters.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

from wickwork import schemas
from wickwork.plans.refresh import Warehouse
from wickwork.sources.candles import LAYOUTS

#: Tables that a refresh stores, besides those with a fixed schema.
TABLES = [
    *[f"bronze_{exchange}" for exchange in LAYOUTS], *schemas.STORED, "dim_date", "dim_datetime", "silver_rejected",
    "fact_market_monthly", "hourly_cells", "daily_cells", "daily_peaks",
]

_NAMED = """fact_market_daily f
  JOIN dim_exchange e ON f.exchange_id = e.exchange_id
  JOIN dim_symbol s ON f.symbol_id = s.symbol_id"""
_IN_PERIOD = "f.date_id BETWEEN :start AND :end"

METRICS: dict[str, str] = {
    "current_price": f"""
SELECT exchange_name, symbol_name, max_by(close_price, date_id) AS current_price, max(date_id) AS price_date
FROM {_NAMED} GROUP BY exchange_name, symbol_name""",
    "accumulated_return": f"""
SELECT exchange_name, symbol_name, first_price, last_price, (last_price - first_price) / nullif(first_price, 0) * 100 AS return_pct
FROM (SELECT exchange_name, symbol_name, min_by(close_price, date_id) AS first_price, max_by(close_price, date_id) AS last_price
      FROM {_NAMED} WHERE {_IN_PERIOD} GROUP BY exchange_name, symbol_name)""",
    "index_base_100": f"""
WITH base AS (SELECT f.exchange_id, f.symbol_id, min_by(close_price, date_id) AS base_price
              FROM fact_market_daily f WHERE {_IN_PERIOD} GROUP BY f.exchange_id, f.symbol_id)
SELECT exchange_name, symbol_name, date_id, close_price, base_price, close_price / nullif(base_price, 0) * 100 AS index_100
FROM {_NAMED} JOIN base b ON f.exchange_id = b.exchange_id AND f.symbol_id = b.symbol_id WHERE {_IN_PERIOD}""",
    "volume_traded": f"""
SELECT exchange_name, symbol_name, sum(volume) AS volume, sum(trade_count) AS trade_count
FROM {_NAMED} WHERE {_IN_PERIOD} GROUP BY exchange_name, symbol_name""",
    # Ranked over one row per series; for very many series there is metrics.rank_by_return.
    "rank_by_return": f"""
WITH ends AS (SELECT exchange_name, symbol_name, min_by(close_price, date_id) AS first_price, max_by(close_price, date_id) AS last_price
              FROM {_NAMED} WHERE {_IN_PERIOD} GROUP BY exchange_name, symbol_name),
returns AS (SELECT *, (last_price - first_price) / nullif(first_price, 0) * 100 AS return_pct FROM ends)
SELECT rank() OVER (ORDER BY return_pct DESC NULLS LAST) AS return_rank, exchange_name, symbol_name, return_pct FROM returns""",
    "daily_variation": f"""
SELECT exchange_name, symbol_name, date_id, variation_daily_pct, variation_prev_day_pct
FROM {_NAMED} WHERE {_IN_PERIOD}""",
    "data_available_until": "SELECT max(date_id) AS available_until FROM fact_market_daily",
    "cross_exchange_price": f"""
SELECT d.date, symbol_name, exchange_name, close_price, volume
FROM {_NAMED} JOIN dim_date d ON f.date_id = d.date_id
WHERE symbol_name = :symbol AND {_IN_PERIOD} ORDER BY d.date, exchange_name""",
    "top_volatile_days": f"""
SELECT d.date, symbol_name, exchange_name, (high_price - low_price) / nullif(open_price, 0) * 100 AS volatility_pct, volume
FROM {_NAMED} JOIN dim_date d ON f.date_id = d.date_id WHERE {_IN_PERIOD}
ORDER BY volatility_pct DESC NULLS LAST, d.date, symbol_name, exchange_name LIMIT :n""",
}


def register_views(house: Warehouse, prefix: str = "") -> list[str]:
    """Temporary views of the stored tables, as far as they have been written; returns their names."""
    found = {f"{prefix}{table}": house.find(table) for table in TABLES}
    for name, table in found.items():
        if table is not None:
            table.createOrReplaceTempView(name)
    return [name for name, table in found.items() if table is not None]


def publish(house: Warehouse, database: str) -> list[str]:
    """Catalog tables over the stored files, made or made again; returns their names.

    Files stay where they are: a refresh replaces days below the same paths. After one that
    added days, publish again, so that the catalog learns of the new partitions.
    """
    spark = house.spark
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    for table in TABLES:
        found = house.find(table)
        if found is None or not found.inputFiles():  # nothing to take columns from, as of rejects without any
            continue
        name = f"{database}.{table}"
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # of a table over given files only the entry goes
        spark.catalog.createTable(name, path=house.path(table), source="parquet")
        if any(c.isPartition for c in spark.catalog.listColumns(name)):
            spark.catalog.recoverPartitions(name)
        names.append(name)
    return names


def metric(spark: SparkSession, name: str, **values: Any) -> DataFrame:
    """One of `METRICS` over the session's names; `values`: start, end, symbol, n, as it needs them."""
    wanted = {k: v for k, v in values.items() if f":{k}" in METRICS[name]}
    return spark.sql(METRICS[name], args=wanted)
