"""Compare Spark queries with their SQL oracles."""

from __future__ import annotations

from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        if Path(f"{sf_dir}/{table}.parquet").exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    """Columns and rows in an order that does not depend on either engine."""
    order = sorted(range(len(columns)), key=columns.__getitem__)
    picked = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(picked, key=repr)


def spark_result(df) -> tuple[list[str], list[tuple]]:
    return _canonical(df.columns, [tuple(row) for row in df.collect()])


def oracle_result(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    done = con.execute(sql)
    return _canonical([c[0] for c in done.description], done.fetchall())


_KINDS = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
          "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def type_mismatches(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    described = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return [
        f"{name}: {kind} vs {described.get(name)}"
        for name, kind in df.dtypes if _KINDS.get(kind) != described.get(name)
    ]
