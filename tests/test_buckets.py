from __future__ import annotations

import datetime as dt
import uuid

import pytest

from tests.helpers import bronze, bronze_row, executed, rows
from wickwork.operators.latest import dedupe_latest
from wickwork.sources import buckets, tables

KEYS = ["symbol", "open_time_ms"]


def day(spark, n, **kw):
    return bronze(spark, [bronze_row(f"2024-01-0{n} {h:02}:00:00", **kw) for h in range(20)]).drop("exchange")


@pytest.fixture
def table(spark, tmp_path):
    name = f"bronze_{uuid.uuid4().hex}"
    both = day(spark, 1).unionByName(day(spark, 1, symbol="ETHUSDT")).unionByName(day(spark, 2))
    buckets.create_bucketed(both, name, str(tmp_path / "bucketed"), KEYS, 4)
    tables.write_partitions(both, str(tmp_path / "plain"))
    yield name
    spark.sql(f"DROP TABLE {name}")


def test_merge_equals_the_plain_form(spark, table, tmp_path):
    late = day(spark, 1, v="9", loaded="2024-02-02 00:00:00").unionByName(day(spark, 3))
    late = late.unionByName(day(spark, 1, v="8", loaded="2024-02-01 12:00:00"))  # versions within a load
    late = late.unionByName(day(spark, 2, v="1", loaded="2024-01-15 00:00:00"))  # an earlier load does not win
    tables.merge_days(late, str(tmp_path / "plain"), KEYS)
    got = buckets.merge_bucketed(late, table, KEYS)
    columns = got.columns
    assert rows(got) == rows(spark.read.parquet(str(tmp_path / "plain")), *columns)
    assert rows(spark.read.parquet(str(tmp_path / "bucketed")), *columns) == rows(got)
    assert {r[0] for r in rows(got, "rate_date")} == {dt.date(2024, 1, d) for d in (1, 2, 3)}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_merge_and_dedupe_move_no_stored_row(spark, table, tmp_path):
    late = buckets.create_bucketed(day(spark, 1, v="9", loaded="2024-02-02 00:00:00"), f"{table}_late", str(tmp_path / "late"), KEYS, 4)
    plan = executed(buckets.merged(late, table, KEYS))
    assert "Window" in plan and "Exchange" not in plan, plan
    assert "Exchange" not in executed(dedupe_latest(spark.table(table), KEYS))
    spark.sql(f"DROP TABLE {table}_late")


def test_other_days_are_not_written(spark, table, tmp_path):
    second = tmp_path / "bucketed" / "rate_date=2024-01-02"
    before = sorted(p.name for p in second.iterdir())
    buckets.merge_bucketed(day(spark, 1, v="9", loaded="2024-02-02 00:00:00"), table, KEYS)
    assert sorted(p.name for p in second.iterdir()) == before
    first = [p for p in (tmp_path / "bucketed" / "rate_date=2024-01-01").iterdir() if p.suffix == ".parquet"]
    assert len(first) <= 4  # one file a bucket


def test_nothing_late(spark, table):
    before = rows(spark.table(table))
    assert rows(buckets.merge_bucketed(day(spark, 1).limit(0), table, KEYS)) == before


def test_rows_without_a_whole_key_are_kept(spark, table):
    nameless = bronze(spark, [bronze_row("2024-01-01 00:00:00", symbol=None)]).drop("exchange")
    buckets.merge_bucketed(nameless, table, KEYS)
    got = buckets.merge_bucketed(nameless, table, KEYS)
    assert got.where("symbol IS NULL").count() == 2 and got.count() == 62
