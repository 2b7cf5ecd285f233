from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.helpers import bronze, bronze_row, rows
from wickwork import session
from wickwork.operators.latest import dedupe_latest
from wickwork.sources import tables

KEYS = ["symbol", "open_time_ms"]


def day(spark, n, **kw):
    return bronze(spark, [bronze_row(f"2024-01-0{n} 0{h}:00:00", **kw) for h in range(3)]).drop("exchange")


def test_writing_a_day_twice_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    both = day(spark, 1).unionByName(day(spark, 2))
    assert tables.write_partitions(both, path) == 6
    before = rows(spark.read.parquet(path))
    assert tables.write_partitions(day(spark, 2), path) == 3
    assert rows(spark.read.parquet(path)) == before


def test_only_written_days_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_partitions(day(spark, 1).unionByName(day(spark, 2)), path)
    tables.write_partitions(day(spark, 2, v="7"), path)
    assert rows(spark.read.parquet(path).groupBy("rate_date", "volume").count()) == [
        (dt.date(2024, 1, 1), "5", 3), (dt.date(2024, 1, 2), "7", 3)]


def test_merge_keeps_the_rest_of_the_day(spark, tmp_path):
    path = str(tmp_path / "t")
    other = day(spark, 1, symbol="ETHUSDT")
    tables.write_partitions(day(spark, 1).unionByName(other).unionByName(day(spark, 2)), path)
    late = day(spark, 1, v="9", loaded="2024-02-02 00:00:00")
    tables.merge_days(late, path, KEYS)
    got = spark.read.parquet(path).groupBy("rate_date", "symbol", "volume").count()
    assert rows(got) == [
        (dt.date(2024, 1, 1), "BTCUSDT", "9", 3), (dt.date(2024, 1, 1), "ETHUSDT", "5", 3),
        (dt.date(2024, 1, 2), "BTCUSDT", "5", 3)]


def test_earlier_load_does_not_win(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.merge_days(day(spark, 1), path, KEYS)
    tables.merge_days(day(spark, 1, v="1", loaded="2024-01-15 00:00:00"), path, KEYS)
    assert rows(spark.read.parquet(path), "volume") == [("5",)] * 3


def test_whole_table_is_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(day(spark, 1), path)
    assert tables.write_table(day(spark, 2), path) == 3
    assert rows(spark.read.parquet(path), "rate_date") == [(dt.date(2024, 1, 2),)] * 3
    tables.write_table(day(spark, 1), path, "rate_date")
    assert rows(tables.partition_inventory(spark.read.parquet(path))) == [(dt.date(2024, 1, 1),)]


def test_missing_table_is_a_warning(spark, tmp_path, caplog):
    assert tables.read_table(spark, str(tmp_path / "none")) is None
    assert "does not exist" in caplog.text


def test_missing_days(spark):
    present = day(spark, 1).unionByName(day(spark, 4))
    got = tables.missing_days(present, dt.date(2023, 12, 31), dt.date(2024, 1, 5))
    assert [r[0].isoformat() for r in got.collect()] == ["2023-12-31", "2024-01-02", "2024-01-03", "2024-01-05"]


def test_latest_version_is_repeatable(spark):
    same_time = day(spark, 1).unionByName(day(spark, 1, v="6"))
    first, second = rows(dedupe_latest(same_time, KEYS)), rows(dedupe_latest(same_time.repartition(3), KEYS))
    assert first == second and len(first) == 3


def test_a_key_with_very_many_copies(spark):
    copies = day(spark, 1).crossJoin(spark.range(20_000)).drop("id")
    assert dedupe_latest(copies, KEYS).count() == 3


def test_a_day_with_most_rows_is_split_over_several_files(spark, tmp_path):
    ids = spark.range(300_000, numPartitions=8)
    hot = F.when(F.col("id") % 3 > 0, F.lit("2024-01-01")).otherwise(F.lit("2024-01-02")).cast("date")
    frame = ids.select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"), hot.alias("rate_date"))
    limit = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "2m")
    try:
        assert tables.write_partitions(frame, str(tmp_path / "t")) == 300_000
    finally:
        spark.conf.set(limit, before)
    assert len(list((tmp_path / "t" / "rate_date=2024-01-01").glob("*.parquet"))) > 2


def test_empty_write_counts_no_rows(spark, tmp_path):
    nothing = day(spark, 1).where("trade_count < 0")
    assert tables.write_table(nothing, str(tmp_path / "a")) == 0
    assert tables.write_partitions(nothing, str(tmp_path / "b")) == 0


def test_preview(spark):
    assert tables.preview(spark.range(500)).count() == 100


def test_staged_result_is_a_scan_with_known_size(spark):
    kept = session.staged(day(spark, 1), "kept")
    assert kept.inputFiles() and rows(kept) == rows(day(spark, 1))
    assert "wickwork" in kept.inputFiles()[0] and session.shared_dir(spark) in kept.inputFiles()[0]


def test_a_cluster_must_name_its_shared_folder():
    class Cluster:
        class conf:
            @staticmethod
            def get(_key, default):
                return default

        class sparkContext:
            master = "spark://somewhere:7077"

            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Cluster)
