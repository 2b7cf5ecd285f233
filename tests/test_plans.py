"""What the physical plans must and must not contain."""

from __future__ import annotations

import pytest

from tests.helpers import executed
from wickwork.operators import facts, numbering
from wickwork.plans import contract
from wickwork.plans.contract import Case
from wickwork.session import staged

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def case(spark):
    return Case(spark, SF_DIR)


def test_candles_hash_and_prune(case):
    plan = executed(case.candles)
    assert "SortAggregate" not in plan
    assert plan.count("Exchange") == 1
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in plan
    assert "PushedFilters: [IsNotNull(event_type)]" in plan


def test_symbols_are_tested_per_candle_and_not_per_event(case):
    above, below = executed(case.silver_rows).split("HashAggregate", 1)
    assert "RLIKE" in above and "RLIKE" not in below


def test_payload_parsing_does_not_shuffle(case):
    from wickwork.sources import candles

    raw = staged(case.raw, "raw")
    assert "Exchange" not in executed(candles.to_bronze(raw, candles.BINANCE))


def test_facts_need_no_shuffle_for_small_dimensions(case):
    plan = executed(case.hourly)
    joins = [line for line in plan.splitlines() if "Join [" in line and "_bucket" not in line]
    assert len(joins) == 3 and all("BroadcastHashJoin" in line for line in joins)
    assert "Exchange hashpartitioning(symbol" not in plan
    assert "Exchange hashpartitioning(open_time" not in plan


def test_daily_fact_shuffles_once_per_grain(case):
    plan = executed(facts.daily_fact(staged(case.hourly, "hourly")))
    assert plan.count("Exchange hashpartitioning") == 2  # candles by day, then days by series
    assert plan.count("Window [") == 1


def test_dedupe_limits_groups_before_the_shuffle(case):
    plan = executed(contract.silver_dedupe_latest(case))
    before, after = plan.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after


@pytest.mark.parametrize("order", ["numbers", "ranks", "lags"])
def test_ordering_computes_its_input_once(spark, order):
    """The sample for the ranges is drawn from what is written, not from the input."""
    rows = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            rows.add(len(batch))
            yield batch

    frame = spark.range(5000).selectExpr("id", "id % 7 AS k", "cast(id % 900 AS string) AS name").mapInPandas(seen, "id long, k long, name string")
    if order == "numbers":
        out = numbering.number_names(frame, "name", "n")
    elif order == "ranks":
        out = numbering.rank_descending(frame, "k", "n")
    else:
        out = numbering.previous_in_order(frame, {"n": "id"}, ["k"], "id")
    assert out.count() == 5000 and rows.value == 5000


def test_wide_dimension_is_not_broadcast(spark, case):
    """Beyond the size limit a join sorts and merges, where AQE splits hot keys."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        plan = executed(Case(spark, SF_DIR).hourly)
        assert plan.count("SortMergeJoin") == 2
        assert "BroadcastHashJoin [exchange#" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
