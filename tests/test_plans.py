"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from millrace.catalog import QUERIES
from millrace.operators.asof import asof_join
from millrace.operators.intervals import interval_join
from millrace.operators.joins import broadcast_if_measured, broadcast_if_small

from .conftest import SF


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "InPandas"):
        assert node not in text, node


def test_filters_and_columns_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        text = plan(QUERIES["filter_between"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThanOrEqual(o_totalprice" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in text


def test_bucketed_join_does_not_shuffle_its_sides(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["join_colocated"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text
    assert text.count("Exchange hashpartitioning") == 1  # the final aggregate only


def test_asof_spreads_a_key_over_its_slots(spark, events):
    left = events.select("user_id", "ts", "event_id")
    text = plan(asof_join(left, left.withColumnRenamed("event_id", "other"), ["user_id"], "ts", "ts", slot="hour"))
    assert "Join" not in text
    assert any("user_id" in line and "__slot" in line for line in text.splitlines() if "Exchange hashpartitioning" in line)


def test_asof_in_even_ranges_never_groups_by_the_key(spark, events):
    left = events.select("user_id", "ts", "event_id")
    text = plan(asof_join(left, left.withColumnRenamed("event_id", "other"), ["user_id"], "ts", "ts"))
    assert "BroadcastHashJoin [__part" in text and text.count("Join ") == 1
    assert not any("user_id" in line for line in text.splitlines() if "Exchange hashpartitioning" in line)


def test_interval_join_broadcasts_only_measured_intervals(spark, events):
    points = events.select("event_id", "ts")
    spans = events.select("user_id", F.col("ts").alias("a"), (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("b"))
    assert "BroadcastHashJoin" in plan(interval_join(points, spans, "ts", "a", "b"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(interval_join(points, spans, "ts", "a", "b", broadcast_bytes=10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_broadcast_limits(spark, events):
    small, large = broadcast_if_small(events, 1 << 30), broadcast_if_small(events, 10)
    assert "ResolvedHint" in small._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in large._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in broadcast_if_measured(events, 10)._jdf.queryExecution().analyzed().toString()


def test_latest_row_is_combined_before_the_shuffle(spark):
    text = plan(QUERIES["read_replacing"](spark, SF))
    assert "partial_max_by" in text and "Window" not in text
