"""Streams give what a batch over the same rows gives, also when restarted."""

import json

import pytest
from pyspark.sql import functions as F

from millrace.plans.bars import ohlcv
from millrace.streaming.bars import read_bars, run_ohlcv
from millrace.streaming.streams import (
    append_files,
    append_partitioned,
    cdc_flatten,
    cdc_latest,
    file_source,
    flush_buffered,
    kafka_options,
    parse_envelope,
    read_buffered,
    route_images,
    trigger_args,
)

from .conftest import rows

ROW = "struct<id:int,order_id:int,status:string,ts:bigint>"


def change(op, ts_ms, before=None, after=None, pos=0):
    return json.dumps({"before": before, "after": after, "source": {"pos": str(pos)}, "op": op, "ts_ms": ts_ms})


def image(i, status, ts=1_704_067_200_123_456):
    return {"id": i, "order_id": i * 10, "status": status, "ts": ts}


CHANGES = [
    change("c", 1, after=image(1, "new")),
    change("u", 3, before=image(1, "new"), after=image(1, "done"), pos=1),
    change("u", 2, before=image(1, "new"), after=image(1, "late"), pos=2),
    change("c", 1, after=image(2, "new")),
    change("d", 5, before=image(2, "new")),
    change("c", 4, after=image(3, "a"), pos=1),
    change("u", 4, before=image(3, "a"), after=image(3, "b"), pos=2),
    "{broken",
    "",
]


def lines(spark, texts=CHANGES):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_flatten(spark):
    got = cdc_flatten(lines(spark), ROW)
    assert got.columns == ["id", "order_id", "status", "ts", "event_date"]
    assert sorted(r.status for r in got.collect()) == ["a", "b", "done", "late", "new", "new"]
    first = got.first()
    assert (first.ts.microsecond, str(first.event_date)) == (123456, "2024-01-01")


def test_latest_state(spark):
    log = parse_envelope(lines(spark), ROW).withColumn("pos", F.col("source")["pos"].cast("int"))
    expected = [(1, "done"), (3, "b")]
    assert rows(cdc_latest(log, "id", "pos").select("id", "status")) == expected
    shuffled = log.orderBy(F.rand(3))
    assert rows(cdc_latest(shuffled, "id", "pos").select("id", "status")) == expected


def test_sink_resumes_without_doubling(spark, folder):
    def run():
        stream = file_source(spark, f"{folder}/in", "value string", kind="text", per_trigger=1)
        append_partitioned(cdc_flatten(stream, ROW), f"{folder}/out", f"{folder}/cp", "event_date").awaitTermination()
        return spark.read.parquet(f"{folder}/out").count()

    lines(spark, CHANGES[:4]).repartition(2).write.text(f"{folder}/in")
    assert run() == 4
    assert run() == 4
    lines(spark, CHANGES[4:]).coalesce(1).write.mode("append").text(f"{folder}/in")
    assert run() == 6
    batch = cdc_flatten(lines(spark), ROW)
    assert rows(spark.read.parquet(f"{folder}/out").select(*batch.columns)) == rows(batch)


def test_routing(spark):
    got = [json.loads(r.value) for r in route_images(lines(spark, CHANGES[:5])).collect()]
    assert "before" not in got[0] and json.loads(got[0]["after"])["status"] == "new"
    assert "after" not in got[4] and json.loads(got[4]["before"])["id"] == 2


def test_bars_stream_equals_batch(spark, folder, events):
    trades = events.select(
        F.col("event_id").alias("trade_id"), F.col("event_type").alias("symbol"), F.col("value").alias("price"),
        F.lit(1.0).alias("quantity"), F.lit(2.0).alias("amount_usdt"), "ts",
    )
    files = [trades.where(c) for c in ("ts < '2024-01-10 00:00:00'", "ts >= '2024-01-10 00:00:00'")]
    for part in files:
        part.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = file_source(spark, f"{folder}/in", trades.schema)
        run_ohlcv(stream, f"{folder}/out", f"{folder}/cp", width="6 hours")
    batch = ohlcv(trades, "6 hours")
    assert rows(read_bars(spark, f"{folder}/out").select(*batch.columns)) == rows(batch)


def test_buffer(spark, folder):
    spark.range(0, 60, 1, 6).write.parquet(f"{folder}/in")
    stream = file_source(spark, f"{folder}/in", "id long", per_trigger=3)
    flush_buffered(stream, f"{folder}/out", f"{folder}/cp").awaitTermination()
    got = read_buffered(spark, f"{folder}/out")
    assert got.count() == 60 and got.select("batch").distinct().count() == 2
    assert got.select("_metadata.file_path").distinct().count() == 2


def test_raw_landing_keeps_text(spark, folder):
    lines(spark).write.text(f"{folder}/in")
    append_files(file_source(spark, f"{folder}/in", "value string", kind="text"), f"{folder}/raw", f"{folder}/cp").awaitTermination()
    assert sorted(r.value for r in spark.read.parquet(f"{folder}/raw").collect()) == sorted(CHANGES)


def test_options():
    got = kafka_options("h:1", "t", per_trigger=5)
    assert got["subscribe"] == "t" and got["maxOffsetsPerTrigger"] == "5" and got["failOnDataLoss"] == "false"
    assert "maxOffsetsPerTrigger" not in kafka_options("h:1", "t", per_trigger=None)
    with pytest.raises(ValueError):
        kafka_options("h:1", "t", start="middle")
    assert trigger_args("drain") == {"availableNow": True}
    assert trigger_args("1 minute") == {"processingTime": "1 minute"}
