"""Streaming loads, drained over files that Spark derives from the events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.times import floor_div, to_micros
from ..operators.aggregates import exact_sum
from ..session import scratch_path
from ..streaming.bars import late_trades, read_bars, repair_bars, run_ohlcv
from ..streaming.layers import applied, folders, read_layers, run_layers
from ..streaming.state import read_state, run_state
from ..streaming.streams import (
    append_files,
    append_partitioned,
    cdc_flatten,
    cdc_latest,
    compact_log,
    file_source,
    flush_buffered,
    json_trades,
    parse_envelope,
    read_buffered,
    route_images,
)
from .base import money, query

ROW = "struct<id:int,order_id:int,status:string,ts:bigint>"

# The same change events in SQL, three to a key: every 10th change is a deletion, three more of ten are updates.
CHANGES_SQL = (
    "SELECT event_id, CAST(event_id // 3 AS INTEGER) AS id, CAST(user_id AS INTEGER) AS order_id, event_type AS status, ts, "
    "CASE WHEN event_id % 10 = 7 THEN 'd' WHEN event_id % 10 IN (1, 2, 3) THEN 'u' ELSE 'c' END AS op FROM events"
)


def change_texts(events):
    """Change envelopes as JSON text, with some lines that are no JSON."""
    us = to_micros(F.col("ts"))
    digit = F.col("event_id") % 10
    op = F.when(digit == 7, "d").when(digit.isin(1, 2, 3), "u").otherwise("c")
    row = F.struct(
        floor_div(F.col("event_id"), 3).cast("int").alias("id"),
        F.col("user_id").cast("int").alias("order_id"),
        F.col("event_type").alias("status"),
        us.alias("ts"),
    )
    envelope = F.struct(
        F.when(op != "c", row).alias("before"),
        F.when(op != "d", row).alias("after"),
        F.create_map(F.lit("pos"), F.col("event_id").cast("string")).alias("source"),
        op.alias("op"),
        floor_div(us, 1000).alias("ts_ms"),
    )
    lines = events.select(F.to_json(envelope).alias("value"))
    return lines.unionAll(events.where(F.col("event_id") % 97 == 0).select(F.lit("{broken").alias("value")))


def _changes(load, spark):
    """A text stream of the change envelopes and a folder for its results."""
    base = scratch_path(spark, "changes")
    change_texts(load("events")).write.text(f"{base}/in")
    return file_source(spark, f"{base}/in", "value string", kind="text", per_trigger=4), base


@query("stream_source", "SELECT event_type, count(*) AS n, min(ts) AS oldest, max(ts) AS newest FROM events GROUP BY event_type")
def stream_source(load, spark):
    events = load("events")
    base = scratch_path(spark, "source")
    events.repartition(6).write.parquet(f"{base}/in")
    append_files(file_source(spark, f"{base}/in", events.schema, per_trigger=2), f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/out").groupBy("event_type").agg(
        F.count("*").alias("n"), F.min("ts").alias("oldest"), F.max("ts").alias("newest")
    )


@query(
    "stream_cdc_flatten",
    f"SELECT id, order_id, status, ts, CAST(ts AS DATE) AS event_date FROM ({CHANGES_SQL}) WHERE op <> 'd'",
    dates="event_date",
)
def stream_cdc_flatten(load, spark):
    lines, base = _changes(load, spark)
    append_files(cdc_flatten(lines, ROW), f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/out")


@query(
    "stream_partitioned_sink",
    f"SELECT CAST(ts AS DATE) AS event_date, status, count(*) AS n FROM ({CHANGES_SQL}) WHERE op <> 'd' GROUP BY ALL",
    dates="event_date",
)
def stream_partitioned_sink(load, spark):
    lines, base = _changes(load, spark)
    append_partitioned(cdc_flatten(lines, ROW), f"{base}/out", f"{base}/checkpoint", "event_date").awaitTermination()
    return spark.read.parquet(f"{base}/out").groupBy("event_date", "status").agg(F.count("*").alias("n"))


@query(
    "stream_trigger_modes",
    "SELECT mode, event_type, count(*) AS n FROM events, (VALUES ('drain'), ('micro'), ('1 second')) t(mode) GROUP BY ALL",
)
def stream_trigger_modes(load, spark):
    events = load("events")
    base, out = scratch_path(spark, "triggers"), None
    events.repartition(2).write.parquet(f"{base}/in")
    for i, mode in enumerate(("drain", "micro", "1 second")):
        run = append_files(file_source(spark, f"{base}/in", events.schema), f"{base}/out{i}", f"{base}/checkpoint{i}", mode=mode)
        if mode == "drain":
            run.awaitTermination()
        else:
            run.processAllAvailable()
            run.stop()
        part = spark.read.parquet(f"{base}/out{i}").withColumn("mode", F.lit(mode))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("mode", "event_type").agg(F.count("*").alias("n"))


def trade_texts(events):
    """Trades as JSON text: symbol, price and volume from the events."""
    us = to_micros(F.col("ts"))
    trade = F.struct(
        F.col("event_id").alias("trade_id"),
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        (F.col("user_id") % 10).cast("double").alias("quantity"),
        (F.col("value") * (F.col("user_id") % 10)).alias("amount_usdt"),
        floor_div(us, 1000).alias("trade_time"),
        floor_div(us, 1000).alias("event_time"),
        (F.col("event_id") % 2 == 0).alias("is_buyer_maker"),
    )
    return events.select(F.to_json(trade).alias("value"))


@query(
    "stream_json_trades",
    "SELECT event_id AS trade_id, event_type AS symbol, value AS price, CAST(user_id % 10 AS DOUBLE) AS quantity, epoch_us(ts) // 1000 AS trade_time, event_id % 2 = 0 AS is_buyer_maker FROM events",
)
def stream_json_trades(load, spark):
    base = scratch_path(spark, "trades")
    trade_texts(load("events")).write.text(f"{base}/in")
    lines = file_source(spark, f"{base}/in", "value string", kind="text")
    append_files(json_trades(lines), f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/out").drop("amount_usdt", "event_time")


@query(
    "stream_raw_landing",
    f"SELECT op, after_status, count(*) AS n FROM (SELECT op, CASE WHEN op <> 'd' THEN status END AS after_status FROM ({CHANGES_SQL})) GROUP BY ALL",
)
def stream_raw_landing(load, spark):
    lines, base = _changes(load, spark)
    append_files(lines, f"{base}/raw", f"{base}/checkpoint").awaitTermination()
    raw = spark.read.parquet(f"{base}/raw")
    read = raw.select(F.get_json_object("value", "$.op").alias("op"), F.get_json_object("value", "$.after.status").alias("after_status"))
    return read.where("op IS NOT NULL").groupBy("op", "after_status").agg(F.count("*").alias("n"))


@query(
    "stream_route_republish",
    "SELECT op <> 'c' AS has_before, op <> 'd' AS has_after, count(*) AS n, "
    f"CAST(sum(CASE WHEN op <> 'd' THEN id ELSE 0 END) AS BIGINT) AS ids FROM ({CHANGES_SQL}) GROUP BY ALL",
)
def stream_route_republish(load, spark):
    lines, base = _changes(load, spark)
    append_files(route_images(lines), f"{base}/topic", f"{base}/checkpoint", kind="text").awaitTermination()
    sent = spark.read.text(f"{base}/topic")
    before, after = (F.get_json_object("value", f"$.{side}") for side in ("before", "after"))
    images = sent.select(before.alias("before"), after.alias("after")).where("before IS NOT NULL OR after IS NOT NULL")
    ids = F.coalesce(F.get_json_object("after", "$.id").cast("bigint"), F.lit(0))
    return images.groupBy(
        F.col("before").isNotNull().alias("has_before"),
        F.col("after").isNotNull().alias("has_after"),
    ).agg(F.count("*").alias("n"), F.sum(ids).alias("ids"))


@query(
    "cdc_latest_state",
    "SELECT id, order_id, status, ts FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY epoch_us(ts) // 1000 DESC, event_id DESC) AS rn "
    f"FROM ({CHANGES_SQL})) WHERE rn = 1 AND op <> 'd'",
)
def cdc_latest_state(load, spark):
    lines, base = _changes(load, spark)
    log = parse_envelope(lines, ROW).withColumn("pos", F.col("source")["pos"].try_cast("bigint"))
    append_files(log, f"{base}/log", f"{base}/checkpoint").awaitTermination()
    compact_log(spark.read.parquet(f"{base}/log"), f"{base}/compact", "id", "pos")
    now = cdc_latest(spark.read.parquet(f"{base}/compact"), "id", "pos")
    return now.withColumn("ts", F.timestamp_micros("ts").cast("timestamp_ntz"))


# Trades in four deliveries by day; every 50th comes one delivery later than its time.
DELIVERIES = "least(3, CAST(floor((day(ts) - 1) / 8) AS INT) + CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0 END)"


@query(
    "stream_ohlcv",
    f"WITH t AS (SELECT *, {DELIVERIES} AS q FROM events), m AS (SELECT q, max(ts) AS newest FROM t GROUP BY q), "
    "l AS (SELECT t.*, date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(newest) FROM m WHERE m.q < t.q) - INTERVAL 1 HOUR AS late FROM t) "
    "SELECT date_trunc('hour', ts) AS period_start, event_type AS symbol, arg_min(value, (ts, event_id)) AS open_price, max(value) AS high_price, min(value) AS low_price, "
    f"arg_max(value, (ts, event_id)) AS close_price, CAST(sum(user_id % 10) AS DOUBLE) AS total_volume, {money('value * (user_id % 10)')} AS total_amount_usdt, "
    "count(*) AS trades_count, count(*) FILTER (late) AS late_trades FROM l GROUP BY ALL",
)
def stream_ohlcv(load, spark):
    """Bars kept over four batches, the ledger of late trades, and the bars after its repair."""
    base = scratch_path(spark, "bars")
    price, quantity = F.col("value").cast("decimal(12,2)"), (F.col("user_id") % 10).cast("decimal(6,0)")
    trades = load("events").select(
        F.col("event_id").alias("trade_id"),
        F.col("event_type").alias("symbol"),
        price.alias("price"),
        quantity.alias("quantity"),
        (price * quantity).cast("decimal(18,2)").alias("amount_usdt"),
        "ts",
        F.expr(DELIVERIES).alias("delivery"),
    )
    for delivery in range(4):
        part = trades.where(F.col("delivery") == delivery).drop("delivery")
        part.repartition(4).write.parquet(f"{base}/in/delivery={delivery}")
    # One delivery a batch: files are taken in the order of their times.
    stream = file_source(spark, f"{base}/in/*", trades.drop("delivery").schema, per_trigger=4)
    run_ohlcv(stream, f"{base}/out", f"{base}/checkpoint", width="1 hour")
    behind = late_trades(spark, f"{base}/out").groupBy(F.window("ts", "1 hour")["start"].alias("period_start"), "symbol").agg(F.count("*").alias("late_trades"))
    repair_bars(spark, f"{base}/out", "1 hour")
    bars = read_bars(spark, f"{base}/out")
    money_columns = [c for c, kind in bars.dtypes if kind.startswith("decimal")]
    joined = bars.join(behind, ["period_start", "symbol"], "left").withColumn("late_trades", F.coalesce("late_trades", F.lit(0)))
    return joined.withColumns({c: F.col(c).cast("double") for c in money_columns})


@query(
    "stream_current_state",
    "SELECT id, order_id, status, ts FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY epoch_us(ts) // 1000 DESC, event_id DESC) AS rn "
    f"FROM ({CHANGES_SQL})) WHERE rn = 1 AND op <> 'd'",
)
def stream_current_state(load, spark):
    """The table of current rows that the stream itself keeps, over four batches or more."""
    base = scratch_path(spark, "state")
    change_texts(load("events")).repartition(16).write.text(f"{base}/in")
    lines = file_source(spark, f"{base}/in", "value string", kind="text", per_trigger=4)
    changes = parse_envelope(lines, ROW).withColumn("pos", F.col("source")["pos"].try_cast("bigint"))
    run_state(changes, f"{base}/out", f"{base}/checkpoint", "id", "pos", buckets=16)
    return read_state(spark, f"{base}/out").withColumn("ts", F.timestamp_micros("ts").cast("timestamp_ntz"))


@query(
    "stream_layered_buffer",
    f"SELECT event_type, count(*) AS n, {money('value')} AS total, CAST(12 AS BIGINT) AS batches, true AS few_folders FROM events GROUP BY event_type",
)
def stream_layered_buffer(load, spark):
    """Twelve small batches; folders are merged by threes, so that three or four are left."""
    base = scratch_path(spark, "layers")
    events = load("events")
    events.repartition(24).write.parquet(f"{base}/in")
    run_layers(file_source(spark, f"{base}/in", events.schema, per_trigger=2), f"{base}/out", f"{base}/checkpoint", fan=3)
    left = folders(spark, f"{base}/out")
    few = F.lit(all(sum(f.level == x for f in left) < 3 for x in range(4)) and len(left) <= 4)
    return read_layers(spark, f"{base}/out").groupBy("event_type").agg(
        F.count("*").alias("n"), exact_sum(F.col("value")).alias("total"), F.lit(applied(spark, f"{base}/out") + 1).cast("long").alias("batches"), few.alias("few_folders")
    )


@query("stream_micro_buffer", f"SELECT CAST(3 AS BIGINT) AS flushes, count(*) AS n, {money('value')} AS total FROM events")
def stream_micro_buffer(load, spark):
    events = load("events")
    base = scratch_path(spark, "buffer")
    events.repartition(12).write.parquet(f"{base}/in")
    stream = file_source(spark, f"{base}/in", events.schema, per_trigger=4)
    flush_buffered(stream, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return read_buffered(spark, f"{base}/out").agg(
        F.countDistinct("batch").alias("flushes"), F.count("*").alias("n"), exact_sum(F.col("value")).alias("total")
    )
