"""Tables kept by micro-batches: layers, current state, bars with late trades."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.plans.bars import ohlcv
from millrace.sources.manifests import manifest
from millrace.streaming.bars import bar_counts, late_trades, read_bars, repair_bars, run_ohlcv
from millrace.streaming.layers import add_batch, applied, folders, read_layers
from millrace.streaming.state import apply_changes, read_state
from millrace.streaming.streams import cdc_latest, file_source

from .conftest import rows

TRADE = "trade_id long, symbol string, price decimal(12,2), quantity decimal(12,2), amount_usdt decimal(18,2), ts timestamp_ntz"


def test_layers_keep_rows_and_few_folders(spark, folder):
    for n in range(30):
        df = spark.createDataFrame([(n, f"x{n}")], "n long, x string")
        assert add_batch(df, folder, n, fan=3)
        assert not add_batch(df, folder, n, fan=3)
        now = folders(spark, folder)
        assert applied(spark, folder) == n
        assert max(sum(f.level == x for f in now) for x in range(5)) < 3
        if n in (0, 8, 17, 29):
            assert rows(read_layers(spark, folder)) == sorted([(i, f"x{i}") for i in range(n + 1)], key=lambda t: str(t[0]))
    spans = sorted((f.first, f.last) for f in now)
    assert spans[0][0] == 0 and all(a[1] + 1 == b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_a_reader_outlives_merges(spark, folder):
    for n in range(4):
        add_batch(spark.createDataFrame([(n,)], "n long"), folder, n, fan=3)
    reader = read_layers(spark, folder)
    for n in range(4, 7):
        add_batch(spark.createDataFrame([(n,)], "n long"), folder, n, fan=3)
    assert reader.count() == 4 and read_layers(spark, folder).count() == 7


def test_a_failed_batch_is_run_again(spark, folder):
    one = spark.createDataFrame([(1,)], "n long")
    add_batch(one, folder, 0)
    one.union(one).write.parquet(f"{folder}/data/b=1")  # a batch that stopped before its manifest
    assert read_layers(spark, folder).count() == 1
    add_batch(one, folder, 1)
    assert read_layers(spark, folder).count() == 2


def test_empty_table_of_layers(spark, folder):
    assert read_layers(spark, folder) is None and applied(spark, folder) == -1
    add_batch(spark.createDataFrame([], "n long"), folder, 0)
    assert read_layers(spark, folder).count() == 0


CHANGE = "before struct<id:int,v:string>, after struct<id:int,v:string>, op string, ts_ms long, pos long"


def change(key, value, op, at, pos):
    row = (key, value)
    return (None if op == "c" else row, None if op == "d" else row, op, at, pos)


def test_state_equals_the_log_after_every_batch(spark, folder):
    batches = [
        [change(k, "a", "c", 10, k) for k in range(20)],
        [change(3, "b", "u", 11, 30), change(4, None, "d", 12, 31), change(3, "c", "u", 11, 32)],
        [change(5, "late", "u", 5, 40), change(4, "back", "c", 12, 41), change(99, "new", "c", 1, 42)],
        [],
        [change(4, "older", "u", 12, 35), change(99, None, "d", 2, 50), change(None, "no key", "c", 3, 51)],
    ]
    log = []
    for number, batch in enumerate(batches):
        log += batch
        df = spark.createDataFrame(batch, CHANGE)
        assert apply_changes(df, folder, number, "id", "pos", buckets=4)
        assert not apply_changes(df, folder, number, "id", "pos", buckets=4)
        expected = cdc_latest(spark.createDataFrame(log, CHANGE), "id", "pos")
        assert rows(read_state(spark, folder)) == rows(expected)
    with pytest.raises(ValueError):
        apply_changes(spark.createDataFrame(batches[0], CHANGE), folder, 9, "id", "pos", buckets=8)


def test_untouched_buckets_keep_their_folder(spark, folder):
    apply_changes(spark.createDataFrame([change(k, "a", "c", 1, k) for k in range(50)], CHANGE), folder, 0, "id", "pos", buckets=8)
    apply_changes(spark.createDataFrame([change(7, "b", "u", 2, 60)], CHANGE), folder, 1, "id", "pos", buckets=8)
    assert sorted(r["folder"] for r in manifest(spark, folder)) == ["batch=0"] * 7 + ["batch=1"]


def trade(i, hour, minute, price, symbol="s"):
    at = dt.datetime(2024, 1, 1, hour, minute)
    return (i, symbol, Decimal(price), Decimal(2), Decimal(price) * 2, at)


def test_late_trades_are_counted_and_repaired(spark, folder):
    deliveries = [
        [trade(1, 10, 0, "5.00"), trade(2, 10, 30, "7.50")],
        [trade(3, 15, 0, "1.25"), trade(4, 10, 10, "0.10"), trade(5, 15, 1, "9.99", "t")],
        [trade(6, 16, 0, "2.00"), trade(7, 10, 45, "8.00"), trade(8, 14, 20, "3.00")],
        [trade(9, 11, 0, "4.00"), trade(10, 16, 30, "2.50")],
    ]
    everything = [t for d in deliveries for t in d]
    out = f"{folder}/out"
    stream = file_source(spark, f"{folder}/in/*", TRADE, per_trigger=1)
    for n, d in enumerate(deliveries):
        spark.createDataFrame(d, TRADE).coalesce(1).write.parquet(f"{folder}/in/d={n}")
        if n in (1, 3):
            run_ohlcv(stream, out, f"{folder}/cp", width="1 hour", fan=2)
    # The newest trades before the batches are of 10:30, 15:01 and 16:00.
    assert sorted(r["trade_id"] for r in late_trades(spark, out).collect()) == [7, 9]
    assert tuple(bar_counts(spark, out).first())[1:] == (10, 2)
    on_time = spark.createDataFrame([t for t in everything if t[0] not in (7, 9)], TRADE)
    order = read_bars(spark, out).columns
    assert rows(read_bars(spark, out)) == rows(ohlcv(on_time, "1 hour").select(order))
    assert repair_bars(spark, out, "1 hour") and not repair_bars(spark, out, "1 hour")
    assert rows(read_bars(spark, out)) == rows(ohlcv(spark.createDataFrame(everything, TRADE), "1 hour").select(order))
    # Run again with nothing new: nothing changes.
    run_ohlcv(stream, out, f"{folder}/cp", width="1 hour", fan=2)
    assert read_bars(spark, out).agg(F.sum("trades_count")).first()[0] == 10
