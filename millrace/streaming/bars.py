"""Price bars from a trade stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .layers import FAN, add_batch, applied, read_layers
from .streams import trigger_args


def ohlcv_stream(trades: DataFrame, width: str = "1 minute", late: str = "1 hour") -> DataFrame:
    """Running bars per symbol; expects trade_id, symbol, price, quantity, amount_usdt, ts."""
    order = F.struct("ts", "trade_id")
    # Watermarks need an instant; the bar's start goes back to a time without a zone below.
    bars = (
        trades.withColumn("ts", F.col("ts").cast("timestamp"))
        .withWatermark("ts", late)
        .groupBy(F.window("ts", width).alias("w"), "symbol")
        .agg(
            F.min_by("price", order).alias("open_price"),
            F.max("price").alias("high_price"),
            F.min("price").alias("low_price"),
            F.max_by("price", order).alias("close_price"),
            F.sum("quantity").alias("total_volume"),
            F.sum("amount_usdt").alias("total_amount_usdt"),
            F.count("trade_id").alias("trades_count"),
        )
    )
    return bars.select(F.col("w.start").cast("timestamp_ntz").alias("period_start"), "symbol", *bars.columns[2:])


def partial_bars(trades: DataFrame, width: str = "1 minute") -> DataFrame:
    """Bars that can be merged: the first and last trade stay with their place."""
    placed = trades.withColumn("period_start", F.window("ts", width)["start"])
    trade = F.struct("ts", "trade_id", "price")
    return placed.groupBy("period_start", "symbol").agg(
        F.min(trade).alias("first"),
        F.max("price").alias("high_price"),
        F.min("price").alias("low_price"),
        F.max(trade).alias("last"),
        F.sum("quantity").alias("total_volume"),
        F.sum("amount_usdt").alias("total_amount_usdt"),
        F.count("trade_id").alias("trades_count"),
    )


def merge_bars(parts: DataFrame) -> DataFrame:
    """One partial bar per period and symbol; types stay those of the parts."""
    kinds = dict(parts.dtypes)
    how = {"first": F.min, "high_price": F.max, "low_price": F.min, "last": F.max, "total_volume": F.sum, "total_amount_usdt": F.sum, "trades_count": F.sum}
    return parts.groupBy("period_start", "symbol").agg(*[f(c).cast(kinds[c]).alias(c) for c, f in how.items()])


def run_ohlcv(trades: DataFrame, path: str, checkpoint: str, width: str = "1 minute", late: str = "1 hour", mode: str = "drain", fan: int = FAN) -> None:
    """Keep bars of a trade stream, and a ledger of the trades that came too late for theirs.

    A trade is late if its bar ended ``late`` or more before the newest trade of the batches before
    its own. Late trades do not change the bars; they are written to the ledger, counted, and
    brought in by ``repair_bars``. Bars and ledger are tables of layers, so a batch that is run
    again after a failure changes nothing and the number of folders stays small.
    """

    def keep(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if number <= applied(spark, f"{path}/marks"):
            return
        batch.persist()
        marks = read_layers(spark, f"{path}/marks")
        # One row: the newest trade before this batch.
        edge = F.lit(None) if marks is None else F.lit(marks.agg(F.max("newest").cast("string")).first()[0])
        ended = F.window("ts", width)["end"] <= edge.cast("timestamp_ntz") - F.expr(f"INTERVAL {late}")
        marked = batch.withColumn("ts", F.col("ts").cast("timestamp_ntz")).withColumn("is_late", F.coalesce(ended, F.lit(False)))
        behind = marked.where("is_late").drop("is_late").withColumn("batch", F.lit(number).cast("long"))
        add_batch(partial_bars(marked.where("NOT is_late"), width), f"{path}/bars", number, merge_bars, fan)
        add_batch(behind, f"{path}/ledger", number, fan=fan)
        mark = marked.agg(F.max("ts").alias("newest"), F.count("*").alias("trades"), F.count_if("is_late").alias("late_trades"))
        add_batch(mark, f"{path}/marks", number, _merge_marks, fan)
        batch.unpersist()

    run = trades.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint)
    run.trigger(**trigger_args(mode)).start().awaitTermination()


def _merge_marks(marks: DataFrame) -> DataFrame:
    return marks.agg(F.max("newest").alias("newest"), F.sum("trades").alias("trades"), F.sum("late_trades").alias("late_trades"))


def bar_counts(spark: SparkSession, path: str) -> DataFrame:
    """One row: newest trade, trades and late trades so far."""
    return _merge_marks(read_layers(spark, f"{path}/marks"))


def late_trades(spark: SparkSession, path: str) -> DataFrame:
    """The ledger: trades that came after their bar was closed, with the number of their batch."""
    return read_layers(spark, f"{path}/ledger")


def repair_bars(spark: SparkSession, path: str, width: str = "1 minute", fan: int = FAN) -> bool:
    """Bring ledger entries that were not brought in before into their bars; False if there are none.

    Only bars that the entries touch are written, as partial bars that are merged when read.
    """
    ledger, upto, done = late_trades(spark, path), applied(spark, f"{path}/ledger"), applied(spark, f"{path}/repairs")
    if ledger is None or upto <= done:
        return False
    new = ledger.where((F.col("batch") > done) & (F.col("batch") <= upto)).drop("batch")
    return add_batch(partial_bars(new, width), f"{path}/repairs", upto, merge_bars, fan)


def read_bars(spark: SparkSession, path: str) -> DataFrame:
    """The bars, with the late trades that ``repair_bars`` has brought in."""
    parts, repairs = read_layers(spark, f"{path}/bars"), read_layers(spark, f"{path}/repairs")
    merged = merge_bars(parts if repairs is None else parts.unionByName(repairs))
    prices = {"first": F.col("first.price").alias("open_price"), "last": F.col("last.price").alias("close_price")}
    return merged.select(*[prices.get(c, F.col(c)) for c in merged.columns])
