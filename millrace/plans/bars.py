"""Open, high, low, close per symbol and time slot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sets import union_named
from ..sources.incremental import existing, newest_day
from ..sources.writers import replace_partitions


def ohlcv(trades: DataFrame, width: str = "1 minute") -> DataFrame:
    """Bars from trade_id, symbol, price, quantity, amount_usdt, ts; open and close by (ts, id)."""
    order = F.struct("ts", "trade_id")
    placed = trades.withColumn("period_start", F.window("ts", width)["start"])
    return placed.groupBy("period_start", "symbol").agg(
        F.min_by("price", order).alias("open_price"),
        F.max("price").alias("high_price"),
        F.min("price").alias("low_price"),
        F.max_by("price", order).alias("close_price"),
        F.sum("quantity").alias("total_volume"),
        F.sum("amount_usdt").alias("total_amount_usdt"),
        F.count("trade_id").alias("trades_count"),
    )


def _cutoff(bars: DataFrame, tail: str) -> DataFrame:
    """One row: the newest bar's start minus ``tail``; NULL when there are no bars."""
    return bars.agg((F.max("period_start") - F.expr(f"INTERVAL {tail}")).alias("cutoff"))


def rebuild_tail(bars: DataFrame, trades: DataFrame, width: str = "1 minute", tail: str = "1 HOUR") -> DataFrame:
    """Bars before the cutoff as they are, later ones computed again.

    The cutoff (newest bar minus ``tail``, a whole number of bars) is used for both parts, so
    no bar comes twice. It is a literal, so older trades are skipped by the scan.
    """
    cutoff = _cutoff(bars, tail).select(F.col("cutoff").cast("string")).first()[0]
    if cutoff is None:
        return ohlcv(trades, width)
    edge = F.lit(cutoff).cast("timestamp_ntz")
    return union_named(bars.where(F.col("period_start") < edge), ohlcv(trades.where(F.col("ts") >= edge), width))


def refresh_bars(trades: DataFrame, path: str, width: str = "1 minute", tail: str = "1 HOUR") -> None:
    """Bring a bar table, partitioned by day, up to date.

    Whole days from the cutoff's day on are computed and replaced, so a second run changes
    nothing. The cutoff is a literal, so older trades are skipped by the scan.
    """
    spark = trades.sparkSession
    newest = newest_day(spark, path, "day")
    if newest is not None:
        last = existing(spark, path).where(F.col("day") == F.lit(newest).cast("date"))
        day = _cutoff(last, tail).select(F.to_date("cutoff").cast("string")).first()[0]
        if day is not None:
            trades = trades.where(F.col("ts") >= F.lit(f"{day} 00:00:00").cast("timestamp_ntz"))
    replace_partitions(ohlcv(trades, width).withColumn("day", F.to_date("period_start")), path, "day")
