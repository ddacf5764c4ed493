"""Checks on loaded data."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .sources.writers import replace_partitions


def reconcile(source: DataFrame, target: DataFrame, by: str) -> DataFrame:
    """Rows of both sides per value of ``by`` and whether they agree; one pass over each."""
    tagged = source.select(by, F.lit(1).alias("__s")).unionByName(target.select(by, F.lit(0).alias("__s")))
    return tagged.groupBy(by).agg(
        F.sum("__s").alias("source_rows"),
        F.sum(1 - F.col("__s")).alias("target_rows"),
    ).withColumn("matches", F.col("source_rows") == F.col("target_rows"))


def below(df: DataFrame, column: str, least=0) -> DataFrame:
    """Rows whose value lies below ``least``; NULL passes the check."""
    return df.where(F.col(column) < F.lit(least))


def rows_on_last_date(df: DataFrame, day: str) -> DataFrame:
    """The newest date and its number of rows."""
    counts = df.groupBy(day).agg(F.count("*").alias("rows"))
    return counts.orderBy(F.col(day).desc_nulls_last()).limit(1)


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()


def _log(spark, mart: str, load_date: str, rows: int, as_of, log: str) -> None:
    line = spark.range(1).select(
        F.lit(mart).alias("mart"),
        F.lit(load_date).alias("load_date"),
        F.lit(rows).cast("bigint").alias("rows"),
        F.lit(as_of).alias("created_at"),
    )
    line.write.mode("append").parquet(log)


def replace_logged(df: DataFrame, mart: str, load_date: str, as_of, target: str, log: str, *by: str) -> None:
    """Like ``write_logged``, but only the partitions of ``by`` that ``df`` holds are replaced."""
    seen = Observation("load")
    replace_partitions(df.observe(seen, F.count(F.lit(1)).alias("rows")), target, *by)
    _log(df.sparkSession, mart, load_date, seen.get["rows"], as_of, log)


def write_logged(df: DataFrame, mart: str, load_date: str, as_of, target: str, log: str) -> None:
    """Write a mart and append (mart, date, rows, created_at) to the load log.

    The rows are counted while they are written, not in a second pass.
    """
    seen = Observation("load")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(target)
    _log(df.sparkSession, mart, load_date, seen.get["rows"], as_of, log)
