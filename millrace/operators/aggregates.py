"""Grouped summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import floor_div
from .ordering import nulls_last, number_rows, same_keys


def count_distinct_if(col: Column, cond: Column) -> Column:
    return F.countDistinct(F.when(cond, col))


def sum_if(col: Column, cond: Column) -> Column:
    return F.sum(F.when(cond, col))


def avg_if(col: Column, cond: Column) -> Column:
    return F.avg(F.when(cond, col))


def any_if(col: Column, cond: Column) -> Column:
    """One value among the rows that satisfy ``cond``; the lowest, so that runs agree."""
    return F.min(F.when(cond, col))


def uniq_if(col: Column, cond: Column, rsd: float = 0.02) -> Column:
    """About how many distinct values the rows that satisfy ``cond`` have; mergeable."""
    return F.approx_count_distinct(F.when(cond, col), rsd)


def collect_if(df: DataFrame, keys, value: str, cond: Column, order, chunk_rows: int) -> DataFrame:
    """``collect_groups`` over the rows that satisfy ``cond``; keys without such rows have an empty chunk 0."""
    lists = collect_groups(df.where(cond), keys, value, order, chunk_rows)
    every = same_keys(df.select(*keys).distinct(), lists, list(keys), "left")
    empty = F.array().cast(lists.schema["items"].dataType)
    return every.select(*keys, F.coalesce("chunk", F.lit(0)).cast("bigint").alias("chunk"), F.coalesce("items", empty).alias("items"))


def share_of(cond: Column, digits: int = 2) -> Column:
    """Rows that satisfy ``cond`` over all rows of the group, rounded."""
    return F.round(F.count_if(cond) / F.count(F.lit(1)), digits)


def exact_sum(col: Column, scale: int = 2) -> Column:
    """Sum of money-like doubles that does not depend on the order of the rows."""
    return F.sum(col.cast(f"decimal(18,{scale})")).cast("double")


def exact_avg(col: Column, scale: int = 2) -> Column:
    """Average of money-like doubles that does not depend on the order of the rows."""
    return exact_sum(col, scale) / F.count(col)


def collect_groups(df: DataFrame, keys, value: str, order, chunk_rows: int) -> DataFrame:
    """All values per key as ordered arrays of at most ``chunk_rows`` items.

    Columns: keys, ``chunk`` (from 0) and ``items``. A key with few rows has the one chunk 0;
    a large key has several rows, so that no array has to hold a whole large group. Whoever
    joins on the key must reckon with that, so the caller states the length.
    """
    numbered = number_rows(df.select(*dict.fromkeys([*keys, value, *[getattr(k, "name", k) for k in order]])), order, keys, "__rn")
    chunk = floor_div(F.col("__rn") - 1, chunk_rows)
    arrays = numbered.groupBy(*keys, chunk.alias("chunk")).agg(
        F.sort_array(F.collect_list(F.struct("__rn", value))).alias("__a")
    )
    return arrays.select(*keys, "chunk", F.transform("__a", lambda x: x[value]).alias("items"))


def first_last(value: str, *order: str) -> tuple[Column, Column]:
    """First and last value by the order columns, as mergeable aggregates; NULL gives way to values."""
    return F.min_by(value, nulls_last(*order)), F.max_by(value, F.struct(*order))


def day_dimensions(df: DataFrame, ts: str, dims, averages, distinct) -> DataFrame:
    """Daily figures per dimension tuple: first/last time, averages, distinct counts."""
    return df.groupBy(F.to_date(ts).alias("day"), *dims).agg(
        F.min(ts).alias("time_min"),
        F.max(ts).alias("time_max"),
        *[F.avg(c).alias(c) for c in averages],
        *[F.countDistinct(c).alias(f"{c}_count") for c in distinct],
    )


def partition_counts(df: DataFrame) -> DataFrame:
    """Rows per partition folder of a partitioned file table."""
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"((?:[^/=]+=[^/]+/)+)[^/]*$", 1)
    return df.groupBy(F.rtrim(folder, F.lit("/")).alias("partition")).agg(F.count("*").alias("rows"))
