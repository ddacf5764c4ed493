"""Typed projections, audit columns and load versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import SECOND, floor_div, to_micros


def project_typed(df: DataFrame, types: dict[str, str], names: dict[str, str] | None = None) -> DataFrame:
    """Cast and select by a name→type mapping; ``names`` renames on the way."""
    names = names or {}
    return df.select(*[F.col(f"`{c}`").try_cast(t).alias(names.get(c, c)) for c, t in types.items()])


def audit_columns(df: DataFrame, as_of: Column, ts: str | None = None) -> DataFrame:
    """Load time, its whole-second version and, given a time column, the business date.

    ``as_of`` is passed in, so that a run can be repeated with the same result.
    """
    stamp = as_of.cast("timestamp_ntz")
    out = df.withColumns({"updated_at": stamp, "version": floor_div(to_micros(stamp), SECOND)})
    return out.withColumn("business_date", F.to_date(ts)) if ts else out


def next_version(df: DataFrame, target: DataFrame, version: str = "version") -> DataFrame:
    """Stamp a full reload with the target's highest version plus one (1 for an empty target)."""
    top = target.agg(F.max(version)).scalar()
    return df.withColumn(version, F.coalesce(top, F.lit(0)) + 1)


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Select and rename columns whose names may hold dots or colons."""
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in names.items()])
