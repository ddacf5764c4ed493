"""Hourly weather from one document per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nested import explode_zipped


def weather_hourly(raw: DataFrame, as_of: Column, measures: dict[str, str] | None = None) -> DataFrame:
    """One row per hour; ``measures`` maps dotted array columns to output columns."""
    measures = measures or {"hourly.temperature_2m": "temperature", "hourly.rain": "rain"}
    rows = explode_zipped(raw, {"hourly.time": "time", **measures})
    return rows.select(
        "time",
        *[F.col(m).try_cast("float").alias(m) for m in measures.values()],
        F.left("time", F.lit(10)).try_cast("date").alias("weather_date"),
        as_of.alias("updated_at"),
    )


def cloud_extremes(flat: DataFrame, column: str = "cloud_cover", low: float = 20, high: float = 80) -> DataFrame:
    """Hours outside the middle band."""
    return flat.where((F.col(column) > high) | (F.col(column) < low))
