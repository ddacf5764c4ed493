"""Seismic events and their daily figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nested import explode_structs
from ..functions.texts import split_part_trim
from ..functions.times import from_epoch
from ..operators.aggregates import day_dimensions
from ..operators.joins import join_by_text_hash
from ..operators.tables import TargetField, conform


# Columns and types of the event table.
EVENT_FIELDS = [
    TargetField("id", "string", nullable=True),
    TargetField("ts", "datetime64_3", nullable=True),
    TargetField("place", "string", nullable=True),
    TargetField("region", "string", nullable=True),
    TargetField("magnitude", "float64", nullable=True),
    TargetField("felt", "int32", nullable=True),
    TargetField("tsunami", "int32", nullable=True),
    TargetField("url", "string", nullable=True),
    TargetField("longitude", "float64", nullable=True),
    TargetField("latitude", "float64", nullable=True),
    TargetField("depth", "float64", nullable=True),
    TargetField("load_date", "date", nullable=True),
    TargetField("updated_at", "datetime", nullable=True),
]


def earthquake_events(docs: DataFrame, regions: DataFrame, as_of: Column) -> DataFrame:
    """Features to rows in the shape of ``EVENT_FIELDS``.

    The whole place text, before it is cut at the comma, is looked up among the regions; the part
    after the comma is the region only of places not listed there.
    """
    known = regions.select("place_hash", F.col("region").alias("known_region"))
    found = join_by_text_hash(
        explode_structs(docs, "features").withColumn("whole", F.col("properties.place")), known, "whole", "place_hash"
    )
    spot = {n: F.get("geometry.coordinates", F.lit(i)) for i, n in enumerate(("longitude", "latitude", "depth"))}
    ts = from_epoch(F.col("properties.time"), "ms")
    filled = found.withColumns(
        {
            "ts": ts,
            "load_date": F.to_date(ts),
            "updated_at": as_of,
            "place": split_part_trim(F.col("whole"), 0),
            "region": F.coalesce("known_region", split_part_trim(F.col("whole"), 1)),
            "magnitude": F.col("properties.mag"),
            **{n: F.col(f"properties.{n}") for n in ("felt", "tsunami", "url")},
            **spot,
        }
    )
    return conform(filled, EVENT_FIELDS)


def earthquake_day_dims(df: DataFrame, ts: str, dims, averages, distinct, target: list[TargetField]) -> DataFrame:
    """Daily figures per dimension tuple in the shape of the target table."""
    return conform(day_dimensions(df, ts, dims, averages, distinct), target)


def earthquake_daily_facts(events: DataFrame, ts: str, magnitude: str) -> DataFrame:
    """Average magnitude and number of events per day."""
    return events.groupBy(F.to_date(ts).alias("day")).agg(
        F.avg(magnitude).alias("avg_magnitude"), F.count("*").alias("events")
    )
