"""Points inside intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import slot_number
from .joins import broadcast_if_measured


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    ts: str,
    start: str,
    end: str,
    on=(),
    slot: str | int = "hour",
    broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """Every (point, interval) with ``start <= ts <= end``; overlapping intervals each match.

    Each interval is listed once per slot it touches and each point has one slot, so this is
    an equi join on (keys, slot) with an exact filter, and no pair is compared outside a slot.
    Choose ``slot`` near the usual length of an interval: much shorter slots list it often, much
    longer ones compare more pairs. The listed intervals are measured: up to ``broadcast_bytes`` they are broadcast and the
    points are not shuffled; beyond that both sides are shuffled and adaptive execution splits
    slots that hold many rows. Columns of the intervals that points have too get the suffix
    ``_interval``.
    """
    shared = [c for c in intervals.columns if c in points.columns and c not in on]
    intervals = intervals.withColumnsRenamed({c: f"{c}_interval" for c in shared})
    start, end = (f"{c}_interval" if c in shared else c for c in (start, end))
    p = points.withColumn("__slot", slot_number(F.col(ts), slot))
    spans = F.sequence(slot_number(F.col(start), slot), slot_number(F.col(end), slot))
    listed = intervals.where(F.col(start) <= F.col(end)).withColumn("__slot", F.explode(spans))
    joined = p.join(broadcast_if_measured(listed, broadcast_bytes), [*on, "__slot"])
    return joined.where((F.col(ts) >= F.col(start)) & (F.col(ts) <= F.col(end))).drop("__slot")
