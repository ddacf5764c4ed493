"""As-of join: nearest right row by time within equal keys."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.times import slot_number
from ..session import materialise
from .joins import broadcast_if_measured
from .ordering import PART, Key, in_even_ranges, sorts


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on,
    left_ts: str,
    right_ts: str,
    op: str = "<",
    tie: str | None = None,
    how: str = "inner",
    slot: str | int | None = None,
    suffix: str = "_right",
) -> DataFrame:
    """Match each left row with the nearest right row for which ``left_ts op right_ts`` holds.

    ``<`` and ``<=`` look forward, ``>`` and ``>=`` back. ``tie`` orders right rows of one
    time: the lowest is taken looking forward, the highest looking back. Right columns whose
    name is taken get ``suffix``; keys are kept once.

    The rows of both sides are sorted together by key and time over even ranges, so neither a
    key nor a moment with many rows crowds a task. A range hands on its last right row, and that
    one row per range is all that later ranges can need of it.

    A caller who knows that one key's rows of one ``slot`` (``day``, ``hour``, ``minute``, or a
    width for whole-number times) fit a task, and that its slots do as well, may name the slot.
    That costs one shuffle instead of two and a written table; the result is the same.
    """
    if op not in ("<", "<=", ">", ">="):
        raise ValueError(f"op must be <, <=, > or >=, not {op}")
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how}")
    forward, strict = op in ("<", "<="), op in ("<", ">")
    on = list(on)
    lcols = [c for c in left.columns if c not in on]
    rcols = [c for c in right.columns if c not in on]
    payload = F.struct(*[F.col(c).alias(c + suffix if c in left.columns else c) for c in rcols])
    tie_value = F.col(tie) if tie else F.lit(0)

    can_match = reduce(and_, [F.col(c).isNotNull() for c in (*on, left_ts)])
    seen = left.where(can_match).select(*on, F.col(left_ts).alias("__t"), F.struct(*lcols).alias("__l"))
    offered = right.dropna(subset=[*on, right_ts]).select(
        *on, F.col(right_ts).alias("__t"), payload.alias("__r"), tie_value.alias("__tie")
    )
    # Among equal times left rows are met first when the match is strict and last when it is not.
    is_right = F.col("__r").isNotNull()
    rows = seen.unionByName(offered, allowMissingColumns=True).withColumn("__side", is_right if strict else ~is_right)
    # NULL is the lowest tie; the best of one time is met last.
    met = [Key("__t", desc=forward), Key("__side"), Key("__tie", desc=forward, nulls_first=not forward)]
    matched = _by_ranges(rows, on, met) if slot is None else _by_slots(rows, on, met, slot, forward)
    if how == "inner":
        return matched.where(F.col("__hit").isNotNull()).select(*on, "__l.*", "__hit.*")
    found = matched.select(*on, "__l.*", "__hit.*")
    never = left.where(~can_match)
    return found.unionByName(never, allowMissingColumns=True)


def _by_ranges(rows: DataFrame, on: list[str], met: list[Key]) -> DataFrame:
    """Left rows with ``__hit``, from even ranges of (key, time).

    Rows are sorted by key first, so the last right row before a range, whatever its key, is the
    nearest one for the range's first key if it has that key; if not, that key has none there.
    """
    order = [*on, *met]
    inside = W.partitionBy(PART).orderBy(*sorts(order))
    last = F.last(F.when(F.col("__r").isNotNull(), F.struct(*on, "__r")), ignorenulls=True)
    spread = in_even_ranges(rows, order).withColumns(
        {
            "__last": last.over(inside.rowsBetween(W.unboundedPreceding, W.currentRow)),
            "__end": F.lead(F.lit(False), 1, True).over(inside),
        }
    )
    is_left = F.col("__l").isNotNull()
    fixed = materialise(
        spread.where(is_left | F.col("__end")).select(
            PART,
            *on,
            "__l",
            F.when(is_left & _same_key(on, "__last"), F.col("__last.__r")).alias("__near"),
            F.when(F.col("__end"), F.col("__last")).alias("__tail"),
            "__end",
        ),
        "asof",
    )
    ends = fixed.where("__end").select(PART, "__tail")
    earlier = W.orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
    handed = ends.select(PART, F.last("__tail", ignorenulls=True).over(earlier).alias("__before")).where(F.col("__before").isNotNull())
    joined = fixed.where(is_left).join(broadcast_if_measured(handed), PART, "left")
    return joined.withColumn("__hit", F.coalesce("__near", F.when(_same_key(on, "__before"), F.col("__before.__r"))))


def _same_key(on: list[str], held: str) -> Column:
    return reduce(and_, [F.col(held)[c] == F.col(c) for c in on], F.col(held).isNotNull())


def _by_slots(rows: DataFrame, on: list[str], met: list[Key], slot: str | int, forward: bool) -> DataFrame:
    """Left rows with ``__hit``, from (key, slot) groups and one carried row per group."""
    rows = rows.withColumn("__slot", slot_number(F.col("__t"), slot))
    pick = F.min_by if forward else F.max_by
    slots = rows.groupBy(*on, "__slot").agg(
        pick("__r", F.when(F.col("__r").isNotNull(), F.struct("__t", "__tie"))).alias("__edge"),
        F.bool_or(F.col("__l").isNotNull()).alias("__wanted"),
    )
    toward = F.col("__slot").desc() if forward else F.col("__slot").asc()
    passed = W.partitionBy(*on).orderBy(toward).rowsBetween(W.unboundedPreceding, -1)
    carried = (
        slots.withColumn("__r", F.last("__edge", ignorenulls=True).over(passed))
        .where(F.col("__wanted") & F.col("__r").isNotNull())
        .select(*on, "__slot", "__r", F.lit(True).alias("__carried"))
    )
    rows = rows.unionByName(carried, allowMissingColumns=True)
    # The carried row lies beyond its slot, so it is met first.
    order = W.partitionBy(*on, "__slot").orderBy(F.col("__carried").asc_nulls_last(), *sorts(met))
    nearest = F.last("__r", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    return rows.withColumn("__hit", nearest).where(F.col("__l").isNotNull())
