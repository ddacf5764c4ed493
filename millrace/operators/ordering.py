"""Numbering, ranking and running values that do not need one task per group.

A window without keys, or over a key that holds a large share of the rows, sorts everything
in one task. Here the rows are range-sorted on (keys, order) across all tasks instead; each
range then needs only small per-range totals of the ranges before it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialise

_ROW = "__row"
PART = "__part"
_POS = "__pos"

@dataclass(frozen=True)
class Key:
    """One sort key."""

    name: str
    desc: bool = False
    nulls_first: bool = False

    def sort(self) -> Column:
        c = F.col(self.name)
        if self.desc:
            return c.desc_nulls_first() if self.nulls_first else c.desc_nulls_last()
        return c.asc_nulls_first() if self.nulls_first else c.asc_nulls_last()


def sorts(order) -> list[Column]:
    """Sort columns of keys and names; names ascend with NULL last."""
    return [k.sort() if isinstance(k, Key) else F.col(k).asc_nulls_last() for k in order]


def same_keys(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Equi join on ``keys`` where NULL equals NULL; right's key columns are dropped."""
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"__r_{k}")
    cond = None
    for k in keys:
        one = left[k].eqNullSafe(renamed[f"__r_{k}"])
        cond = one if cond is None else cond & one
    return left.join(renamed, cond, how).drop(*[f"__r_{k}" for k in keys])


def ranged(df: DataFrame, order) -> DataFrame:
    """Sort across all tasks and fix each row's range number and place in its range.

    The sort key should end in a unique column: rows equal on the whole key share one range.
    """
    placed = df.orderBy(*sorts(order)).withColumn(_ROW, F.monotonically_increasing_id())
    fixed = materialise(placed, "ranged")
    return fixed.withColumns(
        {
            PART: F.shiftright(_ROW, 33),
            _POS: F.col(_ROW).bitwiseAND(F.lit((1 << 33) - 1)),
        }
    ).drop(_ROW)


def number_rows(df: DataFrame, order, partition_by=(), name: str = "row_num", small_keys: bool = False) -> DataFrame:
    """``row_number()`` per key, or over all rows when there is no key.

    ``order`` must be unique within a key: which of two equal rows comes first is not defined.
    Rows are range-sorted at every size, so a key may hold any share of them. A caller that knows
    every key to be small may ask for a plain window with ``small_keys``; the numbers are the same.
    """
    keys = list(partition_by)
    if small_keys:
        if not keys:
            raise ValueError("small_keys needs keys")
        return df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*sorts(order))).cast("bigint"))
    rows = ranged(df, [*keys, *order])
    spans = rows.groupBy(*keys, PART).agg(F.count("*").alias("__n"), F.min(_POS).alias("__first"))
    before = W.partitionBy(*keys).orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
    spans = spans.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    return (
        same_keys(rows, spans, [*keys, PART])
        .withColumn(name, F.col("__before") + F.col(_POS) - F.col("__first") + 1)
        .drop(PART, _POS, "__before", "__first")
    )


_FRONT = "__front"
_BACK = "__back"


def in_even_ranges(df: DataFrame, order) -> tuple[DataFrame, list[str]]:
    """Spread the rows over ranges of the sort key; peers may lie in several ranges, side by side.

    A hash of the whole row follows the sort key, so a value that a third of the rows share is cut
    like any other stretch. Columns that cannot be hashed (maps, variants) do not take part. Rows
    equal in all columns share a range.
    """
    hashed = [f.name for f in df.schema.fields if not re.search(r"\b(map|variant)\b", f.dataType.simpleString())]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = df.repartitionByRange(n, *sorts(order), F.xxhash64(*hashed)).withColumn(PART, F.spark_partition_id())
    return spread.repartitionById(n, F.col(PART))


def _with_peers(df: DataFrame, order, rank: str | None, dense: str | None, sums: dict[str, Column]) -> DataFrame:
    """Attach rank, dense rank and running sums (peers included) over all rows.

    Each range computes them for itself while it is sorted. What a range adds to them is in one row
    per range: its rows, distinct values and sums, and the part of them that belongs to its first and
    its last value. From these rows follow, for a value that runs over a border, where it began and
    where it ends. Nothing is joined on the sort value; the broadcast has one row per shuffle partition.
    """
    names = [k.name if isinstance(k, Key) else k for k in order]
    inside = W.partitionBy(PART).orderBy(*sorts(order))
    placed = in_even_ranges(df, order).withColumns({f"__v_{s}": c for s, c in sums.items()})
    rows = materialise(
        placed.withColumns(
            {_FRONT: F.rank().over(inside), _BACK: F.dense_rank().over(inside)}
            | {f"__s_{s}": F.sum(f"__v_{s}").over(inside) for s in sums}
        ),
        "ranged",
    )
    value = F.struct(*names)
    parts = rows.groupBy(PART).agg(
        F.count("*").alias("n"),
        F.max(_BACK).cast("bigint").alias("values"),
        F.max(_FRONT).cast("bigint").alias("tail"),
        F.min_by(value, _FRONT).alias("first"),
        F.max_by(value, _FRONT).alias("last"),
        *[F.sum(f"__v_{s}").alias(f"all_{s}") for s in sums],
        *[F.sum(F.when(F.col(_BACK) == 1, F.col(f"__v_{s}"))).alias(f"head_{s}") for s in sums],
    )
    line = W.orderBy(PART)
    before, after = line.rowsBetween(W.unboundedPreceding, -1), line.rowsBetween(1, W.unboundedFollowing)
    # A range continues its predecessor's last value unless its own first value is new.
    parts = parts.withColumn("new", ~F.col("first").eqNullSafe(F.lag("last").over(line)) | (F.row_number().over(line) == 1))
    parts = parts.withColumns(
        {
            "ends": F.coalesce(F.lead("new").over(line), F.lit(True)),
            "o_n": F.coalesce(F.sum("n").over(before), F.lit(0)),
            "o_values": F.coalesce(F.sum("values").over(before), F.lit(0))
            - F.sum((~F.col("new")).cast("bigint")).over(line.rowsBetween(W.unboundedPreceding, W.currentRow)),
        }
        | {f"o_{s}": F.sum(f"all_{s}").over(before) for s in sums}
    )
    # Rows before the last value's first peer, known in the range where that value begins.
    begins = F.when(F.col("values") > 1, F.col("o_n") + F.col("tail") - 1).when(F.col("new"), F.col("o_n"))
    parts = parts.withColumn("begins", begins)
    parts = parts.withColumn("began", F.when(F.col("new"), F.col("o_n")).otherwise(F.last("begins", True).over(before)))
    for s in sums:
        whole = _plus(F.col(f"o_{s}"), F.col(f"all_{s}"))
        # A struct tells a sum that is NULL from a range in which the value does not end.
        closes = F.when(F.col("values") > 1, F.struct(_plus(F.col(f"o_{s}"), F.col(f"head_{s}")).alias("v"))).when(
            F.col("ends"), F.struct(whole.alias("v"))
        )
        parts = parts.withColumn("__closes", closes).withColumn(
            f"e_{s}", F.when(F.col("ends"), whole).otherwise(F.first("__closes", True).over(after)["v"])
        )
    kept = [PART, "o_n", "o_values", "began", "values", *[f"{x}_{s}" for s in sums for x in "oe"]]
    settled = parts.select(PART, *[F.col(c).alias(f"__p_{c}") for c in kept[1:]])
    first, last = F.col(_FRONT) == 1, F.col(_BACK) == F.col("__p_values")
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    return rows.join(F.broadcast(settled), PART).select(
        *df.columns,
        *_named(rank, F.when(first, F.col("__p_began") + 1).otherwise(F.col("__p_o_n") + F.col(_FRONT))),
        *_named(dense, F.col("__p_o_values") + F.col(_BACK)),
        *[
            F.when(last, F.col(f"__p_e_{s}"))
            .otherwise(_plus(F.col(f"__p_o_{s}"), F.col(f"__s_{s}")))
            .cast(kinds[f"__s_{s}"])
            .alias(s)
            for s in sums
        ],
    )


def _named(name: str | None, col: Column) -> list[Column]:
    return [col.cast("bigint").alias(name)] if name else []


def _plus(offset: Column, inside: Column) -> Column:
    return F.when(offset.isNull(), inside).when(inside.isNull(), offset).otherwise(offset + inside)


def rank_rows(df: DataFrame, order, rank: str = "rank", dense: str = "dense_rank") -> DataFrame:
    """``rank()`` and ``dense_rank()`` over all rows; few distinct values do not crowd a task."""
    return _with_peers(df, order, rank, dense, {})


def running_sum(df: DataFrame, order, value: Column, name: str) -> DataFrame:
    """``sum(value) over (order by …)`` over all rows, peers included."""
    return _with_peers(df, order, None, None, {name: value})


def neighbours(df: DataFrame, order, value: str, prev: str | None = None, nxt: str | None = None) -> DataFrame:
    """Previous and next ``value`` in the order of all rows (lag and lead by one)."""
    rows = ranged(df, order)
    edges = rows.groupBy(PART).agg(F.min_by(value, _POS).alias("__head"), F.max_by(value, _POS).alias("__tail"))
    by_part = W.orderBy(PART)
    edges = edges.select(
        PART, F.lag("__tail").over(by_part).alias("__before"), F.lead("__head").over(by_part).alias("__after")
    )
    inside = W.partitionBy(PART).orderBy(_POS)
    first, last = F.col(_POS) == 0, F.lead(_POS).over(inside).isNull()
    out = rows.withColumns(
        {"__lag": F.lag(value).over(inside), "__lead": F.lead(value).over(inside), "__isfirst": first, "__islast": last}
    ).join(edges, PART)
    cols = [c for c in df.columns]
    if prev:
        cols.append(F.when(F.col("__isfirst"), F.col("__before")).otherwise(F.col("__lag")).alias(prev))
    if nxt:
        cols.append(F.when(F.col("__islast"), F.col("__after")).otherwise(F.col("__lead")).alias(nxt))
    return out.select(*cols)


def page(df: DataFrame, order, limit: int, offset: int) -> DataFrame:
    """LIMIT/OFFSET over a unique order; the rows of the page come in that order.

    A page at any depth is cut out of the numbered rows, so no task holds what stands before it.
    """
    numbered = number_rows(df, order, name="__rn")
    return numbered.where(F.col("__rn").between(offset + 1, offset + limit)).orderBy("__rn").drop("__rn")


def with_group_values(df: DataFrame, keys, *aggs: Column) -> DataFrame:
    """Attach group aggregates to every row.

    Same as aggregates over ``partition by keys``, but the rows are pre-aggregated before the
    shuffle and joined back, so that adaptive execution can broadcast or split a large key.
    """
    return same_keys(df, df.groupBy(*keys).agg(*aggs), list(keys))


def nulls_last(*order) -> Column:
    """A struct to take the lowest row by, in which NULL counts as higher than every value."""
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    return F.struct(*[part for c in cols for part in (c.isNull(), c)])


def pick_one(df: DataFrame, keys, order, last: bool = False) -> DataFrame:
    """One row per key: the lowest by ``order``, or with ``last`` the highest.

    Equals ``row_number() = 1`` but is pre-aggregated before the shuffle. A row with NULL in an
    order column gives way to one with a value there, in both directions.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    pick = F.max_by(F.struct(*rest), F.struct(*order)) if last else F.min_by(F.struct(*rest), nulls_last(*order))
    picked = df.groupBy(*keys).agg(pick.alias("__p"))
    return picked.select(*keys, "__p.*").select(*df.columns)


def first_non_null(df: DataFrame, keys, value: str, order, name: str) -> DataFrame:
    """The first non-NULL ``value`` of each key in the given order, on every row."""
    best = F.min_by(F.struct(value), F.when(F.col(value).isNotNull(), F.struct(*order)))
    return with_group_values(df, keys, best.getField(value).alias(name))


def exact_quantiles(df: DataFrame, keys, value: str, probs: dict[str, float]) -> DataFrame:
    """Interpolated quantiles per key, exact, without holding a key's values in one task.

    NULL values are left out; a key with nothing else gets NULL, as in SQL.

    Equal values are counted first and range-sorted. Totals per key and range tell which ranges
    hold the wanted ranks; only those are looked into.
    """
    keys = list(keys)

    def place(p: float) -> Column:
        return (F.col("__total") - 1) * F.lit(float(p))

    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("__c"))
    rows = ranged(counts, [*keys, value])
    spans = rows.groupBy(*keys, PART).agg(F.sum("__c").alias("__n"))
    before = W.partitionBy(*keys).orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
    spans = spans.withColumns(
        {
            "__before": F.coalesce(F.sum("__n").over(before), F.lit(0)),
            "__total": F.sum("__n").over(W.partitionBy(*keys)),
        }
    )
    last = F.col("__before") + F.col("__n") - 1
    wanted = F.lit(False)
    for p in probs.values():
        wanted = wanted | ((F.ceil(place(p)) >= F.col("__before")) & (F.floor(place(p)) <= last))
    spans = spans.where(wanted).drop("__n")
    inside = W.partitionBy(*keys, PART).orderBy(_POS).rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = same_keys(rows, spans, [*keys, PART]).withColumn(
        "__last", F.col("__before") + F.sum("__c").over(inside) - 1
    )
    first = F.col("__last") - F.col("__c") + 1

    def at(rank: Column) -> Column:
        return F.max(F.when(rank.between(first, F.col("__last")), F.col(value).cast("double")))

    aggs = []
    for name, p in probs.items():
        aggs += [at(F.floor(place(p))).alias(f"__lo_{name}"), at(F.ceil(place(p))).alias(f"__hi_{name}")]
    found = placed.groupBy(*keys, "__total").agg(*aggs)
    outs = []
    for name, p in probs.items():
        lo, hi = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        outs.append((lo + (hi - lo) * (place(p) - F.floor(place(p)))).alias(name))
    found = found.select(*keys, *outs)
    if not keys:
        return found if found.head(1) else df.agg(*[F.lit(None).cast("double").alias(name) for name in probs])
    return same_keys(df.select(*keys).distinct(), found, keys, "left")
