"""Reads with table semantics: replacing, summing, collapsing, expiring, computed columns.

Rows have no insert order of their own, so every function takes it as a ``seq`` column.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import casts
from ..functions.texts import bucket_of
from ..functions.times import month_key, truncate_precision
from .ordering import pick_one


class RuleError(ValueError):
    """A value was given for a column that is always computed."""


def _scoped(keys, partition) -> list[str]:
    return [*keys, *(partition or [])]


def read_replacing(df: DataFrame, keys, seq: str, version: str | None = None, partition=None) -> DataFrame:
    """Latest row per key: highest version, then last inserted.

    Without ``partition`` this is the final state; with partition columns rows only replace
    each other inside one partition, as after background merges.
    """
    order = [version, seq] if version else [seq]
    return pick_one(df, _scoped(keys, partition), order, last=True)


def read_summing(df: DataFrame, keys, sums, seq: str, partition=None) -> DataFrame:
    """Sum the named columns per key; other columns keep the first inserted value."""
    by = _scoped(keys, partition)
    rest = [c for c in df.columns if c not in by and c not in sums]
    out = df.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in sums], F.min_by(F.struct(*rest), F.col(seq)).alias("__first")
    )
    return out.select(*by, *sums, "__first.*").select(*df.columns)


def read_collapsing(df: DataFrame, keys, sign: str, seq: str) -> DataFrame:
    """The last ``+1`` row of each key whose signs sum above zero."""
    rest = [c for c in df.columns if c not in keys]
    out = df.groupBy(*keys).agg(
        F.sum(sign).alias("__sum"),
        F.max_by(F.struct(*rest), F.when(F.col(sign) > 0, F.col(seq))).alias("__last"),
    )
    return out.where("__sum > 0").select(*keys, "__last.*").select(*df.columns)


def _expired(ts: str, keep: str, as_of) -> Column:
    return F.col(ts) + F.expr(f"INTERVAL {keep}") <= as_of


def ttl_rows(df: DataFrame, ts: str, keep: str, as_of: Column, only: Column | None = None) -> DataFrame:
    """Drop rows older than ``keep`` at ``as_of``; with ``only``, just those that satisfy it."""
    gone = _expired(ts, keep, as_of)
    if only is not None:
        gone = gone & only
    return df.where(~F.coalesce(gone, F.lit(False)))


def ttl_column(df: DataFrame, column: str, default, ts: str, keep: str, as_of: Column) -> DataFrame:
    """Reset a column to its default once the row is older than ``keep``."""
    kind = df.schema[column].dataType
    gone = _expired(ts, keep, as_of)
    return df.withColumn(column, F.when(gone, F.lit(default).cast(kind)).otherwise(F.col(column)))


@dataclass(frozen=True)
class ColumnRule:
    """``kind``: default (may be given), materialized (stored) or alias (made at read)."""

    name: str
    kind: str
    expr: str
    type: str


def write_rules(df: DataFrame, rules) -> DataFrame:
    """What gets stored: defaults filled in, materialized columns added, aliases left out."""
    for r in rules:
        if r.kind in ("materialized", "alias") and r.name in df.columns:
            raise RuleError(f"cannot insert {r.name}: it is {r.kind}")
    for r in rules:
        if r.kind == "default" and r.name not in df.columns:
            df = df.withColumn(r.name, F.expr(r.expr).cast(r.type))
    for r in rules:
        if r.kind == "materialized":
            df = df.withColumn(r.name, F.expr(r.expr).cast(r.type))
    return df


def read_rules(df: DataFrame, rules) -> DataFrame:
    """Stored columns plus aliases, all available by name."""
    for r in rules:
        if r.kind == "alias":
            df = df.withColumn(r.name, F.expr(r.expr).cast(r.type))
    return df


def visible(df: DataFrame, rules) -> DataFrame:
    """What ``*`` shows: no materialized and no alias columns."""
    return df.drop(*[r.name for r in rules if r.kind in ("materialized", "alias")])


def range_partition(col: str, bounds: list[tuple[str, float]], last: str) -> Column:
    """Name of the first range whose upper bound lies above the value."""
    expr = None
    for name, upper in bounds:
        test = F.col(col) < F.lit(upper)
        expr = F.when(test, name) if expr is None else expr.when(test, name)
    return expr.otherwise(last)


def month_partition(ts: str) -> Column:
    return month_key(F.col(ts))


def hash_partition(n: int, *cols: str) -> Column:
    return bucket_of(n, *cols)


def clustered(df: DataFrame, partition: list[str], sort: list[str], files: int | None = None) -> DataFrame:
    """Range-split and sort rows so that files carry narrow value ranges of the sort columns."""
    cols = [*partition, *sort]
    spread = df.repartitionByRange(files, *cols) if files else df.repartitionByRange(*cols)
    return spread.sortWithinPartitions(*cols)


def shard_report(df: DataFrame, n: int, how: str, *cols: str) -> DataFrame:
    """Rows per shard and their share when routed by ``value``, ``hash`` or ``random``."""
    routes = {
        "value": lambda: F.pmod(F.col(cols[0]).cast("bigint"), F.lit(n).cast("bigint")).cast("int"),
        "hash": lambda: bucket_of(n, *cols),
        "random": lambda: F.floor(F.rand(7) * n).cast("int"),
    }
    counts = df.groupBy(routes[how]().alias("shard")).agg(F.count("*").alias("rows"))
    total = df.agg(F.count("*")).scalar()
    return counts.select("shard", "rows", F.round(F.col("rows") / total, 4).alias("share"))


def describe(df: DataFrame) -> list[tuple[int, str, str, str]]:
    """Position, name, type and comment of every column."""
    return [
        (i, f.name, f.dataType.simpleString(), f.metadata.get("comment", ""))
        for i, f in enumerate(df.schema.fields, start=1)
    ]


@dataclass(frozen=True)
class TargetField:
    """A column of the target table; ``type`` is a name from ``casts.TYPE_MAP``."""

    name: str
    type: str
    nullable: bool = False
    array: bool = False


def _truncate_items(items: Column, digits: int) -> Column:
    return F.transform(items, lambda x: truncate_precision(x, digits))


def conform(df: DataFrame, fields: list[TargetField]) -> DataFrame:
    """Cast to the target's types and order; unknown columns go, absent ones are not added.

    Text holding a list is parsed where an array is wanted. NULL becomes 0 or '' where the
    target column is not nullable. Timestamps are cut to the declared precision.
    """
    out = []
    for f in fields:
        if f.name not in df.columns:
            continue
        c = F.col(f"`{f.name}`")
        kind = casts.TYPE_MAP.get(f.type, f.type)
        if f.array:
            given = df.schema[f.name].dataType
            arr = casts.parse_list_text(c, f.type) if isinstance(given, T.StringType) else c.cast(f"array<{kind}>")
            if f.type in casts.PRECISION:
                arr = _truncate_items(arr, casts.PRECISION[f.type])
            out.append(arr.alias(f.name))
            continue
        c = c.try_cast(kind)
        if f.type in casts.PRECISION:
            c = truncate_precision(c, casts.PRECISION[f.type])
        if not f.nullable:
            c = casts.fill_default(c, kind)
        out.append(c.alias(f.name))
    return df.select(*out)


def align_to(df: DataFrame, target: T.StructType) -> DataFrame:
    """The columns ``df`` shares with an existing table, in its order and types."""
    shared = [f for f in target.fields if f.name in df.columns]
    return df.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in shared])


def advance_status(df: DataFrame, id_col: str, status: str, ts: str, steps: dict[str, str], every: int, as_of: Column) -> DataFrame:
    """Move the status of every ``every``-th id one step on and stamp the change time."""
    moves = (F.col(id_col) % every == 0) & F.col(status).isin(*steps)
    nxt = F.create_map(*[F.lit(x) for pair in steps.items() for x in pair])[F.col(status)]
    return df.withColumns(
        {
            status: F.when(moves, nxt).otherwise(F.col(status)),
            ts: F.when(moves, as_of).otherwise(F.col(ts)),
        }
    )


def drop_latest(df: DataFrame, order: list[str]) -> DataFrame:
    """All rows but the one highest by ``order``, which must be unique."""
    top = df.agg(F.max(F.struct(*order))).scalar()
    return df.where(~F.coalesce(F.struct(*order) == top, F.lit(False)))
