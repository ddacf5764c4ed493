"""Aggregate states that can be stored, merged across loads and finished later.

Simple states are plain numbers. ``uniq`` and ``quantiles`` are binary sketches, ``avg`` is a
(total, n) struct. Everything merges associatively, so any split of the input over loads gives
the same result. A ``list`` state is an ordered list in chunks of bounded length, each with the place
of its first value: a key has as many rows as its longest list has chunks, numbered by ``chunk``;
the other states stand on chunk 0. Lists of one load can also be kept as they are (``collect_state``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import floor_div
from .aggregates import collect_groups
from .ordering import number_rows

SIMPLE = ("sum", "max", "min", "any")


@dataclass(frozen=True)
class State:
    """``kind`` is sum, max, min, any, count, avg, uniq, quantiles, any_if or list.

    A list holds the values of ``column`` that are not NULL, sorted by the columns ``order`` (NULL
    last) and then by value, ``chunk_rows`` to a chunk.
    """

    kind: str
    column: str
    cond: str | None = None
    probs: tuple[float, ...] = ()
    order: tuple[str, ...] = ()
    chunk_rows: int = 10_000

    def build(self) -> Column:
        c = F.col(self.column)
        match self.kind:
            case "sum":
                return F.sum(c)
            case "max":
                return F.max(c)
            case "min" | "any":
                return F.min(c)
            case "count":
                return F.count(c)
            case "avg":
                return F.struct(F.sum(c.cast("double")).alias("total"), F.count(c).alias("n"))
            case "uniq":
                return F.hll_sketch_agg(c)
            case "quantiles":
                return F.kll_sketch_agg_double(c.cast("double"))
            case "any_if":
                return F.min(F.when(F.expr(self.cond), c))
        raise ValueError(f"unknown state kind {self.kind}")

    def merge(self, name: str) -> Column:
        c = F.col(name)
        match self.kind:
            case "sum" | "count":
                return F.sum(c)
            case "max":
                return F.max(c)
            case "min" | "any" | "any_if":
                return F.min(c)
            case "avg":
                return F.struct(F.sum(c["total"]).alias("total"), F.sum(c["n"]).alias("n"))
            case "uniq":
                return F.hll_union_agg(c)
            case "quantiles":
                return F.kll_merge_agg_double(c)
        raise ValueError(f"unknown state kind {self.kind}")

    def finish(self, name: str) -> Column:
        c = F.col(name)
        match self.kind:
            case "avg":
                return F.try_divide(c["total"], c["n"])
            case "uniq":
                return F.hll_sketch_estimate(c)
            case "quantiles":
                filled = F.kll_sketch_get_n_double(c) > 0  # an empty sketch has no quantiles
                return F.when(filled, F.array(*[F.kll_sketch_get_quantile_double(c, F.lit(float(p))) for p in self.probs]))
        return c


def _split(spec: dict[str, State]) -> tuple[dict[str, State], dict[str, State]]:
    lists = {n: s for n, s in spec.items() if s.kind == "list"}
    return {n: s for n, s in spec.items() if n not in lists}, lists


def _chunks(values: DataFrame, keys, state: State, name: str) -> DataFrame:
    """(keys, ``__v``, ``__o``) as numbered chunks: (keys, chunk, struct of first place, count and items).

    A value's place is its number in its key. Values are numbered over range-sorted rows, so a key of
    any size is spread, and only the values of one chunk come together.
    """
    keys = list(keys)
    by = [f"__o{i}" for i in range(len(state.order))]
    flat = values.select(*keys, *[F.col("__o")[o].alias(b) for o, b in zip(state.order, by)], "__v", "__o")
    numbered = number_rows(flat, [*by, "__v"], keys, "__n").withColumn("chunk", floor_div(F.col("__n") - 1, state.chunk_rows))
    items = F.sort_array(F.collect_list(F.struct("__n", "__o", "__v")))
    packed = numbered.groupBy(*keys, "chunk").agg(items.alias("__a"))
    return packed.select(
        *keys,
        "chunk",
        F.struct(
            (F.col("__a")[0]["__n"] - 1).alias("start"),
            F.size("__a").cast("bigint").alias("n"),
            F.transform("__a", lambda x: F.struct(x["__o"].alias("__o"), x["__v"].alias("__v"))).alias("items"),
        ).alias(name),
    )


def _beside(plain: DataFrame, chunked: list[DataFrame], keys, names) -> DataFrame:
    """One row of plain states and the lists' chunks side by side, by key and chunk number."""
    rows = plain.withColumn("chunk", F.lit(0).cast("bigint"))
    for chunks in chunked:
        rows = rows.unionByName(chunks, allowMissingColumns=True)
    return rows.groupBy(*keys, "chunk").agg(*[F.any_value(n, F.lit(True)).alias(n) for n in names])


def _order_struct(state: State) -> Column:
    # A struct without fields cannot be stored, so a list without an order carries a constant.
    return F.struct(*[F.col(o) for o in state.order]) if state.order else F.struct(F.lit(0).alias("none"))


def to_state(df: DataFrame, keys, spec: dict[str, State]) -> DataFrame:
    """One row of states per key; with list states one per key and chunk, and a column ``chunk``."""
    plain, lists = _split(spec)
    if not lists:
        return df.groupBy(*keys).agg(*[s.build().alias(n) for n, s in spec.items()])
    one = df.groupBy(*keys).agg(*[s.build().alias(n) for n, s in plain.items()]) if plain else df.select(*keys).distinct()
    chunked = []
    for name, s in lists.items():
        values = df.where(F.col(s.column).isNotNull()).select(*keys, F.col(s.column).alias("__v"), _order_struct(s).alias("__o"))
        chunked.append(_chunks(values, keys, s, name))
    return _beside(one, chunked, keys, spec)


def merge_states(df: DataFrame, keys, spec: dict[str, State]) -> DataFrame:
    """Merge stored states to one row per key; lists to one row per key and chunk.

    The lists of all loads are merged in their order: every value gets its place in the merged list
    and the list is cut anew, so the outcome does not depend on how the input was split over loads.
    """
    plain, lists = _split(spec)
    if not lists:
        return df.groupBy(*keys).agg(*[s.merge(n).alias(n) for n, s in spec.items()])
    one = df.groupBy(*keys).agg(*[s.merge(n).alias(n) for n, s in plain.items()]) if plain else df.select(*keys).distinct()
    chunked = []
    for name, s in lists.items():
        values = df.where(F.col(name).isNotNull()).select(*keys, F.explode(F.col(name)["items"]).alias("__i"))
        chunked.append(_chunks(values.select(*keys, "__i.__v", "__i.__o"), keys, s, name))
    return _beside(one, chunked, keys, spec)


def finalize(df: DataFrame, keys, spec: dict[str, State]) -> DataFrame:
    """States to values. With list states each row is one chunk; ``chunk`` numbers a key's rows from 0.

    A list without values is empty on chunk 0. Plain values stand on chunk 0 and are NULL on the others.
    """
    plain, lists = _split(spec)
    if not lists:
        return df.select(*keys, *[s.finish(n).alias(n) for n, s in spec.items()])
    first = F.col("chunk") == 0
    outs = [
        F.coalesce(F.transform(F.col(n)["items"], lambda x: x["__v"]), F.when(first, F.array())).alias(n)
        if n in lists
        else F.when(first, s.finish(n)).alias(n)
        for n, s in spec.items()
    ]
    return df.select(*keys, "chunk", *outs)


def read_aggregating(df: DataFrame, keys, spec: dict[str, State]) -> DataFrame:
    """Merged and finished values of a stored state table."""
    return finalize(merge_states(df, keys, spec), keys, spec)


def collect_state(df: DataFrame, keys, value: str, order, load: int, chunk_rows: int) -> DataFrame:
    """A value-list state: ordered chunks of one load."""
    return collect_groups(df, keys, value, order, chunk_rows).withColumn("load", F.lit(load))


def merge_collected(*states: DataFrame) -> DataFrame:
    """Value lists of several loads: chunks are kept, read them by (load, chunk)."""
    merged = states[0]
    for s in states[1:]:
        merged = merged.unionByName(s)
    return merged
