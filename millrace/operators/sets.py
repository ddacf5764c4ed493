"""Unions and de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import pick_one, same_keys


def union_named(*dfs: DataFrame) -> DataFrame:
    """Union by column name."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def union_coerced(schema: dict[str, str], *dfs: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Union of tables whose columns differ in type; what does not parse becomes NULL or its default."""
    defaults = defaults or {}

    def shaped(d: DataFrame) -> DataFrame:
        cols = []
        for name, kind in schema.items():
            c = F.col(name).try_cast(kind) if name in d.columns else F.lit(None).cast(kind)
            if name in defaults:
                c = F.coalesce(c, F.lit(defaults[name]).cast(kind))
            cols.append(c.alias(name))
        return d.select(*cols)

    return union_named(*[shaped(d) for d in dfs])


def dedup_key(df: DataFrame, keys, order) -> DataFrame:
    """One row per key, the lowest by ``order``; rows with NULL there only if there is no other."""
    return pick_one(df, keys, order)


def upsert(target: DataFrame, changes: DataFrame, keys, seq: str | None = None) -> DataFrame:
    """Rows of ``changes`` replace or join those of ``target`` on ``keys``.

    When a key comes several times in ``changes``, the highest ``seq`` wins.
    """
    rank = F.col(seq) if seq else F.lit(0)
    cols = target.columns
    both = target.withColumn("__new", F.lit(0)).withColumn("__seq", F.lit(None).cast(changes.select(rank).schema[0].dataType))
    new = changes.withColumn("__new", F.lit(1)).withColumn("__seq", rank).select(*cols, "__new", "__seq")
    return pick_one(both.unionByName(new), keys, ["__new", "__seq"], last=True).select(*cols)


def delete_insert(target: DataFrame, stage: DataFrame, keys) -> DataFrame:
    """Target without the staged keys, plus the staged rows. NULL is a key like others."""
    return without_keys(target, stage, keys).unionByName(stage)


def without_keys(df: DataFrame, other: DataFrame, keys) -> DataFrame:
    """Rows of ``df`` whose key ``other`` does not hold; NULL equals NULL."""
    return same_keys(df, other.select(*keys).distinct(), list(keys), "left_anti")
