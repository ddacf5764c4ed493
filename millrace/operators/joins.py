"""Joins beyond the plain equi join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.texts import normalised_md5
from ..session import planned_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = 64 << 20) -> DataFrame:
    """Mark for broadcast only while the planned size stays below the limit.

    Beyond it the frame is returned as it is and the join shuffles.
    """
    return F.broadcast(df) if planned_bytes(df) <= max_bytes else df


def broadcast_if_measured(df: DataFrame, max_bytes: int = 64 << 20) -> DataFrame:
    """Mark for broadcast only if the data, measured in one aggregation, is below the limit.

    For derived frames, whose planned size says little. Beyond the limit the frame is returned
    as it is and the join shuffles.
    """
    width = F.octet_length(F.to_json(F.struct("*")))
    held = df.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]
    return F.broadcast(df) if held <= max_bytes else df


def join_text_id(left: DataFrame, right: DataFrame, left_id: str, right_id: str, how: str = "inner") -> DataFrame:
    """Join a numeric id with a text id; text that is no number matches nothing."""
    kind = left.schema[left_id].dataType
    clean = right.withColumn("__id", F.col(right_id).try_cast(kind)).where(F.col("__id").isNotNull())
    return left.join(clean, left[left_id] == clean["__id"], how).drop("__id")


def join_by_text_hash(left: DataFrame, right: DataFrame, text: str, hash_col: str) -> DataFrame:
    """Left join on the md5 of the lower-cased, trimmed text."""
    keyed = left.withColumn("__h", normalised_md5(F.col(text)))
    return keyed.join(right, keyed["__h"] == right[hash_col], "left").drop("__h", hash_col)


def first_event(df: DataFrame, keys, order) -> DataFrame:
    """The whole earliest row per key, in one aggregation instead of min-and-join-back."""
    from .ordering import pick_one

    return pick_one(df, keys, order)
