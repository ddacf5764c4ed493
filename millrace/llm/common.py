"""Helpers shared by the text operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise

# Rows per Arrow batch. Documents may hold 100 KB and more; a batch must stay small in a worker.
BATCH_ROWS = 256
# A side is broadcast only if it was counted and its rows times their width stay below this.
BROADCAST_BYTES = 32 << 20


# The folder that holds this package, for workers that were not started in it.
_ROOT = str(Path(__file__).resolve().parents[2])


def bounded_batches(spark: SparkSession) -> None:
    """Limit the rows of an Arrow batch; text tasks hold one batch at a time.

    Python workers also get this package's folder on their path, as the driver may have it only
    on its own. On a cluster without that folder the package has to be installed or sent along.
    """
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, _ROOT])
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


_HELD: list = [None, None]


def kept_in_worker(owner, make: Callable):
    """What a worker process keeps between tasks: one value of one owner; another owner's is dropped first."""
    if _HELD[0] != owner:
        _HELD[:] = owner, None
        _HELD[1] = make()
    return _HELD[1]


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with batches of a bounded number of rows."""
    bounded_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of a batch as UTF-8 bytes; NULL becomes empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def row_key(text: str = "text") -> Column:
    """Tells rows of one doc_id apart by their text; equal rows are interchangeable."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Write a derived frame once and return it with its row count."""
    kept = materialise(df, label)
    return kept, kept.count()


def broadcast_if_counted(df: DataFrame, rows: int, width: int) -> DataFrame:
    """Broadcast when ``rows`` of at most ``width`` bytes fit; beyond that the join shuffles."""
    return F.broadcast(df) if rows * width <= BROADCAST_BYTES else df


def mix64(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit integers."""
    x = values.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(33)
        x *= np.uint64(0xFF51AFD7ED558CCD)
        x ^= x >> np.uint64(33)
        x *= np.uint64(0xC4CEB9FE1A85EC53)
        x ^= x >> np.uint64(33)
    return x
