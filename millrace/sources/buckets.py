"""Tables in hash buckets of a key that are changed at the grain of the change.

A change rewrites only the buckets that hold its keys. The table grows by linear hashing: one bucket
after another is split in two, so growing never rewrites more than the buckets that are split, and a key's
bucket follows from the number of buckets alone. A manifest names the folder and the rows of
every bucket, so its number is known to each later call.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sets import delete_insert, upsert
from ..session import materialise, release
from .manifests import commit, manifest

BUCKET = "__bucket"
ROWS = 1 << 20


def parent(bucket: int) -> int:
    """The bucket that ``bucket`` was split from."""
    return bucket - (1 << (bucket.bit_length() - 1))


def bucket_of(keys, buckets: int) -> Column:
    """A key's bucket among any number of buckets; NULL is a key like others."""
    low = 1 << (buckets.bit_length() - 1)
    h = F.xxhash64(*[F.col(k).isNull() for k in keys], *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    wide, narrow = h.bitwiseAND(2 * low - 1), h.bitwiseAND(low - 1)
    return F.when(wide < buckets, wide).otherwise(narrow).cast("int")


def _read(spark: SparkSession, path: str, rows: list[dict]) -> DataFrame | None:
    held = [f"{path}/data/{r['folder']}/{BUCKET}={r['bucket']}" for r in rows if r["folder"]]
    return spark.read.parquet(*held) if held else None


def read_buckets(spark: SparkSession, path: str) -> DataFrame | None:
    """All rows of the table; None before it has any."""
    return _read(spark, path, manifest(spark, path))


def _change(changes: DataFrame, path: str, keys, merge: Callable[[DataFrame, DataFrame], DataFrame], rows: int) -> int:
    spark, now = changes.sparkSession, manifest(changes.sparkSession, path)
    changes = materialise(changes, "changes")
    before = len(now)
    after = max(1, before, -(-(sum(r["rows"] for r in now) + changes.count()) // rows))
    touched = {r[0] for r in changes.select(bucket_of(keys, before)).distinct().collect()} if before else set()  # at most ``before``
    for new in range(before, after) if before else ():
        while new >= before:
            new = parent(new)
        touched.add(new)
    old = _read(spark, path, [r for r in now if r["bucket"] in touched])
    merged = merge(changes.limit(0) if old is None else old.select(*changes.columns), changes).withColumn(BUCKET, bucket_of(keys, after))
    folder = f"change={max((r['change'] for r in now), default=-1) + 1}"
    merged.hint("rebalance", F.col(BUCKET)).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/data/{folder}")
    written = spark.read.schema(merged.schema).parquet(f"{path}/data/{folder}").groupBy(BUCKET).count().collect()  # at most ``after``
    counts = {r[0]: r[1] for r in written}
    kept = [r | {"change": int(folder.split("=")[1])} for r in now if r["bucket"] not in touched]
    fresh = [b for b in range(after) if b >= before or b in touched]
    kept += [{"bucket": b, "folder": folder if b in counts else None, "rows": counts.get(b, 0), "change": int(folder.split("=")[1])} for b in fresh]
    commit(spark, path, sorted(kept, key=lambda r: r["bucket"]))
    release(changes)
    return after


def upsert_rows(changes: DataFrame, path: str, keys, seq: str | None = None, rows: int = ROWS) -> int:
    """Insert rows with new keys and replace those with known ones; returns the number of buckets.

    Buckets are split so that they hold about ``rows`` rows each. Changes are first reduced to one row per
    key, so that a key which changes often does not count as many.
    """
    newest = upsert(changes.limit(0), changes, keys, seq)
    return _change(newest, path, keys, lambda old, new: upsert(old, new, keys, seq), rows)


def delete_insert_rows(stage: DataFrame, path: str, keys, rows: int = ROWS) -> int:
    """Remove the staged keys from the table, then add the staged rows; returns the number of buckets."""
    return _change(stage, path, keys, lambda old, new: delete_insert(old, new, keys), rows)
