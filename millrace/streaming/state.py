"""The current row of every key, kept up to date by micro-batches of change events.

The table lies in hash buckets of the key. A batch is reduced to the newest change per key, merged
with the buckets it touches, and these are written as new folders; a manifest then names the folder of
each bucket and the number of the batch, in one step. A batch that is run again is left out. Rows are
ordered by their own time and position, not by arrival, and deleted keys stay as marks, so an
older change that comes late changes nothing. Reading needs no reduction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import pick_one
from ..sources.manifests import commit, manifest
from .streams import trigger_args


def apply_changes(changes: DataFrame, path: str, number: int, key: str, position: str | None = None, buckets: int = 64) -> bool:
    """Merge parsed changes (before, after, op, ts_ms, position) as batch ``number``; False if it was merged before."""
    spark = changes.sparkSession
    now = manifest(spark, path)
    if now and now[0]["buckets"] != buckets:
        raise ValueError(f"the table has {now[0]['buckets']} buckets")
    if any(r["applied"] >= number for r in now):
        return False
    order = ["ts_ms", *([position] if position else [])]
    keyed = changes.withColumn("__k", F.coalesce(F.col("after")[key], F.col("before")[key]))
    bucket = F.pmod(F.xxhash64("__k"), F.lit(buckets)).cast("int")
    new = pick_one(keyed.select("__k", "after", "op", *order), ["__k"], order, last=True).withColumn("bucket", bucket)
    touched = {r[0] for r in new.select("bucket").distinct().collect()}  # at most ``buckets``
    held = {r["bucket"]: r["folder"] for r in now if r["folder"]}
    old = [f"{path}/data/{held[b]}/bucket={b}" for b in sorted(touched & held.keys())]
    if old:
        before = spark.read.schema(new.drop("bucket").schema).parquet(*old).withColumn("bucket", bucket)
        new = pick_one(before.unionByName(new), ["__k"], order, last=True)
    if touched:
        new.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/data/batch={number}")
    held |= {b: f"batch={number}" for b in touched}
    commit(spark, path, [{"bucket": b, "folder": held.get(b), "applied": number, "buckets": buckets} for b in range(buckets)])
    return True


def run_state(changes: DataFrame, path: str, checkpoint: str, key: str, position: str | None = None, buckets: int = 64, mode: str = "drain") -> None:
    """Keep the table of a stream of parsed changes."""
    run = changes.writeStream.foreachBatch(lambda batch, number: apply_changes(batch, path, number, key, position, buckets) and None)
    run.option("checkpointLocation", checkpoint).trigger(**trigger_args(mode)).start().awaitTermination()


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """The current row of every key that is not deleted."""
    now = manifest(spark, path)
    held = [f"{path}/data/{r['folder']}/bucket={r['bucket']}" for r in now if r["folder"]]
    if not held:
        raise ValueError(f"no rows were ever written to {path}")
    return spark.read.parquet(*held).where("op <> 'd' AND after IS NOT NULL").select("after.*")
