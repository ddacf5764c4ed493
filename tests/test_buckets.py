"""Bucketed tables that grow by splitting single buckets."""

import os
import random

from pyspark.sql import functions as F

from millrace.sources.buckets import BUCKET, bucket_of, delete_insert_rows, parent, read_buckets, upsert_rows
from millrace.sources.manifests import manifest

from .conftest import rows

KIND = "id long, v string, seq int"


def test_buckets_split_one_by_one(spark):
    keys = spark.range(2000).withColumn("id", F.when(F.col("id") % 500 != 7, F.col("id")))
    placed = keys.select(*[bucket_of(["id"], n).alias(f"b{n}") for n in range(1, 65)]).collect()
    for r in placed:
        for n in range(1, 64):
            now, then = r[f"b{n}"], r[f"b{n + 1}"]
            assert 0 <= now < n and then in (now, n) and (then == now or parent(n) == now)
    assert len({r["b64"] for r in placed}) == 64


def test_grows_from_four_to_many(spark, folder):
    rng, truth, seq = random.Random(4), {}, 0
    sizes = [40, 60, 5, 200, 300, 1]
    counts = []
    for size in sizes:
        batch = []
        for _ in range(size):
            seq += 1
            key = None if rng.random() < 0.02 else rng.randrange(700)
            batch.append((key, f"v{seq}", seq))
        batch += [(batch[0][0], "older", 0)]
        for k, v, s in batch:
            if s:
                truth[k] = (k, v, s)
        counts.append(upsert_rows(spark.createDataFrame(batch, KIND), folder, ["id"], "seq", rows=10))
        assert rows(read_buckets(spark, folder)) == sorted(truth.values(), key=lambda t: tuple((v is None, str(v)) for v in t))
    assert counts[0] >= 4 and counts == sorted(counts) and counts[-1] >= 30
    held = manifest(spark, folder)
    assert [r["bucket"] for r in held] == list(range(counts[-1])) and sum(r["rows"] for r in held) == len(truth)


def test_untouched_buckets_keep_their_files(spark, folder):
    upsert_rows(spark.range(400).select("id", F.lit("a").alias("v"), F.lit(1).alias("seq")), folder, ["id"], "seq", rows=50)

    def files():
        root = folder.removeprefix("file:")
        return {
            (r["bucket"], f): os.stat(os.path.join(root, "data", r["folder"], f"{BUCKET}={r['bucket']}", f)).st_mtime_ns
            for r in manifest(spark, folder)
            for f in os.listdir(os.path.join(root, "data", r["folder"], f"{BUCKET}={r['bucket']}"))
        }

    before = files()
    upsert_rows(spark.createDataFrame([(7, "b", 2)], KIND), folder, ["id"], "seq", rows=50)
    after = files()
    # One bucket for the key, and as the table is over its measure by one row, one more that is split.
    assert len({b for b, _ in after.keys() - before.keys()}) <= 3
    assert all(after[k] == before[k] for k in after.keys() & before.keys()) and len(after.keys() & before.keys()) >= 6
    assert read_buckets(spark, folder).where("id = 7").first()["v"] == "b" and read_buckets(spark, folder).count() == 400


def test_delete_insert(spark, folder):
    assert read_buckets(spark, folder) is None
    first = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 3), (None, "d", 4)], KIND)
    delete_insert_rows(first, folder, ["id"], rows=2)
    delete_insert_rows(spark.createDataFrame([(1, "x", 5), (None, "y", 6), (9, "z", 7)], KIND), folder, ["id"], rows=2)
    delete_insert_rows(spark.createDataFrame([], KIND), folder, ["id"], rows=2)
    assert rows(read_buckets(spark, folder)) == rows(spark.createDataFrame([(1, "x", 5), (2, "c", 3), (None, "y", 6), (9, "z", 7)], KIND))


def test_many_changes_of_few_keys_make_few_buckets(spark, folder):
    changes = spark.range(5000).select((F.col("id") % 20).alias("id"), F.col("id").cast("string").alias("v"), F.col("id").cast("int").alias("seq"))
    assert upsert_rows(changes, folder, ["id"], "seq", rows=10) == 2
    assert rows(read_buckets(spark, folder)) == rows(changes.where("seq >= 4980"))
