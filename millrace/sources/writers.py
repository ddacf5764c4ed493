"""Writing tables so that a second run gives the same result."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sets import delete_insert, upsert
from ..session import materialise, planned_bytes, release
from .readers import jdbc_options, list_files, read_jdbc_table

# Planned bytes of a file, or of a part of it, that one task gets from a shuffle, and most parts of a file.
SHARE = 32 << 20
MOST_PARTS = 32


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", codec: str = "zstd") -> None:
    df.write.mode(mode).option("compression", codec).parquet(path)


def write_partitioned(df: DataFrame, path: str, *by: str, mode: str = "append") -> None:
    """Parquet in one folder per value of ``by``.

    The rows are first brought together per folder, which avoids a file per task and folder;
    the rebalance hint lets adaptive execution split a folder that holds many rows.
    """
    df.hint("rebalance", *map(F.col, by)).write.mode(mode).partitionBy(*by).parquet(path)


def write_format(df: DataFrame, path: str, kind: str, mode: str = "overwrite") -> None:
    """Parquet, CSV (with header) or JSON lines, chosen by name."""
    writer = df.write.mode(mode)
    match kind:
        case "parquet":
            writer.parquet(path)
        case "csv":
            writer.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(path)
        case "json":
            writer.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path)
        case _:
            raise ValueError(f"unknown format {kind}")


def write_files(df: DataFrame, path: str, files: int, merge_only: bool = False) -> DataFrame:
    """Write about ``files`` files and report their sizes.

    ``merge_only`` joins existing partitions without a shuffle; otherwise rows are spread evenly. Where the
    planned share of a file exceeds ``SHARE``, even parts are written aside first, and the task of a file
    reads its parts as Parquet, which are a fraction of the rows it would get from a shuffle.
    """
    spark = df.sparkSession
    # The estimate decides only the number of parts, never the rows.
    parts = 1 if merge_only else min(MOST_PARTS, -(-planned_bytes(df) // (files * SHARE)))
    if parts == 1:
        spread = df.coalesce(files) if merge_only else df.repartition(files)
        spread.write.mode("overwrite").parquet(path)
    else:
        aside = materialise(df.repartition(files * parts), "parts")
        held = sorted(aside.inputFiles())
        # Even parts side by side, one file's after another's, so that each task merges about one file's.
        lots = [spark.read.schema(df.schema).parquet(*held[k::files]) for k in range(min(files, len(held)))]
        reduce(DataFrame.union, lots).coalesce(files).write.mode("overwrite").parquet(path)
        release(aside)
    return list_files(spark, path, ext=".parquet").select("name", "size")


def replace_partitions(df: DataFrame, path: str, *by: str) -> None:
    """Replace exactly the partitions that occur in ``df``; all others stay."""
    (
        df.hint("rebalance", *map(F.col, by))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def write_daily(df: DataFrame, path: str, ts: str, day: str = "day") -> None:
    """One folder per business day; writing a day again replaces it."""
    replace_partitions(df.withColumn(day, F.to_date(ts)), path, day)


def _folders(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Number and path of every version folder, by number."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = [(s.getPath().getName(), s.getPath().toString()) for s in fs.listStatus(root)]
    return sorted((int(name[2:]), where) for name, where in found if name.startswith("v=") and name[2:].isdigit())


def _is_complete(spark: SparkSession, folder: str) -> bool:
    jvm = spark.sparkContext._jvm
    mark = jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def list_versions(spark: SparkSession, path: str) -> list[str]:
    """Complete version folders of a versioned table, oldest first."""
    return [folder for _, folder in _folders(spark, path) if _is_complete(spark, folder)]


def newest_version(spark: SparkSession, path: str) -> str | None:
    """The newest complete version; older ones are not asked for."""
    return next((folder for _, folder in reversed(_folders(spark, path)) if _is_complete(spark, folder)), None)


def _add_version(df: DataFrame, path: str) -> str:
    """A table cannot be overwritten while it is read, so versions are written side by side."""
    taken = _folders(df.sparkSession, path)
    version = f"{path}/v={taken[-1][0] + 1 if taken else 1:06d}"
    df.write.mode("errorifexists").parquet(version)
    return version


def keep_versions(spark: SparkSession, path: str, last: int) -> list[str]:
    """Remove all but the ``last`` complete versions; returns what was removed.

    Readers of a removed version fail, so ``last`` must cover the longest-running one.
    """
    if last < 1:
        raise ValueError("at least one version must stay")
    jvm = spark.sparkContext._jvm
    gone = list_versions(spark, path)[:-last]
    for folder in gone:
        where = jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    return gone


def read_version(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version of a versioned table."""
    return spark.read.parquet(newest_version(spark, path))


def full_refresh(df: DataFrame, path: str) -> str:
    """Reload the whole table as a new version; readers keep the old one until it is complete."""
    return _add_version(df, path)


def delete_insert_by_key(stage: DataFrame, path: str, keys) -> str:
    """Remove the staged keys from the table, then add the staged rows; as a new version."""
    spark = stage.sparkSession
    if newest_version(spark, path) is None:
        return full_refresh(stage, path)
    return _add_version(delete_insert(read_version(spark, path), stage, keys), path)


def upsert_by_key(changes: DataFrame, path: str, keys, seq: str | None = None) -> str:
    """Insert rows with new keys and replace rows with known ones; as a new version."""
    spark = changes.sparkSession
    if newest_version(spark, path) is None:
        return full_refresh(upsert(changes.limit(0), changes, keys, seq), path)
    return _add_version(upsert(read_version(spark, path), changes, keys, seq), path)


def upsert_buckets(changes: DataFrame, path: str, keys, buckets: int, seq: str | None = None, bucket: str = "bucket") -> None:
    """Upsert into a table partitioned by a hash bucket of the key; only touched buckets are rewritten.

    The rows of touched buckets are written aside first, because a folder cannot be replaced
    while it is read. The number of buckets must stay that of the first call.
    """
    spark = changes.sparkSession
    place = F.pmod(F.xxhash64(*[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]), F.lit(buckets)).cast("int")
    new = changes.withColumn(bucket, place)
    touched = [r[0] for r in new.select(bucket).distinct().collect()]  # at most ``buckets``
    if not touched:
        return
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    known = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(root)
    old = spark.read.schema(new.schema).parquet(path).where(F.col(bucket).isin(touched)) if known else new.limit(0)
    merged = materialise(upsert(old, new, [*keys, bucket], seq).select(*new.columns), "upsert")
    replace_partitions(merged, path, bucket)


def write_jdbc(
    df: DataFrame, url: str, table: str, mode: str = "append", batch: int = 50_000, writers: int = 8, truncate: bool = False, **more
) -> None:
    """Append to or refill a JDBC table with a fixed number of writing connections."""
    options = jdbc_options(url, table=table, batchsize=batch, numPartitions=writers, truncate=str(truncate).lower(), **more)
    df.write.format("jdbc").options(**options).mode(mode).save()


def copy_jdbc(spark: SparkSession, source: dict, target: dict) -> None:
    """Copy a table from one JDBC store to another.

    ``source`` holds the arguments of ``read_jdbc_table``, ``target`` those of ``write_jdbc``.
    """
    write_jdbc(read_jdbc_table(spark, **source), **target)


def bucket_count(held: int, per_bucket: int = 256 << 20, least: int = 1) -> int:
    """Buckets for ``held`` bytes; a power of two, so that tables of several sizes still match."""
    return 1 << max(least - 1, -(-held // per_bucket) - 1, 0).bit_length()


def write_bucketed(df: DataFrame, table: str, path: str, key: str | list[str], buckets: int) -> DataFrame:
    """Write hash buckets of ``key``, sorted, so that joins on the key need no shuffle.

    All rows of a key are in one bucket; ``write_colocated`` splits heavy keys.
    """
    keys = [key] if isinstance(key, str) else key
    (
        df.repartition(buckets, *keys)
        .write.bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", path)
        .mode("errorifexists")
        .format("parquet")
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)


def heavy_keys(df: DataFrame, key: str, buckets: int, sample_rows: int = 1_000_000) -> DataFrame:
    """Keys that would fill half a bucket or more by themselves, as (``__heavy``, ``__parts``): some ``2 * buckets`` rows at most.

    Counted in a sample of about ``sample_rows`` rows. The sample decides only how evenly the rows lie:
    a heavy key that it misses stays in one bucket. NULL is not a key here.
    """
    total = df.count()
    part = min(1.0, sample_rows / max(total, 1))
    sample = df.select(F.col(key).alias("__heavy")).where("__heavy IS NOT NULL").sample(part, seed=1)
    share = F.col("count") / F.lit(max(total * part, 1.0))
    counted = sample.groupBy("__heavy").count().where(share * buckets >= 0.5)
    split = counted.select("__heavy", F.least(F.ceil(2 * share * buckets), F.lit(buckets)).cast("int").alias("__parts"))
    return materialise(split, "heavy")


def write_colocated(
    many: DataFrame, one: DataFrame, tables: tuple[str, str], paths: tuple[str, str], keys: tuple[str, str], buckets: int, part: str = "part"
) -> tuple[DataFrame, DataFrame]:
    """Write two tables in buckets of (key, ``part``), so that joining them on both columns needs no shuffle.

    A heavy key of ``many`` is dealt over its parts by a hash of the row, and its rows in ``one`` are
    repeated once per part, so every pair meets exactly once. Give as ``one`` the side with few rows per
    key. Other keys have part 0 alone. Rows of ``many`` with a NULL key are spread and match nothing; read
    ``one`` by itself with ``part = 0`` to have each of its rows once. Later joins of ``many``
    with further tables written in the same buckets do not shuffle either.
    """
    key, other = keys
    heavy = heavy_keys(many, key, buckets)
    number = F.xxhash64(*[F.to_json(F.struct(c)) if _no_hash(many.schema[c].dataType) else F.col(c) for c in many.columns])
    parts = F.when(F.col(key).isNull(), F.lit(buckets)).otherwise(F.coalesce("__parts", F.lit(1)))
    dealt = (
        many.join(F.broadcast(heavy), F.col(key) == F.col("__heavy"), "left")
        .withColumn(part, F.pmod(number, parts).cast("int"))
        .select(*many.columns, part)
    )
    copies = F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1)
    repeated = (
        one.join(F.broadcast(heavy), F.col(other) == F.col("__heavy"), "left")
        .withColumn(part, F.explode(copies))
        .select(*one.columns, part)
    )
    left = write_bucketed(dealt, tables[0], paths[0], [key, part], buckets)
    right = write_bucketed(repeated, tables[1], paths[1], [other, part], buckets)
    release(heavy)
    return left, right


def _no_hash(kind) -> bool:
    return "map<" in kind.simpleString()
