"""Loads that continue where the last one ended."""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sets import without_keys
from ..session import materialise
from ..streaming.streams import file_source, trigger_args
from .readers import list_files
from .writers import replace_partitions

_BATCH = "load_batch"


def existing(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None when there is no such path or no data file in it; other errors are raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def newest_day(spark: SparkSession, path: str, day: str) -> str | None:
    """The newest day of a table partitioned by ``day``, from folder names; no file is opened."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return None
    names = [s.getPath().getName().partition("=") for s in fs.listStatus(root) if s.isDirectory()]
    return max((value for key, _, value in names if key == day and value[:1].isdigit()), default=None)


def past_mark(source: DataFrame, target: DataFrame | None, ts: str, keys, day: str | None = None, newest: str | None = None) -> DataFrame:
    """Source rows the target does not hold yet, judged by the target's highest ``ts``.

    With ``day``, the date of ``ts`` by which the target is partitioned, and ``newest``, its newest
    day, only that partition and the one without a day are read.

    The mark is a literal, so the filter reaches the source scan. Rows with exactly that time, and
    rows without a time, are taken unless their key is already there, in every load.
    """
    if target is None:
        return source
    kind = source.schema[ts].dataType.simpleString()
    last = target.where(F.col(day) == F.lit(newest).cast("date")) if day and newest else target
    undated = target.where(F.col(day).isNull()) if day else target.where(F.col(ts).isNull())
    mark = last.agg(F.max(ts).cast("string")).first()[0]
    none = without_keys(source.where(F.col(ts).isNull()), undated, keys)
    if mark is None:
        return source.where(F.col(ts).isNotNull()).unionByName(none)
    edge = F.lit(mark).cast(kind)
    return without_keys(source.where(F.col(ts) >= edge), last.where(F.col(ts) == edge), keys).unionByName(none)


def load_past_mark(source: DataFrame, path: str, ts: str, keys, day: str = "event_date") -> DataFrame:
    """Append the new rows to a table partitioned by day; returns the whole table."""
    spark = source.sparkSession
    new = past_mark(source, existing(spark, path), ts, keys, day, newest_day(spark, path, day))
    rows = new.withColumn(day, F.to_date(ts))
    rows.hint("rebalance", F.col(day)).write.mode("append").partitionBy(day).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def file_mark(spark: SparkSession, state: str, source: str) -> str | None:
    """Stored mark of a source, or None before its first load."""
    marks = existing(spark, state)
    if marks is None:
        return None
    return marks.where(F.col("source") == source).agg(F.max("max_modified").cast("string")).first()[0]


def load_new_files(
    spark: SparkSession,
    folder: str,
    state: str,
    source: str,
    process: Callable[[list[str]], None],
    ext: str = ".parquet",
    group: int = 10_000,
) -> int:
    """Process files modified since the stored mark, oldest first, at most ``group`` at a time.

    The mark moves after each group. It is the newest modification time processed, not the clock,
    and the files of just that time are stored with it: others of the same time are still new.
    """
    mark = file_mark(spark, state, source)
    files = list_files(spark, folder, since=mark, ext=ext, at_since=True)
    if mark is not None:
        seen = spark.read.parquet(state).where((F.col("source") == source) & (F.col("max_modified") == F.lit(mark).cast("timestamp")))
        files = files.join(seen.select("path"), "path", "left_anti")
    found = materialise(files.select("path", "modified"), "files").orderBy("modified", "path").toLocalIterator()
    done = 0
    for rows in iter(lambda: list(itertools.islice(found, group)), []):
        process([f.path for f in rows])
        top = max(f.modified for f in rows)
        last = [(source, f.modified, f.path) for f in rows if f.modified == top]
        marks = spark.createDataFrame(last, "source string, max_modified timestamp, path string")
        marks.coalesce(1).write.mode("append").parquet(state)
        done += len(rows)
    return done


def load_files_once(
    spark: SparkSession,
    folder: str,
    schema,
    table: str,
    state: str,
    kind: str = "parquet",
    per_batch: int | None = None,
    change: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Load the files a folder has gained into a table, each file once; returns the whole table.

    The file source's own log in ``state`` holds which file belongs to which batch, and is written
    before a batch begins. A batch is a folder of the table named by its number and replaces it. So a
    load that ends between the data and the mark does the same batch over the same files again,
    into the same folder. ``change`` is applied to a batch's rows, which may repeat.

    Unlike a mark by modification time, files that appear late with an old time are loaded too.
    A file that is changed after its load is not loaded again.
    """
    stream = file_source(spark, folder, schema, kind, per_batch)

    def put(rows: DataFrame, batch: int) -> None:
        rows = change(rows) if change else rows
        rows.write.mode("overwrite").parquet(f"{table}/{_BATCH}={batch}")

    query = stream.writeStream.foreachBatch(put).option("checkpointLocation", state).trigger(**trigger_args("drain")).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()
    loaded = existing(spark, table)
    if loaded is not None:
        return loaded.drop(_BATCH)
    empty = spark.read.schema(schema).format(kind).load(folder).limit(0)
    return change(empty) if change else empty


def backfill(source: DataFrame, path: str, ts: str, first: str, last: str, day: str = "day") -> None:
    """Load the days ``first`` to ``last`` again, each replacing its own partition.

    Days without rows are passed over; they do not end the run.
    """
    until = F.date_add(F.lit(last).cast("date"), 1).cast(source.schema[ts].dataType)
    wanted = source.where((F.col(ts) >= F.lit(first).cast(source.schema[ts].dataType)) & (F.col(ts) < until))
    replace_partitions(wanted.withColumn(day, F.to_date(ts)), path, day)
