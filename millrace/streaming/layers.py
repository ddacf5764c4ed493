"""Tables that micro-batches add to: folders named by a manifest and merged in levels.

Every batch is one folder. As soon as a level has ``fan`` folders they are merged into one of the next
level, so that a table of n batches has fewer than ``fan`` folders for each of log(n) levels. The manifest
is a versioned table of a few rows; a reader takes the folders of its newest complete version and
sees all rows before, during and after a merge. A batch that is run again is known by its number
and leaves the table as it is.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

from ..sources.manifests import commit, manifest
from .streams import trigger_args

FAN = 8


@dataclass(frozen=True)
class Folder:
    """One folder of a table: the batches ``first`` to ``last``."""

    folder: str
    level: int
    first: int
    last: int


def folders(spark: SparkSession, path: str) -> list[Folder]:
    """The folders of the table, by level and batch; fewer than ``fan`` a level."""
    return sorted((Folder(**r) for r in manifest(spark, path)), key=lambda f: (f.level, f.first))


def applied(spark: SparkSession, path: str) -> int:
    """The number of the last batch in the table, -1 without one."""
    return max((f.last for f in folders(spark, path)), default=-1)


def _read(spark: SparkSession, path: str, some: list[Folder]) -> DataFrame:
    return spark.read.parquet(*[f"{path}/data/{f.folder}" for f in some])


def read_layers(spark: SparkSession, path: str) -> DataFrame | None:
    """All rows of the table; None before its first batch."""
    now = folders(spark, path)
    return _read(spark, path, now) if now else None


def add_batch(df: DataFrame, path: str, number: int, merge: Callable[[DataFrame], DataFrame] | None = None, fan: int = FAN) -> bool:
    """Add batch ``number`` and merge full levels; False if the table has that batch already.

    ``merge`` turns the rows of several folders into those of one; without it they stay as they are.
    Adaptive execution joins small parts up to its target size and splits large ones.
    """
    spark = df.sparkSession
    if number <= applied(spark, path):
        return False
    now = [*folders(spark, path), Folder(f"b={number}", 0, number, number)]
    df.hint("rebalance").write.mode("overwrite").parquet(f"{path}/data/b={number}")
    level = 0
    while len(full := [f for f in now if f.level == level]) >= fan:
        level += 1
        whole = Folder(f"l={level}-{full[0].first}-{full[-1].last}", level, full[0].first, full[-1].last)
        rows = _read(spark, path, full)
        (merge(rows) if merge else rows).hint("rebalance").write.mode("overwrite").parquet(f"{path}/data/{whole.folder}")
        now = [f for f in now if f not in full] + [whole]
    commit(spark, path, [asdict(f) for f in now])
    return True


def run_layers(df: DataFrame, path: str, checkpoint: str, mode: str = "drain", merge=None, fan: int = FAN) -> None:
    """Write a stream's micro-batches to such a table."""
    run = df.writeStream.foreachBatch(lambda batch, number: add_batch(batch, path, number, merge, fan) and None)
    run.option("checkpointLocation", checkpoint).trigger(**trigger_args(mode)).start().awaitTermination()
