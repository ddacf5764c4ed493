"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "millrace", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library is written for: UTC, ANSI and AQE on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or the one already set.

    Only a local session that names no folder gets one of its own, because a machine-local
    path would be lost with its executor on a cluster.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):  # local-cluster has machines of its own
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="millrace-")
    spark.sparkContext.setCheckpointDir(own)
    return own


_MADE: list[str] = []
_PATHS: dict[int, tuple[DataFrame, str]] = {}


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder; ``remove_scratch`` frees it."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def remove_scratch(spark: SparkSession, *paths: str) -> int:
    """Remove the given scratch paths, or all that this process made; returns how many there were.

    Frames that read them fail afterwards, so this belongs at the end of a job, after its results
    were written elsewhere. Paths that this process did not make are an error.
    """
    wanted = list(paths) or list(_MADE)
    if unknown := [p for p in wanted if p not in _MADE]:
        raise ValueError(f"not made here: {unknown}")
    for key in [k for k, (_, path) in _PATHS.items() if path in wanted]:
        del _PATHS[key]
    for path in wanted:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        _MADE.remove(path)
    return len(wanted)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage so that values which depend on the physical layout (partition numbers,
    positions) stay fixed when executors are lost, and lets later steps read single columns.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    _PATHS[id(kept)] = kept, path
    return kept


def release(*frames: DataFrame) -> None:
    """Remove what ``materialise`` wrote for the given frames, once nothing will read them again."""
    for df in frames:
        _, path = _PATHS.pop(id(df))
        remove_scratch(df.sparkSession, path)


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimised plan; no job is run."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
