"""Manifests: small files that say which folders of a table hold its rows.

A manifest is written under the next number and renamed when it is complete, so readers see
the table before or after a change and nothing between. Data folders that none of the last ``KEPT``
manifests name are removed; a reader may take as long as that many changes.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

KEPT = 4


def _place(spark: SparkSession, path: str):
    """A path and its file system."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    where, fs = _place(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def _manifests(spark: SparkSession, path: str) -> list[str]:
    """Names of the complete manifests, oldest first."""
    return [n for n in _names(spark, f"{path}/manifest") if n.endswith(".json")]


def _rows(spark: SparkSession, path: str, name: str) -> list[dict]:
    where, fs = _place(spark, f"{path}/manifest/{name}")
    stream = fs.open(where)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def manifest(spark: SparkSession, path: str) -> list[dict]:
    """The rows of the newest manifest; none before the first."""
    names = _manifests(spark, path)
    return _rows(spark, path, names[-1]) if names else []


def commit(spark: SparkSession, path: str, rows: list[dict]) -> None:
    """Make ``rows`` the manifest, then remove data folders that none of the last ``KEPT`` manifests name."""
    names = _manifests(spark, path)
    number = int(names[-1].split(".")[0]) + 1 if names else 0
    draft, fs = _place(spark, f"{path}/manifest/{number:012d}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(rows).encode()))
    out.close()
    if not fs.rename(draft, _place(spark, f"{path}/manifest/{number:012d}.json")[0]):
        raise RuntimeError(f"manifest {number} of {path} was written by another run")
    names = _manifests(spark, path)
    used = {r["folder"] for n in names[-KEPT:] for r in _rows(spark, path, n)}
    old = [f"manifest/{n}" for n in names[:-KEPT]]
    for gone in old + [f"data/{n}" for n in _names(spark, f"{path}/data") if n not in used]:
        fs.delete(_place(spark, f"{path}/{gone}")[0], True)
