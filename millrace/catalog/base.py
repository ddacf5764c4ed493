"""Registry of runnable queries and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, dates: str = ""):
    """Register ``fn(load, spark)``; ``load(table)`` reads a supplied table.

    ``dates`` names result columns of type date. Both engines give them as text, because their
    Python clients return dates as different types.
    """
    days = dates.split()

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = fn(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"), spark)
            return out.withColumns({d: F.col(d).cast("string") for d in days}) if days else out

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            as_text = ", ".join(f"CAST({d} AS VARCHAR) AS {d}" for d in days)
            ORACLES[name] = f"SELECT * REPLACE ({as_text}) FROM ({sql})" if days else sql
        return fn

    return add


def k_of(props: str = "props") -> Column:
    """The number inside an event's JSON properties."""
    return F.get_json_object(props, "$.k").cast("int")


K_SQL = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


def half_up(expr: str, digits: int = 2) -> str:
    """SQL that rounds the decimal text of a double, ties away from zero, like Spark."""
    return f"CAST(round(CAST({expr} AS DECIMAL(28,12)), {digits}) AS DOUBLE)"


def money(expr: str) -> str:
    """SQL for an order-independent sum of two-digit doubles."""
    return f"CAST(sum(CAST({expr} AS DECIMAL(18,2))) AS DOUBLE)"
