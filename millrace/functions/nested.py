"""Reshaping nested, zipped and attribute-value data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .casts import parse_list_text


def quoted(name: str) -> str:
    """Column reference for a name that may hold dots or colons."""
    return "`" + name.replace("`", "``") + "`"


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Every struct field becomes a column named by its path; arrays and maps stay."""

    def walk(schema: T.StructType, path: list[str]):
        for field in schema.fields:
            here = [*path, field.name]
            if isinstance(field.dataType, T.StructType):
                yield from walk(field.dataType, here)
            else:
                yield F.col(".".join(quoted(p) for p in here)).alias(sep.join(here))

    return df.select(*walk(df.schema, []))


def rename_by(df: DataFrame, rule) -> DataFrame:
    """Rename all columns with ``rule(name)``."""
    return df.toDF(*[rule(c) for c in df.columns])


def strip_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return rename_by(df, lambda c: c.removeprefix(prefix))


def dots_to_underscores(df: DataFrame) -> DataFrame:
    return rename_by(df, lambda c: c.replace(".", "_"))


def explode_structs(df: DataFrame, array: str, keep: list[str] = ()) -> DataFrame:
    """One row per struct of ``array`` with its fields as columns beside ``keep``."""
    item = "__item"
    return df.select(*keep, F.explode(array).alias(item)).select(*keep, f"{item}.*")


def explode_zipped(df: DataFrame, arrays: dict[str, str], keep: list[str] = ()) -> DataFrame:
    """Parallel arrays to rows. ``arrays`` maps array column to output column.

    Short arrays are padded with NULL; a NULL array anywhere gives no rows.
    """
    zipped = F.arrays_zip(*[F.col(quoted(a)).alias(o) for a, o in arrays.items()])
    kept = [F.col(quoted(k)) for k in keep]
    exploded = df.select(*kept, F.explode(zipped).alias("__z"))
    fields = [F.col("__z").getField(o).alias(o) for o in arrays.values()]
    return exploded.select(*kept, *fields)


def explode_id_text(df: DataFrame, text: str, out: str, to: str = "bigint") -> DataFrame:
    """``"[1,2]"`` text to one row per id; without ids, also for NULL text, one row with NULL."""
    return df.withColumn(out, F.explode_outer(parse_list_text(F.col(quoted(text)), to)))


def explode_days(df: DataFrame, start: str, end: str, out: str) -> DataFrame:
    """One row per calendar day from ``start`` to ``end``, both included."""
    return df.withColumn(out, F.explode(F.sequence(F.to_date(start), F.to_date(end))))


def pairs_to_columns(pairs: Column, codes: dict[str, str], code: str = "code", value: str = "value") -> list[Column]:
    """Array of (``code``, ``value``) structs to one column per wanted code.

    ``codes`` maps attribute code to column name; a code met twice takes its last value.
    """

    def last_of(wanted: str) -> Column:
        return F.try_element_at(F.filter(pairs, lambda p: p[code] == F.lit(wanted)), F.lit(-1))[value]

    return [last_of(wanted).alias(name) for wanted, name in codes.items()]


def key_value_lists(df: DataFrame, text: str, names: dict[str, str]) -> DataFrame:
    """JSON text ``[[[key, value], …], …]`` to one row per record, one column per key."""
    records = df.select(
        *[c for c in df.columns if c != text],
        F.explode(F.from_json(text, "array<array<array<string>>>")).alias("__r"),
    )
    as_pairs = F.transform("__r", lambda kv: F.struct(kv[0].alias("code"), kv[1].alias("value")))
    keep = [c for c in df.columns if c != text]
    return records.select(*keep, *pairs_to_columns(as_pairs, names))


def dims_and_metrics(df: DataFrame, dims: list[str], metrics: list[str], keep: list[str] = ()) -> DataFrame:
    """``dimensions[i].name`` and ``metrics[j]`` to named columns."""
    return df.select(
        *keep,
        *[F.get("dimensions", F.lit(i)).getField("name").alias(n) for i, n in enumerate(dims)],
        *[F.get("metrics", F.lit(j)).alias(n) for j, n in enumerate(metrics)],
    )
