"""Text clean-up and hashing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(col: Column) -> Column:
    return F.when(F.trim(col) != "", col)


def split_part_trim(col: Column, index: int, sep: str = ",", default: str | None = None) -> Column:
    """``index``-th part (from 0), trimmed; missing parts give ``default``."""
    part = F.trim(F.get(F.split(col, sep), F.lit(index)))
    return part if default is None else F.coalesce(part, F.lit(default))


def normalised_md5(col: Column) -> Column:
    return F.md5(F.lower(F.trim(col)))


def bucket_of(n: int, *cols) -> Column:
    """Stable bucket 0..n-1 from the key columns."""
    return F.pmod(F.xxhash64(*cols), F.lit(n).cast("bigint")).cast("int")


def joined_or_null(array: Column, sep: str = ", ") -> Column:
    """Array to text; a NULL array stays NULL (``concat_ws`` alone would give '')."""
    return F.when(array.isNotNull(), F.concat_ws(sep, array))


def without_at(col: Column) -> Column:
    return F.regexp_replace(col, "@", "")


def label_of(code: Column, labels: dict[str, str], unknown: str = "unknown") -> Column:
    """Code to label; an unlisted code is kept, NULL becomes ``unknown``."""
    table = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return F.coalesce(table[code], code, F.lit(unknown))
