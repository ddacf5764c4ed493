"""Casts that never raise, casts that wrap, and casts that always raise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Type names of the target store and the Spark types that hold them.
TYPE_MAP = {
    "uint8": "smallint",
    "uint16": "int",
    "uint32": "bigint",
    "uint64": "decimal(20,0)",
    "int8": "tinyint",
    "int16": "smallint",
    "int32": "int",
    "int64": "bigint",
    "float32": "float",
    "float64": "double",
    "string": "string",
    "date": "date",
    "datetime": "timestamp_ntz",
    "datetime64_0": "timestamp_ntz",
    "datetime64_3": "timestamp_ntz",
    "datetime64_6": "timestamp_ntz",
    "datetime64_9": "timestamp_ntz",
}

# Fractional digits kept per timestamp type.
PRECISION = {"datetime": 0, "datetime64_0": 0, "datetime64_3": 3, "datetime64_6": 6, "datetime64_9": 9}


def cast_or_null(col: Column, to: str) -> Column:
    return col.try_cast(to)


def cast_or_default(col: Column, to: str, default) -> Column:
    """Unparseable values and NULL become ``default``."""
    return F.coalesce(col.try_cast(to), F.lit(default).cast(to))


def cast_or_zero(col: Column, to: str) -> Column:
    return cast_or_default(col, to, 0)


def cast_unsigned(col: Column, bits: int) -> Column:
    """Whole part wrapped into ``bits`` unsigned bits: -1 becomes 2^bits - 1; 0 if unreadable.

    Digits are read as decimals, so none is lost beyond 2^53; text in exponent notation and values
    of more than 38 digits go through a double. 64 bits give ``decimal(20,0)``, fewer ``bigint``.
    """
    text = F.trim(col.cast("string"))
    digits = F.regexp_extract(text, r"^([+-]?\d+)(\.\d*)?$", 1)
    exact = F.when(digits != "", digits).try_cast("decimal(38,0)")
    whole = F.coalesce(exact, col.try_cast("double").try_cast("bigint").cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))
    return F.pmod(whole, F.lit(str(1 << bits)).cast("decimal(38,0)")).cast("decimal(20,0)" if bits >= 64 else "bigint")


def cast_strict(col: Column, to: str, what: str = "value") -> Column:
    """Raise on text that does not parse and on NULL."""
    cast = col.cast(to)
    return F.when(cast.isNotNull(), cast).otherwise(F.raise_error(F.lit(f"{what} must not be NULL")).cast(to))


def fixed_text(col: Column, n: int) -> Column:
    """Text of exactly ``n`` characters, padded on the right; longer text raises."""
    too_long = F.raise_error(F.lit(f"text is longer than {n}")).cast("string")
    return F.when(F.length(col) > n, too_long).otherwise(F.rpad(col, n, " "))


_BYTE = "(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


def is_ipv4(col: Column) -> Column:
    return col.rlike(rf"^({_BYTE}\.){{3}}{_BYTE}$")


def is_ipv6(col: Column) -> Column:
    """Eight groups of up to four hex digits, of which one run may be left out as ``::``."""
    full = col.rlike("^([0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}$")
    groups = F.size(F.filter(F.split(col, ":"), lambda g: g != ""))
    once = (F.length(col) - F.length(F.replace(col, F.lit("::"), F.lit("")))) == 2
    short = once & ~col.contains(":::") & (groups <= 7) & col.rlike("^(([0-9A-Fa-f]{1,4}:)*[0-9A-Fa-f]{1,4})?::([0-9A-Fa-f]{1,4}(:[0-9A-Fa-f]{1,4})*)?$")
    return full | short


def is_uuid(col: Column) -> Column:
    return col.rlike("^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$")


def enum_code(label: Column, codes: dict[str, int]) -> Column:
    """Number of a label; a label outside the list raises, NULL stays NULL."""
    table = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    unknown = F.raise_error(F.concat(F.lit("unknown label "), label)).cast("int")
    return F.when(label.isNull(), F.lit(None)).otherwise(F.coalesce(table[label], unknown))


def enum_label(code: Column, codes: dict[str, int]) -> Column:
    """Label of a number; NULL for a number outside the list."""
    table = F.create_map(*[F.lit(x) for label, number in codes.items() for x in (number, label)])
    return table[code]


def fill_default(col: Column, to: str) -> Column:
    """NULL becomes 0 for numbers and '' for text; other types keep NULL."""
    if to == "string":
        return F.coalesce(col, F.lit(""))
    if to.startswith(("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")):
        return F.coalesce(col, F.lit(0).cast(to))
    return col


def parse_list_text(col: Column, element: str) -> Column:
    """A list written as text, such as ``"[1, 'a,b']"``, to a typed array; empty items are dropped.

    It is read as JSON in which items may stand in single quotes, so quoted items may hold commas
    and the other kind of quote. Text that is no such list is cut at commas, and quotes around
    items are taken off. Items that do not parse become NULL.
    """
    kind = TYPE_MAP.get(element, element)
    inner = F.regexp_replace(F.trim(col), r"^\[|\]$", "")
    read = F.from_json(F.concat(F.lit("["), inner, F.lit("]")), "array<string>", {"allowSingleQuotes": "true"})
    whole = F.when(F.exists(read, lambda x: x.isNotNull()), read)
    cut = F.transform(F.split(inner, ","), lambda x: F.regexp_replace(F.trim(x), "^['\"]|['\"]$", ""))
    if kind == "string":
        read_or_cut = F.coalesce(whole, cut)
    else:
        # Without the characters of numbers and times, such a list is commas and pairs of quotes.
        rest = F.regexp_replace(F.translate(inner, "0123456789TZ.:+- ", ""), "''|\"\"", "")
        read_or_cut = F.when(rest.rlike("^,*$"), cut).otherwise(F.coalesce(whole, cut))
    items = F.transform(read_or_cut, lambda x: F.trim(x))
    filled = F.filter(items, lambda x: x != "")
    return filled if kind == "string" else F.transform(filled, lambda x: x.try_cast(kind))


def strip_to_number(col: Column, to: str = "bigint") -> Column:
    """Drop every non-digit, then read the rest as a number."""
    return F.regexp_replace(col, "[^0-9]", "").try_cast(to)


def trailing_number(col: Column) -> Column:
    """Digits at the end of a code such as ``RUS07``."""
    return F.regexp_extract(col, r"(\d+)$", 1).try_cast("int")
