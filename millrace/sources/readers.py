"""Reading files, file lists and tables."""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ordering import pick_one
from ..session import materialise, release


def read_parquet(spark: SparkSession, *paths: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet by path, glob or list of paths."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*paths)


def read_csv(spark: SparkSession, *paths: str, sep: str = ",", schema=None, infer: bool = False) -> DataFrame:
    """CSV with header. All columns are text unless a schema or ``infer`` says otherwise."""
    reader = spark.read.option("header", True).option("sep", sep).option("inferSchema", infer)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(list(paths))


def read_json(spark: SparkSession, *paths: str, schema=None, multi_line: bool = False) -> DataFrame:
    reader = spark.read.option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(list(paths))


def read_parts(spark: SparkSession, *paths: str, key: list[str], schema=None) -> DataFrame:
    """Tab-separated export parts put together; of equal keys the row of the lowest file path stays."""
    parts = read_csv(spark, *paths, sep="\t", schema=schema)
    placed = parts.withColumn("__file", F.col("_metadata.file_path"))
    rest = [c for c in parts.columns if c not in key]
    return pick_one(placed, key, ["__file", *rest]).drop("__file")


def manifest_paths(spark: SparkSession, manifest: str) -> DataFrame:
    """Trimmed, non-blank, different lines of a text list of paths, as a table with the column ``path``."""
    return spark.read.text(manifest).select(F.trim("value").alias("path")).where("path <> ''").distinct()


def _below_root(path) -> Column:
    """A path without scheme and host, so that ``/data/x``, ``file:/data/x`` and ``file:///data/x`` agree."""
    return F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")


def read_manifest(spark: SparkSession, manifest: str, root: str, schema: T.StructType | None = None) -> DataFrame:
    """The rows of the files that a manifest lists, all of them below the folder ``root``.

    The list stays a table: rows are kept by a semi join on the path of their file, and no path comes
    to the driver. Every file below ``root`` is opened, so this is for lists that name most of a folder;
    ``load_manifest`` is for others. A line without a file is an error, a file listed twice counts once.
    """
    wanted = manifest_paths(spark, manifest).select(_below_root("path").alias("__listed"))
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    # The rows' own name of a file is a URL; the listing knows it beside the plain path.
    there = found.select(_below_root("path").alias("__there"), F.col("_metadata.file_path").alias("__url"))
    known = wanted.join(there, F.col("__listed") == F.col("__there"), "left")
    missing = known.where("__url IS NULL").agg(F.count("*").alias("n"), F.min("__listed").alias("one")).first()
    if missing.n:
        raise FileNotFoundError(f"{missing.n} listed files are not below {root}, such as {missing.one}")
    reader = spark.read.option("recursiveFileLookup", True)
    rows = (reader if schema is None else reader.schema(schema)).parquet(root)
    placed = rows.select("*", F.col("_metadata.file_path").alias("__file"))
    return placed.join(known.select("__url"), F.col("__file") == F.col("__url"), "left_semi").drop("__file")


def load_manifest(
    spark: SparkSession, manifest: str, process: Callable[[DataFrame], None], schema: T.StructType | None = None, group: int = 10_000
) -> int:
    """Hand the listed files to ``process`` in groups of at most ``group``, by path; returns the number of files.

    Only one group of paths is in the driver at a time; other files are not opened.
    """
    listed = materialise(manifest_paths(spark, manifest), "listed")
    paths, done = listed.orderBy("path").toLocalIterator(), 0
    for rows in iter(lambda: list(itertools.islice(paths, group)), []):
        process(read_parquet(spark, *[r.path for r in rows], schema=schema))
        done += len(rows)
    release(listed)
    return done


def read_chosen(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    since: str | None = None,
    contains: str | None = None,
    skip: str | None = None,
    date_pattern: str | None = None,
    loaded_until: str | None = None,
    ext: str = ".parquet",
) -> DataFrame:
    """The rows of the files below ``folder`` that were chosen by time, path or a date in the path.

    The conditions are filters on the files' metadata. Spark applies them to its own listing when it
    plans the scan, so other files are not opened and no list of paths is made. ``since`` keeps files
    modified strictly later, to the millisecond; ``date_pattern`` has one group, the date in the path,
    and keeps files with a date, with ``loaded_until`` only those of a later one. Paths are URLs here
    (a space is ``%20``).
    """
    path, modified = F.col("_metadata.file_path"), F.col("_metadata.file_modification_time")
    reader = spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", f"*{ext}")
    found = reader.parquet(folder)
    if since is not None:
        found = found.where(F.unix_millis(modified) > F.unix_millis(F.lit(since).cast("timestamp")))
    if contains:
        found = found.where(F.contains(path, F.lit(contains)))
    if skip:
        found = found.where(~F.contains(path, F.lit(skip)))
    if date_pattern:
        date = F.regexp_extract(path, date_pattern, 1).try_cast("date")
        found = found.where(date.isNotNull() if loaded_until is None else date > F.lit(loaded_until).cast("date"))
    return found


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a table at ``path``, by its folder; no file is opened."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(root)


def list_files(
    spark: SparkSession,
    folder: str,
    since: str | None = None,
    contains: str | None = None,
    ext: str | None = None,
    skip: str | None = None,
    at_since: bool = False,
) -> DataFrame:
    """Files below ``folder`` as (path, name, size, modified), without reading their content.

    ``since`` keeps files modified strictly later, compared to the millisecond, or with
    ``at_since`` those modified at that time too.
    """
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{ext}" if ext else "*")
        .load(folder)
        .select(
            "path",
            F.element_at(F.split("path", "/"), -1).alias("name"),
            F.col("length").alias("size"),
            F.col("modificationTime").alias("modified"),
        )
    )
    if since is not None:
        own, mark = F.unix_millis("modified"), F.unix_millis(F.lit(since).cast("timestamp"))
        found = found.where(own >= mark if at_since else own > mark)
    if contains:
        found = found.where(F.contains("path", F.lit(contains)))
    if skip:
        found = found.where(~F.contains("path", F.lit(skip)))
    return found


def files_by_date(files: DataFrame, pattern: str, loaded_until: str | None = None) -> DataFrame:
    """Add ``business_date`` found in the file name; keep dates after ``loaded_until``, in order."""
    dated = files.withColumn("business_date", F.regexp_extract("name", pattern, 1).try_cast("date"))
    dated = dated.where("business_date IS NOT NULL")
    if loaded_until is not None:
        dated = dated.where(F.col("business_date") > F.lit(loaded_until).cast("date"))
    return dated.orderBy("business_date", "name")


def number_series(spark: SparkSession, start: int, end: int, name: str = "number") -> DataFrame:
    """Whole numbers from ``start`` up to, not including, ``end``."""
    return spark.range(start, end).withColumnRenamed("id", name)


def random_table(base: DataFrame, key: str, schema: T.StructType, seed: int = 0) -> DataFrame:
    """Pseudo-random values of a schema, one row per row of ``base``.

    Every value is a hash of the row's key, the column and the seed, so a lost task that is run
    again makes the same rows.
    """

    def noise(i: int):
        return F.xxhash64(F.col(key), F.lit(i), F.lit(seed))

    def value(kind: T.DataType, i: int):
        h = noise(i)
        match kind:
            case T.BooleanType():
                return h % 2 == 0
            case T.ByteType() | T.ShortType() | T.IntegerType() | T.LongType():
                top = {"tinyint": 127, "smallint": 32767}.get(kind.simpleString(), 2_000_000_000)
                return F.pmod(h, F.lit(top).cast("bigint")).cast(kind)
            case T.FloatType() | T.DoubleType():
                return (F.pmod(h, F.lit(1 << 52).cast("bigint")) / F.lit(float(1 << 52))).cast(kind)
            case T.DecimalType():
                digits = min(kind.precision, 15)
                return (F.pmod(h, F.lit(10**digits)) / F.lit(10**kind.scale)).cast(kind)
            case T.DateType():
                return F.date_add(F.lit("2000-01-01").cast("date"), F.pmod(h, F.lit(9000).cast("bigint")).cast("int"))
            case T.ArrayType():
                n = F.pmod(h, F.lit(4).cast("bigint")).cast("int")
                items = F.array(*[value(kind.elementType, 100 * i + j) for j in range(1, 4)])
                return F.slice(items, 1, n)
        return F.sha1(h.cast("string")).cast(kind)

    return base.select(*[value(f.dataType, i).alias(f.name) for i, f in enumerate(schema.fields, start=1)])


_SAFE_NAME = re.compile(r"^[A-Za-z_][\w.]*$")


def jdbc_options(url: str, table: str | None = None, query: str | None = None, fetch: int = 1000, **more) -> dict[str, str]:
    """Options of a JDBC read. Credentials come from the caller, never from the library."""
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    if table is not None and not _SAFE_NAME.match(table):
        raise ValueError(f"not a table name: {table}")
    source = {"dbtable": table} if table else {"query": query}
    return {"url": url, "fetchsize": str(fetch), **source, **{k: str(v) for k, v in more.items()}}


def read_jdbc_table(
    spark: SparkSession, url: str, table: str, split: str | None = None, lower=None, upper=None, parts: int = 8, **more
) -> DataFrame:
    """A whole table; with ``split`` (a numeric or time column) it is read by ``parts`` tasks."""
    if split:
        more |= {"partitionColumn": split, "lowerBound": lower, "upperBound": upper, "numPartitions": parts}
    return spark.read.format("jdbc").options(**jdbc_options(url, table=table, **more)).load()


def read_jdbc_query(spark: SparkSession, url: str, query: str, **more) -> DataFrame:
    """The rows of a query that runs in the source."""
    return spark.read.format("jdbc").options(**jdbc_options(url, query=query, **more)).load()
