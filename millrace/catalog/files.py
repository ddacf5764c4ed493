"""File sources and sinks, incremental loads and load checks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nested import flatten
from ..operators.aggregates import exact_sum, partition_counts
from ..quality import below, is_empty, reconcile, rows_on_last_date, write_logged
from ..session import scratch_path
from ..sources.buckets import delete_insert_rows, read_buckets, upsert_rows
from ..sources.incremental import backfill, load_files_once, load_new_files, load_past_mark
from ..sources.readers import (
    list_files,
    load_manifest,
    number_series,
    random_table,
    read_chosen,
    read_csv,
    read_json,
    read_manifest,
    read_parquet,
    read_parts,
)
from ..sources.writers import (
    full_refresh,
    read_version,
    replace_partitions,
    write_daily,
    write_files,
    write_format,
    write_parquet,
    write_partitioned,
)
from ..streaming.streams import append_files, file_source
from .base import half_up, money, query

NTZ = "timestamp_ntz"


def _at(text):
    return F.lit(text).cast(NTZ)


def _daily(events, spark):
    """The events in one folder per day."""
    path = scratch_path(spark, "daily")
    write_daily(events, path, "ts")
    return path


@query(
    "src_parquet_glob",
    f"SELECT origin, count(*) AS n, {money('amount')} AS amount FROM (SELECT 'customer' AS origin, c_acctbal AS amount FROM customer UNION ALL SELECT 'supplier', s_acctbal FROM supplier) GROUP BY origin",
)
def src_parquet_glob(load, spark):
    paths = {}
    for table, column in (("customer", "c_acctbal"), ("supplier", "s_acctbal")):
        paths[table] = scratch_path(spark, f"glob-{table}")
        write_parquet(load(table).select(F.lit(table).alias("origin"), F.col(column).alias("amount")), paths[table])
    both = read_parquet(spark, paths["customer"], f"{paths['supplier']}/part-*.parquet")
    return both.groupBy("origin").agg(F.count("*").alias("n"), exact_sum(F.col("amount")).alias("amount"))


@query("src_csv", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def src_csv(load, spark):
    path = scratch_path(spark, "csv")
    rows = load("customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    for i in (0, 1):
        rows.where(F.col("c_custkey") % 2 == i).write.option("header", True).option("sep", ";").csv(f"{path}/{i}")
    return read_csv(spark, f"{path}/0", f"{path}/1", sep=";", schema=rows.schema)


@query("src_json_nested", "SELECT event_id, user_id AS who_id, event_type AS who_kind, len(list_value(value, value)) AS n FROM events")
def src_json_nested(load, spark):
    path = scratch_path(spark, "json")
    load("events").select(
        "event_id",
        F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("kind")).alias("who"),
        F.array("value", "value").alias("readings"),
    ).write.json(path)
    read = flatten(read_json(spark, path))
    return read.select("event_id", "who_id", "who_kind", F.size("readings").cast("bigint").alias("n"))


@query("src_tsv_parts", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, o_orderpriority FROM orders")
def src_tsv_parts(load, spark):
    path = scratch_path(spark, "tsv")
    rows = load("orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    overlap = rows.where(F.col("o_orderkey") % 3 != 0).withColumn("o_orderstatus", F.lit("late"))
    for part, df in (("part-1", rows), ("part-2", overlap)):
        df.write.option("header", True).option("sep", "\t").csv(f"{path}/{part}")
    return read_parts(spark, f"{path}/part-1", f"{path}/part-2", key=["o_orderkey"])


@query("src_text_manifest", f"SELECT event_type, count(*) AS n, {money('value')} AS total FROM events GROUP BY event_type")
def src_text_manifest(load, spark):
    events = load("events")
    data, manifest = _daily(events, spark), scratch_path(spark, "manifest")
    lines = list_files(spark, data, ext=".parquet").select(F.concat(F.lit("  "), "path").alias("value"))
    lines.unionAll(spark.range(2).select(F.lit(" ").alias("value"))).write.text(manifest)
    read = read_manifest(spark, manifest, data, schema=events.schema)
    return read.groupBy("event_type").agg(F.count("*").alias("n"), exact_sum(F.col("value")).alias("total"))


@query("src_text_manifest_groups", f"SELECT event_type, count(*) AS n, {money('value')} AS total FROM events GROUP BY event_type")
def src_text_manifest_groups(load, spark):
    """The files of a manifest, ten at a time, appended to one table."""
    events = load("events")
    data, manifest, out = _daily(events, spark), scratch_path(spark, "manifest"), scratch_path(spark, "listed")
    list_files(spark, data, ext=".parquet").select("path").write.text(manifest)
    load_manifest(spark, manifest, lambda part: part.write.mode("append").parquet(out), schema=events.schema, group=10)
    return read_parquet(spark, out).groupBy("event_type").agg(F.count("*").alias("n"), exact_sum(F.col("value")).alias("total"))


@query(
    "src_files_modified_after",
    "SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE day(ts) BETWEEN 10 AND 19 GROUP BY ALL",
    dates="day",
)
def src_files_modified_after(load, spark):
    events = load("events")
    data = _daily(events, spark)
    read = read_chosen(spark, data, events.schema, since="2000-01-01 00:00:00", contains="-01-1", skip="manifest")
    return read.groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))


@query(
    "src_files_by_date_key",
    "SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE CAST(ts AS DATE) > DATE '2024-01-20' GROUP BY ALL",
    dates="day",
)
def src_files_by_date_key(load, spark):
    events = load("events")
    data = _daily(events, spark)
    read = read_chosen(spark, data, events.schema, date_pattern=r"day=(\d{4}-\d{2}-\d{2})/", loaded_until="2024-01-20")
    return read.groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))


@query(
    "src_number_series",
    "SELECT range AS number FROM range((SELECT max(c_custkey) + 1 FROM customer)) WHERE range NOT IN (SELECT o_custkey FROM orders)",
)
def src_number_series(load, spark):
    top = load("customer").agg(F.max("c_custkey")).first()[0]
    taken = load("orders").select(F.col("o_custkey").alias("number"))
    return number_series(spark, 0, top + 1).join(taken, "number", "left_anti")


@query(
    "src_random_table",
    "SELECT count(*) AS n, true AS all_filled, true AS in_bounds, true AS varied FROM orders",
)
def src_random_table(load, spark):
    schema = T.StructType.fromDDL("a bigint, b double, c string, d array<int>, e date, f boolean, g decimal(10,2)")
    made = random_table(load("orders").select("o_orderkey"), "o_orderkey", schema, seed=3)
    filled = F.lit(True)
    for name in schema.names:
        filled = filled & F.col(name).isNotNull()
    return made.agg(
        F.count("*").alias("n"),
        F.bool_and(filled).alias("all_filled"),
        F.bool_and(F.col("b").between(0, 1) & (F.size("d") <= 3)).alias("in_bounds"),
        (F.approx_count_distinct("c") > 0.9 * F.count("*")).alias("varied"),
    )


@query("snk_parquet", "SELECT o_orderstatus, 2 * count(*) AS n FROM orders GROUP BY o_orderstatus")
def snk_parquet(load, spark):
    path = scratch_path(spark, "plain")
    for mode in ("overwrite", "append"):
        write_parquet(load("orders"), path, mode)
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query(
    "snk_partitioned",
    "SELECT 'event_date=' || CAST(CAST(ts AS DATE) AS VARCHAR) AS partition, count(*) AS rows FROM events GROUP BY ALL",
)
def snk_partitioned(load, spark):
    path = scratch_path(spark, "by-date")
    write_partitioned(load("events").withColumn("event_date", F.to_date("ts")), path, "event_date")
    return partition_counts(spark.read.parquet(path))


@query("snk_target_file_count", "SELECT CAST(6 AS BIGINT) AS files, true AS sized, count(*) AS rows FROM lineitem")
def snk_target_file_count(load, spark):
    path = scratch_path(spark, "six")
    sizes = write_files(load("lineitem"), path, 6)
    rows = spark.read.parquet(path).agg(F.count("*")).scalar()
    return sizes.agg(F.count("*").alias("files"), F.bool_and(F.col("size") > 0).alias("sized")).withColumn("rows", rows)


@query(
    "snk_format_choice",
    "SELECT kind, o_orderstatus, count(*) AS n, max(o_orderdate) AS newest FROM orders, (VALUES ('parquet'), ('csv'), ('json')) t(kind) GROUP BY ALL",
)
def snk_format_choice(load, spark):
    rows = load("orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    base, out = scratch_path(spark, "formats"), None
    for kind in ("parquet", "csv", "json"):
        write_format(rows, f"{base}/{kind}", kind)
        reader = spark.read.schema(rows.schema).option("header", True)
        back = reader.format(kind).load(f"{base}/{kind}").withColumn("kind", F.lit(kind))
        out = back if out is None else out.unionByName(back)
    return out.groupBy("kind", "o_orderstatus").agg(F.count("*").alias("n"), F.max("o_orderdate").alias("newest"))


@query(
    "snk_daily_files",
    f"SELECT CAST(ts AS DATE) AS day, count(*) AS n, {money('value')} AS total FROM events GROUP BY ALL",
    dates="day",
)
def snk_daily_files(load, spark):
    events = load("events")
    path = _daily(events, spark)
    write_daily(events.where(F.col("ts") >= _at("2024-01-15")), path, "ts")
    return spark.read.parquet(path).groupBy("day").agg(F.count("*").alias("n"), exact_sum(F.col("value")).alias("total"))


@query(
    "snk_replace_partition",
    f"SELECT CAST(ts AS DATE) AS day, {money('CASE WHEN day(ts) >= 15 THEN 2 * value ELSE value END')} AS total FROM events GROUP BY ALL",
    dates="day",
)
def snk_replace_partition(load, spark):
    events = load("events")
    path = _daily(events, spark)
    again = events.where(F.col("ts") >= _at("2024-01-15")).withColumns({"value": F.col("value") * 2, "day": F.to_date("ts")})
    replace_partitions(again, path, "day")
    return spark.read.parquet(path).groupBy("day").agg(exact_sum(F.col("value")).alias("total"))


@query(
    "snk_delete_insert_by_key",
    "SELECT CAST(ts AS DATE) AS day, CASE WHEN day(ts) BETWEEN 10 AND 19 THEN -count(*) ELSE count(*) END AS n FROM events GROUP BY day, day(ts)",
    dates="day",
)
def snk_delete_insert_by_key(load, spark):
    path = scratch_path(spark, "facts")
    facts = load("events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    delete_insert_rows(facts, path, ["day"], rows=8)
    stage = facts.where(F.dayofmonth("day").between(10, 19)).withColumn("n", -F.col("n"))
    for _ in range(2):
        delete_insert_rows(stage, path, ["day"], rows=8)
    return read_buckets(spark, path)


@query("snk_full_refresh", "SELECT * FROM customer WHERE c_acctbal > 0")
def snk_full_refresh(load, spark):
    path = scratch_path(spark, "refreshed")
    full_refresh(load("customer"), path)
    full_refresh(read_version(spark, path).where("c_acctbal > 0"), path)
    return read_version(spark, path)


@query(
    "snk_upsert_key",
    "SELECT user_id, arg_max(event_id, event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id",
)
def snk_upsert_key(load, spark):
    path = scratch_path(spark, "upserted")
    rows = load("events").select("user_id", "event_id", "event_type", "ts")
    for late in (False, True):
        part = rows.where((F.col("ts") >= _at("2024-01-16")) == F.lit(late)).drop("ts")
        upsert_rows(part, path, ["user_id"], seq="event_id", rows=1 << 10)
    return read_buckets(spark, path)


@query(
    "snk_archive_after_load",
    "SELECT event_type, count(*) AS n, count(*) AS kept, true AS archived FROM events GROUP BY event_type",
)
def snk_archive_after_load(load, spark):
    """Loaded rows, the rows of the input and archive folders together, and whether the archive holds some."""
    events = load("events")
    base = scratch_path(spark, "archive")
    events.repartition(3).write.parquet(f"{base}/in")
    # A file is moved once a later batch begins, so the second run moves the first one's last file.
    for _ in range(2):
        stream = file_source(
            spark, f"{base}/in", events.schema, per_trigger=1, cleanSource="archive", sourceArchiveDir=f"{base}/done"
        )
        append_files(stream, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    loaded = spark.read.parquet(f"{base}/out").groupBy("event_type").agg(F.count("*").alias("n"))
    files = spark.read.schema(events.schema).option("recursiveFileLookup", "true")
    both = files.parquet(f"{base}/in").select("event_type", F.lit(False).alias("moved")).unionByName(
        files.parquet(f"{base}/done").select("event_type", F.lit(True).alias("moved"))
    )
    where = both.groupBy("event_type").agg(F.count("*").alias("kept"), F.bool_or("moved").alias("archived"))
    return loaded.join(where, "event_type")


# --- incremental loads ---


@query("inc_high_watermark", "SELECT event_id, ts, value, CAST(ts AS DATE) AS event_date FROM events", dates="event_date")
def inc_high_watermark(load, spark):
    path = scratch_path(spark, "installs")
    source = load("events").select("event_id", "ts", "value")
    load_past_mark(source.where(F.col("ts") < _at("2024-01-12 07:30:00")), path, "ts", ["event_id"])
    for _ in range(2):
        load_past_mark(source, path, "ts", ["event_id"])
    return spark.read.parquet(path)


@query("inc_file_watermark", f"SELECT event_type, count(*) AS n, {money('value')} AS total FROM events GROUP BY event_type")
def inc_file_watermark(load, spark):
    base = scratch_path(spark, "marked")
    events = load("events")

    def process(paths):
        spark.read.schema(events.schema).parquet(*paths).write.mode("append").parquet(f"{base}/out")

    for late in (False, True):
        events.where((F.col("ts") >= _at("2024-01-16")) == F.lit(late)).write.mode("append").parquet(f"{base}/in")
        load_new_files(spark, f"{base}/in", f"{base}/state", "events", process)
    load_new_files(spark, f"{base}/in", f"{base}/state", "events", process)
    return spark.read.parquet(f"{base}/out").groupBy("event_type").agg(F.count("*").alias("n"), exact_sum(F.col("value")).alias("total"))


@query("inc_file_log", f"SELECT event_type, count(*) AS n, {money('value')} AS total FROM events GROUP BY event_type")
def inc_file_log(load, spark):
    """Files are loaded in two runs by the file source's log; a third run finds nothing new."""
    base = scratch_path(spark, "logged-files")
    events = load("events")
    for late in (False, True):
        events.where((F.col("ts") >= _at("2024-01-16")) == F.lit(late)).repartition(4).write.mode("append").parquet(f"{base}/in")
        load_files_once(spark, f"{base}/in", events.schema, f"{base}/out", f"{base}/state", per_batch=2)
    loaded = load_files_once(spark, f"{base}/in", events.schema, f"{base}/out", f"{base}/state")
    return loaded.groupBy("event_type").agg(F.count("*").alias("n"), exact_sum(F.col("value")).alias("total"))


@query("inc_backfill_range", "SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' GROUP BY ALL", dates="day")
def inc_backfill_range(load, spark):
    path = scratch_path(spark, "backfilled")
    events = load("events")
    for first, last in (("2024-01-05", "2024-01-20"), ("2024-01-18", "2024-01-25"), ("2024-01-18", "2024-01-18")):
        backfill(events, path, "ts", first, last)
    return spark.read.parquet(path).groupBy("day").agg(F.count("*").alias("n"))


# --- checks ---


@query(
    "dq_row_reconcile",
    "SELECT CAST(ts AS DATE) AS day, count(*) AS source_rows, count(*) FILTER (WHERE value < 100) AS target_rows, count(*) = count(*) FILTER (WHERE value < 100) AS matches FROM events GROUP BY ALL",
    dates="day",
)
def dq_row_reconcile(load, spark):
    rows = load("events").withColumn("day", F.to_date("ts"))
    return reconcile(rows, rows.where("value < 100"), "day")


@query("dq_min_value", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0")
def dq_min_value(load, spark):
    return below(load("customer").select("c_custkey", "c_acctbal"), "c_acctbal", 0)


@query("dq_loaded_date", "SELECT o_orderdate, count(*) AS rows FROM orders GROUP BY o_orderdate ORDER BY o_orderdate DESC LIMIT 1")
def dq_loaded_date(load, spark):
    return rows_on_last_date(load("orders"), "o_orderdate")


@query("dq_non_empty", "SELECT 'events' AS name, count(*) = 0 AS empty, count(*) AS rows FROM events UNION ALL SELECT 'none', true, 0 FROM (SELECT count(*) FROM events)")
def dq_non_empty(load, spark):
    events = load("events")
    none = events.where("value < -1e9")
    out = None
    for name, df in (("events", events), ("none", none)):
        row = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("name"), F.lit(is_empty(df)).alias("empty"), "rows")
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "dq_load_log",
    "SELECT 'orders' AS mart, status AS load_date, n AS rows, '2024-02-01' AS created_at FROM (SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY o_orderstatus)",
)
def dq_load_log(load, spark):
    base = scratch_path(spark, "logged")
    for status in ("F", "O", "P"):
        write_logged(load("orders").where(F.col("o_orderstatus") == status), "orders", status, "2024-02-01", f"{base}/{status}", f"{base}/log")
    return spark.read.parquet(f"{base}/log")
