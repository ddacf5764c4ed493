"""Reads with table semantics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.ordering import exact_quantiles, same_keys
from ..operators.states import State, read_aggregating, to_state
from ..operators.tables import (
    ColumnRule,
    TargetField,
    advance_status,
    align_to,
    clustered,
    conform,
    describe,
    drop_latest,
    hash_partition,
    month_partition,
    range_partition,
    read_collapsing,
    read_replacing,
    read_rules,
    read_summing,
    shard_report,
    ttl_column,
    ttl_rows,
    visible,
    write_rules,
)
from ..session import scratch_path
from ..sources.writers import write_partitioned
from .base import K_SQL, k_of, query


@query(
    "read_replacing",
    "SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts, arg_max(value, (ts, event_id)) AS value "
    "FROM events GROUP BY user_id, event_type",
)
def read_replacing_query(load, spark):
    rows = load("events").select("user_id", "event_type", "event_id", "ts", "value")
    return read_replacing(rows, ["user_id", "event_type"], seq="event_id", version="ts")


@query(
    "read_replacing_partition",
    f"SELECT user_id, day, arg_max(event_id, (k, event_id)) AS event_id, max(k) AS k FROM "
    f"(SELECT user_id, CAST(ts AS DATE) AS day, event_id, {K_SQL} AS k FROM events) GROUP BY user_id, day",
    dates="day",
)
def read_replacing_partition(load, spark):
    rows = load("events").select("user_id", F.to_date("ts").alias("day"), "event_id", k_of().alias("k"))
    return read_replacing(rows, ["user_id"], seq="event_id", version="k", partition=["day"])


@query(
    "read_summing",
    f"SELECT user_id, CAST(sum({K_SQL}) AS BIGINT) AS k, arg_min(event_type, event_id) AS event_type, min(event_id) AS event_id FROM events GROUP BY user_id",
)
def read_summing_query(load, spark):
    rows = load("events").select("user_id", k_of().alias("k"), "event_type", "event_id")
    return read_summing(rows, ["user_id"], ["k"], seq="event_id")


@query(
    "read_aggregating",
    "SELECT user_id, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS total, max(value) AS high, round(avg(event_id), 6) AS mean, "
    "min(event_id) FILTER (WHERE event_type = 'view') AS any_view FROM events GROUP BY user_id",
)
def read_aggregating_query(load, spark):
    spec = {
        "n": State("count", "event_id"),
        "total": State("sum", "event_id"),
        "high": State("max", "value"),
        "mean": State("avg", "event_id"),
        "any_view": State("any_if", "event_id", cond="event_type = 'view'"),
    }
    events = load("events")
    stored = scratch_path(spark, "states")
    for i in range(3):
        to_state(events.where(F.col("event_id") % 3 == i), ["user_id"], spec).write.mode("append").parquet(stored)
    done = read_aggregating(spark.read.parquet(stored), ["user_id"], spec)
    return done.withColumn("mean", F.round("mean", 6))


@query(
    "read_aggregating_lists",
    "WITH r AS (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn, "
    "count(*) OVER (PARTITION BY event_type) AS n FROM events) "
    "SELECT event_type, (rn - 1) // 500 AS chunk, CASE WHEN (rn - 1) // 500 = 0 THEN max(n) END AS n, "
    "CASE WHEN (rn - 1) // 500 = 0 THEN true END AS users_close, CASE WHEN (rn - 1) // 500 = 0 THEN true END AS median_close, "
    "array_to_string(list(event_id ORDER BY rn), ',') AS ids FROM r GROUP BY event_type, (rn - 1) // 500",
)
def read_aggregating_lists(load, spark):
    """Ordered lists, distinct counts and quantiles of three stored loads in one read; sketches are held against exact values."""
    spec = {
        "n": State("count", "event_id"),
        "users": State("uniq", "user_id"),
        "median": State("quantiles", "value", probs=(0.5,)),
        "ids": State("list", "event_id", order=("ts", "event_id"), chunk_rows=500),
    }
    events = load("events").select("event_type", "event_id", "user_id", "ts", "value")
    stored = scratch_path(spark, "states")
    for i in range(3):
        to_state(events.where(F.col("event_id") % 3 == i), ["event_type"], spec).write.mode("append").parquet(stored)
    done = read_aggregating(spark.read.parquet(stored), ["event_type"], spec)
    exact = events.groupBy("event_type").agg(F.countDistinct("user_id").alias("__users"))
    around = exact_quantiles(events, ["event_type"], "value", {"__low": 0.45, "__high": 0.55})
    judged = same_keys(same_keys(done, exact, ["event_type"]), around, ["event_type"])
    return judged.select(
        "event_type",
        "chunk",
        "n",
        (F.abs(F.col("users") - F.col("__users")) <= 0.05 * F.col("__users")).alias("users_close"),
        F.col("median")[0].between(F.col("__low"), F.col("__high")).alias("median_close"),
        F.array_join("ids", ",").alias("ids"),
    )


@query(
    "read_collapsing",
    "SELECT user_id, event_type, max(event_id) FILTER (WHERE sign > 0) AS event_id, arg_max(value, event_id) FILTER (WHERE sign > 0) AS value, CAST(1 AS INTEGER) AS sign "
    f"FROM (SELECT *, CASE WHEN {K_SQL} % 2 = 0 THEN 1 ELSE -1 END AS sign FROM events) GROUP BY user_id, event_type HAVING sum(sign) > 0",
)
def read_collapsing_query(load, spark):
    sign = F.when(k_of() % 2 == 0, 1).otherwise(-1)
    rows = load("events").select("user_id", "event_type", "event_id", "value", sign.alias("sign"))
    return read_collapsing(rows, ["user_id", "event_type"], "sign", "event_id")


AS_OF = "2024-01-20 12:00:00"


@query(
    "ttl_rows",
    f"SELECT event_id, ts FROM events WHERE NOT (ts + INTERVAL 7 DAY <= TIMESTAMP '{AS_OF}' AND dayofweek(ts) IN (0, 6))",
)
def ttl_rows_query(load, spark):
    weekend = F.dayofweek("ts").isin(1, 7)
    rows = load("events").select("event_id", "ts")
    return ttl_rows(rows, "ts", "7 DAYS", F.lit(AS_OF).cast("timestamp_ntz"), only=weekend)


@query(
    "ttl_column",
    f"SELECT event_id, CASE WHEN ts + INTERVAL 5 DAY <= TIMESTAMP '{AS_OF}' THEN 10.0::DOUBLE ELSE value END AS value FROM events",
)
def ttl_column_query(load, spark):
    rows = load("events").select("event_id", "ts", "value")
    return ttl_column(rows, "value", 10, "ts", "5 DAYS", F.lit(AS_OF).cast("timestamp_ntz")).drop("ts")


RULES = [
    ColumnRule("quantity", "default", "1", "int"),
    ColumnRule("total", "materialized", "p_size * quantity * 2", "int"),
    ColumnRule("taxed", "alias", "total * 1.5", "double"),
]


@query(
    "computed_columns",
    "SELECT p_partkey, p_size, 1 AS quantity, p_size * 2 AS named_total, CAST(p_size * 2 * 1.5 AS DOUBLE) AS named_taxed, 3 AS shown FROM part",
)
def computed_columns(load, spark):
    stored = write_rules(load("part").select("p_partkey", "p_size"), RULES)
    table = read_rules(stored, RULES)
    shown = visible(table, RULES).columns
    return table.select(*shown, F.col("total").alias("named_total"), F.col("taxed").alias("named_taxed"), F.lit(len(shown)).alias("shown"))


def _partition_sizes(df, spark, *by):
    path = scratch_path(spark, "layout")
    write_partitioned(df, path, *by)
    return spark.read.parquet(path).groupBy(*by).agg(F.count("*").alias("rows"))


@query(
    "partition_range",
    "SELECT CASE WHEN o_totalprice < 100000 THEN 'low' WHEN o_totalprice < 300000 THEN 'middle' ELSE 'high' END AS band, count(*) AS rows FROM orders GROUP BY band",
)
def partition_range(load, spark):
    band = range_partition("o_totalprice", [("low", 100000), ("middle", 300000)], "high")
    return _partition_sizes(load("orders").withColumn("band", band), spark, "band")


@query(
    "partition_month",
    "SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS month, count(*) AS rows FROM orders GROUP BY ALL",
)
def partition_month(load, spark):
    return _partition_sizes(load("orders").withColumn("month", month_partition("o_orderdate")), spark, "month")


@query(
    "partition_hash",
    "SELECT count(*) AS rows, count(DISTINCT o_custkey) AS keys, CAST(1 AS BIGINT) AS most_buckets, CAST(0 AS INTEGER) AS lowest, CAST(7 AS INTEGER) AS highest FROM orders",
)
def partition_hash(load, spark):
    path = scratch_path(spark, "hashed")
    write_partitioned(load("orders").withColumn("bucket", hash_partition(8, "o_custkey")), path, "bucket")
    per_key = spark.read.parquet(path).groupBy("o_custkey").agg(
        F.count("*").alias("n"), F.countDistinct("bucket").alias("b"), F.min("bucket").alias("lo"), F.max("bucket").alias("hi")
    )
    return per_key.agg(
        F.sum("n").alias("rows"),
        F.count("*").alias("keys"),
        F.max("b").alias("most_buckets"),
        F.min("lo").alias("lowest"),
        F.max("hi").alias("highest"),
    )


@query(
    "partition_composite",
    "SELECT CAST(strftime(ts, '%Y%m') AS INTEGER) AS month, CAST(user_id % 4 AS INTEGER) AS part, count(*) AS rows FROM events GROUP BY ALL",
)
def partition_composite(load, spark):
    rows = load("events").withColumns({"month": month_partition("ts"), "part": (F.col("user_id") % 4).cast("int")})
    return _partition_sizes(rows, spark, "month", "part")


@query(
    "cluster_by_key",
    "SELECT count(*) AS rows, count(DISTINCT l_partkey) AS parts, true AS ranges_apart FROM lineitem",
)
def cluster_by_key(load, spark):
    path = scratch_path(spark, "clustered")
    clustered(load("lineitem").select("l_partkey", "l_orderkey"), [], ["l_partkey", "l_orderkey"], files=6).write.parquet(path)
    table = spark.read.parquet(path)
    files = table.groupBy(F.col("_metadata.file_name").alias("f")).agg(F.min("l_partkey").alias("lo"), F.max("l_partkey").alias("hi"))
    # Files that are range-split share at most the value at an edge, so widths sum to little more than the whole width.
    spread = files.agg((F.sum(F.col("hi") - F.col("lo")) <= F.max("hi") - F.min("lo")).alias("ok"))
    return table.agg(F.count("*").alias("rows"), F.countDistinct("l_partkey").alias("parts")).withColumn("ranges_apart", spread.scalar())


@query(
    "shard_distribution",
    "SELECT CAST(user_id % 3 AS INTEGER) AS shard, count(*) AS rows, CAST(round(count(*)::DOUBLE / (SELECT count(*) FROM events), 4) AS DOUBLE) AS share FROM events GROUP BY ALL",
)
def shard_distribution(load, spark):
    return shard_report(load("events"), 3, "value", "user_id")


@query(
    "shard_distribution_hash",
    "SELECT count(*) AS rows, CAST(4 AS BIGINT) AS shards, true AS even FROM orders",
)
def shard_distribution_hash(load, spark):
    report = shard_report(load("orders"), 4, "hash", "o_orderkey").unionByName(shard_report(load("orders"), 4, "random"))
    return report.groupBy().agg(
        (F.sum("rows") / 2).cast("bigint").alias("rows"),
        F.countDistinct("shard").alias("shards"),
        (F.max("share") < 0.35).alias("even"),
    )


@query(
    "schema_describe",
    "SELECT CAST(i AS INTEGER) AS position, name, type, (SELECT count(*) FROM events) AS table_rows FROM "
    "(VALUES (1, 'event_id', 'bigint'), (2, 'ts', 'timestamp_ntz'), (3, 'user_id', 'bigint'), (4, 'event_type', 'string'), (5, 'value', 'double'), (6, 'props', 'string')) t(i, name, type)",
)
def schema_describe(load, spark):
    events = load("events")
    listed = spark.createDataFrame(describe(events), "position int, name string, type string, comment string").drop("comment")
    return listed.withColumn("table_rows", events.agg(F.count("*")).scalar())


@query(
    "conform_to_target",
    "SELECT CAST(o_orderkey AS BIGINT) AS id, CASE WHEN o_custkey % 4 = 0 THEN '' ELSE o_orderstatus END AS status, "
    "CASE WHEN o_custkey % 5 = 0 THEN 0 ELSE CAST(o_custkey AS INTEGER) END AS customer, CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE o_custkey END AS customer_or_null, "
    "o_orderdate AS placed, CAST(o_orderkey AS VARCHAR) || '|' || CAST(o_orderkey + 1 AS VARCHAR) AS items FROM orders",
)
def conform_to_target(load, spark):
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    some = F.when(customer % 5 != 0, customer.cast("string"))
    raw = load("orders").select(
        F.lit("ignored").alias("extra"),
        F.concat(F.lit("['"), key.cast("string"), F.lit("','"), (key + 1).cast("string"), F.lit("']")).alias("items"),
        (F.col("o_orderdate") + F.expr("INTERVAL '0.4567' SECOND")).alias("placed"),
        F.when(customer % 4 != 0, F.col("o_orderstatus")).alias("status"),
        some.alias("customer"),
        some.alias("customer_or_null"),
        key.cast("string").alias("id"),
    )
    target = [
        TargetField("id", "int64"),
        TargetField("status", "string"),
        TargetField("customer", "int32"),
        TargetField("customer_or_null", "int64", nullable=True),
        TargetField("placed", "datetime"),
        TargetField("items", "int64", array=True),
        TargetField("not_there", "string"),
    ]
    return conform(raw, target).withColumn("items", F.array_join(F.col("items").cast("array<string>"), "|"))


@query("align_to_target", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def align_to_target(load, spark):
    orders = load("orders")
    texts = [F.col(c).cast("string").alias(c) for c in ("o_orderpriority", "o_totalprice", "o_orderdate", "o_custkey", "o_orderkey")]
    return align_to(orders.select(F.lit(1).alias("extra"), *texts), orders.schema)


@query(
    "state_transition_update",
    "SELECT event_id, CASE WHEN event_id % 5 = 0 AND event_type = 'view' THEN 'click' WHEN event_id % 5 = 0 AND event_type = 'click' THEN 'purchase' ELSE event_type END AS event_type, "
    "CASE WHEN event_id % 5 = 0 AND event_type IN ('view', 'click') THEN TIMESTAMP '2024-03-01' ELSE ts END AS ts "
    "FROM events WHERE (ts, event_id) <> (SELECT max((ts, event_id)) FROM events)",
)
def state_transition_update(load, spark):
    rows = drop_latest(load("events").select("event_id", "event_type", "ts"), ["ts", "event_id"])
    steps = {"view": "click", "click": "purchase"}
    return advance_status(rows, "event_id", "event_type", "ts", steps, 5, F.lit("2024-03-01").cast("timestamp_ntz"))
