"""Aggregates, aggregate states and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.times import to_micros
from ..operators.aggregates import (
    any_if,
    avg_if,
    collect_groups,
    collect_if,
    count_distinct_if,
    day_dimensions,
    exact_avg,
    exact_sum,
    first_last,
    partition_counts,
    share_of,
    sum_if,
    uniq_if,
)
from ..operators.ordering import (
    Key,
    exact_quantiles,
    first_non_null,
    neighbours,
    number_rows,
    pick_one,
    rank_rows,
    running_sum,
    with_group_values,
)
from ..operators.states import State, collect_state, finalize, merge_collected, merge_states, read_aggregating, to_state
from ..session import scratch_path
from ..sources.writers import write_partitioned
from .base import K_SQL, half_up, k_of, money, query

# Values made partly NULL, so that counts of rows and of values differ.
SPARSE_SQL = "CASE WHEN event_id % 7 <> 0 THEN value END"


def sparse():
    return F.when(F.col("event_id") % 7 != 0, F.col("value"))



@query(
    "agg_basic",
    f"SELECT event_type, count(*) AS n_rows, count(v) AS n_values, {money('v')} AS total, min(v) AS low, max(v) AS high, "
    f"{half_up(money('v') + ' / count(v)', 6)} AS mean, {half_up(money('v') + ' / count(*)', 6)} AS mean_over_rows "
    f"FROM (SELECT event_type, {SPARSE_SQL} AS v FROM events) GROUP BY event_type",
)
def agg_basic(load, spark):
    v = F.col("v")
    return (
        load("events")
        .select("event_type", sparse().alias("v"))
        .groupBy("event_type")
        .agg(
            F.count("*").alias("n_rows"),
            F.count(v).alias("n_values"),
            exact_sum(v).alias("total"),
            F.min(v).alias("low"),
            F.max(v).alias("high"),
            F.round(exact_avg(v), 6).alias("mean"),
            F.round(exact_sum(v) / F.count("*"), 6).alias("mean_over_rows"),
        )
    )


@query("agg_having", "SELECT user_id, count(*) AS n FROM events GROUP BY user_id HAVING count(*) > 25")
def agg_having(load, spark):
    return load("events").groupBy("user_id").agg(F.count("*").alias("n")).where("n > 25")


@query("agg_global", "SELECT max(ts) AS newest, min(ts) AS oldest, count(*) AS n FROM events")
def agg_global(load, spark):
    return load("events").agg(F.max("ts").alias("newest"), F.min("ts").alias("oldest"), F.count("*").alias("n"))


@query(
    "agg_distinct",
    "SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts, count(DISTINCT (l_orderkey, l_linenumber)) AS lines "
    "FROM lineitem GROUP BY l_returnflag",
)
def agg_distinct(load, spark):
    return (
        load("lineitem")
        .groupBy("l_returnflag")
        .agg(
            F.countDistinct("l_orderkey").alias("orders"),
            F.countDistinct("l_partkey").alias("parts"),
            F.countDistinct("l_orderkey", "l_linenumber").alias("lines"),
        )
    )


@query("agg_distinct_global", "SELECT count(DISTINCT l_orderkey) AS orders FROM lineitem")
def agg_distinct_global(load, spark):
    return load("lineitem").agg(F.countDistinct("l_orderkey").alias("orders"))


@query("agg_approx_distinct", "SELECT l_returnflag, true AS within_bound FROM lineitem GROUP BY l_returnflag")
def agg_approx_distinct(load, spark):
    # Kept apart: beside an exact distinct count the estimator would hold a state per distinct value.
    by_flag = load("lineitem").groupBy("l_returnflag")
    estimates = by_flag.agg(F.approx_count_distinct("l_orderkey", 0.02).alias("estimate"))
    exact = by_flag.agg(F.countDistinct("l_orderkey").alias("n"))
    near = F.abs(F.col("estimate") - F.col("n")) <= 0.08 * F.col("n")
    return estimates.join(exact, "l_returnflag").select("l_returnflag", near.alias("within_bound"))


@query("agg_uniq_if", "SELECT l_returnflag, true AS within_bound FROM lineitem GROUP BY l_returnflag")
def agg_uniq_if(load, spark):
    """Estimated against exact distinct orders among lines of more than 25 pieces."""
    wanted = F.col("l_quantity") > 25
    by_flag = load("lineitem").groupBy("l_returnflag")
    estimates = by_flag.agg(uniq_if(F.col("l_orderkey"), wanted).alias("estimate"))
    exact = by_flag.agg(count_distinct_if(F.col("l_orderkey"), wanted).alias("n"))
    near = F.abs(F.col("estimate") - F.col("n")) <= 0.08 * F.col("n")
    return estimates.join(exact, "l_returnflag").select("l_returnflag", near.alias("within_bound"))


@query(
    "agg_collect_if",
    "WITH n AS (SELECT o_custkey, o_orderkey, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 5 AS chunk FROM orders WHERE o_orderstatus = 'F') "
    "SELECT o_custkey, coalesce(chunk, 0) AS chunk, coalesce(orders, '') AS orders FROM (SELECT DISTINCT o_custkey FROM orders) "
    "LEFT JOIN (SELECT o_custkey, chunk, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS orders FROM n GROUP BY ALL) USING (o_custkey)",
)
def agg_collect_if(load, spark):
    lists = collect_if(load("orders"), ["o_custkey"], "o_orderkey", F.col("o_orderstatus") == "F", ["o_orderkey"], chunk_rows=5)
    return lists.select("o_custkey", "chunk", F.array_join(F.col("items").cast("array<string>"), ",").alias("orders"))


@query(
    "agg_if",
    f"SELECT user_id % 10 AS grp, {money('CASE WHEN event_id % 2 = 0 THEN value END')} AS even_sum, "
    "round(avg(CASE WHEN event_type = 'view' THEN event_id END), 4) AS view_avg, "
    "count(DISTINCT CASE WHEN event_type = 'click' THEN user_id END) AS clickers, "
    "min(CASE WHEN event_type = 'signup' THEN event_id END) AS any_signup FROM events GROUP BY user_id % 10",
)
def agg_if(load, spark):
    kind = F.col("event_type")
    return (
        load("events")
        .groupBy((F.col("user_id") % 10).alias("grp"))
        .agg(
            sum_if(F.col("value").cast("decimal(18,2)"), F.col("event_id") % 2 == 0).cast("double").alias("even_sum"),
            F.round(avg_if(F.col("event_id"), kind == "view"), 4).alias("view_avg"),
            count_distinct_if(F.col("user_id"), kind == "click").alias("clickers"),
            any_if(F.col("event_id"), kind == "signup").alias("any_signup"),
        )
    )


@query(
    "agg_case_sum",
    "SELECT o_orderpriority, count(*) FILTER (WHERE o_totalprice > 300000) AS big, "
    f"{half_up('count(*) FILTER (WHERE o_totalprice > 300000) / count(*)')} AS big_share FROM orders GROUP BY o_orderpriority",
)
def agg_case_sum(load, spark):
    big = F.col("o_totalprice") > 300000
    return load("orders").groupBy("o_orderpriority").agg(F.count_if(big).alias("big"), share_of(big).alias("big_share"))


@query(
    "agg_collect",
    "SELECT o_custkey, chunk, array_to_string(list(o_orderkey ORDER BY rn), ',') AS order_keys FROM "
    "(SELECT *, (rn - 1) // 10 AS chunk FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)) "
    "GROUP BY o_custkey, chunk",
)
def agg_collect(load, spark):
    lists = collect_groups(load("orders"), ["o_custkey"], "o_orderkey", ["o_orderdate", "o_orderkey"], chunk_rows=10)
    return lists.select("o_custkey", "chunk", F.array_join("items", ",").alias("order_keys"))


@query(
    "agg_quantiles",
    "SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.5), 4) AS p50, round(quantile_cont(l_extendedprice, 0.9), 4) AS p90 "
    "FROM lineitem GROUP BY l_returnflag",
)
def agg_quantiles(load, spark):
    found = exact_quantiles(load("lineitem").select("l_returnflag", "l_extendedprice"), ["l_returnflag"], "l_extendedprice", {"p50": 0.5, "p90": 0.9})
    return found.select("l_returnflag", F.round("p50", 4).alias("p50"), F.round("p90", 4).alias("p90"))


@query(
    "agg_any_first",
    f"SELECT user_id, arg_min(v, event_id) FILTER (WHERE v IS NOT NULL) AS first_value FROM (SELECT user_id, event_id, {SPARSE_SQL} AS v FROM events) GROUP BY user_id",
)
def agg_any_first(load, spark):
    rows = load("events").select("user_id", "event_id", sparse().alias("v"))
    return rows.groupBy("user_id").agg(F.min_by("v", F.when(F.col("v").isNotNull(), F.col("event_id"))).alias("first_value"))


@query(
    "agg_ordered_first_last",
    "SELECT user_id, arg_min(event_type, (ts, event_id)) AS first_type, arg_max(event_type, (ts, event_id)) AS last_type FROM events GROUP BY user_id",
)
def agg_ordered_first_last(load, spark):
    first, last = first_last("event_type", "ts", "event_id")
    return load("events").groupBy("user_id").agg(first.alias("first_type"), last.alias("last_type"))


def _in_two_loads(df, keys, spec):
    """States of two separate loads put together."""
    parts = [to_state(df.where(F.col("event_id") % 2 == i), keys, spec) for i in (0, 1)]
    return parts[0].unionByName(parts[1])


@query("state_distinct", "SELECT event_type, true AS within_bound FROM events GROUP BY event_type")
def state_distinct(load, spark):
    events = load("events")
    spec = {"users": State("uniq", "user_id")}
    merged = read_aggregating(_in_two_loads(events, ["event_type"], spec), ["event_type"], spec)
    exact = events.groupBy("event_type").agg(F.countDistinct("user_id").alias("n"))
    return merged.join(exact, "event_type").select("event_type", (F.abs(F.col("users") - F.col("n")) <= 0.05 * F.col("n")).alias("within_bound"))


@query("state_quantile", "SELECT event_type, true AS within_bound FROM events GROUP BY event_type")
def state_quantile(load, spark):
    events = load("events").select("event_type", "event_id", "value")
    spec = {"q": State("quantiles", "value", probs=(0.5, 0.9))}
    merged = read_aggregating(_in_two_loads(events, ["event_type"], spec), ["event_type"], spec)
    # The estimate is judged by the share of values at or below it.
    judged = events.join(merged, "event_type").groupBy("event_type").agg(
        *[(F.count_if(F.col("value") <= F.col("q")[i]) / F.count("*")).alias(f"s{i}") for i in (0, 1)]
    )
    return judged.select("event_type", ((F.abs(F.col("s0") - 0.5) < 0.03) & (F.abs(F.col("s1") - 0.9) < 0.03)).alias("within_bound"))


@query(
    "state_avg_count",
    "SELECT user_id, count(*) AS n, round(avg(event_id), 6) AS mean FROM events GROUP BY user_id",
)
def state_avg_count(load, spark):
    spec = {"n": State("count", "event_id"), "mean": State("avg", "event_id")}
    done = read_aggregating(_in_two_loads(load("events"), ["user_id"], spec), ["user_id"], spec)
    return done.select("user_id", "n", F.round("mean", 6).alias("mean"))


@query(
    "state_collect",
    "SELECT user_id, load, chunk, array_to_string(list(event_id ORDER BY rn), ',') AS ids FROM "
    "(SELECT *, (rn - 1) // 20 AS chunk FROM (SELECT user_id, event_id, CAST(event_id % 2 AS INTEGER) AS load, "
    "row_number() OVER (PARTITION BY user_id, event_id % 2 ORDER BY event_id) AS rn FROM events)) GROUP BY ALL",
)
def state_collect(load, spark):
    events = load("events")
    loads = [collect_state(events.where(F.col("event_id") % 2 == i), ["user_id"], "event_id", ["event_id"], i, chunk_rows=20) for i in (0, 1)]
    return merge_collected(*loads).select("user_id", "load", "chunk", F.array_join("items", ",").alias("ids"))


@query(
    "state_any_if",
    "SELECT user_id, min(event_id) FILTER (WHERE event_type = 'purchase') AS any_purchase FROM events GROUP BY user_id",
)
def state_any_if(load, spark):
    spec = {"any_purchase": State("any_if", "event_id", cond="event_type = 'purchase'")}
    return read_aggregating(_in_two_loads(load("events"), ["user_id"], spec), ["user_id"], spec)


@query(
    "state_simple",
    "SELECT user_id, CAST(sum(event_id) AS BIGINT) AS total, max(value) AS high FROM events GROUP BY user_id",
)
def state_simple(load, spark):
    spec = {"total": State("sum", "event_id"), "high": State("max", "value")}
    return read_aggregating(_in_two_loads(load("events"), ["user_id"], spec), ["user_id"], spec)


@query(
    "agg_multi_dim_day",
    "SELECT CAST(o_orderdate AS DATE) AS day, o_orderstatus, o_orderpriority, min(o_orderdate) AS time_min, max(o_orderdate) AS time_max, "
    "avg(o_orderkey) AS o_orderkey, count(DISTINCT o_custkey) AS o_custkey_count FROM orders GROUP BY ALL",
    dates="day",
)
def agg_multi_dim_day(load, spark):
    return day_dimensions(load("orders"), "o_orderdate", ["o_orderstatus", "o_orderpriority"], ["o_orderkey"], ["o_custkey"])


@query(
    "agg_partition_counts",
    "SELECT 'month=' || strftime(ts, '%Y%m') || '/event_type=' || event_type AS partition, count(*) AS rows FROM events GROUP BY ALL",
)
def agg_partition_counts(load, spark):
    path = scratch_path(spark, "parts")
    rows = load("events").withColumn("month", F.date_format("ts", "yyyyMM"))
    write_partitioned(rows, path, "month", "event_type")
    return partition_counts(spark.read.parquet(path))


# --- windows ---


@query(
    "win_row_number",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS row_num, "
    "row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) AS in_status FROM orders",
)
def win_row_number(load, spark):
    rows = load("orders").select("o_orderkey", "o_orderstatus", "o_orderdate", "o_totalprice")
    overall = number_rows(rows, [Key("o_totalprice", desc=True), "o_orderkey"])
    # Few statuses hold all rows, so the keyed numbering takes the range-sorted way as well.
    both = number_rows(overall, ["o_orderdate", "o_orderkey"], ["o_orderstatus"], "in_status")
    return both.select("o_orderkey", "row_num", "in_status")


@query(
    "win_rank_dense",
    "SELECT l_orderkey, l_linenumber, l_quantity, rank() OVER w AS rank, dense_rank() OVER w AS dense_rank "
    "FROM lineitem WINDOW w AS (ORDER BY l_quantity DESC NULLS FIRST)",
)
def win_rank_dense(load, spark):
    rows = load("lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return rank_rows(rows, [Key("l_quantity", desc=True, nulls_first=True)])


@query(
    "win_lag_lead",
    "SELECT event_id, lag(value) OVER w AS prev_value, lead(value) OVER w AS next_value FROM events WINDOW w AS (ORDER BY ts, event_id)",
)
def win_lag_lead(load, spark):
    rows = load("events").select("event_id", "ts", "value")
    return neighbours(rows, ["ts", "event_id"], "value", "prev_value", "next_value").drop("ts", "value")


@query(
    "win_total",
    f"SELECT c_custkey, c_acctbal, (SELECT {money('c_acctbal')} FROM customer) AS total FROM customer",
)
def win_total(load, spark):
    customer = load("customer").select("c_custkey", "c_acctbal")
    return customer.withColumn("total", customer.agg(exact_sum(F.col("c_acctbal"))).scalar())


@query(
    "win_running_sum",
    "SELECT l_orderkey, l_linenumber, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) OVER (ORDER BY l_shipdate) AS DOUBLE) AS running FROM lineitem",
)
def win_running_sum(load, spark):
    rows = load("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice")
    summed = running_sum(rows, ["l_shipdate"], F.col("l_extendedprice").cast("decimal(18,2)"), "running")
    return summed.select("l_orderkey", "l_linenumber", F.col("running").cast("double").alias("running"))


@query(
    "win_count_partition",
    "SELECT o_orderkey, o_custkey, n FROM (SELECT o_orderkey, o_custkey, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders) WHERE n > 12",
)
def win_count_partition(load, spark):
    rows = load("orders").select("o_orderkey", "o_custkey")
    return with_group_values(rows, ["o_custkey"], F.count("*").alias("n")).where("n > 12")


ZONES_SQL = (
    "SELECT CASE WHEN l_suppkey % 7 = 0 THEN 'V' ELSE '' END || l_suppkey AS plant, "
    "CASE WHEN l_linenumber = 1 THEN '' WHEN l_linenumber = 2 THEN NULL ELSE 'RUS' || lpad(CAST((l_suppkey + l_partkey % 3) % 13 AS VARCHAR), 2, '0') END AS time_zone "
    "FROM lineitem"
)


def zone_rows(lineitem):
    """Many zone rows per plant: blank, missing and different codes."""
    key = F.col("l_suppkey")
    number = ((key + F.col("l_partkey") % 3) % 13).cast("string")
    return lineitem.select(
        F.concat(F.when(key % 7 == 0, "V").otherwise(""), key.cast("string")).alias("plant"),
        F.when(F.col("l_linenumber") == 1, "")
        .when(F.col("l_linenumber") == 2, F.lit(None))
        .otherwise(F.concat(F.lit("RUS"), F.lpad(number, 2, "0")))
        .alias("time_zone"),
    )


@query(
    "win_dedup_pick",
    f"SELECT plant, time_zone FROM (SELECT *, row_number() OVER (PARTITION BY plant ORDER BY coalesce(time_zone, '') <> '' DESC, time_zone DESC NULLS LAST) AS rn FROM ({ZONES_SQL})) WHERE rn = 1",
)
def win_dedup_pick(load, spark):
    rows = zone_rows(load("lineitem"))
    filled = F.coalesce(F.col("time_zone") != "", F.lit(False))
    return pick_one(rows, ["plant"], [filled, "time_zone"], last=True)


@query(
    "win_first_non_null",
    f"SELECT event_id, user_id, arg_min(v, (ts, event_id)) FILTER (WHERE v IS NOT NULL) OVER (PARTITION BY user_id) AS first_value "
    f"FROM (SELECT *, {SPARSE_SQL} AS v FROM events)",
)
def win_first_non_null(load, spark):
    rows = load("events").select("event_id", "user_id", "ts", sparse().alias("v"))
    return first_non_null(rows, ["user_id"], "v", ["ts", "event_id"], "first_value").drop("ts", "v")
