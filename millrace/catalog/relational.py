"""Projection, filter, sort, limit, joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.nested import dims_and_metrics, dots_to_underscores, flatten, strip_prefix
from ..functions.texts import normalised_md5, without_at
from ..operators.aggregates import exact_sum
from ..operators.asof import asof_join
from ..operators.intervals import interval_join
from ..operators.joins import broadcast_if_small, first_event, join_by_text_hash, join_text_id
from ..operators.ordering import Key, page
from ..operators.projection import audit_columns, next_version, project_typed, rename_columns
from ..operators.sets import dedup_key, union_coerced, union_named
from ..session import planned_bytes, scratch_path
from ..sources.writers import bucket_count, write_bucketed, write_colocated
from .base import K_SQL, half_up, k_of, money, query

NTZ = "timestamp_ntz"


@query("sel_star", "SELECT * FROM customer")
def sel_star(load, spark):
    return load("customer").select("*")


@query("filter_eq", "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'")
def filter_eq(load, spark):
    return load("customer").where(F.col("c_mktsegment") == "BUILDING")


@query(
    "filter_like",
    "SELECT c_custkey, c_name, c_name ILIKE 'customer#%7' AS ends_in_seven FROM customer WHERE c_name LIKE 'Customer_00000%1_'",
)
def filter_like(load, spark):
    return (
        load("customer")
        .where(F.col("c_name").like("Customer_00000%1_"))
        .select("c_custkey", "c_name", F.col("c_name").ilike("customer#%7").alias("ends_in_seven"))
    )


@query(
    "filter_and_or",
    "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer "
    "WHERE (c_mktsegment = 'MACHINERY' AND c_acctbal > 5000) OR c_acctbal < 0 OR c_nationkey = 3",
)
def filter_and_or(load, spark):
    rich = (F.col("c_mktsegment") == "MACHINERY") & (F.col("c_acctbal") > 5000)
    return (
        load("customer")
        .where(rich | (F.col("c_acctbal") < 0) | (F.col("c_nationkey") == 3))
        .select("c_custkey", "c_mktsegment", "c_acctbal")
    )


@query(
    "filter_between",
    "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders "
    "WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-03-31' AND o_totalprice BETWEEN 1000 AND 200000",
)
def filter_between(load, spark):
    first, last = (F.lit(d).cast(NTZ) for d in ("1997-01-01", "1997-03-31"))
    return (
        load("orders")
        .where(F.col("o_orderdate").between(first, last) & F.col("o_totalprice").between(1000, 200000))
        .select("o_orderkey", "o_orderdate", "o_totalprice")
    )


@query(
    "filter_regex",
    "SELECT page_id, url FROM pages WHERE regexp_matches(url, '^https://(m|blog)\\.') AND regexp_matches(url, '/[0-9]+(/|\\.html|#top)?$')",
)
def filter_regex(load, spark):
    return (
        load("pages")
        .where(F.col("url").rlike(r"^https://(m|blog)\.") & F.col("url").rlike(r"/[0-9]+(/|\.html|#top)?$"))
        .select("page_id", "url")
    )


@query("filter_bands", "SELECT event_id, value FROM events WHERE value > 80 OR value < 20")
def filter_bands(load, spark):
    return load("events").where((F.col("value") > 80) | (F.col("value") < 20)).select("event_id", "value")


@query(
    "filter_not_null",
    "SELECT page_id, TRY_CAST(regexp_extract(url, '/([0-9]+)$', 1) AS BIGINT) AS item FROM pages "
    "WHERE TRY_CAST(regexp_extract(url, '/([0-9]+)$', 1) AS BIGINT) IS NOT NULL",
)
def filter_not_null(load, spark):
    item = F.regexp_extract("url", "/([0-9]+)$", 1).try_cast("bigint").alias("item")
    return load("pages").select("page_id", item).where(F.col("item").isNotNull())


@query("rename_dotted", "SELECT event_id AS visit_id, user_id AS client_id, value AS reading FROM events")
def rename_dotted(load, spark):
    raw = load("events").select(
        F.col("event_id").alias("ym:s:visitID"), F.col("user_id").alias("ym:s:clientID"), F.col("value").alias("hourly.value")
    )
    return rename_columns(raw, {"ym:s:visitID": "visit_id", "ym:s:clientID": "client_id", "hourly.value": "reading"})


@query(
    "rename_strip_prefix",
    "SELECT p_partkey AS partkey, p_brand AS brand, p_size AS size, p_retailprice AS price_retail FROM part",
)
def rename_strip_prefix(load, spark):
    raw = load("part").select("p_partkey", "p_brand", "p_size", F.col("p_retailprice").alias("p_price.retail"))
    return dots_to_underscores(strip_prefix(raw, "p_"))


@query(
    "project_typed",
    "SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS INTEGER) AS o_custkey, "
    "CAST(o_orderdate AS DATE) AS o_orderdate, TRY_CAST(o_orderpriority AS INTEGER) AS o_orderpriority FROM orders",
    dates="o_orderdate",
)
def project_typed_query(load, spark):
    types = {"o_orderkey": "string", "o_custkey": "int", "o_orderdate": "date", "o_orderpriority": "int"}
    return project_typed(load("orders"), types, {"o_orderkey": "order_id"})


@query(
    "lateral_alias",
    "SELECT o_orderkey, o_totalprice * 2 AS double_price, o_totalprice * 2 + 1 AS plus_one FROM orders",
)
def lateral_alias(load, spark):
    return load("orders").select(
        "o_orderkey", F.expr("o_totalprice * 2 AS double_price"), F.expr("double_price + 1 AS plus_one")
    )


@query(
    "sort_multi",
    "SELECT c_mktsegment, c_acctbal, c_custkey FROM customer ORDER BY c_mktsegment, c_acctbal DESC NULLS FIRST, c_custkey",
)
def sort_multi(load, spark):
    # The unique last key lets the range sort split rows that agree on the others.
    order = [Key("c_mktsegment"), Key("c_acctbal", desc=True, nulls_first=True), Key("c_custkey")]
    return load("customer").select("c_mktsegment", "c_acctbal", "c_custkey").orderBy(*[k.sort() for k in order])


@query("limit_topk", "SELECT event_id, value FROM events ORDER BY value DESC NULLS LAST, event_id LIMIT 5")
def limit_topk(load, spark):
    return load("events").select("event_id", "value").orderBy(F.col("value").desc_nulls_last(), "event_id").limit(5)


@query("limit_offset", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal NULLS LAST, c_custkey LIMIT 20 OFFSET 40")
def limit_offset(load, spark):
    return page(load("customer").select("c_custkey", "c_acctbal"), ["c_acctbal", "c_custkey"], 20, 40)


@query("distinct_rows", "SELECT DISTINCT p_brand, p_type FROM part")
def distinct_rows(load, spark):
    return load("part").select("p_brand", "p_type").distinct()


@query(
    "audit_columns",
    "SELECT event_id, TIMESTAMP '2024-02-01 06:00:00' AS updated_at, CAST(1706767200 AS BIGINT) AS version, "
    "CAST(ts AS DATE) AS business_date FROM events",
    dates="business_date",
)
def audit(load, spark):
    rows = load("events").select("event_id", "ts")
    return audit_columns(rows, F.lit("2024-02-01 06:00:00"), "ts").drop("ts")


@query(
    "version_next",
    "SELECT c_custkey, c_name, (SELECT CAST(max(c_nationkey) AS INTEGER) + 1 FROM customer) AS version FROM customer",
)
def version_next(load, spark):
    customer = load("customer")
    loaded = customer.select("c_custkey", F.col("c_nationkey").alias("version"))
    return next_version(customer.select("c_custkey", "c_name"), loaded)


@query(
    "normalise_json_rows",
    f"SELECT event_id, {K_SQL} AS props_k, user_id AS who_id, event_type AS who_act_type FROM events",
)
def normalise_json_rows(load, spark):
    nested = load("events").select(
        "event_id",
        F.from_json("props", "k int").alias("props"),
        F.struct(F.col("user_id").alias("id"), F.struct(F.col("event_type").alias("type")).alias("act")).alias("who"),
    )
    return flatten(nested)


@query(
    "zip_dims_metrics",
    "SELECT o_orderkey AS day_id, o_orderstatus AS status, o_orderpriority AS priority, o_totalprice AS price, "
    "CAST(o_custkey AS DOUBLE) AS customer, CAST(NULL AS DOUBLE) AS absent FROM orders",
)
def zip_dims_metrics(load, spark):
    raw = load("orders").select(
        F.col("o_orderkey").alias("day_id"),
        F.array(F.struct(F.col("o_orderstatus").alias("name")), F.struct(F.col("o_orderpriority").alias("name"))).alias("dimensions"),
        F.array("o_totalprice", F.col("o_custkey").cast("double")).alias("metrics"),
    )
    return dims_and_metrics(raw, ["status", "priority"], ["price", "customer", "absent"], ["day_id"])


@query("drop_columns", "SELECT * EXCLUDE (l_tax, l_discount, l_extendedprice, l_quantity) FROM lineitem")
def drop_columns(load, spark):
    return load("lineitem").drop("l_tax", "l_discount", "l_extendedprice", "l_quantity")


# --- joins ---


@query(
    "join_inner",
    "SELECT o_orderkey, c_name, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey",
)
def join_inner(load, spark):
    return (
        load("orders")
        .join(load("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(load("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "c_name", "n_name")
    )


@query(
    "join_left",
    "SELECT c_custkey, coalesce(o.n, 0) AS n_orders, coalesce(o.status, 'none') AS status FROM customer LEFT JOIN "
    "(SELECT o_custkey, o_orderstatus AS status, count(*) AS n FROM orders GROUP BY ALL) o ON c_custkey = o_custkey",
)
def join_left(load, spark):
    big = load("orders").groupBy("o_custkey", F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"))
    return (
        load("customer")
        .join(big, F.col("c_custkey") == F.col("o_custkey"), "left")
        .select("c_custkey", F.coalesce("n", F.lit(0)).alias("n_orders"), F.coalesce("status", F.lit("none")).alias("status"))
    )


@query(
    "join_right",
    "SELECT s_name, n_name FROM (SELECT s_name, CASE WHEN s_nationkey % 5 = 0 THEN s_nationkey + 100 ELSE s_nationkey END AS k FROM supplier) RIGHT JOIN nation ON k = n_nationkey",
)
def join_right(load, spark):
    # Every fifth nation loses its suppliers.
    moved = F.when(F.col("s_nationkey") % 5 == 0, F.col("s_nationkey") + 100).otherwise(F.col("s_nationkey"))
    suppliers = load("supplier").select("s_name", moved.alias("k"))
    return suppliers.join(load("nation"), F.col("k") == F.col("n_nationkey"), "right").select("s_name", "n_name")


@query(
    "join_using",
    "SELECT user_id, event_type, e.event_id, t.n FROM events e JOIN "
    "(SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL) t USING (user_id, event_type)",
)
def join_using(load, spark):
    events = load("events").select("user_id", "event_type", "event_id")
    return events.join(events.groupBy("user_id", "event_type").agg(F.count("*").alias("n")), ["user_id", "event_type"])


@query(
    "join_mixed_type_key",
    "SELECT l_orderkey, l_linenumber, l_extendedprice, s_name FROM lineitem JOIN "
    "(SELECT CASE WHEN s_suppkey % 7 = 0 THEN 'V' ELSE '0' END || s_suppkey AS plant, s_name FROM supplier) z "
    "ON l_suppkey = TRY_CAST(plant AS BIGINT)",
)
def join_mixed_type_key(load, spark):
    prefix = F.when(F.col("s_suppkey") % 7 == 0, "V").otherwise("0")
    texts = load("supplier").select(F.concat(prefix, F.col("s_suppkey").cast("string")).alias("plant"), "s_name")
    joined = join_text_id(load("lineitem"), texts, "l_suppkey", "plant")
    return joined.select("l_orderkey", "l_linenumber", "l_extendedprice", "s_name")


@query(
    "join_two_key",
    f"SELECT a.event_id, b.event_id AS later_id FROM events a JOIN "
    f"(SELECT event_id, event_id - {K_SQL} AS source_id, event_type FROM events) b "
    "ON a.event_id = b.source_id AND a.event_type = b.event_type",
)
def join_two_key(load, spark):
    events = load("events")
    later = events.select(
        F.col("event_id").alias("later_id"), (F.col("event_id") - k_of()).alias("event_id"), "event_type"
    )
    return events.join(later, ["event_id", "event_type"]).select("event_id", "later_id")


@query(
    "join_hash_key",
    "SELECT c_custkey, r.n_name AS region FROM customer LEFT JOIN "
    "(SELECT md5('nation ' || CASE WHEN n_nationkey % 6 = 0 THEN n_nationkey + 100 ELSE n_nationkey END) AS h, n_name FROM nation) r "
    "ON md5(lower(trim('  Nation ' || c_nationkey || ' '))) = r.h",
)
def join_hash_key(load, spark):
    texts = load("customer").select(
        "c_custkey", F.concat(F.lit("  Nation "), F.col("c_nationkey").cast("string"), F.lit(" ")).alias("place")
    )
    # Every sixth nation has a key that no customer has.
    key = F.when(F.col("n_nationkey") % 6 == 0, F.col("n_nationkey") + 100).otherwise(F.col("n_nationkey"))
    label = F.concat(F.lit("nation "), key.cast("string"))
    regions = load("nation").select(normalised_md5(label).alias("place_hash"), F.col("n_name").alias("region"))
    return join_by_text_hash(texts, regions, "place", "place_hash").select("c_custkey", "region")


@query(
    "join_broadcast",
    f"SELECT n_name, {money('o_totalprice')} AS total, count(*) AS n_orders FROM orders "
    "JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name",
)
def join_broadcast(load, spark):
    customers = broadcast_if_small(load("customer").select("c_custkey", "c_nationkey"))
    nations = broadcast_if_small(load("nation").select("n_nationkey", "n_name"))
    return (
        load("orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name")
        .agg(exact_sum(F.col("o_totalprice")).alias("total"), F.count("*").alias("n_orders"))
    )


@query(
    "join_colocated",
    f"SELECT o_orderpriority, count(*) AS lines, {money('l_extendedprice')} AS price FROM lineitem "
    "JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority",
)
def join_colocated(load, spark):
    lines, orders = load("lineitem").select("l_orderkey", "l_extendedprice"), load("orders").select("o_orderkey", "o_orderpriority")
    # Both sides need the same number of buckets; the larger one sets it.
    buckets = bucket_count(max(planned_bytes(lines), planned_bytes(orders)), least=spark.sparkContext.defaultParallelism)
    lines = _bucketed(lines, "lines", "l_orderkey", spark, buckets)
    orders = _bucketed(orders, "orders", "o_orderkey", spark, buckets)
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_orderpriority")
        .agg(F.count("*").alias("lines"), exact_sum(F.col("l_extendedprice")).alias("price"))
    )


@query(
    "join_colocated_heavy_key",
    f"SELECT o_orderpriority, count(*) AS lines, {money('l_extendedprice')} AS price FROM (SELECT l_extendedprice, "
    "CASE WHEN l_linenumber = 1 THEN (SELECT min(o_orderkey) FROM orders) ELSE l_orderkey END AS l_key FROM lineitem) "
    "JOIN orders ON l_key = o_orderkey GROUP BY o_orderpriority",
)
def join_colocated_heavy_key(load, spark):
    """First lines all go to one order, so that a quarter of the table or more has one key; it is dealt over several buckets."""
    orders = load("orders").select("o_orderkey", "o_orderpriority")
    first = orders.agg(F.min("o_orderkey")).scalar()
    lines = load("lineitem").select(F.when(F.col("l_linenumber") == 1, first).otherwise(F.col("l_orderkey")).alias("l_key"), "l_extendedprice")
    buckets = bucket_count(max(planned_bytes(lines), planned_bytes(orders)), least=spark.sparkContext.defaultParallelism)
    paths = scratch_path(spark, "heavy-lines"), scratch_path(spark, "heavy-orders")
    names = f"heavy_lines_{paths[0][-32:]}", f"heavy_orders_{paths[1][-32:]}"
    lines, orders = write_colocated(lines, orders, names, paths, ("l_key", "o_orderkey"), buckets)
    return (
        lines.join(orders, (F.col("l_key") == F.col("o_orderkey")) & (lines["part"] == orders["part"]))
        .groupBy("o_orderpriority")
        .agg(F.count("*").alias("lines"), exact_sum(F.col("l_extendedprice")).alias("price"))
    )


def _bucketed(df, label, key, spark, buckets):
    path = scratch_path(spark, label)
    return write_bucketed(df, f"{label}_{path[-32:]}", path, key, buckets)


@query(
    "join_asof",
    "SELECT a.user_id, a.event_id AS purchase_id, a.ts AS purchase_ts, b.event_id AS view_id, b.ts AS view_ts "
    "FROM (SELECT * FROM events WHERE event_type = 'purchase') a "
    "ASOF JOIN (SELECT * FROM events WHERE event_type = 'view') b ON a.user_id = b.user_id AND a.ts < b.ts",
)
def join_asof(load, spark):
    events = load("events")
    buys = events.where("event_type = 'purchase'").select(
        "user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchase_ts")
    )
    views = events.where("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("view_ts"))
    return asof_join(buys, views, ["user_id"], "purchase_ts", "view_ts", "<", tie="view_id")


@query(
    "join_asof_back_left",
    "SELECT a.user_id, a.event_id AS click_id, b.event_id AS signup_id, b.value AS signup_value "
    "FROM (SELECT * FROM events WHERE event_type = 'click') a "
    "ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') b ON a.user_id = b.user_id AND a.ts >= b.ts",
)
def join_asof_back_left(load, spark):
    events = load("events")
    clicks = events.where("event_type = 'click'").select("user_id", F.col("event_id").alias("click_id"), "ts")
    signups = events.where("event_type = 'signup'").select(
        "user_id", F.col("event_id").alias("signup_id"), F.col("ts").alias("signup_ts"), F.col("value").alias("signup_value")
    )
    found = asof_join(clicks, signups, ["user_id"], "ts", "signup_ts", ">=", tie="signup_id", how="left")
    return found.select("user_id", "click_id", "signup_id", "signup_value")


# One promotion starts on each day with events and runs for 30 hours, so neighbours overlap.
PROMO_SQL = (
    "SELECT 'promo_' || CAST(day AS VARCHAR) AS event_name, day + INTERVAL 9 HOUR AS start_time, day + INTERVAL 39 HOUR AS end_time "
    "FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events)"
)


def promotions(events):
    start = F.col("day").cast(NTZ)
    days = events.select(F.to_date("ts").alias("day")).distinct()
    return days.select(
        F.concat(F.lit("promo_"), F.col("day").cast("string")).alias("event_name"),
        (start + F.expr("INTERVAL 9 HOURS")).alias("start_time"),
        (start + F.expr("INTERVAL 39 HOURS")).alias("end_time"),
    )


@query(
    "join_interval",
    f"SELECT e.event_id, p.event_name FROM events e JOIN ({PROMO_SQL}) p ON e.ts BETWEEN p.start_time AND p.end_time",
)
def join_interval(load, spark):
    events = load("events")
    return interval_join(events.select("event_id", "ts"), promotions(events), "ts", "start_time", "end_time").select("event_id", "event_name")


@query(
    "join_semi_in_set",
    "SELECT * FROM orders WHERE (o_custkey, o_orderstatus) IN "
    "(SELECT o_custkey, o_orderstatus FROM orders WHERE o_totalprice > 450000)",
)
def join_semi_in_set(load, spark):
    orders = load("orders")
    wanted = orders.where("o_totalprice > 450000").select("o_custkey", "o_orderstatus")
    return orders.join(wanted, ["o_custkey", "o_orderstatus"], "left_semi")


@query(
    "join_anti_delete",
    "SELECT * FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01')",
)
def join_anti_delete(load, spark):
    staged = load("orders").where(F.col("o_orderdate") >= F.lit("2000-01-01").cast(NTZ)).select(F.col("o_custkey").alias("c_custkey"))
    return load("customer").join(staged, "c_custkey", "left_anti")


@query(
    "subquery_scalar",
    "SELECT c_custkey, c_acctbal FROM customer WHERE CAST(c_acctbal AS DECIMAL(18,2)) * (SELECT count(*) FROM customer) "
    "> (SELECT sum(CAST(c_acctbal AS DECIMAL(18,2))) FROM customer)",
)
def subquery_scalar(load, spark):
    customer = load("customer")
    balance = F.col("c_acctbal").cast("decimal(18,2)")
    mean = customer.agg(F.avg(balance)).scalar()
    return customer.where(balance > mean).select("c_custkey", "c_acctbal")


@query(
    "join_first_event",
    "SELECT user_id, event_type, arg_min(event_id, (ts, event_id)) AS event_id, arg_min(value, (ts, event_id)) AS value "
    "FROM events GROUP BY user_id, event_type",
)
def join_first_event(load, spark):
    rows = load("events").select("user_id", "event_type", "event_id", "ts", "value")
    return first_event(rows, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


# --- unions and de-duplication ---


@query(
    "union_all",
    "SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT s_suppkey, s_name FROM supplier",
)
def union_all(load, spark):
    suppliers = load("supplier").select("s_suppkey", "s_name")
    return load("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")).unionAll(suppliers).unionAll(suppliers)


@query(
    "union_by_name",
    "SELECT c_custkey AS id, c_acctbal AS balance FROM customer UNION ALL BY NAME SELECT s_acctbal AS balance, s_suppkey AS id FROM supplier",
)
def union_by_name(load, spark):
    a = load("customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))
    b = load("supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"))
    return union_named(a, b)


@query(
    "union_coerced",
    "SELECT o_orderkey AS id, TRY_CAST(o_custkey AS INTEGER) AS item_count, 'orders' AS origin FROM orders UNION ALL "
    "SELECT p_partkey, coalesce(TRY_CAST(CASE WHEN p_size % 5 = 0 THEN 'n/a' ELSE CAST(p_size AS VARCHAR) END AS INTEGER), NULL), 'part' FROM part",
)
def union_coerced_query(load, spark):
    orders = load("orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("item_count"), F.lit("orders").alias("origin"))
    size = F.when(F.col("p_size") % 5 == 0, "n/a").otherwise(F.col("p_size").cast("string"))
    parts = load("part").select(F.col("p_partkey").cast("string").alias("id"), size.alias("item_count"), F.lit("part").alias("origin"))
    return union_coerced({"id": "bigint", "item_count": "int", "origin": "string"}, orders, parts)


@query("dedup_full", "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def dedup_full(load, spark):
    return load("lineitem").select("l_orderkey", "l_linenumber", "l_returnflag").dropDuplicates()


@query(
    "dedup_key",
    "SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey, min(o_orderdate) AS o_orderdate FROM orders GROUP BY o_custkey",
)
def dedup_key_query(load, spark):
    return dedup_key(load("orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"])
