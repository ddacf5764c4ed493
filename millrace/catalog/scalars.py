"""Scalar functions and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import casts, texts, times
from ..functions.nested import (
    explode_days,
    explode_id_text,
    explode_structs,
    explode_zipped,
    key_value_lists,
    pairs_to_columns,
)
from .base import K_SQL, half_up, k_of, query


@query(
    "fn_case",
    "SELECT c_custkey, CASE WHEN c_acctbal > 6000 THEN 'high' WHEN c_acctbal BETWEEN 2000 AND 6000 THEN 'middle' ELSE 'low' END AS level FROM customer",
)
def fn_case(load, spark):
    b = F.col("c_acctbal")
    return load("customer").select("c_custkey", F.when(b > 6000, "high").when(b.between(2000, 6000), "middle").otherwise("low").alias("level"))


@query(
    "fn_null",
    "SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment, coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') AS filled, "
    "CASE WHEN c_acctbal < 0 THEN 0.0::DOUBLE ELSE c_acctbal END AS balance FROM customer",
)
def fn_null(load, spark):
    segment = F.nullif("c_mktsegment", F.lit("BUILDING"))
    rows = load("customer").select(
        "c_custkey", segment.alias("segment"), segment.alias("filled"), F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance")
    )
    return rows.fillna({"filled": "none", "balance": 0.0})


@query(
    "fn_greatest_least",
    "SELECT c_custkey, greatest(CASE WHEN c_nationkey <> 3 THEN c_acctbal END, 5000.0::DOUBLE) AS top, least(CASE WHEN c_nationkey <> 3 THEN c_acctbal END, 5000.0::DOUBLE) AS bottom FROM customer",
)
def fn_greatest_least(load, spark):
    v = F.when(F.col("c_nationkey") != 3, F.col("c_acctbal"))
    fixed = F.lit(5000.0)
    return load("customer").select("c_custkey", F.greatest(v, fixed).alias("top"), F.least(v, fixed).alias("bottom"))


@query(
    "fn_string_basic",
    "SELECT doc_id, substring(text, 1, 5) AS head, lower(text) AS low, replace(upper(text), 'ẞ', 'SS') AS up, trim('  ' || source || ' ') AS trimmed, length(text) AS len FROM documents",
)
def fn_string_basic(load, spark):
    return load("documents").select(
        "doc_id",
        F.substring("text", 1, 5).alias("head"),
        F.lower("text").alias("low"),
        F.upper("text").alias("up"),
        F.trim(F.concat(F.lit("  "), "source", F.lit(" "))).alias("trimmed"),
        F.length("text").cast("bigint").alias("len"),
    )


@query(
    "fn_string_tail",
    "SELECT c_custkey, right(c_name, 4) AS tail, substring(c_name, length(c_name) - 2, 3) AS last_three, CAST(right(c_name, 3) AS INTEGER) AS number FROM customer",
)
def fn_string_tail(load, spark):
    return load("customer").select(
        "c_custkey",
        F.right("c_name", F.lit(4)).alias("tail"),
        F.substring("c_name", -3, 3).alias("last_three"),
        F.right("c_name", F.lit(3)).try_cast("int").alias("number"),
    )


@query(
    "fn_regex",
    "SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, replace(url, 'example', 'sample') AS swapped, "
    "CAST(regexp_replace(url, '[^0-9]', '', 'g') AS BIGINT) AS digits, ltrim('00' || page_id, '0') AS no_zeros, "
    "length(html) - length(replace(html, '<', '')) AS tags FROM pages",
)
def fn_regex(load, spark):
    return load("pages").select(
        "page_id",
        F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"),
        F.replace("url", F.lit("example"), F.lit("sample")).alias("swapped"),
        casts.strip_to_number(F.col("url")).alias("digits"),
        F.regexp_replace(F.concat(F.lit("00"), F.col("page_id").cast("string")), "^0+", "").alias("no_zeros"),
        (F.length("html") - F.length(F.replace("html", F.lit("<"), F.lit("")))).cast("bigint").alias("tags"),
    )


@query(
    "fn_split_part",
    "SELECT page_id, trim(split_part(url, '.', 1)) AS first, CASE WHEN length(url) - length(replace(url, '.', '')) >= 3 THEN trim(split_part(url, '.', 4)) ELSE 'Other' END AS fourth FROM pages",
)
def fn_split_part(load, spark):
    url = F.col("url")
    return load("pages").select(
        "page_id",
        texts.split_part_trim(url, 0, r"\.").alias("first"),
        texts.split_part_trim(url, 3, r"\.", default="Other").alias("fourth"),
    )


@query(
    "fn_concat",
    "SELECT o_orderkey, o_orderstatus || '-' || o_orderpriority AS joined, o_orderstatus || ', ' || o_orderkey AS listed, "
    "CASE WHEN o_custkey % 2 = 0 THEN o_orderstatus || ', ' || o_orderpriority END AS maybe FROM orders",
)
def fn_concat(load, spark):
    both = F.when(F.col("o_custkey") % 2 == 0, F.array("o_orderstatus", "o_orderpriority"))
    return load("orders").select(
        "o_orderkey",
        F.concat("o_orderstatus", F.lit("-"), "o_orderpriority").alias("joined"),
        F.concat_ws(", ", "o_orderstatus", F.col("o_orderkey").cast("string")).alias("listed"),
        texts.joined_or_null(both).alias("maybe"),
    )


@query(
    "fn_hash",
    "SELECT doc_id, md5(lower(trim(text, ' '))) AS digest, true AS in_range FROM documents",
)
def fn_hash(load, spark):
    bucket = texts.bucket_of(16, "doc_id")
    return load("documents").select("doc_id", texts.normalised_md5(F.col("text")).alias("digest"), bucket.between(0, 15).alias("in_range"))


@query(
    "fn_date_pg",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, strftime(o_orderdate, '%Y-%m') AS month, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, "
    "CAST(o_orderdate AS DATE) + 1 AS next_day, o_orderdate + INTERVAL 1 HOUR AS hour_later, CAST(dayofweek(o_orderdate) AS INTEGER) AS dow FROM orders",
    dates="day month_start next_day",
)
def fn_date_pg(load, spark):
    d = F.col("o_orderdate")
    return load("orders").select(
        "o_orderkey",
        F.to_date(d).alias("day"),
        F.date_format(d, "yyyy-MM").alias("month"),
        F.trunc(d, "month").alias("month_start"),
        F.date_add(F.to_date(d), 1).alias("next_day"),
        (d + F.expr("INTERVAL 1 HOUR")).alias("hour_later"),
        times.sunday_zero(d).alias("dow"),
    )


@query(
    "fn_epoch",
    "SELECT event_id, date_trunc('second', ts) AS from_s, date_trunc('millisecond', ts) AS from_ms, ts AS from_us, ts AS from_ns, "
    "TIMESTAMP '1970-01-01' - INTERVAL 1 SECOND * event_id AS before_epoch FROM events",
)
def fn_epoch(load, spark):
    us = times.to_micros(F.col("ts"))
    return load("events").select(
        "event_id",
        times.from_epoch(F.floor(us / 1_000_000), "s").alias("from_s"),
        times.from_epoch(F.floor(us / 1000), "ms").alias("from_ms"),
        times.from_epoch(us, "us").alias("from_us"),
        times.from_epoch(us * 1000 + F.col("event_id") % 1000, "ns").alias("from_ns"),
        times.from_epoch(-F.col("event_id"), "s").alias("before_epoch"),
    )


@query(
    "fn_parse_ts",
    "SELECT event_id, date_trunc('second', ts) AS from_space, date_trunc('millisecond', ts) AS from_iso, CASE WHEN event_id % 5 = 0 THEN NULL ELSE date_trunc('second', ts) END AS best_effort, CAST(ts AS DATE) AS day FROM events",
    dates="day",
)
def fn_parse_ts(load, spark):
    space = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    mixed = (
        F.when(F.col("event_id") % 5 == 0, "soon")
        .when(F.col("event_id") % 2 == 0, space)
        .otherwise(F.date_format("ts", "dd.MM.yyyy HH:mm:ss"))
    )
    return load("events").select(
        "event_id",
        times.parse_ts(space, "yyyy-MM-dd HH:mm:ss").alias("from_space"),
        times.parse_ts(iso, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("from_iso"),
        times.parse_ts(mixed, "yyyy-MM-dd HH:mm:ss", "dd.MM.yyyy HH:mm:ss").alias("best_effort"),
        F.left(space, F.lit(10)).try_cast("date").alias("day"),
    )


@query(
    "fn_trunc_precision",
    "SELECT event_id, date_trunc('second', ts) AS s, date_trunc('millisecond', ts) AS ms, ts AS us FROM events",
)
def fn_trunc_precision(load, spark):
    ts = F.col("ts")
    return load("events").select("event_id", *[times.truncate_precision(ts, d).alias(n) for d, n in ((0, "s"), (3, "ms"), (6, "us"))])


@query(
    "fn_calendar_keys",
    "SELECT o_orderkey, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS month_key, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS day_key, "
    "CAST(date_trunc('week', o_orderdate) AS DATE) AS monday, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(o_orderdate AS DATE) + 10 AS later, "
    "CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS days FROM orders",
    dates="monday later",
)
def fn_calendar_keys(load, spark):
    d = F.col("o_orderdate")
    return load("orders").select(
        "o_orderkey",
        times.month_key(d).alias("month_key"),
        F.date_format(d, "yyyyMMdd").cast("int").alias("day_key"),
        times.monday_of(d).alias("monday"),
        F.year(d).alias("year"),
        F.date_add(F.to_date(d), 10).alias("later"),
        F.datediff(F.to_date(d), F.lit("1995-01-01").cast("date")).alias("days"),
    )


# Text numbers of which some cannot be read.
NUMBER_TEXT_SQL = "CASE p_size % 4 WHEN 0 THEN CAST(p_size AS VARCHAR) WHEN 1 THEN CAST(-p_size AS VARCHAR) WHEN 2 THEN p_size || 'a' END"


def number_text():
    size = F.col("p_size")
    text = size.cast("string")
    return (
        F.when(size % 4 == 0, text).when(size % 4 == 1, (-size).cast("string")).when(size % 4 == 2, F.concat(text, F.lit("a")))
    )


@query(
    "fn_cast_or",
    "SELECT p_partkey, TRY_CAST(v AS BIGINT) AS or_null, coalesce(TRY_CAST(v AS BIGINT), 0) AS or_zero, coalesce(TRY_CAST(v AS BIGINT), -100) AS or_default "
    f"FROM (SELECT p_partkey, {NUMBER_TEXT_SQL} AS v FROM part)",
)
def fn_cast_or(load, spark):
    v = F.col("v")
    return load("part").select("p_partkey", number_text().alias("v")).select(
        "p_partkey",
        casts.cast_or_null(v, "bigint").alias("or_null"),
        casts.cast_or_zero(v, "bigint").alias("or_zero"),
        casts.cast_or_default(v, "bigint", -100).alias("or_default"),
    )


@query(
    "fn_cast_unsigned",
    "SELECT c_custkey, ((CAST(trunc(c_acctbal) AS BIGINT) % 256) + 256) % 256 AS u8, ((CAST(trunc(c_acctbal) AS BIGINT) % 65536) + 65536) % 65536 AS u16 FROM customer",
)
def fn_cast_unsigned(load, spark):
    b = F.col("c_acctbal")
    return load("customer").select("c_custkey", casts.cast_unsigned(b, 8).alias("u8"), casts.cast_unsigned(b, 16).alias("u16"))


@query(
    "fn_cast_strict",
    "SELECT o_orderkey, CAST(CAST(o_custkey AS VARCHAR) AS INTEGER) AS customer, CAST(substring(o_orderpriority, 1, 1) AS SMALLINT) AS priority FROM orders",
)
def fn_cast_strict(load, spark):
    return load("orders").select(
        "o_orderkey",
        casts.cast_strict(F.col("o_custkey").cast("string"), "int", "o_custkey").alias("customer"),
        casts.cast_strict(F.left("o_orderpriority", F.lit(1)), "smallint", "o_orderpriority").alias("priority"),
    )


@query(
    "fn_round_math",
    f"SELECT l_orderkey, l_linenumber, CAST(round(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_discount AS DECIMAL(15,2)), 2) AS DOUBLE) AS rebate, l_orderkey % 10 AS digit, "
    f"CASE WHEN l_discount <> 0 THEN {half_up('l_tax / l_discount', 4)} END AS ratio, (l_linenumber + 1) * 10 AS scaled FROM lineitem",
)
def fn_round_math(load, spark):
    price, off = (F.col(c).cast("decimal(15,2)") for c in ("l_extendedprice", "l_discount"))
    return load("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.round(price * off, 2).cast("double").alias("rebate"),
        (F.col("l_orderkey") % 10).alias("digit"),
        F.round(F.try_divide("l_tax", "l_discount"), 4).alias("ratio"),
        ((F.col("l_linenumber") + 1) * 10).alias("scaled"),
    )


@query(
    "fn_array",
    "SELECT vec_id, len(embedding) AS n, embedding[1] AS first, embedding[len(embedding)] AS last, CAST(NULL AS FLOAT) AS beyond FROM embeddings",
)
def fn_array(load, spark):
    e = F.col("embedding")
    return load("embeddings").select(
        "vec_id",
        F.size(e).cast("bigint").alias("n"),
        F.get(e, F.lit(0)).alias("first"),
        F.try_element_at(e, F.lit(-1)).alias("last"),
        F.get(e, F.lit(100_000)).alias("beyond"),
    )


@query(
    "fn_array_build",
    f"SELECT event_id, array_to_string([i * 10 for i in range({K_SQL} % 6)], ',') AS tens, len(range({K_SQL} % 6)) AS n FROM events",
)
def fn_array_build(load, spark):
    n = k_of() % 6
    up = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    tens = F.transform(up, lambda i: i * 10)
    return load("events").select("event_id", F.array_join(tens, ",").alias("tens"), F.size(tens).cast("bigint").alias("n"))


@query(
    "fn_map_tuple_enum",
    "SELECT event_id, CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 END AS code, "
    "CASE user_id % 4 WHEN 1 THEN 'desktop' WHEN 2 THEN 'tablet' WHEN 3 THEN 'mobile' ELSE '0' END AS device, value AS second FROM events",
)
def fn_map_tuple_enum(load, spark):
    codes = F.create_map(F.lit("view"), F.lit(1), F.lit("click"), F.lit(2), F.lit("purchase"), F.lit(3))
    pair = F.struct(F.col("event_id").alias("a"), F.col("value").alias("b"))
    device = texts.label_of((F.col("user_id") % 4).cast("string"), {"1": "desktop", "2": "tablet", "3": "mobile"})
    return load("events").select("event_id", codes[F.col("event_type")].alias("code"), device.alias("device"), pair["b"].alias("second"))


@query(
    "fn_json_path",
    f"SELECT event_id, {K_SQL} AS k, json_extract_string(props, '$.k') AS raw, CAST(NULL AS VARCHAR) AS absent, {K_SQL} AS parsed FROM events",
)
def fn_json_path(load, spark):
    return load("events").select(
        "event_id",
        k_of().alias("k"),
        F.get_json_object("props", "$.k").alias("raw"),
        F.get_json_object("props", "$.no.such").alias("absent"),
        F.from_json("props", "k int, other struct<>")["k"].alias("parsed"),
    )


@query(
    "fn_array_text",
    "SELECT o_orderkey, o_orderkey + 1 AS second, CAST(3 AS BIGINT) AS n, CAST(o_orderdate AS DATE) AS day, o_orderdate AS ts, o_orderstatus || '|' || o_orderpriority AS words FROM orders",
    dates="day",
)
def fn_array_text(load, spark):
    key = F.col("o_orderkey")
    text = F.concat(F.lit("["), key.cast("string"), F.lit(", "), (key + 1).cast("string"), F.lit(",,"), F.lit("7]"))
    stamp = F.concat(F.lit("['"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("']"))
    words = F.concat(F.lit("['"), "o_orderstatus", F.lit("','"), "o_orderpriority", F.lit("']"))
    ints = casts.parse_list_text(text, "int64")
    return load("orders").select(
        "o_orderkey",
        F.get(ints, F.lit(1)).alias("second"),
        F.size(ints).cast("bigint").alias("n"),
        F.get(casts.parse_list_text(F.substring_index(stamp, "T", 1), "date"), F.lit(0)).alias("day"),
        F.get(casts.parse_list_text(stamp, "datetime"), F.lit(0)).alias("ts"),
        F.array_join(casts.parse_list_text(words, "string"), "|").alias("words"),
    )


@query(
    "fn_default_fill",
    f"SELECT p_partkey, coalesce({NUMBER_TEXT_SQL}, '') AS text, coalesce(TRY_CAST({NUMBER_TEXT_SQL} AS INTEGER), 0) AS number, TRY_CAST({NUMBER_TEXT_SQL} AS DATE) AS day FROM part",
    dates="day",
)
def fn_default_fill(load, spark):
    v = number_text()
    return load("part").select(
        "p_partkey",
        casts.fill_default(v, "string").alias("text"),
        casts.fill_default(v.try_cast("int"), "int").alias("number"),
        casts.fill_default(F.lit(None).cast("date"), "date").alias("day"),
    )


@query(
    "fn_type_name",
    "SELECT 'bigint' AS a, 'string' AS b, 'timestamp_ntz' AS c, count(*) AS n FROM events",
)
def fn_type_name(load, spark):
    kinds = [F.typeof(c).alias(n) for c, n in (("event_id", "a"), ("event_type", "b"), ("ts", "c"))]
    return load("events").select(*kinds).groupBy("a", "b", "c").agg(F.count("*").alias("n"))


@query(
    "fn_hex_uuid",
    "SELECT event_id, upper(hex(event_type)) AS hexed, true AS is_uuid FROM events",
)
def fn_hex_uuid(load, spark):
    return load("events").select(
        "event_id", F.hex("event_type").alias("hexed"), casts.is_uuid(F.uuid()).alias("is_uuid")
    )


@query(
    "fn_type_checks",
    "SELECT event_id, event_id % 300 < 256 AS v4, event_id % 2 = 0 AS v6, rpad(event_type, 10, ' ') AS fixed, "
    "CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 ELSE 5 END AS code, event_type AS label FROM events",
)
def fn_type_checks(load, spark):
    codes = {"view": 1, "click": 2, "purchase": 3, "signup": 4, "error": 5}
    v4 = F.concat(F.lit("10.0.7."), (F.col("event_id") % 300).cast("string"))
    v6 = F.concat(F.lit("2001:db8::"), F.hex(F.col("event_id") % 65536), F.when(F.col("event_id") % 2 == 0, "").otherwise("::1"))
    code = casts.enum_code(F.col("event_type"), codes)
    return load("events").select(
        "event_id",
        casts.is_ipv4(v4).alias("v4"),
        casts.is_ipv6(v6).alias("v6"),
        casts.fixed_text(F.col("event_type"), 10).alias("fixed"),
        code.alias("code"),
        casts.enum_label(code, codes).alias("label"),
    )


# --- reshaping ---


@query(
    "explode_struct_array",
    "SELECT o_orderkey, 'price' AS name, o_totalprice AS reading FROM orders UNION ALL SELECT o_orderkey, 'customer', CAST(o_custkey AS DOUBLE) FROM orders",
)
def explode_struct_array(load, spark):
    features = F.array(
        F.struct(F.lit("price").alias("name"), F.col("o_totalprice").alias("reading")),
        F.struct(F.lit("customer").alias("name"), F.col("o_custkey").cast("double").alias("reading")),
    )
    return explode_structs(load("orders").select("o_orderkey", features.alias("features")), "features", ["o_orderkey"])


@query(
    "explode_zipped",
    f"SELECT event_id, CAST(i AS INTEGER) AS hour, CASE WHEN i < {K_SQL} % 5 THEN value + i END AS reading FROM events, "
    f"unnest(range(4)) AS t(i) WHERE {K_SQL} % 9 <> 0 UNION ALL "
    f"SELECT event_id, NULL, value + 4 FROM events WHERE {K_SQL} % 9 <> 0 AND FALSE",
)
def explode_zipped_query(load, spark):
    n = k_of() % 5
    hours = F.when(k_of() % 9 != 0, F.sequence(F.lit(0), F.lit(3)))
    readings = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.col("value") + i)).otherwise(F.array().cast("array<double>"))
    raw = load("events").select("event_id", hours.alias("hourly.time"), readings.alias("hourly.value"))
    return explode_zipped(raw, {"hourly.time": "hour", "hourly.value": "reading"}, ["event_id"])


@query(
    "explode_text_list",
    f"SELECT event_id, event_id + i AS item FROM events, unnest(range({K_SQL} % 4 + 1)) AS t(i)",
)
def explode_text_list(load, spark):
    ids = F.sequence(F.col("event_id"), F.col("event_id") + k_of() % 4)
    text = F.concat(F.lit("["), F.array_join(ids.cast("array<string>"), ", "), F.lit("]"))
    return explode_id_text(load("events").select("event_id", text.alias("ids")), "ids", "item").drop("ids")


@query(
    "array_join_range",
    f"SELECT event_id, unnest(generate_series(CAST(ts AS DATE), CAST(ts AS DATE) + CAST({K_SQL} % 4 AS INTEGER), INTERVAL 1 DAY))::DATE AS day FROM events",
    dates="day",
)
def array_join_range(load, spark):
    rows = load("events").select("event_id", "ts", F.date_add(F.to_date("ts"), k_of() % 4).alias("until"))
    return explode_days(rows, "ts", "until", "day").drop("ts", "until")


@query(
    "eav_to_columns",
    f"SELECT event_id, event_type AS kind, CASE WHEN event_id % 3 = 0 THEN NULL ELSE {K_SQL} || '' END AS size_code, CAST(NULL AS VARCHAR) AS never FROM events",
)
def eav_to_columns(load, spark):
    def pair(code, value):
        return F.struct(F.lit(code).alias("attrCode"), value.alias("valueCode"))

    full = F.array(pair("KIND", F.col("event_type")), pair("SIZE", k_of().cast("string")))
    pairs = F.when(F.col("event_id") % 3 == 0, F.array(pair("KIND", F.col("event_type")))).otherwise(full)
    rows = load("events").select("event_id", pairs.alias("attributes"))
    return rows.select("event_id", *pairs_to_columns(F.col("attributes"), {"KIND": "kind", "SIZE": "size_code", "NONE": "never"}, "attrCode", "valueCode"))


@query(
    "pairs_json_rows",
    "SELECT o_orderkey, o_orderstatus AS nickname, CASE i WHEN 0 THEN 'yes' ELSE CAST(o_custkey AS VARCHAR) END AS pay FROM orders, unnest(range(2)) AS t(i)",
)
def pairs_json_rows(load, spark):
    def pair(key, value):
        return F.array(F.lit(key), value)

    def record(pay):
        return F.array(pair("nickname", F.col("o_orderstatus")), pair("pay", pay))

    doc = F.to_json(F.array(record(F.lit("yes")), record(F.col("o_custkey").cast("string"))))
    return key_value_lists(load("orders").select("o_orderkey", doc.alias("doc")), "doc", {"nickname": "nickname", "pay": "pay"})
