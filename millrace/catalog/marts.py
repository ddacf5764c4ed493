"""Marts over the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.texts import normalised_md5
from ..functions.times import floor_div, to_micros
from ..operators.aggregates import exact_sum
from ..operators.tables import TargetField
from ..plans.bars import ohlcv, rebuild_tail, refresh_bars
from ..plans.cards import ISSUED, first_transaction
from ..plans.feeds import (
    change_log,
    fx_rates,
    geo_metrics_versioned,
    news_clean,
    page_view_answers,
    pages_on,
    promo_logins,
    promo_reach,
    users_per_device,
)
from ..plans.quakes import earthquake_daily_facts, earthquake_day_dims, earthquake_events
from ..plans.shops import shop_timezone
from ..plans.users import survey_users
from ..plans.weather import cloud_extremes, weather_hourly
from ..plans.web import (
    join_hits,
    web_daily,
    web_depth,
    web_devices,
    web_geo,
    web_marts,
    web_new_returning,
    web_top_pages,
    web_traffic,
)
from ..quality import replace_logged
from ..session import scratch_path
from ..sources.buckets import delete_insert_rows, read_buckets
from ..sources.writers import replace_partitions
from .base import K_SQL, half_up, k_of, money, query
from .relational import PROMO_SQL, promotions
from .summaries import ZONES_SQL, zone_rows

# --- shops ---

SHOP_SQL = (
    "SELECT s_suppkey AS st_id, s_name AS shop_name, coalesce(TRY_CAST(nullif(regexp_extract(z.zone, '([0-9]+)$', 1), '') AS INTEGER), 3) AS tz_code "
    "FROM supplier {join} JOIN (SELECT CAST(plant AS BIGINT) AS st_id, max(CASE WHEN trim(time_zone) <> '' THEN time_zone END) AS zone "
    f"FROM ({ZONES_SQL}) WHERE regexp_matches(plant, '^[0-9]+$') GROUP BY plant) z ON s_suppkey = z.st_id"
)


def _shops(load, **options):
    shops = load("supplier").select(F.col("s_suppkey").cast("string").alias("st_id"), F.col("s_name").alias("shop_name"))
    return shop_timezone(shops, zone_rows(load("lineitem")), **options)


@query("mart_shop_timezone", SHOP_SQL.format(join=""))
def mart_shop_timezone(load, spark):
    return _shops(load)


@query("mart_shop_timezone_all", SHOP_SQL.format(join="LEFT"))
def mart_shop_timezone_all(load, spark):
    return _shops(load, keep_unmatched=True)


# --- people ---


@query(
    "mart_survey_users",
    "SELECT telegram_id, arg_min(user_nickname, (registration_date, user_nickname)) AS user_nickname, min(registration_date) AS registration_date FROM "
    "(SELECT o_custkey + 1 AS telegram_id, o_orderstatus || '_' || o_orderpriority AS user_nickname, CAST(o_orderdate AS DATE) AS registration_date FROM orders) GROUP BY telegram_id",
    dates="registration_date",
)
def mart_survey_users(load, spark):
    key = (F.col("o_custkey") + 1).cast("string")
    noisy = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("@@"), key)).when(
        F.col("o_orderkey") % 3 == 1, F.concat(key, F.lit("@"))
    ).otherwise(key)
    rows = load("orders").select(
        "o_orderkey",
        noisy.alias("tg_id"),
        F.concat(F.lit("@"), "o_orderstatus", F.lit("_@"), "o_orderpriority").alias("tg_nickname"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("update_at"),
    )
    return survey_users(*[rows.where(F.col("o_orderkey") % 3 == i).drop("o_orderkey") for i in range(3)])


# --- weather ---

NOW = "2024-02-01 00:00:00"


@query(
    "mart_weather_hourly",
    f"SELECT CAST(CAST(ts AS DATE) AS VARCHAR) || 'T0' || h || ':00' AS time, CAST(value + h AS FLOAT) AS temperature, CASE WHEN h < 2 THEN CAST(value AS FLOAT) END AS rain, "
    f"CAST(ts AS DATE) AS weather_date, TIMESTAMP '{NOW}' AS updated_at FROM events, unnest(range(4)) AS t(h)",
    dates="weather_date",
)
def mart_weather_hourly(load, spark):
    hours = F.sequence(F.lit(0), F.lit(3))
    day = F.to_date("ts").cast("string")
    raw = load("events").select(
        F.transform(hours, lambda h: F.concat(day, F.lit("T0"), h.cast("string"), F.lit(":00"))).alias("hourly.time"),
        F.transform(hours, lambda h: F.col("value") + h).alias("hourly.temperature_2m"),
        F.array("value", "value").alias("hourly.rain"),
    )
    return weather_hourly(raw, F.lit(NOW).cast("timestamp_ntz"))


@query("mart_weather_cloud", "SELECT ts AS datetime, CAST(value AS INTEGER) AS cloud_cover FROM events WHERE CAST(value AS INTEGER) > 80 OR CAST(value AS INTEGER) < 20")
def mart_weather_cloud(load, spark):
    return cloud_extremes(load("events").select(F.col("ts").alias("datetime"), F.rint("value").cast("int").alias("cloud_cover")))


# --- seismic events ---


def _features(events):
    place = F.when(
        F.col("event_id") % 4 != 0,
        F.concat((F.col("user_id") % 30).cast("string"), F.lit(" km N of "), "event_type", F.lit(", R"), (F.col("user_id") % 5).cast("string")),
    ).otherwise(F.concat(F.lit("Sea of "), "event_type"))
    feature = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.struct(
            floor_div(to_micros(F.col("ts")), 1000).alias("time"),
            place.alias("place"),
            F.col("value").alias("mag"),
            F.when(F.col("event_id") % 3 == 0, k_of()).alias("felt"),
            (F.col("event_id") % 2).cast("int").alias("tsunami"),
            F.concat(F.lit("https://quakes.example/"), F.col("event_id").cast("string")).alias("url"),
        ).alias("properties"),
        F.struct(F.array(F.col("user_id").cast("double"), k_of().cast("double"), F.col("value")).alias("coordinates")).alias("geometry"),
    )
    return events.select(F.array(feature).alias("features"))


def _regions(events):
    """Regions by the hash of whole place texts: of seas, and of places 7 km off that hold a comma."""
    kinds = events.select("event_type").distinct()
    seas = kinds.select(F.concat(F.lit("sea of "), "event_type").alias("text"), F.concat(F.lit("Ocean "), "event_type").alias("region"))
    near = kinds.select(
        F.concat(F.lit(" 7 KM N of "), "event_type", F.lit(", R2")).alias("text"), F.concat(F.lit("Shelf "), "event_type").alias("region")
    )
    return seas.unionByName(near).select(normalised_md5(F.col("text")).alias("place_hash"), "region")


@query(
    "mart_earthquake_events",
    f"SELECT CAST(event_id AS VARCHAR) AS id, date_trunc('millisecond', ts) AS ts, "
    "CASE WHEN event_id % 4 <> 0 THEN user_id % 30 || ' km N of ' || event_type ELSE 'Sea of ' || event_type END AS place, "
    "CASE WHEN event_id % 4 = 0 THEN 'Ocean ' || event_type WHEN user_id % 30 = 7 THEN 'Shelf ' || event_type ELSE 'R' || user_id % 5 END AS region, value AS magnitude, "
    f"CASE WHEN event_id % 3 = 0 THEN {K_SQL} END AS felt, CAST(event_id % 2 AS INTEGER) AS tsunami, 'https://quakes.example/' || event_id AS url, "
    f"CAST(user_id AS DOUBLE) AS longitude, CAST({K_SQL} AS DOUBLE) AS latitude, value AS depth, CAST(ts AS DATE) AS load_date, TIMESTAMP '{NOW}' AS updated_at FROM events",
    dates="load_date",
)
def mart_earthquake_events(load, spark):
    events = load("events")
    return earthquake_events(_features(events), _regions(events), F.lit(NOW).cast("timestamp_ntz"))


@query(
    "mart_earthquake_day_dims",
    "SELECT CAST(ts AS DATE) AS day, event_type AS kind, CAST(user_id % 3 AS VARCHAR) AS net, date_trunc('second', min(ts)) AS time_min, date_trunc('second', max(ts)) AS time_max, "
    "avg(event_id) AS nst, CAST(count(DISTINCT user_id) AS BIGINT) AS place_count FROM events GROUP BY ALL",
    dates="day",
)
def mart_earthquake_day_dims(load, spark):
    raw = load("events").select(
        "ts",
        F.col("event_type").alias("kind"),
        (F.col("user_id") % 3).cast("string").alias("net"),
        F.col("event_id").alias("nst"),
        F.col("user_id").alias("place"),
    )
    target = [
        TargetField("day", "date"),
        TargetField("kind", "string"),
        TargetField("net", "string"),
        TargetField("time_min", "datetime"),
        TargetField("time_max", "datetime"),
        TargetField("nst", "float64"),
        TargetField("place_count", "int64"),
    ]
    figures = earthquake_day_dims(raw, "ts", ["kind", "net"], ["nst"], ["place"], target)
    path = scratch_path(spark, "quake-dims")
    # Loaded by day: the second load replaces its own days only.
    replace_partitions(figures, path, "day")
    replace_partitions(figures.where(F.col("day") >= F.lit("2024-01-20").cast("date")), path, "day")
    return spark.read.schema(figures.schema).parquet(path)


@query(
    "mart_earthquake_daily_facts",
    f"SELECT CAST(ts AS DATE) AS day, round(avg(event_id), 4) AS avg_magnitude, count(*) AS events FROM events GROUP BY ALL",
    dates="day",
)
def mart_earthquake_daily_facts(load, spark):
    path = scratch_path(spark, "quake-facts")
    rows = load("events").select("ts", F.col("event_id").alias("mag"))
    delete_insert_rows(earthquake_daily_facts(rows, "ts", "mag"), path, ["day"], rows=8)
    again = rows.where(F.to_date("ts") >= F.lit("2024-01-20").cast("date"))
    delete_insert_rows(earthquake_daily_facts(again, "ts", "mag"), path, ["day"], rows=8)
    return read_buckets(spark, path).withColumn("avg_magnitude", F.round("avg_magnitude", 4))


# --- price bars ---


def trades_of(events):
    """Trades: symbol, price and volume from the events."""
    lots = F.col("user_id") % 10
    return events.select(
        F.col("event_id").alias("trade_id"),
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        lots.cast("double").alias("quantity"),
        (F.col("value") * lots).cast("decimal(18,2)").alias("amount_usdt"),
        "ts",
    )


BARS_SQL = (
    "SELECT date_trunc('hour', ts) AS period_start, event_type AS symbol, arg_min(value, (ts, event_id)) AS open_price, max(value) AS high_price, min(value) AS low_price, "
    "arg_max(value, (ts, event_id)) AS close_price, CAST(sum(user_id % 10) AS DOUBLE) AS total_volume, CAST(sum(CAST(value * (user_id % 10) AS DECIMAL(18,2))) AS DOUBLE) AS total_amount_usdt, "
    "count(*) AS trades_count FROM events GROUP BY ALL"
)


def _plain(bars):
    return bars.withColumn("total_amount_usdt", F.col("total_amount_usdt").cast("double"))


@query("mart_ohlcv_1m", BARS_SQL.replace("'hour'", "'minute'"))
def mart_ohlcv_1m(load, spark):
    return _plain(ohlcv(trades_of(load("events"))))


@query("mart_ohlcv_1h", BARS_SQL)
def mart_ohlcv_1h(load, spark):
    # The events are about four minutes apart, so hourly bars hold more trades.
    return _plain(ohlcv(trades_of(load("events")), "1 hour"))


@query("mart_ohlcv_rebuild_tail", BARS_SQL)
def mart_ohlcv_rebuild_tail(load, spark):
    trades = trades_of(load("events"))
    loaded = ohlcv(trades.where(F.col("ts") < F.lit("2024-01-20 10:20:00").cast("timestamp_ntz")), "1 hour")
    return _plain(rebuild_tail(loaded, trades, "1 hour"))


@query("mart_ohlcv_refresh", BARS_SQL)
def mart_ohlcv_refresh(load, spark):
    path = scratch_path(spark, "bars")
    trades = trades_of(load("events"))
    refresh_bars(trades.where(F.col("ts") < F.lit("2024-01-20 10:20:00").cast("timestamp_ntz")), path, "1 hour")
    for _ in range(2):
        refresh_bars(trades, path, "1 hour")
    return _plain(spark.read.parquet(path).drop("day"))


# --- cards ---


@query(
    "mart_first_transaction",
    "WITH t AS (SELECT o_custkey AS card_num, o_orderdate, max(o_totalprice) AS amt FROM orders GROUP BY ALL), "
    "f AS (SELECT card_num, arg_min(amt, o_orderdate) AS amt FROM t GROUP BY card_num) "
    "SELECT 'd' || c_nationkey AS card_order_dt, CAST(card_num AS VARCHAR) AS card_num, c_name AS cookie, c_mktsegment AS url, amt > 150000 AS transaction_level, "
    "c_custkey % 3 = 0 AS status_flag, '2024-01-01' AS partition_date, '2024-01-01' AS load_date FROM f JOIN customer ON card_num = c_custkey WHERE c_custkey % 5 <> 4",
)
def mart_first_transaction(load, spark):
    customer, day = load("customer"), F.when(F.col("c_custkey") % 5 != 4, "2024-01-01").otherwise("2023-12-31")
    number = F.col("c_custkey").cast("string")
    cards = customer.select(
        F.md5(number).alias("card_num_md5"),
        F.concat(F.lit("d"), F.col("c_nationkey").cast("string")).alias("card_order_dt"),
        F.col("c_mktsegment").alias("url"),
        F.col("c_name").alias("cookie"),
        day.alias("load_date"),
    )
    status = customer.select(
        number.alias("card_num"),
        F.md5(number).alias("card_num_md5"),
        F.when(F.col("c_custkey") % 3 == 0, ISSUED).otherwise("blocked").alias("status"),
        F.lit("2024-01-01").alias("load_date"),
    )
    spent = load("orders").select(
        F.col("o_custkey").cast("string").alias("card_num"),
        F.col("o_totalprice").cast("string").alias("amount"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("transaction_datetime"),
        F.lit("2024-01-01").alias("load_date"),
    )
    found = first_transaction(cards, status, spent, "2024-01-01", threshold=150000)
    path = scratch_path(spark, "cards")
    replace_logged(found, "first_transaction", "2024-01-01", "2024-01-02", path, f"{path}-log", "partition_date")
    logged = spark.read.parquet(f"{path}-log").select("rows")
    out = spark.read.schema(found.schema).parquet(path)
    # The log's figure must be that of the table.
    return out.where(out.agg(F.count("*")).scalar() == logged.agg(F.max("rows")).scalar())


# --- web traffic ---

VISITS_SQL = (
    f"SELECT ts AS dt, event_id // 8 AS client, event_id AS visit, CASE WHEN {K_SQL} % 13 = 0 THEN [NULL] ELSE range(event_id, event_id + {K_SQL} % 4 + 1) END AS ids, CAST(floor(value) AS INTEGER) AS duration, {K_SQL} % 4 + 1 AS pages, "
    f"CASE {K_SQL} % 3 WHEN 0 THEN '1' WHEN 1 THEN '0' END AS is_new, CASE WHEN {K_SQL} % 5 <> 0 THEN event_type END AS referer, "
    f"CASE WHEN user_id % 7 <> 0 THEN 'land' || user_id % 25 END AS country, 'city' || user_id % 40 AS city, CASE WHEN {K_SQL} % 11 <> 0 THEN '/p/' || {K_SQL} % 20 END AS url "
    "FROM events"
)
HITS_SQL = (
    f"SELECT event_id // 8 AS h_client, CASE WHEN event_type = 'error' THEN -event_id - 1 ELSE event_id END AS watch, event_id AS view_id, CASE {K_SQL} % 6 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '3' WHEN 3 THEN '4' END AS device, "
    f"CASE WHEN {K_SQL} % 7 <> 0 THEN 'br' || {K_SQL} % 3 END AS browser, 'os' || user_id % 4 AS os FROM events"
)
JOINED_SQL = (
    f"SELECT * FROM (SELECT *, unnest(ids) AS watch_id FROM ({VISITS_SQL})) v LEFT JOIN ({HITS_SQL}) h ON v.client = h.h_client AND v.watch_id = h.watch"
)
DAY_SQL = "CAST(dt AS DATE) AS business_date"


def visits_of(events):
    """Visits: every event starts one and lists the next few events as its hits; some list none."""
    k, key = k_of(), F.col("event_id")
    ids = F.sequence(key, key + k % 4).cast("array<string>")
    flag = F.when(k % 3 == 0, "1").when(k % 3 == 1, "0")
    cols = {
        "dateTime": F.col("ts"),
        "clientID": floor_div(key, 8),
        "visitID": key,
        "watchIDs": F.when(k % 13 != 0, F.concat(F.lit("["), F.array_join(ids, ", "), F.lit("]"))),
        "visitDuration": F.floor("value").cast("int"),
        "pageViews": k % 4 + 1,
        "isNewUser": flag,
        "lastsignReferalSource": F.when(k % 5 != 0, F.col("event_type")),
        "regionCountry": F.when(F.col("user_id") % 7 != 0, F.concat(F.lit("land"), (F.col("user_id") % 25).cast("string"))),
        "regionCity": F.concat(F.lit("city"), (F.col("user_id") % 40).cast("string")),
        "startURL": F.when(k % 11 != 0, F.concat(F.lit("/p/"), (k % 20).cast("string"))),
    }
    return events.select(*[c.alias(f"ym:s:{n}") for n, c in cols.items()])


def hits_of(events):
    """Hits: one per event; those of errors have ids that no visit lists, and others belong to another client."""
    k, key = k_of(), F.col("event_id")
    device = F.when(k % 6 < 4, (k % 6 + 1).cast("string"))
    cols = {
        "clientID": floor_div(key, 8),
        "watchID": F.when(F.col("event_type") == "error", -key - 1).otherwise(key),
        "pageViewID": key,
        "deviceCategory": device,
        "browser": F.when(k % 7 != 0, F.concat(F.lit("br"), (k % 3).cast("string"))),
        "operatingSystem": F.concat(F.lit("os"), (F.col("user_id") % 4).cast("string")),
    }
    return events.select(*[c.alias(f"ym:pv:{n}") for n, c in cols.items()])


def _web(load):
    """Visits, and visits joined with their hits."""
    events = load("events")
    visits = visits_of(events)
    return visits, join_hits(visits, hits_of(events))


_DAILY = f"count(DISTINCT client) AS dau, {half_up('avg(duration)')} AS avg_duration, {half_up('count(*) FILTER (WHERE pages = 1) / count(*)')} AS bounce_rate"


@query(
    "mart_web_daily",
    f"SELECT * FROM (SELECT {DAY_SQL}, {_DAILY} FROM ({VISITS_SQL}) GROUP BY ALL) JOIN (SELECT {DAY_SQL}, count(view_id) AS pageviews FROM ({JOINED_SQL}) GROUP BY ALL) USING (business_date)",
    dates="business_date",
)
def mart_web_daily(load, spark):
    return web_daily(*_web(load))


@query("mart_web_daily_hits", f"SELECT {DAY_SQL}, count(view_id) AS pageviews, {_DAILY} FROM ({JOINED_SQL}) GROUP BY ALL", dates="business_date")
def mart_web_daily_hits(load, spark):
    return web_daily(*_web(load), grain="hit")


_USERS = "count(*) FILTER (WHERE is_new = '1') AS new_users, count(*) FILTER (WHERE is_new = '0') AS returning_users"


@query(
    "mart_web_traffic",
    f"SELECT {DAY_SQL}, coalesce(referer, 'unknown') AS source, count(DISTINCT visit) AS sessions, {_USERS} FROM ({VISITS_SQL}) GROUP BY ALL",
    dates="business_date",
)
def mart_web_traffic(load, spark):
    return web_traffic(*_web(load))


@query(
    "mart_web_traffic_hits",
    f"SELECT {DAY_SQL}, coalesce(referer, 'unknown') AS source, count(DISTINCT visit) AS sessions, {_USERS} FROM ({JOINED_SQL}) GROUP BY ALL",
    dates="business_date",
)
def mart_web_traffic_hits(load, spark):
    return web_traffic(*_web(load), grain="hit")


@query("mart_web_new_returning", f"SELECT {DAY_SQL}, {_USERS} FROM ({JOINED_SQL}) GROUP BY ALL", dates="business_date")
def mart_web_new_returning(load, spark):
    return web_new_returning(*_web(load), grain="hit")


@query(
    "mart_web_geo",
    f"SELECT {DAY_SQL}, coalesce(country, 'unknown') AS country, city, count(DISTINCT visit) AS sessions, count(DISTINCT client) AS dau FROM ({VISITS_SQL}) GROUP BY ALL",
    dates="business_date",
)
def mart_web_geo(load, spark):
    return web_geo(_web(load)[0])


@query(
    "mart_web_devices",
    f"SELECT {DAY_SQL}, CASE device WHEN '1' THEN 'desktop' WHEN '2' THEN 'tablet' WHEN '3' THEN 'mobile' ELSE coalesce(device, 'unknown') END AS device_category, "
    f"coalesce(browser, 'unknown') AS browser, coalesce(os, 'unknown') AS os, count(DISTINCT visit) AS sessions FROM ({JOINED_SQL}) GROUP BY ALL",
    dates="business_date",
)
def mart_web_devices(load, spark):
    return web_devices(_web(load)[1])


@query(
    "mart_web_top_pages",
    f"SELECT * FROM (SELECT {DAY_SQL}, coalesce(url, 'unknown') AS url, {half_up('avg(duration)')} AS avg_duration FROM ({VISITS_SQL}) GROUP BY ALL) "
    f"JOIN (SELECT {DAY_SQL}, coalesce(url, 'unknown') AS url, count(DISTINCT view_id) AS pageviews FROM ({JOINED_SQL}) GROUP BY ALL) USING (business_date, url)",
    dates="business_date",
)
def mart_web_top_pages(load, spark):
    return web_top_pages(*_web(load))


@query(
    "mart_web_top_pages_hits",
    f"SELECT {DAY_SQL}, coalesce(url, 'unknown') AS url, count(DISTINCT view_id) AS pageviews, {half_up('avg(duration)')} AS avg_duration FROM ({JOINED_SQL}) GROUP BY ALL",
    dates="business_date",
)
def mart_web_top_pages_hits(load, spark):
    return web_top_pages(*_web(load), grain="hit")


@query(
    "mart_web_depth",
    f"SELECT {DAY_SQL}, {half_up('avg(pages)')} AS avg_pageviews, max(pages) AS max_pageviews, {half_up('count(*) FILTER (WHERE pages = 1) / count(*)')} AS bounce_rate FROM ({VISITS_SQL}) GROUP BY ALL",
    dates="business_date",
)
def mart_web_depth(load, spark):
    return web_depth(*_web(load))


@query(
    "mart_web_depth_hits",
    f"SELECT {DAY_SQL}, {half_up('avg(pages)')} AS avg_pageviews, max(pages) AS max_pageviews, {half_up('count(*) FILTER (WHERE pages = 1) / count(*)')} AS bounce_rate FROM ({JOINED_SQL}) GROUP BY ALL",
    dates="business_date",
)
def mart_web_depth_hits(load, spark):
    return web_depth(*_web(load), grain="hit")


# Integer figures of each mart, which mart_web_all adds up.
WEB_FIGURES = {
    "daily_metrics": ["dau", "pageviews"],
    "traffic_sources": ["sessions", "new_users", "returning_users"],
    "new_vs_returning": ["new_users", "returning_users"],
    "geo_stats": ["sessions", "dau"],
    "devices": ["sessions"],
    "top_pages": ["pageviews"],
    "session_depth": ["max_pageviews"],
}
_WEB_ALL = {
    "daily_metrics": f"SELECT business_date, dau + pageviews AS x FROM (SELECT {DAY_SQL}, count(DISTINCT client) AS dau FROM ({VISITS_SQL}) GROUP BY ALL) JOIN (SELECT {DAY_SQL}, count(view_id) AS pageviews FROM ({JOINED_SQL}) GROUP BY ALL) USING (business_date)",
    "traffic_sources": f"SELECT {DAY_SQL}, count(DISTINCT visit) + count(*) FILTER (WHERE is_new IS NOT NULL) AS x FROM ({VISITS_SQL}) GROUP BY CAST(dt AS DATE), referer",
    "new_vs_returning": f"SELECT {DAY_SQL}, count(*) FILTER (WHERE is_new IS NOT NULL) AS x FROM ({VISITS_SQL}) GROUP BY CAST(dt AS DATE)",
    "geo_stats": f"SELECT {DAY_SQL}, count(DISTINCT visit) + count(DISTINCT client) AS x FROM ({VISITS_SQL}) GROUP BY CAST(dt AS DATE), country, city",
    "devices": f"SELECT {DAY_SQL}, count(DISTINCT visit) AS x FROM ({JOINED_SQL}) GROUP BY CAST(dt AS DATE), device, browser, os",
    "top_pages": f"SELECT {DAY_SQL}, count(DISTINCT view_id) AS x FROM ({JOINED_SQL}) GROUP BY CAST(dt AS DATE), url",
    "session_depth": f"SELECT {DAY_SQL}, max(pages) AS x FROM ({VISITS_SQL}) GROUP BY CAST(dt AS DATE)",
}


@query(
    "mart_web_all",
    " UNION ALL ".join(
        f"SELECT '{mart}' AS mart, CAST(business_date AS VARCHAR) AS day, count(*) AS n, CAST(sum(x) AS BIGINT) AS total FROM ({sql}) GROUP BY business_date"
        for mart, sql in _WEB_ALL.items()
    ),
)
def mart_web_all(load, spark):
    """Per mart and day: rows and the sum of the mart's integer figures."""
    events, out = load("events"), None
    for name, mart in web_marts(visits_of(events), hits_of(events)).items():
        total = sum((F.sum(c) for c in WEB_FIGURES[name]), F.lit(0)).cast("bigint")
        days = mart.groupBy(F.col("business_date").cast("string").alias("day")).agg(F.count("*").alias("n"), total.alias("total"))
        days = days.select(F.lit(name).alias("mart"), "day", "n", "total")
        out = days if out is None else out.unionByName(days)
    return out


# --- promotions and page views ---


@query(
    "mart_promo_logins",
    f"SELECT user_id, event_name, count(*) AS logins FROM events JOIN ({PROMO_SQL}) p ON ts BETWEEN start_time AND end_time GROUP BY ALL",
)
def mart_promo_logins(load, spark):
    events = load("events")
    return promo_logins(events.withColumnRenamed("ts", "login_time"), promotions(events))


@query(
    "mart_promo_reach",
    f"SELECT event_name, count(DISTINCT user_id) AS users FROM events JOIN ({PROMO_SQL}) p ON ts BETWEEN start_time AND end_time GROUP BY ALL",
)
def mart_promo_reach(load, spark):
    events = load("events")
    return promo_reach(events.withColumnRenamed("ts", "login_time"), promotions(events))


def _views(events):
    return events.select(
        "event_id",
        "user_id",
        F.when(F.col("event_type") == "view", "home").otherwise(F.col("event_type")).alias("page"),
        F.when(k_of() % 2 == 0, "mobile").otherwise("web").alias("device"),
        k_of().alias("view_time"),
    )


@query(
    "mart_page_view_answers",
    f"SELECT count(DISTINCT user_id) FILTER (WHERE {K_SQL} % 2 = 0) AS mobile_users, avg({K_SQL}) FILTER (WHERE event_type = 'view') AS avg_home_time FROM events",
)
def mart_page_view_answers(load, spark):
    return page_view_answers(_views(load("events")))


@query(
    "mart_page_view_pages",
    "WITH v AS (SELECT user_id, CASE WHEN event_type = 'view' THEN 'home' ELSE event_type END AS page, event_id FROM events "
    f"WHERE {K_SQL} % 2 <> 0), n AS (SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 20 AS chunk FROM v) "
    "SELECT user_id, coalesce(chunk, 0) AS chunk, coalesce(pages, '') AS pages FROM (SELECT DISTINCT user_id FROM events) "
    "LEFT JOIN (SELECT user_id, chunk, string_agg(page, ',' ORDER BY event_id) AS pages FROM n GROUP BY ALL) USING (user_id)",
)
def mart_page_view_pages(load, spark):
    """Pages of every user on the web, in order; users without any have an empty list."""
    lists = pages_on(_views(load("events")), "web", ["event_id"], chunk_rows=20)
    return lists.select("user_id", "chunk", F.array_join("items", ",").alias("pages"))


@query(
    "mart_page_view_devices",
    f"SELECT CASE WHEN {K_SQL} % 2 = 0 THEN 'mobile' ELSE 'web' END AS device, count(DISTINCT user_id) AS users FROM events GROUP BY ALL",
)
def mart_page_view_devices(load, spark):
    return users_per_device(_views(load("events")))


# --- feeds ---


@query(
    "mart_news_clean",
    "SELECT CASE WHEN doc_id % 3 = 0 THEN 'unknown' ELSE lang END AS author, lang || ' ' || source AS title, text AS description, 'u' || doc_id AS url, source AS source_name, "
    "TIMESTAMP '2024-01-01' + INTERVAL 1 SECOND * doc_id AS published_at, TIMESTAMP '2024-01-02 03:04:05' AS updated_at FROM documents",
)
def mart_news_clean(load, spark):
    stamp = F.timestamp_add("SECOND", F.col("doc_id"), F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00.75'"))
    raw = load("documents").select(
        F.when(F.col("doc_id") % 6 == 0, " ").when(F.col("doc_id") % 3 != 0, F.col("lang")).alias("author"),
        F.concat_ws(" ", "lang", "source").alias("title"),
        F.col("text").alias("description"),
        F.concat(F.lit("u"), F.col("doc_id").cast("string")).alias("url"),
        F.col("text").alias("content"),
        F.lit("x").alias("source.id"),
        F.col("source").alias("source.name"),
        F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("publishedAt"),
        F.lit("2024-01-02 03:04:05.678").alias("updated_at"),
    )
    return news_clean(raw)


@query(
    "mart_change_log",
    "SELECT o_orderkey AS id, o_orderstatus AS kind, o_orderdate AS ts, o_orderpriority AS comment, CAST(NULL AS VARCHAR) AS ip, 'a' || o_custkey AS author_key, 'm' || o_orderkey AS data_master, "
    "CASE WHEN o_orderkey % 4 <> 0 THEN 'd1, d' || o_orderkey END AS data_duplicates, 'item' || i AS item_key, o_custkey + i AS rev_number, DATE '2024-02-01' AS updated_at "
    "FROM orders, unnest(range(o_orderkey % 3)) AS t(i)",
    dates="updated_at",
)
def mart_change_log(load, spark):
    key = F.col("o_orderkey")
    n = (key % 3).cast("int")
    change = F.transform(
        F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: F.struct(F.concat(F.lit("item"), i.cast("string")).alias("key"), (F.col("o_custkey") + i).alias("revision")),
    )
    raw = load("orders").select(
        key.alias("id"),
        F.col("o_orderstatus").alias("kind"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.col("o_orderpriority").alias("comment"),
        F.lit(None).cast("string").alias("ip"),
        F.concat(F.lit("a"), F.col("o_custkey").cast("string")).alias("author.key"),
        F.concat(F.lit("m"), key.cast("string")).alias("data.master"),
        F.when(key % 4 != 0, F.array(F.lit("d1"), F.concat(F.lit("d"), key.cast("string")))).alias("data.duplicates"),
        change.alias("changes"),
        F.lit("2024-02-01").alias("updated_at"),
    )
    return change_log(raw)


@query(
    "mart_fx_rates",
    "SELECT o_orderkey AS pair, o_orderpriority AS category, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS sell, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) END AS buy FROM orders",
)
def mart_fx_rates(load, spark):
    def attribute(code, value):
        return F.struct(F.lit(code).alias("attrCode"), value.cast("string").alias("valueCode"))

    sell, buy = attribute("SELL", F.col("o_totalprice").cast("decimal(18,2)")), attribute("BUY", F.col("o_custkey"))
    raw = load("orders").select(
        F.col("o_orderkey").alias("pair"),
        F.col("o_orderpriority").alias("category"),
        F.when(F.col("o_orderkey") % 2 == 0, F.array(sell, buy)).otherwise(F.array(sell)).alias("attributes"),
    )
    return fx_rates(raw, {"SELL": "sell", "BUY": "buy"})


@query(
    "mart_geo_metrics_versioned",
    "SELECT CAST(o_orderdate AS DATE) AS business_date, o_orderstatus AS country_code, CASE WHEN o_custkey % 2 = 0 THEN '' ELSE o_orderpriority END AS country_name, "
    "'c' || o_custkey AS city_name, CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE o_custkey END AS city_id, o_orderkey AS visits, CAST(0 AS BIGINT) AS users, CAST(0 AS BIGINT) AS new_users, CAST(2 AS BIGINT) AS pageviews, "
    "CAST(0.25 AS DOUBLE) AS bounce_rate, TIMESTAMP '2024-02-01' AS updated_at, CAST(1706745600 AS BIGINT) AS version FROM orders",
    dates="business_date",
)
def mart_geo_metrics_versioned(load, spark):
    customer = F.col("o_custkey")
    raw = load("orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("business_date"),
        F.col("o_orderstatus").alias("country_code"),
        F.when(customer % 2 != 0, F.col("o_orderpriority")).alias("country_name"),
        F.concat(F.lit("c"), customer.cast("string")).alias("city_name"),
        F.when(customer % 3 != 0, customer.cast("string")).otherwise("n/a").alias("city_id"),
        F.col("o_orderkey").cast("string").alias("visits"),
        F.lit(None).cast("string").alias("users"),
        F.lit("none").alias("new_users"),
        F.lit("2").alias("pageviews"),
        F.lit("0.25").alias("bounce_rate"),
    )
    return geo_metrics_versioned(raw, F.lit("2024-02-01").cast("timestamp_ntz"))
