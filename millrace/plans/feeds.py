"""Marts over news, edit records, exchange rates, promotions, page views and geo metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import cast_or_zero
from ..functions.nested import pairs_to_columns
from ..functions.texts import blank_to_null, joined_or_null
from ..functions.times import SECOND, floor_div, floor_ts, to_micros
from ..operators.aggregates import avg_if, collect_if, count_distinct_if
from ..operators.intervals import interval_join


def promo_logins(logins: DataFrame, promos: DataFrame) -> DataFrame:
    """Logins per user and promotion while it ran, both ends included.

    Expects user_id, login_time and event_name, start_time, end_time.
    """
    hits = interval_join(logins.select("user_id", "login_time"), promos, "login_time", "start_time", "end_time")
    return hits.groupBy("user_id", "event_name").agg(F.count("*").alias("logins"))


def promo_reach(logins: DataFrame, promos: DataFrame) -> DataFrame:
    """Distinct users per promotion."""
    hits = interval_join(logins.select("user_id", "login_time"), promos, "login_time", "start_time", "end_time")
    return hits.groupBy("event_name").agg(F.countDistinct("user_id").alias("users"))


def page_view_answers(views: DataFrame) -> DataFrame:
    """Users on mobile devices and average time on the home page."""
    return views.agg(
        count_distinct_if(F.col("user_id"), F.col("device") == "mobile").alias("mobile_users"),
        avg_if(F.col("view_time"), F.col("page") == "home").alias("avg_home_time"),
    )


def pages_on(views: DataFrame, device: str, order, chunk_rows: int) -> DataFrame:
    """Pages every user saw on a device as ordered chunks; users without any have an empty chunk 0."""
    return collect_if(views, ["user_id"], "page", F.col("device") == device, order, chunk_rows)


def users_per_device(views: DataFrame) -> DataFrame:
    return views.groupBy("device").agg(F.countDistinct("user_id").alias("users"))


def news_clean(raw: DataFrame, no_author: str = "unknown") -> DataFrame:
    """Names without dots, an author everywhere, times to the second, no noise columns."""
    return raw.select(
        F.coalesce(blank_to_null(F.col("author")), F.lit(no_author)).alias("author"),
        "title",
        "description",
        "url",
        F.col("`source.name`").alias("source_name"),
        floor_ts(F.col("publishedAt").try_cast("timestamp_ntz"), SECOND).alias("published_at"),
        floor_ts(F.col("updated_at").try_cast("timestamp_ntz"), SECOND).alias("updated_at"),
    )


def change_log(edits: DataFrame) -> DataFrame:
    """One row per changed item of an edit record."""
    return edits.withColumn("__c", F.explode("changes")).select(
        "id",
        "kind",
        F.col("timestamp").try_cast("timestamp_ntz").alias("ts"),
        "comment",
        "ip",
        F.col("`author.key`").alias("author_key"),
        F.col("`data.master`").alias("data_master"),
        joined_or_null(F.col("`data.duplicates`")).alias("data_duplicates"),
        F.col("__c.key").alias("item_key"),
        F.col("__c.revision").alias("rev_number"),
        F.to_date(F.col("updated_at")).alias("updated_at"),
    )


def fx_rates(raw: DataFrame, codes: dict[str, str]) -> DataFrame:
    """Attribute list to columns beside all other columns."""
    rest = [c for c in raw.columns if c != "attributes"]
    return raw.select(*rest, *pairs_to_columns(F.col("attributes"), codes, "attrCode", "valueCode"))


def geo_metrics_versioned(raw: DataFrame, updated_at: Column) -> DataFrame:
    """Typed metrics; ``version`` is the load time in whole seconds."""
    return raw.select(
        F.col("business_date").try_cast("date").alias("business_date"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("country_code", "country_name", "city_name")],
        cast_or_zero(F.col("city_id"), "bigint").alias("city_id"),
        *[cast_or_zero(F.col(c), "bigint").alias(c) for c in ("visits", "users", "new_users", "pageviews")],
        cast_or_zero(F.col("bounce_rate"), "double").alias("bounce_rate"),
        updated_at.alias("updated_at"),
        floor_div(to_micros(updated_at), SECOND).alias("version"),
    )
