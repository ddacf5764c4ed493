"""Web traffic from visits and hits.

A visit lists its hit ids as text. ``join_hits`` repeats the visit once per hit, so figures
about visits are taken from the visits themselves (``grain="visit"``) and only page views and
devices use the joined rows; ``grain="hit"`` computes everything on the joined rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nested import explode_id_text
from ..functions.texts import label_of
from ..operators.aggregates import collect_if, share_of, uniq_if
from ..operators.ordering import same_keys
from ..session import materialise

V = "ym:s:"
H = "ym:pv:"

# Device codes of the export.
DEVICES = {"1": "desktop", "2": "tablet", "3": "mobile"}


def _v(name: str) -> Column:
    return F.col(f"`{V}{name}`")


def _h(name: str) -> Column:
    return F.col(f"`{H}{name}`")


def _day() -> Column:
    return F.to_date(_v("dateTime")).alias("business_date")


def _or_unknown(col: Column) -> Column:
    return F.coalesce(col, F.lit("unknown"))


def join_hits(visits: DataFrame, hits: DataFrame) -> DataFrame:
    """Every visit once per hit it lists, with the hit's columns where it is found."""
    listed = explode_id_text(visits, f"{V}watchIDs", "watch_id")
    return listed.join(hits, (_v("clientID") == _h("clientID")) & (F.col("watch_id") == _h("watchID")), "left")


def _rows(visits: DataFrame, joined: DataFrame, grain: str) -> DataFrame:
    if grain not in ("visit", "hit"):
        raise ValueError("grain must be visit or hit")
    return visits if grain == "visit" else joined


def _flag(value: str) -> Column:
    return F.count_if(_v("isNewUser") == value)


def web_daily(visits: DataFrame, joined: DataFrame, grain: str = "visit") -> DataFrame:
    """Daily users, page views, average duration and bounce rate."""
    figures = [
        F.countDistinct(_v("clientID")).alias("dau"),
        F.round(F.avg(_v("visitDuration")), 2).alias("avg_duration"),
        share_of(_v("pageViews") == 1).alias("bounce_rate"),
    ]
    views = F.count(_h("pageViewID")).alias("pageviews")
    if grain == "hit":
        return joined.groupBy(_day()).agg(views, *figures)
    per_day = _rows(visits, joined, grain).groupBy(_day()).agg(*figures)
    return same_keys(per_day, joined.groupBy(_day()).agg(views), ["business_date"], "left").fillna(0, ["pageviews"])


def web_traffic(visits: DataFrame, joined: DataFrame, grain: str = "visit") -> DataFrame:
    """Sessions, new and returning users per day and source."""
    rows = _rows(visits, joined, grain)
    return rows.groupBy(_day(), _or_unknown(_v("lastsignReferalSource")).alias("source")).agg(
        F.countDistinct(_v("visitID")).alias("sessions"),
        _flag("1").alias("new_users"),
        _flag("0").alias("returning_users"),
    )


def web_new_returning(visits: DataFrame, joined: DataFrame, grain: str = "visit") -> DataFrame:
    rows = _rows(visits, joined, grain)
    return rows.groupBy(_day()).agg(_flag("1").alias("new_users"), _flag("0").alias("returning_users"))


def web_geo(visits: DataFrame) -> DataFrame:
    """Sessions and users per day, country and city; the same at both grains, as every visit has a joined row."""
    return visits.groupBy(
        _day(), _or_unknown(_v("regionCountry")).alias("country"), _or_unknown(_v("regionCity")).alias("city")
    ).agg(F.countDistinct(_v("visitID")).alias("sessions"), F.countDistinct(_v("clientID")).alias("dau"))


def web_devices(joined: DataFrame) -> DataFrame:
    """Sessions per day, device class, browser and system."""
    return joined.groupBy(
        _day(),
        label_of(_h("deviceCategory"), DEVICES).alias("device_category"),
        _or_unknown(_h("browser")).alias("browser"),
        _or_unknown(_h("operatingSystem")).alias("os"),
    ).agg(F.countDistinct(_v("visitID")).alias("sessions"))


def web_top_pages(visits: DataFrame, joined: DataFrame, grain: str = "visit") -> DataFrame:
    """Page views and average duration per day and landing page."""
    page = [_day(), _or_unknown(_v("startURL")).alias("url")]
    views = F.countDistinct(_h("pageViewID")).alias("pageviews")
    duration = F.round(F.avg(_v("visitDuration")), 2).alias("avg_duration")
    if grain == "hit":
        return joined.groupBy(*page).agg(views, duration)
    per_page = visits.groupBy(*page).agg(duration)
    return same_keys(per_page, joined.groupBy(*page).agg(views), ["business_date", "url"], "left").fillna(0, ["pageviews"])


def web_depth(visits: DataFrame, joined: DataFrame, grain: str = "visit") -> DataFrame:
    """Average and highest depth and bounce rate per day."""
    return _rows(visits, joined, grain).groupBy(_day()).agg(
        F.round(F.avg(_v("pageViews")), 2).alias("avg_pageviews"),
        F.max(_v("pageViews")).alias("max_pageviews"),
        share_of(_v("pageViews") == 1).alias("bounce_rate"),
    )


def web_views_of(joined: DataFrame, landing: Column, chunk_rows: int) -> DataFrame:
    """Pages of every client as ordered chunks, from visits that satisfy ``landing`` only."""
    rows = joined.select(_v("clientID").alias("client_id"), _h("pageViewID").alias("view_id"), landing.alias("__landing"))
    return collect_if(rows, ["client_id"], "view_id", F.col("__landing") & F.col("view_id").isNotNull(), ["view_id"], chunk_rows)


def web_users_if(joined: DataFrame, landing: Column) -> DataFrame:
    """Per day: all clients, and about how many of them came by visits that satisfy ``landing``."""
    return joined.groupBy(_day()).agg(
        F.countDistinct(_v("clientID")).alias("clients"), uniq_if(_v("clientID"), landing).alias("landed")
    )


def web_marts(visits: DataFrame, hits: DataFrame, grain: str = "visit") -> dict[str, DataFrame]:
    """All seven marts by name; visits and hits are joined and stored once for all of them."""
    joined = materialise(join_hits(visits, hits), "visits-hits")
    return {
        "daily_metrics": web_daily(visits, joined, grain),
        "traffic_sources": web_traffic(visits, joined, grain),
        "new_vs_returning": web_new_returning(visits, joined, grain),
        "geo_stats": web_geo(visits),
        "devices": web_devices(joined),
        "top_pages": web_top_pages(visits, joined, grain),
        "session_depth": web_depth(visits, joined, grain),
    }
