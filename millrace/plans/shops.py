"""Shops with their time zone number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import trailing_number
from ..functions.texts import blank_to_null


def shop_timezone(shops: DataFrame, zones: DataFrame, keep_unmatched: bool = False, default: int = 3) -> DataFrame:
    """``st_id, shop_name, tz_code``: one row per shop, zone ``RUSnn`` gives nn, no zone gives 3.

    ``zones.plant`` is text that may be no number and may repeat with a blank zone; of several
    zones the highest text is taken, which the max aggregate does before any shuffle.
    """
    clean = (
        zones.where(F.col("plant").rlike("^[0-9]+$"))
        .select(F.col("plant").try_cast("bigint").alias("st_id"), blank_to_null(F.col("time_zone")).alias("zone"))
        .groupBy("st_id")
        .agg(F.max("zone").alias("zone"))
    )
    base = shops.select(F.col("st_id").try_cast("bigint").alias("st_id"), "shop_name")
    joined = base.join(clean, "st_id", "left" if keep_unmatched else "inner")
    return joined.select("st_id", "shop_name", F.coalesce(trailing_number(F.col("zone")), F.lit(default)).alias("tz_code"))
