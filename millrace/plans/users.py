"""People from several surveys, one row each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import strip_to_number
from ..functions.texts import without_at
from ..operators.ordering import pick_one
from ..operators.sets import union_named


def survey_users(*surveys: DataFrame) -> DataFrame:
    """``telegram_id, user_nickname, registration_date``; the earliest date per id, then nickname."""
    cols = ["tg_id", "tg_nickname", "update_at"]
    rows = union_named(*[s.select(*cols) for s in surveys]).select(
        strip_to_number(F.col("tg_id")).alias("telegram_id"),
        without_at(F.col("tg_nickname")).alias("user_nickname"),
        F.left("update_at", F.lit(10)).try_cast("date").alias("registration_date"),
    )
    known = rows.where("telegram_id IS NOT NULL")
    return pick_one(known, ["telegram_id"], ["registration_date", "user_nickname"])
