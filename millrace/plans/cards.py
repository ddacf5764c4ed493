"""First transaction of every issued card."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import nulls_last

# Fixed value: status text of an issued card.
ISSUED = "выдана"


def first_transaction(cards: DataFrame, status: DataFrame, transactions: DataFrame, load_date: str, threshold: float = 300) -> DataFrame:
    """Order attributes, whether the first amount exceeds the threshold, and the status flag.

    All inputs are cut to the load date first. A transaction without a time is not the first one
    unless all are. Among first transactions of one time the largest amount counts; amounts are
    compared as numbers.
    """
    today = [d.where(F.col("load_date") == F.lit(load_date)) for d in (cards, status, transactions)]
    cards, status, transactions = today
    amount = F.col("amount").try_cast("double")
    firsts = transactions.groupBy("card_num").agg(
        F.min_by(amount, nulls_last("transaction_datetime", -amount)).alias("amt")
    )
    known = status.select("card_num", "card_num_md5", "status").distinct()
    orders = cards.select("card_num_md5", "card_order_dt", "url", "cookie").distinct()
    joined = firsts.join(known, "card_num").join(orders, "card_num_md5")
    return joined.select(
        "card_order_dt",
        "card_num",
        "cookie",
        "url",
        F.coalesce(F.col("amt") > threshold, F.lit(False)).alias("transaction_level"),
        F.coalesce(F.col("status") == ISSUED, F.lit(False)).alias("status_flag"),
        F.lit(load_date).alias("partition_date"),
        F.lit(load_date).alias("load_date"),
    )
