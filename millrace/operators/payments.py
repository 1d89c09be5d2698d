"""Payment decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.functions.scalar import PAID_BELOW, money, payment_status, transaction_id


def charge(orders: DataFrame, paid_below=PAID_BELOW, keep=()) -> DataFrame:
    """One payment per order, the same for every attempt, with the columns to ``keep``.
    Narrow: no shuffle."""
    return orders.select(
        *keep,
        "order_id",
        "user_id",
        money("total_amount").alias("amount"),
        payment_status("total_amount", paid_below).alias("status"),
        transaction_id("order_id").alias("transaction_id"),
    )
