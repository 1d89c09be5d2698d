"""Scalar rules, as column expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.schemas import MONEY

# Thresholds, prefixes and defaults.
HIGH_VALUE_ABOVE = Decimal("10000")
PAID_BELOW = Decimal("10000")
VELOCITY_THRESHOLD = 3
WINDOW_SIZE = "5 minutes"
GRACE = "1 minute"
LATE_CANDIDATE_MS = 60_000
TRANSACTION_PREFIX = "pay-"
DEFAULT_CURRENCY = "USD"


def col(column) -> Column:
    """A column by name, or the column itself."""
    return F.col(column) if isinstance(column, str) else column


def money(column) -> Column:
    return col(column).cast(MONEY)


def has_text(column) -> Column:
    """Neither null nor blank."""
    return F.coalesce(col(column).rlike(r"\S"), F.lit(False))


def first_non_blank(*columns, fallback=None) -> Column:
    """First column with text, else ``fallback``, else a new random id.

    The random id differs between attempts of a task: pass a ``fallback`` made from the
    record's own coordinates wherever the value ends up in a key.
    """
    last = F.uuid() if fallback is None else col(fallback)
    return F.coalesce(*[F.when(has_text(c), col(c)) for c in columns], last)


def default_currency(currency) -> Column:
    return F.when(has_text(currency), col(currency)).otherwise(F.lit(DEFAULT_CURRENCY))


def order_total(items, total) -> Column:
    """The given total, else the exact sum of price times quantity."""
    summed = F.aggregate(
        col(items),
        F.lit(0).cast(MONEY),
        lambda acc, item: (acc + item["price"] * item["quantity"]).cast(MONEY),
    )
    return F.coalesce(money(total), summed)


def payment_status(amount, paid_below=PAID_BELOW) -> Column:
    """Strictly below the limit is paid; the limit itself fails."""
    return F.when(money(amount) < F.lit(paid_below), F.lit("PAID")).otherwise(F.lit("FAILED"))


def transaction_id(order_id) -> Column:
    """Derived from the order, so a retry names the same payment."""
    return F.concat(F.lit(TRANSACTION_PREFIX), col(order_id).cast("string"))


def epoch_ms(timestamp) -> Column:
    return F.unix_millis(col(timestamp).cast("timestamp"))


def velocity_score(count) -> Column:
    return F.least(F.lit(1.0), col(count) / F.lit(10.0))


def velocity_order_id(user_id, window_start) -> Column:
    return F.concat_ws(
        "|", F.lit("velocity"), col(user_id).cast("string"), epoch_ms(window_start).cast("string")
    )


def is_open(window_end, stream_time, grace=GRACE) -> Column:
    """A window takes records until its end plus grace is reached by stream time."""
    return col(window_end) > col(stream_time) - F.expr(f"INTERVAL {grace}")
