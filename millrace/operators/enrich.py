"""Orders joined with user profiles: latest table, or the profile at arrival."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.blocks import BLOCK_ROWS, fill_forward, join_skewed


def fits(df: DataFrame, limit_rows: int) -> bool:
    """Whether a table has at most so many rows; counting stops at the limit."""
    return df.limit(limit_rows + 1).count() <= limit_rows


def enrich_projection(joined: DataFrame, processed_at=None) -> DataFrame:
    """Order columns plus ``user_name`` and ``user_email``; the event id stays the order's.

    ``processed_at`` becomes the new ``occurred_at`` where given.
    """
    named = joined.withColumnsRenamed({"name": "user_name", "email": "user_email"})
    return named if processed_at is None else named.withColumn("occurred_at", processed_at)


def enrich(
    orders: DataFrame, profiles: DataFrame, key="user_id", *, broadcast_rows=None,
    processed_at=None, rows=BLOCK_ROWS,
):
    """Orders with the latest profile of their user; orders without one are dropped.

    ``profiles`` holds one row per key. With ``broadcast_rows`` the whole table is sent to
    every task if it has at most that many rows. Otherwise orders of hot users have those
    users' profiles sent to them and the rest are joined by key.
    """
    known = orders.where(F.col(key).isNotNull())
    if broadcast_rows is not None and fits(profiles, broadcast_rows):
        joined = known.join(F.broadcast(profiles), key)
    else:
        joined = join_skewed(known, profiles, [key], "inner", rows)
    return enrich_projection(joined, processed_at)


def asof_enrich(
    orders: DataFrame, changes: DataFrame, key="user_id", seq="offset", *, before=None,
    rows=BLOCK_ROWS,
):
    """Orders with the profile that was current when they arrived.

    Both logs carry ``seq``, the arrival order. An order sees the last change of its key
    at or before its own place; an order before the first change is dropped and never
    comes back; later changes touch later orders only. A change whose fields are all null
    is a tombstone and clears the profile. ``before`` holds the profiles from before the
    logs begin, one row per key, without ``seq``.
    """
    if before is not None:
        known = before.withColumn(seq, F.lit(-1).cast(changes.schema[seq].dataType))
        changes = changes.unionByName(known)
    profile_columns = [c for c in changes.columns if c not in (key, seq)]
    order_columns = [c for c in orders.columns if c not in (key, seq)]
    profile = F.struct(*profile_columns)
    # Order columns stay apart, so those nobody asks for are not shuffled.
    own = {c: f"_order_{c}" for c in order_columns}
    change_rows = changes.where(F.col(key).isNotNull()).select(
        key, seq, F.lit(0).alias("_side"), profile.alias("_profile")
    )
    order_rows = orders.where(F.col(key).isNotNull()).select(
        key, seq, F.lit(1).alias("_side"), *[F.col(c).alias(own[c]) for c in order_columns]
    )
    log = change_rows.unionByName(order_rows, allowMissingColumns=True)
    filled = fill_forward(log, [key], seq, "_profile", "_current", tie="_side", rows=rows)
    alive = F.coalesce(*[F.col(f"_current.{c}").cast("string") for c in profile_columns])
    hit = filled.where((F.col("_side") == 1) & alive.isNotNull())
    joined = hit.select(
        key, seq, *[F.col(own[c]).alias(c) for c in order_columns],
        *[f"_current.{c}" for c in profile_columns],
    )
    return enrich_projection(joined)
