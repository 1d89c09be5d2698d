"""Deduplication: by idempotency key, log coordinate and event id."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.blocks import BLOCK_ROWS, all_of, split_hot


def first_per_key(df: DataFrame, keys, order) -> DataFrame:
    """The first row of each key. Copies collapse before the shuffle, so a key with a
    third of all rows costs one row per task."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(first.alias("_first")).select(*keys, "_first.*")


def dedup_first(
    submissions: DataFrame, key="idempotency_key", order="offset", order_id="order_id",
    failed=None, rows=BLOCK_ROWS,
):
    """Every submission with the order id its key stands for, and whether it was taken.

    The first submission of a key wins; later ones get its order id and emit nothing.
    A submission whose send ``failed`` (a condition) frees the key for the next one; it
    answers with its own order id unless the key was already held. A submission without a key
    stands for itself: its own place takes the part of the key, so that such rows are spread.

    Rows of a hot key stay where they are and have its winner, found with partial
    aggregation, sent to them; the others are answered in one window by key.
    """
    sent = F.lit(True) if failed is None else ~failed
    first = F.min(F.when(sent, F.struct(F.col(order).alias("at"), F.col(order_id).alias("id"))))
    common, rare = split_hot(submissions, [key], rows)
    winners = F.broadcast(common.groupBy(key).agg(first.alias("_won")))
    alone = [F.when(F.col(key).isNull(), F.col(c)) for c in (order, order_id)]
    answered = common.join(winners, key).unionByName(
        rare.withColumn("_won", first.over(Window.partitionBy(key, *alone)))
    )
    held = F.col("_won.at") <= F.col(order)
    return answered.select(
        *submissions.columns,
        F.when(held, F.col("_won.id")).otherwise(F.col(order_id)).alias("canonical_order_id"),
        F.coalesce(F.col("_won.at") == F.col(order), F.lit(False)).alias("accepted"),
    )


def skip_processed(df: DataFrame, ledger: DataFrame, keys=("partition", "offset")):
    """Records whose log coordinate is not in the ledger yet. Coordinates are unique, so none is hot."""
    return df.join(ledger.select(*keys), list(keys), "left_anti")


def ledger_dedup(df: DataFrame, ledger: DataFrame, keys=("partition", "offset"), coordinate=None):
    """Records to process: new to the ledger, one per log coordinate.

    Redelivered copies are equal, so the least row stands for all of them. ``coordinate`` are the
    keys that the ledger has, if a record consists of several rows.
    """
    rest = [c for c in df.columns if c not in keys]
    once = (
        df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row")).select(*keys, "_row.*")
        if rest
        else df.select(*keys).distinct()
    )
    return skip_processed(once, ledger, coordinate or keys).select(*df.columns)


def ledger_rows(processed: DataFrame) -> DataFrame:
    """What a processed batch adds to the ledger."""
    return processed.select("partition", "offset", "order_id")


def dedup_events(df: DataFrame, keys=("channel", "event_id"), order=("offset",)) -> DataFrame:
    """The first row per channel and event id; rows without an event id all pass.

    Each row without one has a key of its own, so the input is read once and no task gets them all.
    """
    known = all_of([F.col(k).isNotNull() for k in keys])
    marked = df.withColumn("_alone", F.when(~known, F.monotonically_increasing_id()))
    return first_per_key(marked, [*keys, "_alone"], list(order)).select(*df.columns)
