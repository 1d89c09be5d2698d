"""Fraud alerts: high-value orders and order velocity, with late-data rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.envelope import with_envelope
from millrace.functions.scalar import (
    GRACE,
    HIGH_VALUE_ABOVE,
    LATE_CANDIDATE_MS,
    VELOCITY_THRESHOLD,
    WINDOW_SIZE,
    epoch_ms,
    is_open,
    money,
    velocity_order_id,
    velocity_score,
)
from millrace.operators.blocks import BLOCK_ROWS, all_of, running_count, running_max


def drop_null_orders(df: DataFrame, *columns) -> DataFrame:
    """Records with a value in each of the given columns (default: the user)."""
    return df.where(all_of([F.col(c).isNotNull() for c in columns or ("user_id",)]))


def rekey(df: DataFrame, column) -> DataFrame:
    """Set the record key. Nothing moves until an operator needs the key."""
    return df.withColumn("key", F.col(column))


def high_value_alerts(
    orders: DataFrame, threshold=HIGH_VALUE_ABOVE, amount="total_amount", keep=(),
):
    """One alert per order strictly above the threshold, with the columns to ``keep``.
    Narrow: no shuffle."""
    return orders.where(money(amount) > F.lit(threshold)).select(
        *keep,
        "trace_id",
        "order_id",
        "user_id",
        F.lit("HIGH_VALUE").alias("reason"),
        F.lit(1.0).alias("score"),
    )


def with_window(df: DataFrame, size=WINDOW_SIZE, ts="occurred_at") -> DataFrame:
    """Add the epoch-aligned tumbling window as ``window_start`` and ``window_end``."""
    return df.withColumn("_w", F.window(ts, size)).select(
        "*", F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end")
    ).drop("_w")


def window_counts(df: DataFrame, size=WINDOW_SIZE, *, user="user_id", ts="occurred_at"):
    """Records per user and tumbling window; counted before the shuffle."""
    return (
        with_window(drop_null_orders(df, user, ts).select(user, ts), size, ts)
        .groupBy(user, "window_start", "window_end")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def running_counts(
    df: DataFrame, size=WINDOW_SIZE, *, user="user_id", ts="occurred_at", offset="offset",
    rows=BLOCK_ROWS,
):
    """Every record with its place in its user's window, in arrival order."""
    windowed = with_window(drop_null_orders(df, user, ts), size, ts)
    return running_count(windowed, [user, "window_start"], offset, "n", rows)


def velocity_alerts(
    df: DataFrame, size=WINDOW_SIZE, threshold=VELOCITY_THRESHOLD, *, user="user_id",
    ts="occurred_at", chunk=1 << 20,
):
    """One alert for each record that takes a user's window to ``threshold`` or beyond.

    An alert holds the user, the window and the running count, nothing of the record
    itself. So the alerts of a window follow from its final count ``n``: one for each number
    from the threshold to ``n``. Rows are counted before the only large shuffle, and no
    row-level window is needed. Windows that qualify are cut into ranges of ``chunk``
    numbers that are spread over all tasks, so a window with a third of all rows is not
    written out by one of them.
    """
    counts = window_counts(df, size, user=user, ts=ts).withColumnRenamed(user, "user_id")
    return growth_alerts(counts.withColumn("before", F.lit(0).cast("long")), threshold, chunk)


def growth_alerts(counts: DataFrame, threshold=VELOCITY_THRESHOLD, chunk=1 << 20):
    """The alerts of windows whose count went from ``before`` to ``n``."""
    low = F.greatest(F.lit(threshold).cast("long"), F.col("before") + 1)
    grown = counts.withColumn("_low", low).where(F.col("_low") <= F.col("n"))
    ranges = grown.select(
        "user_id",
        "window_start",
        F.col("n").alias("_last"),
        F.explode(F.sequence("_low", "n", F.lit(chunk).cast("long"))).alias("_from"),
    )
    # A fixed number of partitions: the ranges are tiny before they are written out, and
    # adaptive execution would otherwise put them all into one task.
    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    upto = F.least(F.col("_last"), F.col("_from") + F.lit(chunk - 1))
    numbers = ranges.repartition(tasks, "user_id", "window_start", "_from").select(
        "user_id", "window_start", F.explode(F.sequence("_from", upto)).alias("n")
    )
    return velocity_rows(numbers)


def velocity_rows(counts: DataFrame, *keep) -> DataFrame:
    """The alert for a (user, window, running count), with the columns to ``keep``."""
    return counts.select(
        *keep,
        velocity_order_id("user_id", "window_start").alias("order_id"),
        "user_id",
        F.lit("VELOCITY").alias("reason"),
        velocity_score("n").alias("score"),
        "n",
    )


def velocity_events(counts: DataFrame, *, occurred_at="window_start") -> DataFrame:
    """Velocity alerts as complete events, one for each running count of a window.

    ``counts`` holds ``user_id, window_start, n``. Each has an id of its own, made from the user,
    the window and the count, which also starts its trace; the user is the key.
    """
    alerts = velocity_rows(counts.select("user_id", "window_start", "n"), "window_start")
    named = with_envelope(alerts, "reason", "order_id", "n", occurred_at=occurred_at)
    return rekey(named, "user_id").drop("window_start")


def fraud_alerts(
    orders: DataFrame, size=WINDOW_SIZE, threshold=HIGH_VALUE_ABOVE,
    velocity_threshold=VELOCITY_THRESHOLD, *, grace=None, partition="partition",
):
    """Both kinds of alert in one bag.

    With ``grace`` orders that come too late for their window are not counted, as on the
    stream (``partition`` and ``offset`` say how they came); a late order of high value
    is still an alert.
    """
    columns = ["order_id", "user_id", "reason", "score"]
    high = high_value_alerts(orders, threshold).select(columns)
    counted = orders
    if grace is not None:
        counted = drop_late(orders, partition=partition, size=size, grace=grace)
    fast = velocity_alerts(counted, size, velocity_threshold).select(columns)
    return high.unionByName(fast)


def event_time(
    log: DataFrame, *, occurred_at="occurred_at", record_ts="timestamp", partition="partition",
    offset="offset", rows=BLOCK_ROWS,
):
    """Add ``event_time``: the event's own time, else the record time if it is not before
    the epoch, else the highest event time its partition has shown so far."""
    record = F.when(epoch_ms(record_ts) >= 0, F.col(record_ts))
    own = log.withColumn("_own", F.coalesce(F.col(occurred_at), record))
    seen = running_max(own, [partition], offset, "_own", "_seen", rows, split="all")
    return seen.withColumn("event_time", F.coalesce("_own", "_seen")).drop("_own", "_seen")


def late_candidates(
    log: DataFrame, lag_ms=LATE_CANDIDATE_MS, *, occurred_at="occurred_at",
    record_ts="timestamp",
):
    """Records that reached the log ``lag_ms`` or more after they happened."""
    lag = epoch_ms(record_ts) - epoch_ms(occurred_at)
    return log.withColumn("lag_ms", lag).where(F.col("lag_ms") >= lag_ms)


def with_stream_time(
    log: DataFrame, *, partition="partition", offset="offset", ts="occurred_at",
    before=None, rows=BLOCK_ROWS,
):
    """Add ``stream_time``: the highest event time of the partition up to this record.

    ``before`` has the stream time each partition had reached before this log, one row per
    partition of the topic (broadcast: a topic has thousands of partitions at most).
    """
    timed = running_max(log, [partition], offset, ts, "stream_time", rows, split="all")
    if before is None:
        return timed
    past = F.broadcast(before.select(partition, F.col("stream_time").alias("_past")))
    return timed.join(past, partition, "left").withColumn(
        "stream_time", F.greatest("stream_time", "_past")
    ).drop("_past")


def drop_late(
    log: DataFrame, *, partition="partition", offset="offset", ts="occurred_at",
    size=WINDOW_SIZE, grace=GRACE, before=None, rows=BLOCK_ROWS, user="user_id",
):
    """Records whose window was still open when they arrived.

    Records without a ``user`` never reach a window: they are dropped and do not move the clock.

    Exact, record by record. Stream time is kept per ``partition``, which should be the
    partition of the log as read for counting (the one re-keyed by user). ``before`` is as
    in ``with_stream_time``.
    """
    timed = with_window(
        with_stream_time(
            drop_null_orders(log, user), partition=partition, offset=offset, ts=ts, before=before, rows=rows
        ),
        size,
        ts,
    )
    return timed.where(is_open("window_end", "stream_time", grace)).drop(
        "window_start", "window_end", "stream_time"
    )
