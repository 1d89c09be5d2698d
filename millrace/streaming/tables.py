"""Batch operators over a stream, with their state in versioned tables.

Each micro-batch runs the batch operator on the state left by the batch before, writes its
output to its own folder and the new state as version ``batch_id``. A repeated batch starts
from the same version and replaces the same folders, so nothing happens twice. A hot key is
handled as in the batch operators, whatever the size of the micro-batch. State is rewritten
with every batch, so large micro-batches suit it best.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.blocks import all_of
from millrace.operators.dedup import first_per_key
from millrace.operators.enrich import asof_enrich
from millrace.functions.scalar import GRACE, HIGH_VALUE_ABOVE, VELOCITY_THRESHOLD, WINDOW_SIZE, is_open
from millrace.operators.fraud import (
    drop_late, drop_null_orders, growth_alerts, high_value_alerts, with_window,
)
from millrace.operators.inventory import FOLD_ROWS, reserve_stock, stock_left
from millrace.operators.ledger import once_by_ranges, ranges_of, with_processed
from millrace.operators.tables import upsert
from millrace.sinks.tables import (
    drop_versions, exactly_once_writer, fan_out, read_batches, read_table, write_version,
)


def velocity_writer(
    folder: str, size=WINDOW_SIZE, grace=GRACE, threshold=VELOCITY_THRESHOLD, *,
    user="user_id", ts="occurred_at", partition="partition", offset="offset",
):
    """Velocity alerts with the exact late rule, record by record, over micro-batches.

    Gives what ``velocity_alerts(drop_late(log))`` gives for the whole log, however it is
    cut into micro-batches. Alerts go to ``folder/alerts``. State is the stream time of
    each partition and the counts of windows that can still grow. The log is partitioned by
    user, so a window lives as long as its own partition's time allows: an idle one
    keeps no windows of the others.
    """

    def write(batch: DataFrame, batch_id: int):
        spark = batch.sparkSession
        times = read_table(spark, f"{folder}/times", before=batch_id)
        counts = read_table(spark, f"{folder}/counts", before=batch_id)
        batch = drop_null_orders(batch, user)
        accepted = drop_late(
            batch, partition=partition, offset=offset, ts=ts, size=size, grace=grace,
            before=times, user=user,
        )
        windowed = with_window(drop_null_orders(accepted, user, ts), size, ts)
        new = windowed.groupBy(F.col(user).alias("user_id"), "window_start", "window_end").agg(
            F.count(F.lit(1)).alias("n"), F.max(partition).alias("_partition")
        )
        zero = F.lit(0).cast("long")
        log = new.withColumn("before", zero)
        if counts is not None:
            old = counts.withColumnsRenamed({"n": "before"}).withColumn("n", zero)
            log = log.unionByName(old)
        total = log.groupBy("user_id", "window_start", "window_end").agg(
            F.sum("before").alias("before"), (F.sum("before") + F.sum("n")).alias("n"),
            F.max("_partition").alias("_partition"),
        )
        write_version(total, f"{folder}/totals", batch_id)
        total = read_table(spark, f"{folder}/totals", before=batch_id + 1)
        alerts = growth_alerts(total, threshold)
        alerts.write.mode("overwrite").parquet(f"{folder}/alerts/batch_id={batch_id}")

        reached = batch.groupBy(partition).agg(F.max(ts).alias("stream_time"))
        if times is not None:
            reached = reached.unionByName(times).groupBy(partition).agg(
                F.max("stream_time").alias("stream_time")
            )
        write_version(reached, f"{folder}/times", batch_id)
        times = read_table(spark, f"{folder}/times", before=batch_id + 1)
        reached = times.select(F.col(partition).alias("_partition"), "stream_time")
        growing = total.join(reached, "_partition").where(
            is_open("window_end", "stream_time", grace)
        )
        write_version(
            growing.select("user_id", "window_start", "window_end", "n", "_partition"),
            f"{folder}/counts",
            batch_id,
        )
        # These are the job's own: nobody else is at an older version.
        for state in ("totals", "times", "counts"):
            drop_versions(spark, f"{folder}/{state}", batch_id)

    return write


def fraud_writer(
    folder: str, size=WINDOW_SIZE, grace=GRACE, above=HIGH_VALUE_ABOVE, threshold=VELOCITY_THRESHOLD, **columns,
):
    """Both kinds of alert from one read of the orders: what ``fraud_alerts`` with ``grace`` gives for the whole log.

    High-value alerts go to ``folder/high-value``, velocity alerts to ``folder/velocity/alerts``; see
    ``velocity_writer``, which takes ``columns``.
    """
    high = exactly_once_writer(f"{folder}/high-value", lambda batch: high_value_alerts(batch, above))
    return fan_out([high, velocity_writer(f"{folder}/velocity", size, grace, threshold, **columns)])


def reserve_writer(
    folder: str, stock: DataFrame, seq=("offset", "line"), rows=FOLD_ROWS, coordinate=None,
):
    """Reserve the lines of each micro-batch; see ``reserve_stock``.

    ``stock`` is what there is before the first batch. Events go to ``folder/events``, what
    is left to ``folder/stock``. With ``coordinate``, the log's partition and offset columns, a ledger of
    what has been processed is kept in ``folder/ledger`` and moves together with the stock: a record
    that comes again, in this micro-batch or a later one, takes nothing and has no event.
    """

    def write(batch: DataFrame, batch_id: int):
        spark = batch.sparkSession
        shelf = read_table(spark, f"{folder}/stock", before=batch_id)
        shelf = stock if shelf is None else shelf
        ledger = None
        if coordinate is not None:
            ledger = read_table(spark, f"{folder}/ledger", before=batch_id)
            if ledger is None:
                ledger = ranges_of(batch.where(F.lit(False)), *coordinate)
            line = [c for c in seq if c not in coordinate]
            batch = once_by_ranges(batch, ledger, coordinate, line)
        events, _ = reserve_stock(batch, shelf, seq, rows)
        mine = f"{folder}/events/batch_id={batch_id}"
        events.write.mode("overwrite").parquet(mine)
        # What is left, and done, follows from the events as written: the fold runs once.
        events = spark.read.schema(events.schema).parquet(mine)
        write_version(stock_left(shelf, events), f"{folder}/stock", batch_id)
        if ledger is not None:
            write_version(with_processed(ledger, events, coordinate), f"{folder}/ledger", batch_id)
            drop_versions(spark, f"{folder}/ledger", batch_id)

    return write


def enrich_writer(folder: str, key="user_id", seq="offset", *, fields, side="log_side"):
    """Join the orders of each micro-batch with the profile at arrival; see ``asof_enrich``.

    A micro-batch holds orders (``side`` 1) and profile changes (0) of one log. Joined
    orders go to ``folder/orders``, the profiles to ``folder/profiles``.
    """

    def write(batch: DataFrame, batch_id: int):
        spark = batch.sparkSession
        changes = batch.where(F.col(side) == 0).select(key, seq, *fields)
        orders = batch.where(F.col(side) == 1).drop(side, *fields)
        known = read_table(spark, f"{folder}/profiles", before=batch_id)
        if known is None:
            known = changes.drop(seq).where(F.lit(False))
        joined = asof_enrich(orders, changes, key, seq, before=known)
        joined.write.mode("overwrite").parquet(f"{folder}/orders/batch_id={batch_id}")
        now = upsert(known, changes, key, seq, on_null="delete", missing="overwrite")
        write_version(now, f"{folder}/profiles", batch_id)

    return write


def dedup_writer(path: str, keys=("channel", "event_id"), order=("offset",), *,
                 ts="occurred_at", horizon=None):
    """Write the first record per key; records with a null in the key all pass.

    The output is its own memory: a key is new if no earlier batch wrote it. With a ``horizon``
    only what lies within it, in event time before the oldest record of this batch, is
    remembered, besides records without a time. Copies inside a batch collapse before the shuffle, so one key may fill a third of it.
    """
    keys = list(keys)

    def write(batch: DataFrame, batch_id: int):
        spark = batch.sparkSession
        known = all_of([F.col(k).isNotNull() for k in keys])
        once = first_per_key(batch.where(known), keys, list(order)).select(*batch.columns)
        if batch_id > 0:
            recent = F.col("batch_id") < batch_id
            if horizon is not None:
                oldest = batch.agg(F.min(ts)).first()[0]
                near = F.col(ts) >= F.lit(oldest) - F.expr(f"INTERVAL {horizon}")
                recent = recent & F.coalesce(near, F.lit(True))
            written = read_batches(spark, path, batch.drop("batch_id").schema)
            once = once.join(written.where(recent).select(*keys), keys, "left_anti")
        rows = once.select(*batch.columns).unionByName(batch.where(~known))
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write
