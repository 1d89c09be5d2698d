"""Deduplication on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.blocks import all_of


def stream_dedup(stream: DataFrame, keys=("channel", "event_id"), *, ts="occurred_at",
                 horizon) -> DataFrame:
    """The first record per key; records with a null in the key all pass.

    Copies are recognised for as long as they come within ``horizon`` of each other in
    event time; state older than that is dropped. All copies of a key pass through one
    task, one by one; ``streaming.tables.dedup_writer`` collapses them before the shuffle.
    """
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, horizon)
    known = all_of([F.col(k).isNotNull() for k in keys])
    once = timed.where(known).dropDuplicatesWithinWatermark(list(keys))
    return once.unionByName(timed.where(~known))
