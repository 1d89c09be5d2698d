"""Consumer lag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def log_bounds(log: DataFrame) -> DataFrame:
    """First offset and end offset (one past the last) of each partition."""
    return log.groupBy("topic", "partition").agg(
        F.min("offset").alias("begin_offset"), (F.max("offset") + 1).alias("end_offset")
    )


def consumer_lag(groups: DataFrame, bounds: DataFrame, committed: DataFrame) -> DataFrame:
    """Lag per group and partition, never below zero.

    ``groups`` has a row per (group_id, topic), ``bounds`` one per partition, ``committed``
    the offsets groups have committed. A partition without one counts from its beginning.
    """
    partitions = groups.join(bounds, "topic")
    known = partitions.join(committed, ["group_id", "topic", "partition"], "left")
    at = F.coalesce("committed_offset", "begin_offset")
    return known.select(
        "group_id",
        "topic",
        "partition",
        at.alias("committed_offset"),
        "end_offset",
        F.greatest(F.lit(0).cast("long"), F.col("end_offset") - at).alias("lag"),
    ).orderBy("group_id", "topic", "partition")


def group_lag(lag: DataFrame) -> DataFrame:
    """Total lag per group and topic."""
    return lag.groupBy("group_id", "topic").agg(F.sum("lag").alias("total_lag"))


def progress_lag(progress) -> dict:
    """Lag per topic partition of a running streaming query, from its last progress.

    ``progress`` is a ``StreamingQueryProgress`` read as a dict, or its JSON.
    """
    import json

    report = progress if isinstance(progress, dict) else json.loads(progress)
    lag = {}
    for source in report.get("sources", []):
        done, latest = (
            json.loads(value) if isinstance(value, str) else value
            for value in (source.get("endOffset"), source.get("latestOffset"))
        )
        if not isinstance(latest, dict):
            continue
        for topic, ends in latest.items():
            if not isinstance(ends, dict):
                continue
            for partition, end in ends.items():
                at = ((done or {}).get(topic) or {}).get(partition, 0)
                lag[(topic, int(partition))] = max(0, end - at)
    return lag
