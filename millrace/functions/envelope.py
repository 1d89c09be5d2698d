"""The envelope every event carries: id, time and trace id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalar import col, has_text


def event_id_of(*columns) -> Column:
    """An id in UUID form made from the columns that name the event.

    The same event has the same id in every attempt, so a repeated task or batch cannot
    make a second one of it. Each value goes in behind its length, so that no two lists of
    values read the same; a null is told from every text.
    """
    texts = [col(c).cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit("-")) for t in texts]
    digest = F.md5(F.concat_ws("|", *parts))
    bounds = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digest, start, size) for start, size in bounds])


def with_envelope(df: DataFrame, *named_by, occurred_at, trace_id="trace_id") -> DataFrame:
    """Put ``event_id``, ``occurred_at`` and ``trace_id`` in front of an event's fields.

    A trace id the row already has is kept; otherwise the event id starts a trace.
    """
    event_id = event_id_of(*named_by)
    fields = [c for c in df.columns if c not in ("event_id", "occurred_at", "trace_id")]
    trace = event_id
    if trace_id in df.columns:
        trace = F.when(has_text(trace_id), F.col(trace_id)).otherwise(event_id)
    return df.select(
        event_id.alias("event_id"),
        col(occurred_at).alias("occurred_at"),
        trace.alias("trace_id"),
        *fields,
    )
