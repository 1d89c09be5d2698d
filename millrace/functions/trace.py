"""Trace ids carried in record headers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.scalar import col, has_text

# Fixed value: the header name.
TRACE_HEADER = "traceId"


def header_trace(headers) -> Column:
    """Text of the last header named ``traceId``, if it is not empty."""
    named = F.filter(col(headers), lambda h: h["key"] == TRACE_HEADER)
    text = F.try_element_at(named, F.lit(-1))["value"].cast("string")
    return F.when(F.octet_length(text) > 0, text)


def set_trace_header(headers, trace_id) -> Column:
    """The headers with exactly one ``traceId``."""
    others = F.filter(col(headers), lambda h: h["key"] != TRACE_HEADER)
    own = F.struct(
        F.lit(TRACE_HEADER).alias("key"), F.encode(col(trace_id), "UTF-8").alias("value")
    )
    empty = F.array().cast("array<struct<key:string,value:binary>>")
    return F.concat(F.coalesce(others, empty), F.array(own))


def with_trace_id(
    log, *, headers="headers", payload="trace_id", prefer="header", fallback=None
):
    """Settle a record's trace id and write it back as its single header.

    ``prefer`` says which side wins when both carry one; services that read the payload
    let it override the header. ``fallback`` replaces the random id for records with
    neither (use it where the id must not change between attempts).
    """
    from_header = header_trace(headers)
    from_payload = F.when(has_text(payload), col(payload))
    sides = (from_header, from_payload) if prefer == "header" else (from_payload, from_header)
    last = F.uuid() if fallback is None else col(fallback)
    settled = log.withColumn("trace_id", F.coalesce(*sides, last))
    return settled.withColumn("headers", set_trace_header(headers, "trace_id"))
