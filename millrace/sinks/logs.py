"""Writing keyed logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_topic_rows(
    df: DataFrame, key, topic: str, *, trace="trace_id", partition=None, fields=None,
) -> DataFrame:
    """Events as records: text key, JSON value, the trace id as header.

    ``partition`` is an optional column with the partition to write to.
    """
    columns = list(fields or [c for c in df.columns if c != partition])
    header = F.struct(
        F.lit("traceId").alias("key"), F.encode(F.col(trace), "UTF-8").alias("value")
    )
    no_headers = F.array().cast("array<struct<key:string,value:binary>>")
    headers = (
        F.when(F.col(trace).isNotNull(), F.array(header)).otherwise(no_headers)
        if trace in df.columns
        else no_headers
    )
    value = F.to_json(
        F.struct(*columns), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    )
    return df.select(
        F.encode(F.col(key).cast("string"), "UTF-8").alias("key"),
        F.encode(value, "UTF-8").alias("value"),
        F.lit(topic).alias("topic"),
        *([F.col(partition).cast("int").alias("partition")] if partition else []),
        headers.alias("headers"),
    )


def write_topic(rows: DataFrame, *, bootstrap=None, path=None, mode="append", segment_records=None):
    """Write records to brokers (needs the log connector) or to a folder by topic, and by partition where they name one.

    ``segment_records`` is how many records a file of the folder has at most: what lets a reader cap its
    micro-batches in records.
    """
    if bootstrap is not None:
        rows.write.format("kafka").option("kafka.bootstrap.servers", bootstrap).option(
            "includeHeaders", "true"
        ).save()
    else:
        folders = [c for c in ("topic", "partition") if c in rows.columns]
        rows.write.mode(mode).option("maxRecordsPerFile", segment_records or 0).partitionBy(*folders).parquet(path)


def stream_topic(rows: DataFrame, checkpoint: str, *, bootstrap=None, path=None, trigger=None):
    """Start a query that appends records to brokers or to a folder by topic."""
    writer = rows.writeStream.option("checkpointLocation", checkpoint).trigger(
        **(trigger or {"availableNow": True})
    )
    if bootstrap is not None:
        writer = writer.format("kafka").option("kafka.bootstrap.servers", bootstrap).option(
            "includeHeaders", "true"
        )
        return writer.start()
    return writer.format("parquet").partitionBy("topic").option("path", path).start()
