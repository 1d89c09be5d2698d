"""Keyed logs as DataFrames with the columns of Spark's log source."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.schemas import TOPIC_LOG


def read_topic(
    spark: SparkSession, topic: str, *, streaming=False, starting="earliest",
    max_per_trigger=None, segment_records=None, partitions=None, bootstrap=None, path=None,
    file_format="parquet",
) -> DataFrame:
    """A topic as a batch or streaming DataFrame.

    From brokers (``bootstrap``; needs the log connector on the class path) or from a
    folder of files (``path``) holding the same columns. Only committed records are read.
    ``max_per_trigger`` caps a micro-batch: in records where they come from brokers or where ``segment_records``
    says how many a file holds at most, else in files. With ``partitions`` only these are read, as by one
    member of a consumer group; a folder must have been written by partition for it (see ``write_topic``).
    """
    reader = spark.readStream if streaming else spark.read
    if bootstrap is not None:
        options = {
            "kafka.bootstrap.servers": bootstrap,
            **({"subscribe": topic} if partitions is None else {"assign": json.dumps({topic: list(partitions)})}),
            "startingOffsets": starting,
            "kafka.isolation.level": "read_committed",
            "includeHeaders": "true",
        }
        if streaming and max_per_trigger:
            options["maxOffsetsPerTrigger"] = str(max_per_trigger)
        return reader.format("kafka").options(**options).load().select(*TOPIC_LOG.fieldNames())
    reader = reader.schema(TOPIC_LOG)
    if streaming and max_per_trigger:
        files = max_per_trigger if segment_records is None else max(1, max_per_trigger // segment_records)
        reader = reader.option("maxFilesPerTrigger", files)
    if partitions is not None:
        # As a pattern: a stream takes a plain path for the place where the folder begins, and finds no partition in it.
        reader = reader.option("basePath", path)
        path = f"{path}/topic={topic}/partition={{{','.join(str(p) for p in partitions)}}}"
    log = reader.format(file_format).load(path).where(F.col("topic") == topic)
    return log.select(*TOPIC_LOG.fieldNames())


def table_stream(
    spark: SparkSession, folder: str, table: str, *, max_files=None, max_bytes=None,
) -> DataFrame:
    """A table's files as a stream; ``table`` is one file, a folder of files or a pattern.

    ``max_files`` or ``max_bytes`` caps a micro-batch.
    """
    # As a pattern, because a stream takes a plain path for a folder.
    path = f"{folder}/{{{table}}}"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(path)
