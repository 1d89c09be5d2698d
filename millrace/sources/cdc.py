"""Change data capture."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.tables import latest_per_key

# Fixed value: the operation code of a deletion.
DELETE = "d"


def cdc_unwrap(changes: DataFrame, *, op="op", after="after", into="value") -> DataFrame:
    """Keep the row after each change; a deletion becomes a record without a value.

    Tombstones, which have no operation, are kept as they are.
    """
    image = F.when(F.col(op) != DELETE, F.col(after))
    return changes.withColumn(into, image).drop(op, after, "before")


def reroute(log: DataFrame, regex: str, replacement: str, topic="topic") -> DataFrame:
    """Rename topics that match ``regex`` as a whole; others keep their name."""
    name = F.col(topic)
    whole = f"^(?:{regex})$"
    renamed = F.regexp_replace(name, whole, replacement)
    return log.withColumn(topic, F.when(name.rlike(whole), renamed).otherwise(name))


def cdc_state(changes: DataFrame, key="key", order=("partition", "offset")) -> DataFrame:
    """The table as it stands after the changes."""
    rows = cdc_unwrap(changes)
    return latest_per_key(rows, key, order, tombstone=F.col("value").isNull())
