"""Avro bodies of profile records.

``decode.decode_avro`` uses Spark's avro package. Where that package is not on the class
path, ``decode_text_record`` reads records whose fields are all text, as profiles are.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _length(data, at):
    """A variable-length zigzag number and the place after it."""
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 0x7F) << shift
        at += 1
        shift += 7
        if byte < 0x80:
            return (value >> 1) ^ -(value & 1), at


def _record(data, optional):
    """The texts of one record. An optional field says first whether it is there."""
    at, texts = 0, []
    for may_be_null in optional:
        if may_be_null:
            branch, at = _length(data, at)
            if branch == 0:
                texts.append(None)
                continue
        size, at = _length(data, at)
        if size < 0 or at + size > len(data):
            raise ValueError("text is longer than the body")
        texts.append(bytes(data[at:at + size]).decode("utf-8"))
        at += size
    return texts


def decode_text_record(framed: DataFrame, schema: T.StructType, body="body", into="event"):
    """Decode bodies with the writer's ``schema`` into a struct column.

    A nullable field is a union of null and text. Bodies that do not fit give null.
    """
    optional = [f.nullable for f in schema.fields]
    names = schema.fieldNames()
    loose = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "_ok"]])

    @F.pandas_udf(loose)
    def decode(bodies: pd.Series) -> pd.DataFrame:
        rows = []
        for data in bodies:
            try:
                rows.append([*_record(data, optional), "y"])
            except (IndexError, TypeError, ValueError):
                rows.append([None] * (len(names) + 1))
        return pd.DataFrame(rows, columns=[*names, "_ok"])

    read = framed.withColumn("_read", decode(body))
    fields = F.struct(*[F.col(f"_read.{n}").alias(n) for n in names])
    return read.withColumn(into, F.when(F.col("_read._ok").isNotNull(), fields)).drop("_read")
