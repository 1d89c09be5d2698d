"""Decoding record values: typed JSON, framed bodies, schema versions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.scalar import has_text

_CORRUPT = "_corrupt"


def _text(value):
    return F.col(value).cast("string")


def decode_json(log: DataFrame, schema: T.StructType, *, value="value", into="event",
                required=(), allowed=None) -> DataFrame:
    """Decode JSON values into the struct column ``into``.

    Unknown fields are ignored; null and empty values decode to null. A value that is not
    JSON, has a field of the wrong type, lacks a field in ``required`` or has one outside
    its ``allowed`` values leaves ``into`` null and says why in ``error``.
    """
    # In bytes: counting characters walks the whole text, each time it is asked whether there is one.
    text = F.when(F.octet_length(_text(value)) > 0, _text(value))
    wide = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    # A generator's row is made once: a filter on a projected value goes below the projection and parses
    # the text again for each field it looks at.
    parsed = log.select("*", F.explode(F.array(F.from_json(text, wide, options))).alias("_parsed"))
    problem = F.when(F.col(f"_parsed.{_CORRUPT}").isNotNull(), F.lit("malformed"))
    for name in required:
        problem = problem.when(
            text.isNotNull() & F.col(f"_parsed.{name}").isNull(), F.lit(f"{name} is missing")
        )
    for name, values in (allowed or {}).items():
        problem = problem.when(
            ~F.col(f"_parsed.{name}").isin(*values), F.lit(f"{name} is unknown")
        )
    fields = F.struct(*[F.col(f"_parsed.{f.name}").alias(f.name) for f in schema.fields])
    good = text.isNotNull() & F.col("error").isNull()
    return (
        parsed.withColumn("error", problem)
        .withColumn(into, F.when(good, fields))
        .drop("_parsed")
    )


def quarantine(decoded: DataFrame, *, error="error", attempts="attempts"):
    """Decoded records, and the undecodable ones for the dead-letter topic.

    A dead letter keeps the original record, the reason and the number of attempts.
    """
    good = decoded.where(F.col(error).isNull()).drop(error)
    bad = decoded.where(F.col(error).isNotNull())
    tried = F.col(attempts) + 1 if attempts in decoded.columns else F.lit(1)
    original = [c for c in ("key", "value", "topic", "partition", "offset", "headers")
                if c in decoded.columns]
    return good, bad.select(*original, F.col(error).alias("error"), tried.alias(attempts))


def parse_or_raw(log: DataFrame, value="value") -> DataFrame:
    """Values that are JSON objects as a map in ``value_json``, others as text in
    ``value_raw``; blank values give neither."""
    text = F.when(has_text(_text(value)), _text(value))
    parsed = F.from_json(text, "map<string,string>")
    # A malformed text may still yield the entries read before the error.
    whole = F.try_parse_json(text).isNotNull() & text.rlike(r"^\s*\{")
    return log.withColumn("value_json", F.when(whole, parsed)).withColumn(
        "value_raw", F.when(~F.coalesce(whole, F.lit(False)), text)
    )


# Frame layout, one zero byte and a 4-byte big-endian schema id.
FRAME_MAGIC = 0
FRAME_HEADER = 5


def _number(data, start, size):
    return F.conv(F.hex(F.substring(data, start, size)), 16, 10).cast("long")


def split_wire_frame(log: DataFrame, value="value") -> DataFrame:
    """Add ``magic``, ``schema_id`` and ``body``; the last two are null without a frame."""
    data = F.col(value)
    framed = (F.octet_length(data) >= FRAME_HEADER) & (F.col("magic") == FRAME_MAGIC)
    rest = F.expr(f"substring(`{value}`, {FRAME_HEADER + 1})")
    return (
        log.withColumn("magic", F.when(F.octet_length(data) > 0, _number(data, 1, 1)).cast("int"))
        .withColumn("schema_id", F.when(framed, _number(data, 2, 4)))
        .withColumn("body", F.when(framed, rest))
    )


def wire_frame(schema_id, body):
    """A body behind its frame."""
    head = F.lpad(F.hex(F.col(schema_id).cast("long")), 8, "0")
    return F.concat(F.unhex(F.concat(F.lit("00"), head)), F.encode(F.col(body), "UTF-8"))


def decode_avro(framed: DataFrame, schema_json: str, into="event") -> DataFrame:
    """Decode frame bodies. Needs Spark's avro package on the class path."""
    from pyspark.sql.avro.functions import from_avro

    return framed.withColumn(into, from_avro(F.col("body"), schema_json, {"mode": "PERMISSIVE"}))


def conform(df: DataFrame, target: T.StructType, defaults=None) -> DataFrame:
    """Read rows of one schema version with another.

    Extra columns are dropped and optional ones that are missing get their default (null
    unless given). A required column that is missing and has no default is an error, as a
    reader of that schema could not read the data.
    """
    defaults = defaults or {}
    missing = [
        f.name for f in target.fields
        if f.name not in df.columns and not f.nullable and f.name not in defaults
    ]
    if missing:
        raise ValueError(f"required columns are missing: {', '.join(missing)}")
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(defaults.get(f.name)))
            .cast(f.dataType)
            .alias(f.name)
            for f in target.fields
        ]
    )


def conform_all(versions, target: T.StructType, defaults=None) -> DataFrame:
    """Rows of several schema versions under one schema."""
    first, *others = [conform(df, target, defaults) for df in versions]
    for df in others:
        first = first.unionByName(df)
    return first
