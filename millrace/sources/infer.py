"""Schemaless JSON to flat columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INT32 = (-(1 << 31), (1 << 31) - 1)


# Fields that get a column of their own, at most.
MOST_FIELDS = 1000


def infer_fields(df: DataFrame, json_col, exclude=("items",), most=MOST_FIELDS) -> T.StructType:
    """The flat schema of a JSON column, over all its rows.

    Booleans, whole numbers (32 bits if all fit, else 64), other numbers (double), and text
    for everything else, including nested values. Null fields say nothing. Where rows
    disagree the wider type wins, text being the widest. Of more than ``most`` fields the most frequent
    ones are taken, names deciding between equals.

    One aggregated pass; what reaches the driver is a row for each field taken.
    """
    entries = _entries(df, json_col, exclude).select("name", "v", F.schema_of_variant("v").alias("told"))
    told = F.col("told")
    kind = (
        F.when(told.isin("BOOLEAN", "BIGINT", "VOID"), told)
        .when(told.startswith("DECIMAL") | told.isin("DOUBLE", "FLOAT"), F.lit("REAL"))
        .otherwise(F.lit("TEXT"))
    )
    number = F.when(told == "BIGINT", F.try_variant_get("v", "$", "bigint"))
    kinds = (
        entries.select("name", kind.alias("kind"), number.alias("n"))
        .groupBy("name", "kind")
        .agg(F.min("n").alias("low"), F.max("n").alias("high"), F.count(F.lit(1)).alias("rows"))
        .where(F.col("kind") != "VOID")
    )
    names = kinds.groupBy("name").agg(
        F.sum("rows").alias("rows"), F.collect_list(F.struct("kind", "low", "high")).alias("kinds")
    )
    taken = names.orderBy(F.col("rows").desc(), "name").limit(most).collect()
    return T.StructType([
        T.StructField(row["name"], _widest({k["kind"]: k for k in row["kinds"]}))
        for row in sorted(taken, key=lambda row: row["name"])
    ])


def _entries(df, json_col, exclude):
    """A row per field of each object: its name and its value."""
    fields = F.from_json(F.col(json_col).cast("string"), "map<string,variant>")
    entries = df.select(F.explode(fields).alias("name", "v"))
    return entries.where(~F.col("name").isin(*exclude)) if exclude else entries


def _widest(kinds):
    """The type that holds every kind of value seen in a field."""
    if set(kinds) == {"BOOLEAN"}:
        return T.BooleanType()
    if set(kinds) == {"BIGINT"}:
        whole = kinds["BIGINT"]
        fits = _INT32[0] <= whole["low"] and whole["high"] <= _INT32[1]
        return T.IntegerType() if fits else T.LongType()
    if set(kinds) <= {"BIGINT", "REAL"}:
        return T.DoubleType()
    return T.StringType()


def infer_flatten(
    df: DataFrame, json_col, exclude=("items",), types=None, most=MOST_FIELDS, rest=None,
) -> DataFrame:
    """Replace a JSON column by one column per top-level field.

    ``types`` gives the type of fields the caller knows better, such as money as a decimal.
    Rows whose value is not an object, or does not parse, pass through and keep their text
    in ``json_col``. ``most`` fields get a column (see ``infer_fields``); the column ``rest``, where it is named,
    holds the others of each row as a map of variants, so that no field is lost.
    """
    schema = infer_fields(df, json_col, exclude, most)
    for name, kind in (types or {}).items():
        schema = T.StructType(
            [T.StructField(f.name, kind if f.name == name else f.dataType) for f in schema.fields]
        )
    text = F.col(json_col).cast("string")
    is_object = F.coalesce(text.rlike(r"^\s*\{"), F.lit(False))
    wide = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    options = {"columnNameOfCorruptRecord": "_corrupt"}
    parsed = df.withColumn("_row", F.when(is_object, F.from_json(text, wide, options)))
    others = [c for c in df.columns if c != json_col]
    left = []
    if rest is not None:
        listed = [*schema.names, *exclude]
        unlisted = F.map_filter(F.from_json(text, "map<string,variant>"), lambda name, v: ~name.isin(*listed))
        left = [F.when(is_object & F.col("_row._corrupt").isNull(), unlisted).alias(rest)]
    return parsed.select(
        *others,
        F.when(is_object, F.col("_row._corrupt")).otherwise(text).alias(json_col),
        *[F.col("_row").getField(f.name).alias(f.name) for f in schema.fields],
        *left,
    )
