"""Pipeline counters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def counters(df: DataFrame, *by) -> DataFrame:
    """Rows per value of ``by``; a null value counts as ``unknown``."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit("unknown")).alias(c) for c in by]
    return df.groupBy(*named).agg(F.count(F.lit(1)).alias("n"))


def observe_counts(df: DataFrame, name, **conditions) -> DataFrame:
    """Count rows, and rows meeting each condition, while another action runs.

    The totals arrive in ``StreamingQueryProgress.observedMetrics`` or in an
    ``Observation``; the data is not read a second time.
    """
    measures = [F.count(F.lit(1)).alias("rows")]
    measures += [F.count_if(test).alias(label) for label, test in conditions.items()]
    return df.observe(name, *measures)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)
