"""The ledger as ranges: against a set of coordinates."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import ledger
from millrace.streaming.tables import reserve_writer
from millrace.sinks import tables as sinks

LOG = "partition int, offset long, v string"


def runs(done):
    """Maximal runs of a set of (partition, offset)."""
    out = []
    for p, o in sorted(done):
        if out and out[-1][0] == p and out[-1][2] == o - 1:
            out[-1][2] = o
        else:
            out.append([p, o, o])
    return [tuple(r) for r in out]


@pytest.mark.parametrize("rows", [7, 1 << 22])
def test_ranges_are_the_fewest_and_lookups_exact(spark, rows):
    rng = random.Random(rows)
    done = {(p, o) for p in range(3) for o in range(100) if rng.random() < (0.9, 0.5, 1.0)[p]}
    records = spark.createDataFrame([(p, o, "x") for p, o in done] * 2 + [(None, 5, "x"), (1, None, "x")], LOG)
    ranges = ledger.ranges_of(records, rows=rows)
    assert sorted(map(tuple, ranges.collect())) == runs(done)
    more = {(p, o) for p in range(4) for o in range(90, 130)}
    both = ledger.with_processed(ranges, spark.createDataFrame([(p, o, "") for p, o in more], LOG), rows=rows)
    assert sorted(map(tuple, both.collect())) == runs(done | more)
    asked = [(p, o, "y") for p in range(5) for o in range(-2, 140)]
    log = spark.createDataFrame(asked + [(None, 1, "y"), (2, None, "y")], LOG)
    want = sorted(str((p, o)) for p, o, _ in asked if (p, o) not in done) + ["(2, None)", "(None, 1)"]
    for few in (0, 10_000):
        got = ledger.skip_ranges(log, ranges, few=few, rows=rows).select("partition", "offset").collect()
        assert sorted(str(tuple(r)) for r in got) == sorted(want)


def test_one_partition_is_looked_up_by_many_tasks(spark):
    """Lines of one log partition do not meet in one task, nor is each held against all of its ranges."""
    lines = spark.range(600_000).select(
        F.lit(0).alias("partition"), F.expr("id div 3").alias("offset"), F.col("id").alias("v")
    )
    done = ledger.ranges_of(lines.where("offset % 10 < 9 AND offset < 100000"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        new = ledger.skip_ranges(lines, done)
        held = new.groupBy(F.spark_partition_id()).count().agg(F.sum("count"), F.max("count")).first()
        assert held[0] == 330_000 and held[1] < 250_000
        assert "NestedLoop" not in new._jdf.queryExecution().toString() and "BroadcastHash" not in (
            new._jdf.queryExecution().toString()
        )
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_contiguous_history_is_one_row(spark):
    log = spark.range(50_000).selectExpr("CAST(0 AS INT) AS partition", "id AS offset", "'x' AS v")
    ranges = ledger.ranges_of(log, rows=1000)
    assert [tuple(r) for r in ranges.collect()] == [(0, 0, 49_999)]
    assert ledger.skip_ranges(log, ranges).count() == 0
    assert ledger.ranges_of(log.where("false")).count() == 0


def test_copies_of_a_record_collapse(spark):
    rows = [(0, 1, "a"), (0, 1, "a"), (0, 2, "b"), (0, 3, "c")]
    log = spark.createDataFrame(rows, LOG)
    done = ledger.ranges_of(log.where("offset = 2"))
    assert sorted(r.offset for r in ledger.once_by_ranges(log, done).collect()) == [1, 3]


def test_redelivered_records_take_no_stock_in_the_stream(spark, tmp_path):
    folder = str(tmp_path / "r")
    schema = "partition int, offset long, line int, sku string, quantity int"
    stock = spark.createDataFrame([("a", 10)], "sku string, quantity int")
    write = reserve_writer(folder, stock, coordinate=("partition", "offset"))
    first = [(4, 99, 0, "a", 2), (4, 99, 1, "a", 1), (4, 99, 0, "a", 2), (4, 100, 0, "a", 50)]
    batches = [first, first + [(4, 101, 0, "a", 3)], [(4, 101, 0, "a", 3), (4, 100, 0, "a", 50)]]
    for number, rows in enumerate(batches):
        for _ in range(2):  # each batch is repeated, as after a failure
            write(spark.createDataFrame(rows, schema), number)
    events = sinks.read_batches(spark, f"{folder}/events").select("offset", "line", "status").collect()
    assert sorted(map(tuple, events)) == [
        (99, 0, "RESERVED"), (99, 1, "RESERVED"), (100, 0, "REJECTED"), (101, 0, "RESERVED"),
    ]
    assert sinks.read_table(spark, f"{folder}/stock").first().quantity == 4
    assert [tuple(r) for r in sinks.read_table(spark, f"{folder}/ledger").collect()] == [(4, 99, 101)]
