"""Tables in buckets: what a batch rewrites, what a repeated batch leaves, and documents put aside."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.tables import upsert
from millrace.plans import inputs, queries
from millrace.sinks import buckets as sink

UPDATES = "id long, at long, a string, b string"


def batch(spark, rows, schema=UPDATES):
    return spark.createDataFrame(rows, schema)


def table(spark, path):
    return {r.id: (r.a, r.b) for r in sink.read_buckets(spark, path).collect()}


def written(path, version):
    return {n for n in os.listdir(f"{path}/version={version}") if n.startswith("bucket=")}


def test_a_batch_rewrites_the_buckets_it_touches(spark, tmp_path):
    path = str(tmp_path / "t")
    first = batch(spark, [(i, 0, f"a{i}", None) for i in range(200)])
    sink.write_buckets(first, path, 0, "id", "at", buckets=16)
    assert len(written(path, 0)) == 16
    second = batch(spark, [(7, 1, None, "b"), (300, 2, "x", "y")])
    sink.write_buckets(second, path, 1, "id", "at", buckets=16)
    touched = {r[0] for r in second.select(sink.bucket_of(["id"], 16)).collect()}
    assert written(path, 1) == {f"bucket={b}" for b in touched} and len(touched) <= 2
    want = upsert(first.drop("at"), second, "id", "at")
    assert table(spark, path) == {r.id: (r.a, r.b) for r in want.collect()}
    files = spark.read.parquet(f"{path}/version=1")
    held = first.withColumn("n", sink.bucket_of(["id"], 16)).where(F.col("n").isin(list(touched)))
    assert files.count() == held.count() + 1


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    options = {"on_null": "delete", "missing": "overwrite", "buckets": 4}
    sink.write_buckets(batch(spark, [(1, 0, "a", "b"), (2, 0, "x", None)]), path, 0, "id", "at", **options)
    gone = batch(spark, [(1, 1, None, None), (3, 1, "c", None)])
    for _ in range(2):
        sink.write_buckets(gone, path, 1, "id", "at", **options)
        assert table(spark, path) == {2: ("x", None), 3: ("c", None)}
    # Nothing is left; then a key comes back, with a column the table did not have.
    empty = batch(spark, [(2, 2, None, None), (3, 2, None, None)])
    sink.write_buckets(empty, path, 2, "id", "at", **options)
    assert table(spark, path) == {}
    wider = batch(spark, [(2, 3, "n", None, 5)], UPDATES + ", c int")
    sink.write_buckets(wider, path, 3, "id", "at", **options)
    assert [tuple(r) for r in sink.read_buckets(spark, path).collect()] == [(2, "n", None, 5)]
    # Readers at the batch before still find it, and no bucket that is used is dropped.
    assert sink.read_buckets(spark, path, before=2).count() == 2
    sink.drop_unused(spark, path, 3, keep=1)
    assert sink.read_buckets(spark, path).count() == 1 and not os.path.exists(f"{path}/manifest/version=0")
    with pytest.raises(ValueError):
        sink.write_buckets(wider, path, 4, "id", "at", buckets=8)


def test_untouched_buckets_read_a_new_column_as_null(spark, tmp_path):
    path = str(tmp_path / "t")
    sink.write_buckets(batch(spark, [(i, 0, "a", "b") for i in range(50)]), path, 0, "id", "at", buckets=8)
    sink.write_buckets(batch(spark, [(1, 1, None, None, 9)], UPDATES + ", c int"), path, 1, "id", "at", buckets=8)
    got = {r.id: (r.a, r.c) for r in sink.read_buckets(spark, path).collect()}
    assert got == {i: ("a", 9 if i == 1 else None) for i in range(50)}


def test_documents_are_kept_and_the_others_put_aside(spark, tmp_path):
    path = str(tmp_path / "d")
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("n", T.IntegerType())])
    write = sink.document_writer(path, schema, required=("name",), buckets=4)
    log = "key string, value string, offset long, timestamp timestamp_ntz"

    def records(*rows):
        return batch(spark, [(k, v, o, None) for k, v, o in rows], log).withColumn(
            "timestamp", F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
        )

    write(records(("a", '{"name":"x","n":1}', 0), ("b", '{"name":"y"}', 1), ("a", "{oops", 2), ("c", '{"n":1}', 3)), 0)
    write(records(("a", '{"name":"z"}', 4), ("b", None, 5), (None, '{"name":"q"}', 6), ("d", "", 7)), 1)
    kept = sink.read_buckets(spark, f"{path}/table").select("id", "name", "n").collect()
    assert [tuple(r) for r in kept] == [("a", "z", None)]
    dead = spark.read.parquet(f"{path}/dead").select("offset", "error").collect()
    assert sorted(map(tuple, dead)) == [(2, "malformed"), (3, "name is missing"), (6, "key is missing")]


def test_inserted_rows_are_one_per_key_as_they_lie(spark, tmp_path):
    path = str(tmp_path / "i")
    fail = [True]

    def fault(batch_id):
        if batch_id == 1 and fail:
            fail.clear()
            raise RuntimeError("before the commit")

    write = sink.insert_writer(path, "id", "at", buckets=4, after_write=fault)
    write(batch(spark, [(1, 0, "a", None), (1, 1, "b", None), (None, 0, "n", None), (None, 0, "n", None)]), 0)
    again = batch(spark, [(1, 0, "z", None), (2, 0, "c", None), (None, 2, "m", None)])
    with pytest.raises(RuntimeError):
        write(again, 1)
    write(again, 1)
    got = sorted((str(r.id), r.a) for r in sink.read_inserted(spark, path).collect())
    assert got == [("1", "a"), ("2", "c"), ("None", "m"), ("None", "n"), ("None", "n")]
    assert not any(r.a == "z" for r in spark.read.parquet(f"{path}/version=1").collect())


class Stopped(Exception):
    """Raised where a query would go on."""


@pytest.mark.parametrize("name, key", [
    ("stream_upsert_buckets", "user_id"),
    ("stream_payments_inserted", "concat('pay-', order_id)"),
    ("stream_documents", "CAST(key AS STRING)"),
])
def test_files_of_a_part_have_no_bucket_in_common(spark, sf_dir, monkeypatch, name, key):
    """A batch has one file; what all batches rewrite or read does not grow with the number of files."""
    arrivals, key = inputs.arrivals, F.expr(key)

    def spy(spark, folder, parts, by):
        path = arrivals(spark, folder, parts[:1], by)
        files = spark.read.parquet(path).where(key.isNotNull()).select(
            F.input_file_name().alias("file"), sink.bucket_of([key], 32).alias("bucket")
        ).distinct()
        assert files.select("file").distinct().count() > 1
        assert files.count() == files.select("bucket").distinct().count()
        raise Stopped

    monkeypatch.setattr(inputs, "arrivals", spy)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        with pytest.raises(Stopped):
            queries.QUERIES[name](spark, sf_dir)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
