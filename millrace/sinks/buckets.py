"""Upserted tables in buckets of keys: a batch reads and rewrites the buckets it touches.

Data lies in ``version=n/bucket=b``: what batch ``n`` made of bucket ``b``. A manifest, one row per bucket,
says which version of each bucket is the newest. It is written last, as a version of its own, so
readers see all of a batch or nothing, and a repeated batch starts from the manifest before it.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.blocks import all_of
from millrace.operators.dedup import first_per_key
from millrace.operators.tables import upsert
from millrace.session import on_disk
from millrace.sinks.tables import drop_versions, read_table, _versions, write_version
from millrace.sources.decode import decode_json, quarantine

# Fixed values of a table's folder.
MANIFEST, BUCKET = "manifest", "bucket"
ENTRY = "bucket int, version long, buckets int, schema string"


def bucket_of(keys, buckets):
    """The bucket of a key."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _manifest(spark, path, before=None):
    """The newest manifest: version by bucket, and the table's schema. As many rows as buckets."""
    table = read_table(spark, f"{path}/{MANIFEST}", before)
    entries = [] if table is None else table.collect()
    if not entries:
        return {}, None, None
    found = {e.bucket: e.version for e in entries if e.version is not None}
    return found, entries[0].buckets, T.StructType.fromJson(json.loads(entries[0].schema))


def _read(spark, path, versions, schema):
    """The rows of some buckets. Files from before a column was added have nulls in it."""
    if not versions:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/version={v}/{BUCKET}={b}" for b, v in sorted(versions.items())]
    return spark.read.schema(schema).parquet(*folders)


def read_buckets(spark: SparkSession, path: str, before=None) -> DataFrame | None:
    """The table as the last finished batch left it, or the last before a batch."""
    versions, _, schema = _manifest(spark, path, before)
    return None if schema is None else _read(spark, path, versions, schema)


def write_buckets(batch: DataFrame, path: str, version: int, keys, order_by, buckets=256, **options):
    """Upsert a batch into the table; see ``upsert`` for ``options``.

    Cost follows the buckets that have a key in the batch, not the table. The number of buckets is
    settled by the first batch. To the driver come bucket numbers only.
    """
    spark = batch.sparkSession
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    versions, settled, schema = _manifest(spark, path, before=version)
    if settled not in (None, buckets):
        raise ValueError(f"the table has {settled} buckets")
    number = bucket_of(keys, buckets)
    touched = [row[0] for row in batch.select(number).distinct().collect()]
    if schema is None:
        schema = batch.drop(*order).schema
    held = {b: versions[b] for b in touched if b in versions}
    table = upsert(_read(spark, path, held, schema), batch, keys, order, **options)
    placed = table.withColumn(BUCKET, number)
    # One file a bucket, or several of the usual size.
    placed.hint("rebalance", BUCKET).write.partitionBy(BUCKET).mode("overwrite").parquet(
        f"{path}/version={version}"
    )
    written = _written(spark, f"{path}/version={version}")
    now = {b: v for b, v in versions.items() if b not in set(touched)} | {b: version for b in written}
    # A bucket without rows has no version; one row at least carries the schema.
    entries = [(b, now.get(b), buckets, table.schema.json()) for b in {0, *now}]
    write_version(spark.createDataFrame(entries, ENTRY), f"{path}/{MANIFEST}", version)


def _written(spark, folder):
    files, root = on_disk(spark, folder)
    names = [entry.getPath().getName() for entry in files.listStatus(root)]
    return [int(name.split("=")[1]) for name in names if name.startswith(f"{BUCKET}=")]


def drop_unused(spark: SparkSession, path: str, version: int, keep=3):
    """Delete buckets that none of the newest ``keep`` manifests up to ``version`` names.

    To be called when no reader is at an older one.
    """
    used = set()
    for at in [v for v in _versions(spark, f"{path}/{MANIFEST}") if v <= version][-keep:]:
        versions, _, _ = _manifest(spark, path, before=at + 1)
        used |= {(v, b) for b, v in versions.items()}
    files, root = on_disk(spark, path)
    jvm = spark.sparkContext._jvm
    for entry in files.listStatus(root):
        name = entry.getPath().getName()
        number = int(name.split("=")[1]) if name.startswith("version=") else None
        if number is None or number > version:
            continue
        for bucket in _written(spark, f"{path}/{name}"):
            if (number, bucket) not in used:
                files.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/{name}/{BUCKET}={bucket}"), True)
    drop_versions(spark, f"{path}/{MANIFEST}", version, keep)


def bucket_writer(path: str, keys, order_by, buckets=256, **options):
    """A ``foreachBatch`` callback that upserts each micro-batch into a table in buckets."""

    def write(batch: DataFrame, batch_id: int):
        write_buckets(batch, path, batch_id, keys, order_by, buckets, **options)
        drop_unused(batch.sparkSession, path, batch_id)

    return write


def insert_writer(path: str, keys, order_by, buckets=256, transform=None, after_write=None):
    """A ``foreachBatch`` callback that writes the first row of each key, once and for good.

    A batch is held against the keys in the buckets it touches, and only new ones are written: a table
    that ``read_inserted`` takes as it is, one row per key, without any aggregation. A repeated
    batch does not see what its first attempt wrote, and replaces it. Rows with a null key all pass.
    ``transform`` and ``after_write`` are as in ``exactly_once_writer``.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)

    def write(batch: DataFrame, batch_id: int):
        spark = batch.sparkSession
        rows = (batch if transform is None else transform(batch)).withColumn(BUCKET, bucket_of(keys, buckets))
        known = all_of([F.col(k).isNotNull() for k in keys])
        marked = rows.withColumn("_alone", F.when(~known, F.monotonically_increasing_id()))
        order = [order_by] if isinstance(order_by, str) else list(order_by)
        once = first_per_key(marked, [*keys, BUCKET, "_alone"], order).select(*rows.columns)
        touched = {row[0] for row in rows.where(known).select(BUCKET).distinct().collect()}
        folders = [
            f"{path}/version={v}/{BUCKET}={b}" for v in _versions(spark, path) if v < batch_id
            for b in _written(spark, f"{path}/version={v}") if b in touched
        ]
        if folders:
            held = spark.read.schema(rows.select(*keys).schema).parquet(*folders)
            once = once.join(held, keys, "left_anti").select(*rows.columns)
        once.hint("rebalance", BUCKET).write.partitionBy(BUCKET).mode("overwrite").parquet(
            f"{path}/version={batch_id}"
        )
        if after_write is not None:
            after_write(batch_id)

    return write


def read_inserted(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of all finished batches of ``insert_writer``; nothing where none has written a row."""
    folders = [
        f"{path}/version={v}/{BUCKET}={b}" for v in _versions(spark, path)
        for b in _written(spark, f"{path}/version={v}")
    ]
    return spark.read.parquet(*folders) if folders else None


def document_writer(path: str, schema: T.StructType, *, order_by="offset", buckets=256, required=()):
    """A ``foreachBatch`` callback that keeps the last document of each key, and quarantines the others.

    Takes records of a topic. A value that is not JSON, does not fit ``schema`` or lacks a ``required``
    field, and a record without a key, go to ``path/dead`` with the reason; the stream goes on. A
    record without a value deletes. A document replaces the one before as a whole, under ``id``, the
    record's key, with ``ingested_at``, the record's time. Documents are in ``path/table``.
    """
    fields = [f.name for f in schema.fields]

    def write(batch: DataFrame, batch_id: int):
        decoded = decode_json(batch, schema, required=required)
        keyless = F.when(F.col("key").isNull(), F.lit("key is missing"))
        good, dead = quarantine(decoded.withColumn("error", F.coalesce("error", keyless)))
        dead.write.mode("overwrite").parquet(f"{path}/dead/batch_id={batch_id}")
        # A document, even one without fields, has a time; a deletion has none.
        documents = good.select(
            F.col("key").cast("string").alias("id"), order_by, *[f"event.{f}" for f in fields],
            F.when(F.col("event").isNotNull(), F.col("timestamp")).alias("ingested_at"),
        )
        write_buckets(
            documents, f"{path}/table", batch_id, "id", order_by, buckets,
            on_null="delete", missing="overwrite",
        )
        drop_unused(batch.sparkSession, f"{path}/table", batch_id)

    return write
