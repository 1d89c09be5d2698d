"""Sinks for ``foreachBatch`` that give the same result when a batch is run again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.dedup import first_per_key
from millrace.operators.tables import latest_per_key, upsert
from millrace.session import on_disk


def exactly_once_writer(path: str, transform=None, after_write=None):
    """Write each micro-batch to its own folder, replacing what an earlier attempt left.

    The checkpoint names the batch, so input progress and output move together: a run that
    dies after the write repeats the same batch into the same folder. ``transform`` makes
    the output rows. ``after_write`` is called with the batch id before the batch counts as
    done (tests fail there).
    """

    def write(batch: DataFrame, batch_id: int):
        rows = batch if transform is None else transform(batch)
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        if after_write is not None:
            after_write(batch_id)

    return write


def read_batches(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """All rows written so far, with the ``batch_id`` they came in."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())]))
    return reader.option("basePath", path).parquet(path)


def read_committed(spark: SparkSession, path: str, keys) -> DataFrame:
    """One row per key, from the first batch that wrote it.

    Guards against input that was itself delivered twice, in different batches.
    """
    rows = read_batches(spark, path)
    order = ["batch_id", *[c for c in rows.columns if c not in (*keys, "batch_id")]]
    return first_per_key(rows, list(keys), order).drop("batch_id")


def _versions(spark: SparkSession, path: str):
    """Numbers of the finished versions of a table, from its folder."""
    jvm = spark.sparkContext._jvm
    files, root = on_disk(spark, path)
    if not files.exists(root):
        return []
    found = []
    for entry in files.listStatus(root):
        name = entry.getPath().getName()
        done = jvm.org.apache.hadoop.fs.Path(entry.getPath(), "_SUCCESS")
        if name.startswith("version=") and files.exists(done):
            found.append(int(name.split("=", 1)[1]))
    return sorted(found)


def write_version(df: DataFrame, path: str, version: int):
    """Write a version of a table. Older ones stay for who still reads them: see ``drop_versions``."""
    df.write.mode("overwrite").parquet(f"{path}/version={version}")


def drop_versions(spark: SparkSession, path: str, version: int, keep=3):
    """Delete all but the newest ``keep`` versions up to ``version``.

    To be called when no reader is at an older one. A restart goes back one batch at most, so it
    always finds the version it starts from.
    """
    files, root = on_disk(spark, path)
    for old in [v for v in _versions(spark, path) if v <= version][:-keep]:
        files.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root, f"version={old}"), True)


def read_table(spark: SparkSession, path: str, before=None) -> DataFrame | None:
    """The latest finished version of a table, or the latest before a batch."""
    ready = [v for v in _versions(spark, path) if before is None or v < before]
    return spark.read.parquet(f"{path}/version={ready[-1]}") if ready else None


def upsert_writer(path: str, keys, order_by, **options):
    """Apply each micro-batch to a table kept as files.

    Batch ``n`` reads the newest version before ``n`` and writes version ``n``, so a
    repeated batch starts from the same table and readers always see a finished one. Every
    version is a whole table: for large tables with small batches use ``merge_writer`` on
    a table format with row-level changes.
    """

    def write(batch: DataFrame, batch_id: int):
        spark = batch.sparkSession
        table = read_table(spark, path, before=batch_id)
        order = [order_by] if isinstance(order_by, str) else list(order_by)
        if table is None:
            table = batch.drop(*order).where(F.lit(False))
        write_version(upsert(table, batch, keys, order, **options), path, batch_id)

    return write


def merge_writer(table: str, keys, order_by, document=False):
    """Apply each micro-batch to a catalog table that supports row-level changes.

    As ``upsert``: fields a record leaves out keep their value and null records are
    ignored, or, with ``document``, records replace the whole and null records delete.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order_by] if isinstance(order_by, str) else list(order_by)

    def write(batch: DataFrame, batch_id: int):
        fields = [c for c in batch.columns if c not in keys and c not in order]
        if document:
            empty = F.coalesce(*[F.col(c).cast("string") for c in fields]).isNull()
            last = latest_per_key(batch.withColumn("gone", empty), keys, order).drop(*order)
        else:
            nothing = batch.drop(*order).where(F.lit(False))
            last = upsert(nothing, batch, keys, order).withColumn("gone", F.lit(False))
        same = F.expr(" AND ".join(f"updates.{k} = {table}.{k}" for k in keys))
        new = {c: F.col(f"updates.{c}") for c in [*keys, *fields]}
        changed = {
            c: new[c] if document else F.coalesce(new[c], F.col(f"{table}.{c}")) for c in fields
        }
        gone = F.col("updates.gone")
        merge = last.alias("updates").mergeInto(table, same).withSchemaEvolution()
        merge = merge.whenMatched(gone).delete().whenMatched().update(changed)
        merge.whenNotMatched(~gone).insert(new).merge()

    return write


def fan_out(writers):
    """One ``foreachBatch`` callback that gives every writer the whole batch.

    The batch is kept for the length of the call, so the source is read once.
    """

    def write(batch: DataFrame, batch_id: int):
        batch.persist()
        try:
            for writer in writers:
                writer(batch, batch_id)
        finally:
            batch.unpersist()

    return write


def start_groups(stream: DataFrame, writers: dict, checkpoint_root: str, trigger=None):
    """One query per consumer group, each with its own progress over the whole log."""
    return {
        group: stream.writeStream.queryName(group)
        .foreachBatch(writer)
        .option("checkpointLocation", f"{checkpoint_root}/{group}")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
        for group, writer in writers.items()
    }

