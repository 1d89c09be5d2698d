"""Shared helpers of the text operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import on_disk, scratch_dir

# Text worked on at once inside a task, in bytes; what numpy needs is a small multiple.
BLOCK_BYTES = 2 << 20

def read(spark, sf_dir, table) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def texts(docs: DataFrame, *more) -> DataFrame:
    """``doc_id`` and ``text`` alone (a null text is empty), whatever else the rows hold."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        *more,
    )


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """Write a table in the folder the cluster shares and read it again.

    Cuts the lineage, so a lost executor costs a read. The folder goes with ``done_with``, or
    when the driver's process ends.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    # What is written needs no shuffle files any more: of this write, whatever the session does.
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def done_with(*tables):
    """Delete stored tables that nothing will read again."""
    for table in tables:
        files, root = on_disk(table.sparkSession, table.stored_at)
        files.delete(root, True)
        files.cancelDeleteOnExit(root)


def blocks(rows, size, limit=BLOCK_BYTES):
    """Lists of consecutive rows of about ``limit`` together; ``size`` measures one."""
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += size(row)
        if total >= limit:
            yield held
            held, total = [], 0
    if held:
        yield held


def keep_once(docs: DataFrame, judged: DataFrame, digest) -> DataFrame:
    """The documents judged ``kept``, with all their columns.

    ``judged`` names a document by ``doc_id`` and ``digest``, as the column ``digest`` of
    ``docs`` does. A document stored twice with both the same is kept once.
    """
    units = judged.groupBy("doc_id", "digest").agg(
        F.max("kept").alias("kept"), F.count("*").alias("_copies")
    )
    chosen = stored(units.where("kept").select(
        F.col("doc_id").alias("_id"), F.col("digest").alias("_of"), "_copies"
    ), "kept-documents")
    # The row goes along as one column, so that no name of its own is in the way.
    marked = docs.select(
        F.struct(*docs.columns).alias("_row"), F.col("doc_id").alias("_doc"), digest.alias("_digest")
    )
    same = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_digest") == F.col("_of"))
    kept = marked.join(chosen, same)
    if chosen.where("_copies > 1").isEmpty():
        return kept.select("_row.*")
    repeated = kept.where("_copies > 1").groupBy("_of", "_id").agg(F.first("_row").alias("_row"))
    return kept.where("_copies = 1").select("_row.*").unionByName(repeated.select("_row.*"))
