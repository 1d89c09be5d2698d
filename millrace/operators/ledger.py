"""A ledger of processed log records, kept as ranges of offsets.

History without gaps is one row per log partition, whatever its length; each offset done out of turn
is a row of its own until the gap before it closes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.blocks import BLOCK, BLOCK_ROWS, block_of
from millrace.operators.dedup import first_per_key
from millrace.operators.enrich import fits

# Ranges that are sent to all tasks, at most: each record is held against those of its partition.
FEW = 256
# Offsets of a block of records that are looked up: whole rows, and a record may have many lines.
ROWS = 1 << 16


def _islands(ranges, keys):
    """Join ranges that touch or overlap, per ``keys``, into one."""
    order = Window.partitionBy(*keys).orderBy("first", "last")
    reached = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("first") > reached + 1, 1).otherwise(0)
    island = F.sum("_opens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = ranges.withColumn("_opens", opens).withColumn("_island", island)
    return numbered.groupBy(*keys, "_island").agg(
        F.min("first").alias("first"), F.max("last").alias("last")
    ).drop("_island")


def _in_blocks(ranges, partition, rows):
    """Ranges cut at the edges of blocks of ``rows`` offsets."""
    blocks = F.sequence(block_of("first", rows), block_of("last", rows))
    return ranges.select(partition, "first", "last", F.explode(blocks).alias(BLOCK)).select(
        partition, BLOCK,
        F.greatest("first", F.col(BLOCK) * rows).alias("first"),
        F.least("last", (F.col(BLOCK) + 1) * rows - 1).alias("last"),
    )


def merge_ranges(ranges: DataFrame, partition="partition", rows=BLOCK_ROWS) -> DataFrame:
    """The same offsets in the fewest ranges: ``partition, first, last``.

    Ranges are cut at the edges of blocks of ``rows`` offsets and joined inside each block. Only those
    that end at an edge can go on in the next block, two a block at most, and only they are
    joined per partition.
    """
    cut = _in_blocks(ranges, partition, rows)
    inside = _islands(cut, [partition, BLOCK])
    at_edge = (F.col("first") == F.col(BLOCK) * rows) | (F.col("last") == (F.col(BLOCK) + 1) * rows - 1)
    joined = _islands(inside.where(at_edge).drop(BLOCK), [partition])
    return joined.unionByName(inside.where(~at_edge).drop(BLOCK))


def ranges_of(records: DataFrame, partition="partition", offset="offset", rows=BLOCK_ROWS) -> DataFrame:
    """The ranges of the records' coordinates; those with a null in it are left out.

    Offsets that follow each other collapse block by block, where they are shuffled to.
    """
    known = records.where(F.col(partition).isNotNull() & F.col(offset).isNotNull())
    place = F.col(offset).cast("long")
    single = known.select(partition, place.alias("first"), place.alias("last")).distinct()
    local = _islands(single.withColumn(BLOCK, block_of("first", rows)), [partition, BLOCK]).drop(BLOCK)
    return merge_ranges(local, partition, rows)


def skip_ranges(
    df: DataFrame, ledger: DataFrame, partition="partition", offset="offset", few=FEW, rows=ROWS,
) -> DataFrame:
    """Records whose coordinate lies in no range of the ledger; one without a coordinate lies in none.

    A ledger of at most ``few`` ranges goes to the records, which stay where they are. Else ranges are cut at
    the edges of blocks of ``rows`` offsets, and the last one that starts at or before each record is found
    inside its block, one block beside the other.
    """
    done = ledger.select(F.col(partition).alias("_partition"), "first", "last")
    if fits(done, few):
        inside = (F.col(partition) == F.col("_partition")) & F.col(offset).between(F.col("first"), F.col("last"))
        return df.join(F.broadcast(done), inside, "left_anti")
    known = F.col(partition).isNotNull() & F.col(offset).isNotNull()
    starts = _in_blocks(ledger, partition, rows).select(
        partition, BLOCK, F.col("first").alias("_at"), F.lit(0).alias("_side"), F.col("last").alias("_last"),
    )
    records = df.where(known).withColumns({
        BLOCK: block_of(offset, rows), "_at": F.col(offset).cast("long"), "_side": F.lit(1),
        "_last": F.lit(None).cast("long"),
    })
    log = starts.unionByName(records, allowMissingColumns=True)
    along = Window.partitionBy(partition, BLOCK).orderBy("_at", "_side")
    reached = F.last("_last", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    filled = log.withColumn("_reached", reached)
    new = (F.col("_side") == 1) & ~F.coalesce(F.col("_reached") >= F.col("_at"), F.lit(False))
    return filled.where(new).select(*df.columns).unionByName(df.where(~known))


def once_by_ranges(
    df: DataFrame, ledger: DataFrame, keys=("partition", "offset"), line=(), few=FEW, rows=ROWS,
) -> DataFrame:
    """Records to process: new to the ledger, one for each coordinate.

    ``keys`` are partition and offset. A record of several rows has a row for each value of ``line``;
    redelivered copies are equal, so the least row stands for all of them.
    """
    new = skip_ranges(df, ledger, *keys, few, rows)
    rest = [c for c in df.columns if c not in (*keys, *line)]
    if not rest:
        return new.distinct()
    return first_per_key(new, [*keys, *line], rest).select(*df.columns)


def with_processed(ledger: DataFrame, processed: DataFrame, keys=("partition", "offset"), rows=BLOCK_ROWS):
    """The ledger with the records of a batch in it."""
    done = ranges_of(processed, *keys, rows)
    return merge_ranges(ledger.select(keys[0], "first", "last").unionByName(done), keys[0], rows)
