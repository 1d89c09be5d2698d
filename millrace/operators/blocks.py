"""Running values along a log that stay balanced when one key holds most of the rows.

A window over ``(key)`` ordered by offset puts a whole key into one task. Here a key's log
is cut into blocks of offsets. Each block is windowed on its own, a small table with one
row per block carries the value from the blocks before, and an equi join on
``(key, block)`` puts the two together. Offsets are unique in a log partition, so no block
holds more than ``rows`` of its rows, whatever the skew.

Keys small enough to be one group are not cut (see ``hot_hashes``) and carry nothing. Null
keys must be dropped by the caller.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 1 << 22
BLOCK = "_block"
HASH = "_hot_hash"
# Sketches of frequent keys, and keys that each keeps track of.
SHARDS, TRACKED = 64, 4096


def block_of(offset, rows=BLOCK_ROWS):
    """Number of the block an offset lies in."""
    column = F.col(offset) if isinstance(offset, str) else offset
    return F.call_function("div", column.cast("long"), F.lit(rows).cast("long"))


def _named(df, keys, kinds=None):
    """Rows with the hash of their key, null if any of its columns is; ``kinds`` are the types to hash it in."""
    columns = [F.col(k) if kinds is None else F.col(k).try_cast(kinds[k].dataType) for k in keys]
    known = all_of([c.isNotNull() for c in columns])
    return df.withColumn(HASH, F.when(known, F.xxhash64(*columns)))


def hot_hashes(df: DataFrame, keys, rows=BLOCK_ROWS) -> DataFrame:
    """Hashes of the keys with more than ``rows`` rows, to be broadcast.

    A sketch of frequent items tells them: tasks send sketches of bounded size, which are merged
    side by side, ``SHARDS`` of them by the hash, and no table of all keys is ever counted or shuffled. A
    sketch never counts too few. It may count a key that has a little less, or lose sight of
    one with less than ``3.5 / TRACKED`` of its shard's rows; how a key is handled changes no result. Nor
    does it matter if two keys share a hash: both are then handled alike.

    At most about ``count(df) / rows`` keys can qualify: 250,000 for a trillion rows at the default, and
    ``SHARDS * TRACKED`` whatever the size.
    """
    named = _named(df, keys).select(HASH).where(F.col(HASH).isNotNull())
    sketched = named.groupBy(F.pmod(HASH, F.lit(SHARDS)).alias("_shard")).agg(
        F.expr(f"approx_top_k({HASH}, {TRACKED}, {TRACKED})").alias("_seen")
    )
    likely = sketched.select(F.explode("_seen").alias("_item")).where(F.col("_item.count") > rows)
    return F.broadcast(likely.select(F.col("_item.item").alias(HASH)))


def split_hot(df: DataFrame, keys, rows=BLOCK_ROWS):
    """Rows of hot keys, and all others (those with a null key among them).

    Adaptive execution leaves out the first part where no key is hot.
    """
    hot, named = hot_hashes(df, keys, rows), _named(df, keys)
    return named.join(hot, HASH, "left_semi").drop(HASH), named.join(hot, HASH, "left_anti").drop(HASH)


def join_skewed(df: DataFrame, table: DataFrame, keys, how="inner", rows=BLOCK_ROWS):
    """Join rows with a table of one row per key (``how``: inner, left, left_semi, left_anti).

    Rows of hot keys do not move: the table's rows for those keys, as few as there are hot
    keys, are broadcast to them. All others are joined by key. Spark's own handling of a
    skewed join needs both sides straight from a shuffle, which an aggregated table is not.
    Without a hot key the first branch is empty and adaptive execution leaves it out. Rows
    with a null key match nothing and, where the join keeps them, skip the shuffle.
    """
    keys = list(keys)
    known = all_of([F.col(k).isNotNull() for k in keys])
    keyed = df.where(known)
    hot, named = hot_hashes(keyed, keys, rows), _named(keyed, keys)
    common = named.join(hot, HASH, "left_semi").drop(HASH)
    rare = named.join(hot, HASH, "left_anti").drop(HASH)
    few = F.broadcast(_named(table, keys, df.schema).join(hot, HASH, "left_semi").drop(HASH))
    joined = common.join(few, keys, how).unionByName(rare.join(table, keys, how))
    if how in ("left", "left_anti"):
        joined = joined.unionByName(df.where(~known), allowMissingColumns=True)
    return joined


def _cut(df, keys, offset, rows, split):
    """Rows with their ``_block``, and those of them whose key has several blocks.

    ``split="hot"`` cuts only the keys that need it; ``"all"`` cuts every key and saves the
    counting pass, for keys known to be few and large.
    """
    number = block_of(offset, rows)
    if split == "all":
        blocked = df.withColumn(BLOCK, number)
        return blocked, blocked
    hot, named = hot_hashes(df, keys, rows), _named(df, keys)
    marked = named.join(hot.withColumn("_hot", F.lit(True)), HASH, "left").drop(HASH)
    zero = F.lit(0).cast("long")
    blocked = marked.withColumn(BLOCK, F.when(F.col("_hot"), number).otherwise(zero)).drop("_hot")
    return blocked, named.join(hot, HASH).drop(HASH).withColumn(BLOCK, number)


def _carried(rows, keys, part, fold):
    """One row per block with the value folded over the blocks before it."""
    parts = rows.groupBy(*keys, BLOCK).agg(part.alias("_part"))
    before = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(*keys, BLOCK, fold(F.col("_part")).over(before).alias("_carry"))


def _up_to_here(keys, order):
    return (
        Window.partitionBy(*keys, BLOCK)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def _attach(local, carried, keys, name, combine):
    """The join keeps the partitioning and sort order the window left behind."""
    joined = local.join(carried, [*keys, BLOCK], "left")
    return joined.withColumn(name, combine(F.col("_local"), F.col("_carry"))).drop(
        "_local", "_carry", BLOCK
    )


def running_count(df, keys, offset, name, rows=BLOCK_ROWS, split="hot"):
    """Rows of the key up to and including this one, in offset order."""
    blocked, cut = _cut(df, keys, offset, rows, split)
    carried = _carried(cut, keys, F.count(F.lit(1)), F.sum)
    numbered = Window.partitionBy(*keys, BLOCK).orderBy(offset)
    local = blocked.withColumn("_local", F.row_number().over(numbered))
    return _attach(
        local, carried, keys, name, lambda here, past: here + F.coalesce(past, F.lit(0))
    )


def running_max(df, keys, offset, value, name, rows=BLOCK_ROWS, split="hot"):
    """Largest ``value`` seen by the key up to and including this row."""
    blocked, cut = _cut(df, keys, offset, rows, split)
    carried = _carried(cut, keys, F.max(value), F.max)
    local = blocked.withColumn("_local", F.max(value).over(_up_to_here(keys, [offset])))
    return _attach(local, carried, keys, name, F.greatest)


def fill_forward(df, keys, offset, value, name, tie=None, rows=BLOCK_ROWS, split="hot"):
    """Last non-null ``value`` of the key up to and including this row.

    ``tie`` orders rows that share an offset.
    """
    order = [offset] if tie is None else [offset, tie]
    blocked, cut = _cut(df, keys, offset, rows, split)
    rank = F.struct(*order)
    carried = _carried(
        cut,
        keys,
        F.max_by(value, F.when(F.col(value).isNotNull(), rank)),
        lambda part: F.last(part, ignorenulls=True),
    )
    local = blocked.withColumn(
        "_local", F.last(value, ignorenulls=True).over(_up_to_here(keys, order))
    )
    return _attach(local, carried, keys, name, F.coalesce)


def all_of(conditions):
    """Conjunction of conditions."""
    return reduce(lambda left, right: left & right, conditions)
