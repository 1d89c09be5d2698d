"""Exact deduplication by a minimal perfect hash over the digests a corpus already holds."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import keep_once, stored, texts

# Digests in a shard of the index on average: bounds what one task holds.
SHARD_DIGESTS = 2_048
# Bits for each key still to place in a level: fewer levels for more bits.
BITS_PER_KEY = 2
# Stands for a null doc_id inside the index.
NO_ID = -(1 << 63)


def digest_table(docs: DataFrame) -> DataFrame:
    """One narrow row per document: ``row`` names it within this table, ``digest`` its text."""
    digest = F.unhex(_sha256(F.col("text")))
    table = texts(docs).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", digest.alias("digest")
    )
    return stored(table, "digests")


def _hash(words, seed):
    """A hash of 256-bit digests (rows of four words), another one for each seed."""
    with np.errstate(over="ignore"):
        h = np.full(len(words), np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        for column in words.T:
            h = (h ^ column) * np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(31)
        h *= np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(29))


def perfect_hash(words):
    """Levels of bit vectors that give each of the distinct digests a slot of its own.

    In each level the keys are hashed to a few bits each; a bit that a single key falls on
    is set and the others go on to the next level. The number of set bits before its own is
    a key's slot, so n keys fill exactly n slots.
    """
    levels, left, seed = [], words, 0
    while len(left):
        size = max(64, BITS_PER_KEY * len(left))
        at = (_hash(left, seed) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(alone)
        left = left[~alone[at]]
        seed += 1
    return levels


def slots(levels, words):
    """The slot of each digest; any slot, or -1, for one that was not hashed."""
    out = np.full(len(words), -1, np.int64)
    left, before = np.arange(len(words)), 0
    for seed, bits in enumerate(levels):
        if not len(left):
            break
        at = (_hash(words[left], seed) % np.uint64(len(bits))).astype(np.int64)
        rank = np.cumsum(bits) - 1
        hit = bits[at]
        out[left[hit]] = before + rank[at[hit]]
        before += int(bits.sum())
        left = left[~hit]
    return out


def _words(digests):
    return np.frombuffer(b"".join(digests), "<u8").reshape(-1, 4)


def _build(shard: pd.DataFrame) -> pd.DataFrame:
    digests = [bytes(d) for d in shard["digest"]]
    words = _words(digests)
    levels = perfect_hash(words)
    place = np.argsort(slots(levels, words))
    columns = {
        "shard": shard["shard"].iloc[0],
        "levels": [[len(b).to_bytes(8, "little") + np.packbits(b).tobytes() for b in levels]],
        "digests": b"".join(digests[i] for i in place),
    }
    for name in ("doc_id", "row", "n"):
        columns[name + "s"] = shard[name].to_numpy(np.int64)[place].tobytes()
    return pd.DataFrame(columns)


def _shard(n):
    # Another hash than the one Spark shuffles by, so that shards spread over all tasks.
    return F.pmod(F.xxhash64("digest"), F.lit(n)).cast("int").alias("shard")


def _by_digest(table, n):
    """One row per distinct digest: copies meet where they are read, before any shuffle."""
    last = F.max(F.struct("doc_id", "row")).alias("last")
    grouped = table.groupBy("digest").agg(last, F.count("*").alias("n"))
    known = F.coalesce("last.doc_id", F.lit(NO_ID)).alias("doc_id")
    return grouped.select("digest", _shard(n), known, "last.row", "n")


def build_index(table: DataFrame, digests_per_shard=SHARD_DIGESTS) -> DataFrame:
    """The index of a digest table: a row per shard with its perfect hash and its slots.

    A slot holds the whole digest and the locator of the winner, which is the row with the
    largest ``doc_id`` (a null one counts as smallest), and the number of copies.
    """
    n = table.count() // digests_per_shard + 1
    index = _by_digest(table, n).groupBy("shard").applyInPandas(
        _build,
        "shard int, levels array<binary>, digests binary, doc_ids binary, rows binary, ns binary",
    )
    return stored(index.withColumn("of", F.lit(n)), "digest-index")


def _probe(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
    """What the slots say of bare digests: the winner and the copies of a member, nothing of others."""
    out = asked[["digest"]].assign(known=False, doc_id=NO_ID, row=-1, n=0)
    if held.empty or out.empty:
        return out
    shard = held.iloc[0]
    levels = [
        np.unpackbits(np.frombuffer(b, np.uint8, offset=8))[: int.from_bytes(b[:8], "little")]
        .astype(bool)
        for b in shard["levels"]
    ]
    words, kept = _words(out["digest"]), np.frombuffer(shard["digests"], "<u8").reshape(-1, 4)
    at = np.maximum(slots(levels, words), 0)
    # A stranger lands on someone's slot: only equal bytes make a member.
    known = (kept[at] == words).all(axis=1)
    out["known"] = known
    for name in ("doc_id", "row", "n"):
        out.loc[known, name] = np.frombuffer(shard[name + "s"], np.int64)[at[known]]
    return out


def judge(table: DataFrame, index: DataFrame, registered=True) -> DataFrame:
    """Each row of a digest table with the document that stays for its text.

    The index is asked for bare digests. One found in it is a member: its slot names the winner and
    the number of copies. Rows of the others are grouped among themselves. ``registered`` says that the index was
    built over this very table, so that the winner is one of its rows; otherwise all
    members are repeats and go.

    Returns ``row, doc_id, digest, keep_id, group_size, kept, known``. Exactly one row of
    a group is kept, even if rows repeat with their ``doc_id``. Empty tables give no rows.
    """
    first = index.select("of").first()
    n = first[0] if first else 1
    asked = table.select("digest").distinct().select("digest", _shard(n))
    probed = asked.groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(
        _probe, "digest binary, known boolean, doc_id long, row long, n long"
    )
    probed = stored(probed, "probed-digests")
    strangers = _by_digest(table.join(probed.where(~F.col("known")).select("digest"), "digest"), n)
    found = probed.where("known").unionByName(strangers.drop("shard").withColumn("known", F.lit(False)))
    found = found.select(
        "digest", F.nullif("doc_id", F.lit(NO_ID)).alias("keep_id"), F.col("row").alias("keep_row"),
        F.col("n").alias("group_size"), "known",
    )
    stays = F.col("row") == F.col("keep_row")
    return table.join(found, "digest").select(
        "row", "doc_id", "digest", "keep_id", "group_size",
        (stays if registered else stays & ~F.col("known")).alias("kept"), "known",
    )


def exact_dedup(docs: DataFrame) -> DataFrame:
    """``judge`` for a corpus against the index of itself.

    A null text is empty; texts are equal when all their bytes are. Other columns, whatever
    their names, are not looked at.
    """
    table = digest_table(docs)
    return judge(table, build_index(table))


def drop_repeats(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    return keep_once(docs, exact_dedup(docs), F.unhex(_sha256(F.col("text"))))


def _sha256(text):
    return F.sha2(F.coalesce(text, F.lit("")), 256)
