"""Importance resampling towards a target: documents drawn by how much their n-grams look like it.

All runs of one to three words are counted by hashed bucket, in the corpus and in the target. A
bucket's gain is the logarithm of its share there against its share here; a document weighs
the sum of its n-grams' gains, and the draw without replacement adds a Gumbel number.

Inside a task, the n-grams of some ten thousand words at a time are interned in open-addressed tables of
arrays: keyed by xxhash64, compared byte by byte, with a bucket and a count in each slot. Words are
interned by their own bytes; a run of words is then the bytes of its words' slot numbers, and its crc32
follows from theirs. What an n-gram is worth is looked up by slot.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import stored, texts

BUCKETS = 10_000
LONGEST = 3
# Words of a text that counts, and the share drawn, in percent.
LEAST_WORDS = 20
SHARE = 5
SEED = "42"
# Words interned at once, and bytes of text at once: their tables stay small enough for a core's cache.
WORDS = 1 << 15
BLOCK = 1 << 20
# Longer words are compared and summed up one by one.
LONG = 64

SPACE = 32
# What a byte stands for: letters in lower case, digits and all beyond ASCII; the rest parts words.
FOLDED = np.zeros(256, np.uint8)
FOLDED[0x30:0x3A] = range(0x30, 0x3A)
FOLDED[0x61:0x7B] = range(0x61, 0x7B)
FOLDED[0x41:0x5B] = range(0x61, 0x7B)
FOLDED[0x80:] = range(0x80, 0x100)


# The primes of xxhash64, and the reflected polynomial of crc32.
PRIMES = tuple(np.uint64(p) for p in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5,
))
POLYNOMIAL = 0xEDB88320


def _turned(x, bits):
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _lane(h, lane):
    p1, p2, _, p4, _ = PRIMES
    return _turned(h ^ (_turned(lane * p2, 31) * p1), 27) * p1 + p4


def _mixed(h):
    _, p2, p3, _, _ = PRIMES
    h = (h ^ (h >> np.uint64(33))) * p2
    h = (h ^ (h >> np.uint64(29))) * p3
    return h ^ (h >> np.uint64(32))


def hash_rows(rows):
    """xxhash64 of each row of 64-bit numbers, as of its bytes (less than 32 of them)."""
    with np.errstate(over="ignore"):
        h = np.full(len(rows), PRIMES[4] + np.uint64(8 * rows.shape[1]), np.uint64)
        for lane in rows.astype(np.uint64).T:
            h = _lane(h, lane)
        return _mixed(h)


def eight_bytes(data):
    """The eight bytes from each position of an array as a number; there are zeros after the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))


def hash_strings(data, starts, sizes):
    """xxhash64 of strings of ``data``: those of less than 32 bytes side by side, others one by one."""
    p1, p2, p3, _, p5 = PRIMES
    eight, at, left = eight_bytes(data), starts.copy(), sizes.copy()
    long = sizes >= 32
    left[long] = 0
    with np.errstate(over="ignore"):
        h = p5 + sizes.astype(np.uint64)
        while len(rows := np.flatnonzero(left >= 8)):
            h[rows] = _lane(h[rows], eight[at[rows]])
            at[rows] += 8
            left[rows] -= 8
        rows = np.flatnonzero(left >= 4)
        four = eight[at[rows]] & np.uint64(0xFFFFFFFF)
        h[rows] = _turned(h[rows] ^ (four * p1), 23) * p2 + p3
        at[rows] += 4
        left[rows] -= 4
        while len(rows := np.flatnonzero(left > 0)):
            h[rows] = _turned(h[rows] ^ ((eight[at[rows]] & np.uint64(255)) * p5), 11) * p1
            at[rows] += 1
            left[rows] -= 1
        h = _mixed(h)
    view = memoryview(data)
    for k in np.flatnonzero(long):
        h[k] = xxhash.xxh64_intdigest(view[starts[k]:starts[k] + sizes[k]])
    return h


def _crc_shifts(longest=LONG):
    """Per number of bytes what a crc32 becomes when as many zero bytes follow, by each of its four bytes."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(POLYNOMIAL), one >> 1)
    shifts = np.zeros((longest + 2, 4, 256), np.uint32)
    shifts[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32)[:, None])
    for n in range(1, longest + 2):
        shifts[n] = one[shifts[n - 1] & 255] ^ (shifts[n - 1] >> 8)
    return shifts


SHIFTS = _crc_shifts()


def crc_joined(first, second, size):
    """The crc32 of two strings put together, from theirs and the size of the second."""
    out = second.copy()
    for k in range(4):
        out ^= SHIFTS[size, k, (first >> np.uint32(8 * k)) & np.uint32(255)]
    return out


class Slots:
    """An open-addressed table: ``slot`` says where each key went, ``owner`` which key has a slot (or -1).

    Keys that are equal as numbers are the same only if ``equal`` says so of the strings behind them.
    ``count`` and ``bucket`` are by slot.
    """

    def __init__(self, keys, equal):
        size = 1 << max(4, int(2 * len(keys)).bit_length())
        self.owner = np.full(size, -1, np.int64)
        self.slot = (keys >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64)
        left = np.arange(len(keys))
        while len(left):
            at = self.slot[left]
            empty = self.owner[at] < 0
            # Of several at one empty slot one is written; the others find it there.
            self.owner[at[empty]] = left[empty]
            owner = self.owner[at]
            same = owner == left
            other = np.flatnonzero(~same)
            alike = other[keys[owner[other]] == keys[left[other]]]
            same[alike] = equal(owner[alike], left[alike])
            left = left[~same]
            self.slot[left] = (self.slot[left] + 1) & (size - 1)
        self.used = np.flatnonzero(self.owner >= 0)

    def counted(self, slots):
        self.count = np.bincount(slots, minlength=len(self.owner))

    def spread(self, values):
        """An array by slot from one value for each used slot."""
        out = np.zeros(len(self.owner), values.dtype)
        out[self.used] = values
        return out


def equal_bytes(data, starts, sizes):
    """Whether strings of ``data`` are equal: eight bytes at a time, long ones as a whole."""
    eight = eight_bytes(data)

    def equal(a, b):
        out = sizes[a] == sizes[b]
        long = out & (sizes[a] > LONG)
        for k in np.flatnonzero(long):
            here, there = (data[starts[x[k]]:starts[x[k]] + sizes[a[k]]] for x in (a, b))
            out[k] = np.array_equal(here, there)
        rows, done = np.flatnonzero(out & ~long), 0
        while len(rows):
            left = np.minimum(sizes[a[rows]] - done, 8).astype(np.uint64)
            differ = eight[starts[a[rows]] + done] ^ eight[starts[b[rows]] + done]
            # The first byte is the lowest; bytes past the end are shifted out.
            wrong = (differ << (np.uint64(64) - left * np.uint64(8))) > 0
            out[rows[wrong]] = False
            done += 8
            rows = rows[~wrong & (sizes[a[rows]] > done)]
        return out

    return equal


def normalised(data, offsets):
    """All words of several texts as one array of bytes, a space after each: starts, ends and text of each."""
    # What parts words also stands between texts.
    folded = FOLDED[np.insert(data, offsets[1:], 0)]
    offsets = offsets + np.arange(len(offsets))
    inside = folded > 0
    starts = np.flatnonzero(inside & ~np.r_[False, inside[:-1]])
    ends = np.flatnonzero(~inside & np.r_[False, inside[:-1]])
    of = np.searchsorted(offsets, starts, side="right") - 1
    inside[ends] = True
    out = folded[inside]
    out[out == 0] = SPACE
    sizes = ends - starts
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    return out, starts, starts + sizes, of


def _words(view, data, starts, ends, n, buckets):
    """The table of single words, the first ``n`` of which count; also crc32 and size by slot."""
    sizes = ends - starts
    table = Slots(hash_strings(data, starts, sizes), equal_bytes(data, starts, sizes))
    table.counted(table.slot[:n])
    owners = table.owner[table.used]
    spans = zip(starts[owners].tolist(), ends[owners].tolist())
    crcs = np.fromiter((zlib.crc32(view[a:b]) for a, b in spans), np.uint32, len(owners))
    table.bucket = table.spread((crcs % buckets).astype(np.int64))
    return table, table.spread(crcs), table.spread(sizes[owners])


def _runs(view, starts, ends, of, n, words, crcs, sizes, buckets):
    """The table of runs of two words and more whose first is one of the first ``n``; and their texts."""
    rows, firsts, lasts = [], [], []
    for size in range(2, LONGEST + 1):
        first = np.arange(max(0, min(n, len(starts) - size + 1)))
        first = first[of[first] == of[first + size - 1]]
        row = np.full((len(first), LONGEST), -1, np.int64)
        for k in range(size):
            row[:, k] = words.slot[first + k]
        rows.append(row)
        firsts.append(first)
        lasts.append(first + size - 1)
    rows, firsts, lasts = (np.concatenate(x) for x in (rows, firsts, lasts))
    table = Slots(hash_rows(rows), lambda a, b: (rows[a] == rows[b]).all(axis=1))
    table.counted(table.slot)
    owners = table.owner[table.used]
    mine = rows[owners]
    space = np.uint32(zlib.crc32(b" "))
    crc = crcs[mine[:, 0]]
    for k in range(1, LONGEST):
        word = np.maximum(mine[:, k], 0)
        size = np.minimum(sizes[word], LONG)
        joined = crc_joined(crc, crc_joined(np.full(len(crc), space), crcs[word], size), size + 1)
        crc = np.where(mine[:, k] >= 0, joined, crc)
    # Words too long for the tables: the crc32 of the run's bytes, which stand together.
    longest = np.where(mine >= 0, sizes[np.maximum(mine, 0)], 0).max(axis=1, initial=0)
    for k in np.flatnonzero(longest > LONG):
        crc[k] = zlib.crc32(view[starts[firsts[owners[k]]]:ends[lasts[owners[k]]]])
    table.bucket = table.spread((crc % buckets).astype(np.int64))
    return table, of[firsts]


def interned(data, offsets, words=WORDS, buckets=BUCKETS):
    """The n-grams of some texts, part by part: tables with the slot and the text of each occurrence.

    Two of them a part, of single words and of longer runs.
    """
    data, starts, ends, of = normalised(data, offsets)
    for a in range(0, len(starts), words):
        # A run that starts here may end in the next part.
        part = slice(a, a + words + LONGEST - 1)
        low, high = starts[a], ends[part][-1]
        here, s, e, text = data[low:high], starts[part] - low, ends[part] - low, of[part]
        view, n = memoryview(here), min(words, len(s))
        single, crcs, sizes = _words(view, here, s, e, n, buckets)
        runs, text_of_run = _runs(view, s, e, text, n, single, crcs, sizes, buckets)
        yield (single, single.slot[:n], text[:n]), (runs, runs.slot, text_of_run)


def blocks_of(batch, limit=BLOCK):
    """A batch's texts as arrays of bytes, some at a time: first row, bytes, and where each text starts."""
    column = batch.column("text").cast(pa.large_string())
    sizes = np.diff(np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1])
    row = 0
    while row < len(column):
        total = np.cumsum(sizes[row:])
        n = max(1, int(np.searchsorted(total, limit, side="right")))
        part = column.slice(row, n)
        ends = np.frombuffer(part.buffers()[1], np.int64)[part.offset:part.offset + n + 1]
        data = np.frombuffer(part.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
        yield row, data, ends - ends[0]
        row += n


def _count(batches):
    counts = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, data, offsets in blocks_of(batch):
            for tables in interned(data, offsets):
                for table, _, _ in tables:
                    counts += np.bincount(table.bucket, table.count, BUCKETS).astype(np.int64)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int32()), pa.array(counts[used], pa.int64())], names=["bucket", "n"]
    )


def bucket_counts(rows: DataFrame) -> DataFrame:
    """``bucket, n``: how many n-grams of all texts fall into each bucket; counted before the shuffle."""
    counted = rows.select("text").mapInArrow(_count, "bucket int, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame) -> np.ndarray:
    """The gain of each bucket; two numbers a bucket come to the driver, however many texts there are."""
    counts = np.zeros((2, BUCKETS), np.int64)
    for into, rows in zip(counts, (docs, target)):
        for row in bucket_counts(rows).collect():
            into[row.bucket] = row.n
    (all_s, all_t), (s, t) = counts.sum(axis=1).tolist(), counts.astype(float)
    share = (t + 1.0) * (all_s + float(BUCKETS)) / ((s + 1.0) * (all_t + float(BUCKETS)))
    return np.array([math.floor(1000.0 * math.log(x)) for x in share.tolist()], np.int64)


def _weigh(gain):
    def run(batches):
        for batch in batches:
            words, features, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for row, data, offsets in blocks_of(batch):
                n = len(offsets) - 1
                here = slice(row, row + n)
                for tables in interned(data, offsets):
                    for table, slots, of in tables:
                        # What each occurrence is worth is gathered by its slot.
                        worth = gain[table.bucket][slots]
                        weight[here] += np.bincount(of, worth, n).astype(np.int64)
                        features[here] += np.bincount(of, minlength=n)
                    words[here] += np.bincount(tables[0][2], minlength=n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (words, features, weight))],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    return run


def _gumbel(seed):
    """A number per document, made from its id alone."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(scored: DataFrame, order, number="rank") -> DataFrame:
    """Number all rows from 1 in the order given, however many there are.

    Rows are dealt by ranges of the order and written; a row's number is its place in its range
    plus the sizes of the ranges before it, of which there are as many as partitions.
    """
    dealt = scored.repartitionByRange(*order).sortWithinPartitions(*order)
    # The id of a row is its partition and its place in it.
    placed = stored(dealt.withColumn("_place", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("_place", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.col("_place").bitwiseAND((1 << 33) - 1)
    numbered = placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return numbered.withColumn(number, F.col("_before") + place + 1).drop("_part", "_place", "_before")


def resample(docs: DataFrame, target: DataFrame, share=SHARE, least=LEAST_WORDS, seed=SEED) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every document; ``rank`` is null if it is not drawn.

    Of the documents with ``least`` words or more, ``share`` percent (rounded down) are drawn, the
    highest scores first, ties by the smaller ``doc_id``. A null or empty text has no words and weighs
    nothing; a null ``doc_id`` draws like an empty one and comes last in a tie. Repeated rows count and
    are drawn each. Only ``doc_id`` and ``text`` are read, of ``target`` ``text``. With no target, or no
    documents, gains follow from the counts of nothing.
    """
    rows = texts(docs)
    gain = gains(rows, target.select(F.coalesce(F.col("text"), F.lit("")).alias("text")))
    weighed = rows.mapInArrow(_weigh(gain), "doc_id long, n_words long, n_features long, weight long")
    scored = weighed.withColumn("score", F.col("weight") + _gumbel(seed))
    scored = stored(scored.withColumn("row", F.monotonically_increasing_id()), "weighed")
    eligible = scored.where(F.col("n_words") >= least)
    drawn = share * eligible.count() // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc()]
    numbered = ranked(eligible, order)
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    others = scored.where(F.col("n_words") < least).withColumn("rank", F.lit(None).cast("long"))
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    return numbered.withColumn("rank", rank).select(*columns).unionByName(others.select(*columns))
