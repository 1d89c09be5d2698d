"""Removal of long repeated byte strings by prefix doubling over content-chosen positions.

A string of ``length`` bytes that occurs twice holds, in both places, the same position chosen by
content alone (the least hash in a window), and at least ``AHEAD`` equal bytes from there on.
So only such positions are ranked: by what follows, at growing offsets, until they are
alone or past the threshold, as in prefix doubling of a suffix array. What is still together
then is a repeat; only at the edges of repeats are single starts compared.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import done_with, stored, texts

LENGTH = 200
# Bytes that are equal from a chosen position on, and the hashed ones there.
AHEAD, GRAM = 32, 8
# Bytes handled at once inside a task.
SLICE = 1 << 20


def _gram_hashes(data):
    """A hash of the ``GRAM`` bytes from each position of an array of bytes."""
    n = len(data) - GRAM + 1
    grams = np.lib.stride_tricks.as_strided(data, (n, GRAM), (1, 1))
    with np.errstate(over="ignore"):
        h = np.ascontiguousarray(grams).view("<u8").ravel() * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return h


def _window_least(keys, window):
    """The least key of each ``window`` consecutive ones, by minima from block edges both ways."""
    n = len(keys) - window + 1
    size = -(-len(keys) // window) * window
    padded = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(keys)] = keys
    table = padded.reshape(-1, window)
    after = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    before = np.minimum.accumulate(table, axis=1).ravel()
    return np.minimum(after[:n], before[window - 1:window - 1 + n])


def anchors(data, length=LENGTH):
    """For each start of a ``length``-byte string its chosen position, as runs of starts.

    Returns arrays ``at, first, last``: the position and the first and last start that choose
    it. ``data`` is an array of bytes.
    """
    n = len(data) - length + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3
    window = length - AHEAD + 1
    found = []
    # Starts are handled in slices; what a start chooses depends on its own bytes only.
    for low in range(0, n, SLICE):
        high = min(n, low + SLICE)
        h = _gram_hashes(data[low:high + window - 1 + GRAM - 1])
        place = np.arange(len(h), dtype=np.uint64)
        # The leftmost of equal hashes: the place, under 2 ** 24 in a slice, breaks ties.
        keys = (h & np.uint64(0xFFFFFFFFFF000000)) | place
        chosen = (_window_least(keys, window) & np.uint64(0xFFFFFF)).astype(np.int64) + low
        found.append(chosen)
    chosen = np.concatenate(found)
    starts = np.flatnonzero(np.diff(chosen, prepend=-1))
    ends = np.append(starts[1:], len(chosen)) - 1
    return chosen[starts], starts, ends


def _columns(parts, names):
    return pd.DataFrame({
        name: np.concatenate([np.asarray(p) for p in column]) if column else np.zeros(0, np.int64)
        for name, column in zip(names, parts)
    })


ANCHORS = "row long, at int, first int, last int, name long, context long"


def _find_anchors(length):
    window = length - AHEAD + 1

    def run(frames):
        for frame in frames:
            parts = [[] for _ in range(6)]
            for row, text in zip(frame["row"], frame["text"]):
                raw = text.encode("utf-8", "surrogatepass")
                at, first, last = anchors(np.frombuffer(raw, np.uint8), length)
                names = [xxhash.xxh3_64_intdigest(raw[a:a + AHEAD]) for a in at.tolist()]
                # All bytes that a string through this position may hold, and where it is in them.
                lows = np.maximum(0, at - window + 1).tolist()
                contexts = [
                    xxhash.xxh3_64_intdigest(raw[low:a + length], a - low)
                    for low, a in zip(lows, at.tolist())
                ]
                for part, values in zip(parts, (
                    np.full(len(at), row), at.astype(np.int32), first.astype(np.int32),
                    last.astype(np.int32), np.array(names, np.uint64).view(np.int64),
                    np.array(contexts, np.uint64).view(np.int64),
                )):
                    part.append(values)
            yield _columns(parts, ("row", "at", "first", "last", "name", "context"))

    return run


# Starts that are compared together before they are compared one by one.
CELL, PART = 32, 8
CELLS = "row long, start int, k int, low int, high int, core binary, left binary, right binary, open boolean"


def _find_cells(length):
    """Starts of the positions still open, in cells of ``CELL``, with the bytes all have in common."""
    common = length - CELL + 1

    def run(frames):
        for frame in frames:
            out = []
            for row, text, positions in zip(frame["row"], frame["text"], frame["positions"]):
                raw = text.encode("utf-8", "surrogatepass")
                for p in positions:
                    at, first, last = p["at"], p["first"], p["last"]
                    for k in range((at - last) // CELL, (at - first) // CELL + 1):
                        s = at - CELL * k
                        out.append((
                            row, s, k, max(0, s - last), min(CELL - 1, s - first),
                            xxhash.xxh3_128_digest(raw[s:s + common], k),
                            raw[max(0, s - CELL + 1):s], raw[s + common:s + length], p["open"],
                        ))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in CELLS.split(", ")])

    return run


def _shared(rows, keys):
    """Rows whose keys another row has too. Counted before the shuffle, then joined back.

    The counts are stored, so that the join reads two plain shuffles and Spark may split the
    rows of a frequent key over several tasks.
    """
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    return rows.join(stored(counts, "shared-keys"), keys, "left_semi")


def _narrowed(cells, step, size):
    """Cells cut into smaller ones, ranked by the pair of their rank and the bytes these add.

    A start ``j`` bytes before the core takes ``j`` bytes on its left and the rest on its right;
    a cell of starts ``j`` to ``j + size - 1`` has the bytes in common that all of them take.
    """
    cut = cells.withColumn("j", F.explode(F.sequence(
        F.col("low") - F.col("low") % size, F.col("high"), F.lit(size)
    )))
    before, after = F.col("j"), F.lit(step - size) - F.col("j")
    cut = cut.where((F.length("left") >= before) & (F.length("right") >= after))
    left = F.substring(F.col("left"), F.length("left") - before + 1, before)
    right = F.substring(F.col("right"), F.lit(1), after)
    return cut.select(
        "row", "start", "open", "j", F.greatest("low", "j").alias("low"),
        F.least("high", F.col("j") + size - 1).alias("high"),
        F.xxhash64("core", "j", left, right).alias("rank"),
        F.xxhash64(right, left, "j", "core").alias("rank2"),
        *(["core", "left", "right"] if size > 1 else []),
    )


def repeated_starts(rows: DataFrame, length=LENGTH) -> DataFrame:
    """``row, low, high``: runs of starts of byte strings that also start elsewhere.

    ``rows`` holds ``row`` and ``text`` and gives the same at each reading. Every start
    is looked at through the one position it chooses: equal strings choose equally.
    """
    found = stored(rows.mapInPandas(_find_anchors(length), ANCHORS), "anchors", compression="zstd")
    # First rank: the bytes ahead. Positions that are alone with them are done.
    left = stored(_shared(found, ["name"]), "ranked", compression="zstd")
    done_with(found)
    # Second: all bytes around. Who shares them has every start in common.
    classes = left.groupBy("name", "context").agg(
        F.count("*").alias("n"), F.min(F.struct("row", "at", "first", "last")).alias("one")
    )
    classes = stored(classes, "classes")
    whole = left.join(classes.where("n > 1").select("name", "context"), ["name", "context"])
    whole = stored(whole.select("row", F.col("first").alias("low"), F.col("last").alias("high")), "whole")
    done_with(left)
    # The others may share a part with one of another class: one position stands for each.
    several = classes.groupBy("name").agg(
        F.count("*").alias("k"), F.min("n").alias("least")
    ).where("k > 1 and least = 1").select("name")
    todo = classes.join(several, "name", "left_semi").select(
        "one.row", F.struct("one.at", "one.first", "one.last", (F.col("n") == 1).alias("open")).alias("p")
    ).groupBy("row").agg(F.collect_list("p").alias("positions"))
    cells = rows.join(todo, "row").select("row", "text", "positions")
    cells = stored(cells.mapInPandas(_find_cells(length), CELLS), "cells", compression="zstd")
    open_cells = stored(_shared(cells, ["core"]), "shared-cells", compression="zstd")
    done_with(cells)
    parts = _narrowed(open_cells, CELL, PART)
    parts = stored(_shared(parts, ["rank", "rank2"]), "shared-parts", compression="zstd")
    done_with(open_cells)
    starts = _shared(_narrowed(parts.drop("rank", "rank2", "j"), CELL, 1), ["rank", "rank2"])
    single = starts.where("open").select(
        "row", (F.col("start") - F.col("j")).alias("low"), (F.col("start") - F.col("j")).alias("high")
    )
    return whole.unionByName(single)


def _cut_udf(length):
    @F.pandas_udf("n_removed long, n_spans long, kept binary")
    def cut(text: pd.Series, low: pd.Series, high: pd.Series) -> pd.DataFrame:
        removed, spans, kept = [], [], []
        for t, first, last in zip(text, low, high):
            raw = np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8)
            if first is None or not len(first):
                removed.append(0)
                spans.append(0)
                kept.append(raw.tobytes())
                continue
            edge = np.zeros(len(raw) + 1, np.int64)
            np.add.at(edge, np.asarray(first), 1)
            np.add.at(edge, np.asarray(last) + length, -1)
            gone = np.cumsum(edge[:-1]) > 0
            removed.append(int(gone.sum()))
            spans.append(int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()))
            kept.append(raw[~gone].tobytes())
        return pd.DataFrame({"n_removed": removed, "n_spans": spans, "kept": kept})

    return cut


def cut_repeats(docs: DataFrame, length=LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` of each document.

    ``kept`` holds the bytes of the text that no string of ``length`` bytes covers which also
    starts anywhere else, in this document or another. A null text is empty; texts shorter than
    ``length`` stay whole; repeated rows are repeats of each other.
    """
    rows = stored(
        texts(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"),
        "texts", compression="zstd",
    )
    marks = repeated_starts(rows.select("row", "text"), length)
    marks = stored(marks.groupBy("row").agg(
        F.collect_list("low").alias("low"), F.collect_list("high").alias("high")
    ), "marks")
    cut = _cut_udf(length)("text", "low", "high")
    marked = rows.join(marks, "row", "left").withColumn("cut", cut)
    return marked.select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "cut.n_removed",
        "cut.n_spans", "cut.kept",
    )
