"""Benchmark decontamination: exact pieces of test items, verified by edit distance."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import blocks

# Edits an item may have, as a share of its length.
ERROR_RATE = 0.05
# Characters of benchmark items that are sent to the tasks at once.
ITEMS_CHARS = 4 << 20

FOUND = "items array<long>, distances array<int>"


def plain(text):
    """Letters and digits in lower case, with one space for all that lies between them."""
    words = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")
    return F.trim(words)


def budget(length, rate=ERROR_RATE):
    return int(length * rate)


def pieces(item, errors):
    """``(offset, piece)`` for errors + 1 pieces: errors edits leave one of them whole."""
    ends = [len(item) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(ends, ends[1:])]


def char_masks(item):
    masks = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def infix_distance(masks, length, text):
    """Fewest edits between an item and any part of ``text``, by bit-parallel columns.

    The column of the edit table under each character is held as its steps up and down,
    one bit for each character of the item.
    """
    ones, top = (1 << length) - 1, 1 << (length - 1)
    up, down, score = ones, 0, length
    best = score
    for c in text:
        match = masks.get(c, 0)
        flat = match | down
        diagonal = (((match & up) + up) ^ up) | match
        rise, fall = down | (ones & ~(diagonal | up)), up & diagonal
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
            best = min(best, score)
        rise, fall = rise << 1 & ones, fall << 1 & ones
        up, down = fall | (ones & ~(flat | rise)), rise & flat
    return best


def item_finder(items, rate=ERROR_RATE):
    """A function from a plain text to ``{number of item: distance}`` of all that are in it."""
    import ahocorasick

    machine, shapes = ahocorasick.Automaton(), []
    at = {}
    for number, item in enumerate(items):
        errors = budget(len(item), rate)
        shapes.append((item, len(item), errors, char_masks(item)))
        for offset, piece in pieces(item, errors):
            at.setdefault(piece, []).append((number, offset))
    for piece, places in at.items():
        machine.add_word(piece, (len(piece), places))
    if at:
        machine.make_automaton()

    def find(text):
        found, tried = {}, {}
        for end, (length, places) in machine.iter(text) if at else ():
            for number, offset in places:
                if found.get(number) == 0:
                    continue
                item, size, errors, masks = shapes[number]
                start = end + 1 - length - offset
                # Hits that expect the item where it was just looked for tell nothing new.
                if tried.get(number) == start:
                    continue
                tried[number] = start
                if text.startswith(item, start) and start >= 0:
                    found[number] = 0
                    continue
                near = text[max(0, start - errors): start + size + errors]
                distance = infix_distance(masks, size, near)
                if distance <= errors:
                    found[number] = min(distance, found.get(number, distance))
        return found

    return find


def _finder_udf(items, rate):
    """A column function from plain texts to item ids and distances."""
    names = [ids for _, ids in items]
    wanted = [item for item, _ in items]

    @F.pandas_udf(FOUND)
    def find_items(batches: pd.Series) -> pd.DataFrame:
        find, ids, distances = item_finder(wanted, rate), [], []
        for block in blocks(batches, len):
            for text in block:
                hits = [(i, d) for n, d in find(text).items() for i in names[n]]
                hits.sort(key=lambda hit: (hit[0] is not None, hit[0] or 0, hit[1]))
                ids.append([i for i, _ in hits])
                distances.append([d for _, d in hits])
        return pd.DataFrame({"items": ids, "distances": distances})

    return find_items


def with_leaks(docs: DataFrame, benchmark: DataFrame, rate=ERROR_RATE) -> DataFrame:
    """Add ``leaks``: the ids of benchmark items in the text and their distances.

    An item is in a text if some part of it is within ``rate`` of the item's length in
    edits, both compared as plain words. Items without letters or digits, and documents
    without text, match nothing; an item without an id is named by null; equal items are
    each named. The items go to the tasks in blocks of bounded size, however many there are,
    and each block is looked for in the texts as they stream by.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("id"), plain(F.col("text")).alias("item"))
    items = items.where("item <> ''").groupBy("item").agg(
        F.collect_list(F.struct("id")).alias("ids")  # bare values would lose the nulls
    )
    total = items.agg(F.sum(F.length("item"))).first()[0] or 0
    n = total // ITEMS_CHARS + 1
    out = docs.withColumn("_plain", plain(F.col("text")))
    parts = []
    for i in range(n):
        rows = items.where(F.pmod(F.xxhash64("item"), F.lit(n)) == i).collect()
        block = [(row["item"], [r["id"] for r in row["ids"]]) for row in rows]
        out = out.withColumn(f"_found{i}", _finder_udf(block, rate)("_plain"))
        parts.append(f"_found{i}")
    leaks = F.struct(*[
        (F.concat(*[F.col(p)[field] for p in parts])).alias(field) for field in ("items", "distances")
    ])
    return out.withColumn("leaks", leaks).drop("_plain", *parts)
