"""Packing of documents into training sequences by multiway differencing.

A document's tokens are cut into whole windows and a rest of small pieces. Windows that are full are
sequences as they are. The other pieces are dealt to groups of bounded size, and each group is
divided into near-equal windows by differencing: every piece starts as a partial partition of its
own, and the two partitions with the largest spread are merged, the fullest window of one with the
emptiest of the other, until one is left. If a window holds more than fits, the group is divided
again into more windows.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored, texts

WINDOW = 2048
# Token id after each document.
END = 1
# Rests of documents are cut into pieces of this many tokens: the smaller, the less padding.
PIECE = 512
# Pieces divided together, about.
GROUP = 2048

# Runs that the fast encoder would need a time that grows with their square for.
LONG_RUN = re.compile(r"\S{1000}|\s{1000}")
# How byte-level files part a text, as their library does (a fixed value).
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters():
    """The letter that stands for each byte in byte-level files: itself if printable, else one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _plain_ranks(model):
    """Bytes of each token if the file is a plain byte-level one whose ids are in the order of merging."""
    coder, cut = model["model"], model["pre_tokenizer"] or {}
    plain = (
        coder.get("type") == "BPE" and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
        and not cut.get("add_prefix_space") and not model.get("normalizer")
        and not any(coder.get(k) for k in (
            "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges",
        ))
        and not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in model["added_tokens"])
    )
    if not plain:
        return None
    merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in coder["merges"]]
    added = {t["content"] for t in model["added_tokens"]}
    vocabulary = {token: i for token, i in coder["vocab"].items() if token not in added}
    first = len(vocabulary) - len(merges)
    letters = _byte_letters()
    if first != 256 or any(vocabulary.get(m) != first + i for i, m in enumerate(merges)):
        return None
    return {bytes(letters[c] for c in token): i for token, i in vocabulary.items()}


def ids_encoder(text_of_file):
    """A function from a text to its token ids, as the file's own library gives them.

    Plain byte-level files are run by the faster of two equal encoders; texts with long runs, and
    files with any other step, by the library itself.
    """
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(text_of_file)
    library.no_truncation()
    library.no_padding()

    def whole(text):
        return np.array(library.encode(text, add_special_tokens=False).ids, "<u4")

    model = json.loads(text_of_file)
    ranks = _plain_ranks(model)
    if ranks is None:
        return whole
    import tiktoken

    special = {t["content"]: t["id"] for t in model["added_tokens"]}
    fast = tiktoken.Encoding("packing", pat_str=PARTS, mergeable_ranks=ranks, special_tokens=special)

    def encode(text):
        if LONG_RUN.search(text):
            return whole(text)
        return fast.encode_to_numpy(text, allowed_special="all").astype("<u4")

    return encode


def cuts(n, window=WINDOW, piece=PIECE):
    """Starts of the pieces of ``n`` tokens: full windows, then a rest in small pieces."""
    full = n - n % window
    return [*range(0, full, window), *range(full, n, piece)]


def _cut_texts(text_of_file, window, piece, end):
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")])

    def run(batches):
        encode = ids_encoder(text_of_file)
        for batch in batches:
            out = [[] for _ in schema]
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                ids = np.append(encode(text.as_py()), np.uint32(end)).astype("<u4")
                n = len(ids)
                starts = cuts(n, window, piece)
                for start, stop in zip(starts, [*starts[1:], n]):
                    row = (doc_id.as_py(), start, stop - start, zlib.crc32(ids[start:stop].tobytes()), n)
                    for column, value in zip(out, row):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], schema=schema)

    return run


def divide(sizes, m):
    """Windows of ``m`` near-equal sums: the fullest sum, and the window of each size."""
    sums, merged, heap = [], [], []
    for i, size in enumerate(sizes):
        alone = np.zeros(m, np.int64)
        alone[0] = size
        sums.append(alone)
        heap.append((-int(size) if m > 1 else 0, i))
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        joined = sums[a] + sums[b][::-1]
        order = np.argsort(-joined, kind="stable")
        merged.append((a, b, order))
        sums.append(joined[order])
        sums[a] = sums[b] = None
        heapq.heappush(heap, (int(sums[-1][-1] - sums[-1][0]), len(sums) - 1))
    # From the last merge back: which final window each window of a partition became.
    place = {len(sums) - 1: np.arange(m)}
    for k in range(len(merged) - 1, -1, -1):
        a, b, order = merged[k]
        final = np.empty(m, np.int64)
        final[order] = place.pop(len(sizes) + k)
        place[a], place[b] = final, final[::-1]
    return int(sums[-1][0]), np.array([place[i][0] for i in range(len(sizes))])


def fit(sizes, window=WINDOW):
    """The window of each size, none over ``window``: more windows are tried until all fit.

    The number rises in steps that double, and then goes back to the least that was seen to fit
    between the last two steps.
    """
    low = max(1, -(-int(np.sum(sizes)) // window))
    tried, step = low, 1
    fullest, found = divide(sizes, low)
    while fullest > window:
        low, tried, step = tried, min(tried + step, len(sizes)), step * 2
        fullest, found = divide(sizes, tried)
    while tried - low > 1:
        middle = (low + tried) // 2
        fullest, other = divide(sizes, middle)
        if fullest > window:
            low = middle
        else:
            tried, found = middle, other
    return found


def _fit_group(window):
    def run(frame):
        frame = frame.sort_values(["length", "piece"], ascending=[False, True])
        frame = frame.assign(at=fit(frame["length"].to_numpy(), window))
        frame = frame.sort_values(["at", "length", "piece"], ascending=[True, False, True])
        same = frame.groupby("at", sort=False)
        return frame.assign(
            offset=same["length"].cumsum() - frame["length"],
            sequence_id=same["piece"].transform("min"),
        )[PACKED]

    return run


PACKED = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(docs: DataFrame, tokenizer, window=WINDOW, piece=PIECE, group=GROUP, end=END) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``tokenizer`` is the path of a tokenizer file on the driver; ids are the library's for the whole
    text, nothing added, then ``end``. A null or empty text is ``end`` alone. Each id is in exactly
    one piece, and pieces follow each other in a sequence of at most ``window`` tokens without gaps.
    Repeated rows, and rows that share a ``doc_id`` or have none, are packed each; other columns are
    not read. A sequence is named by the least piece in it. No table, no rows.
    """
    with open(tokenizer, encoding="utf-8") as file:
        text_of_file = file.read()
    cut = texts(docs).mapInArrow(
        _cut_texts(text_of_file, window, piece, end),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long",
    )
    # The ids of pieces are numbers of rows, so they are written before anything depends on them.
    pieces = stored(cut.withColumn("piece", F.monotonically_increasing_id()), "pieces")
    full = pieces.where(F.col("length") == window).withColumns(
        {"sequence_id": F.col("piece"), "offset": F.lit(0).cast("long")}
    )
    rest = pieces.where(F.col("length") < window)
    groups = max(1, -(-rest.count() // group))
    # Groups of about equal size, dealt by a number that no two pieces share.
    dealt = rest.withColumn("group", F.pmod(F.xxhash64("piece"), F.lit(groups)))
    packed = dealt.groupBy("group").applyInPandas(
        _fit_group(window), ", ".join(f"{c} long" for c in PACKED)
    )
    return packed.unionByName(full.select(*PACKED))
