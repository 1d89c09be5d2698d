"""Token counts of whole texts; huge ones are encoded in chunks that are spliced exactly."""

from __future__ import annotations

import os
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import blocks, stored, texts

# Characters of a chunk, and by how many it reaches into the next one at first.
CHUNK = 32_768
OVERLAP = 512
# Near a cut, the last tokens may differ from those of the whole text: no splice so close to
# it. More than the longest special token and a look ahead.
MARGIN = 64
# Words whose counts a task remembers, and characters of text it counts at once.
REMEMBERED = 400_000
AT_ONCE = 1 << 20

# Letters, marks and single line ends next to each other are pre-tokens of their own.
PIECE = re.compile(r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+|[.,;:!?*#$&|]+|\n(?=[^\n])")
BESIDE_SPACE = re.compile(r" \s|\s ")
BETWEEN_WORDS = re.compile(r"(?<=\S) (?=\S)")


def words_of(text):
    """Parts of a text that are encoded on their own, whatever stands around them.

    A single space between two characters that are no white space begins a new
    pre-token, so it parts the text for good; it belongs to the part after it.
    """
    if not text:
        return []
    if text[0] == " " or text[-1] == " " or BESIDE_SPACE.search(text):
        return BETWEEN_WORDS.split(text)
    return text.split(" ")  # the same, where no space stands beside white space


def _tokenizer(json):
    """The library's tokenizer, for one task: it has one core, and each thread of the library's would hold memory."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(json)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _counter(json):
    """A function from texts to token counts that remembers the counts of words."""
    tokenizer = _tokenizer(json)
    known, known_pieces = {}, {}

    def encode(found, into):
        found = list(found)
        encoded = tokenizer.encode_batch_fast(found, add_special_tokens=False)
        into.update(zip(found, map(len, encoded)))

    def learn(words):
        """Words repeat less than what they consist of: sum the counts of the pieces."""
        cut, whole = {}, []
        for w in words:
            pieces = PIECE.findall(w)
            if "".join(pieces) == w:
                pieces[0] = " " + pieces[0]
                cut[w] = pieces
            else:
                whole.append(" " + w)
        encode(set().union(*cut.values()) - known_pieces.keys(), known_pieces)
        known.update((w, sum(map(known_pieces.__getitem__, p))) for w, p in cut.items())
        counts = {}
        encode(whole, counts)
        known.update((w[1:], n) for w, n in counts.items())

    def count(found):
        parts = [words_of(text) for text in found]
        starts = [p.pop(0) if p else "" for p in parts]
        learn(set().union(*parts) - known.keys())
        first = tokenizer.encode_batch_fast(starts, add_special_tokens=False)
        sums = [len(e) + sum(map(known.__getitem__, p)) for e, p in zip(first, parts)]
        for memory in (known, known_pieces):
            if len(memory) > REMEMBERED:
                memory.clear()
        return sums

    return count


def _count_whole(json):
    def run(batches):
        count = _counter(json)
        for batch in batches:
            # Texts become Python's a block at a time.
            found = (text.as_py() for text in batch.column("text"))
            sums = [n for block in blocks(found, len, AT_ONCE) for n in count(block)]
            kept = [batch.column(name) for name in COUNTED]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sums, pa.int64())], names=[*COUNTED, "n_tokens"])

    return run


COUNTED = ["row", "doc_id", "n_bytes"]


def boundaries(encoding):
    """Where pre-tokens start, in characters, and how many tokens come before each."""
    starts, last = [], None
    for i, (word, (start, _)) in enumerate(zip(encoding.word_ids, encoding.offsets)):
        if word != last:
            starts.append((start, i))
        last = word
    return starts


def _encode_chunks(json):
    def run(frames):
        tokenizer = _tokenizer(json)
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                encoding = tokenizer.encode(row.text, add_special_tokens=False)
                found = [(row.start + at, i) for at, i in boundaries(encoding)]
                left = [p for p in found if row.k and p[0] < row.start + row.overlap]
                last = row.start + len(row.text) - MARGIN
                right = [p for p in found if not row.last and row.next <= p[0] <= last]
                out.append((
                    row.row, row.k, len(encoding),
                    [p[0] for p in left], [p[1] for p in left],
                    [p[0] for p in right], [p[1] for p in right],
                ))
            yield pd.DataFrame(out, columns=SPLICE_COLUMNS)

    return run


SPLICE_COLUMNS = ["row", "k", "n", "left_at", "left_n", "right_at", "right_n"]
SPLICE = (
    "row long, k long, n long, left_at array<long>, left_n array<long>, "
    "right_at array<long>, right_n array<long>"
)


def _spliced(huge, json, chunk, overlap):
    """Token counts of the documents of ``huge``; null where a seam has no common boundary.

    A chunk reaches ``overlap`` characters into the next. Where both have a pre-token
    boundary at the same place, what follows is encoded alike from there on, in the chunks
    as in the whole text, because a pre-token depends on nothing before it. So the left
    chunk counts up to that place and the right one from it on.
    """
    size = F.length("text")
    n_chunks = F.greatest(F.lit(1), F.ceil((size - F.lit(overlap)) / F.lit(chunk))).cast("long")
    pieces = huge.select("*", F.explode(F.sequence(F.lit(0).cast("long"), n_chunks - 1)).alias("k"))
    start = F.col("k") * chunk
    last = F.col("k") == n_chunks - 1
    pieces = pieces.select(
        "row", "k", start.alias("start"), (start + chunk).alias("next"), last.alias("last"),
        F.lit(overlap).alias("overlap"),
        F.substr("text", (start + 1).cast("int"), F.when(last, size).otherwise(chunk + overlap))
        .alias("text"),
    )
    encoded = pieces.repartition("row", "k").mapInPandas(_encode_chunks(json), SPLICE)
    order = Window.partitionBy("row").orderBy("k")
    after = F.lead(F.struct("left_at", "left_n")).over(order)

    def tokens_before(side):
        place = F.array_position(f"{side}_at", F.col("at"))
        return F.get(f"{side}_n", (place - 1).cast("int"))

    seams = encoded.withColumn("after", after).withColumn("at", F.try_element_at(
        F.array_intersect("right_at", "after.left_at"), F.lit(1)
    ))
    twice = F.when(F.col("after").isNull(), F.lit(0)).otherwise(
        F.col("n") - tokens_before("right") + tokens_before("after.left")
    )
    counted = seams.groupBy("row").agg(
        F.sum(F.col("n") - twice).alias("n_tokens"),
        F.count_if(twice.isNull()).alias("open_seams"),
    )
    return counted.select("row", F.when(F.col("open_seams") == 0, F.col("n_tokens")).alias("n_tokens"))


def token_counts(docs: DataFrame, tokenizer, limit=1024, chunk=CHUNK, overlap=OVERLAP) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document.

    ``tokenizer`` is the path of a byte-level tokenizer file on the driver. Counts equal the library's
    for the whole text, special strings in it included; no tokens are added. Null and
    empty texts have none. Rows that repeat are counted each. Texts of over ``chunk`` characters
    are encoded in chunks over all tasks; where two do not meet, the overlap is widened.
    """
    with open(tokenizer, encoding="utf-8") as file:
        json = file.read()
    rows = texts(docs).select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"), "text",
    )
    plain = rows.where(F.length("text") <= chunk).mapInArrow(
        _count_whole(json), "row long, doc_id long, n_bytes long, n_tokens long"
    )
    # Short texts are none of the chunks' business; without long ones there is nothing to splice.
    huge = stored(rows.where(F.length("text") > chunk), "huge-texts")
    parts, left = [plain.drop("row")], huge
    while not left.isEmpty():
        counted = stored(_spliced(left.select("row", "text"), json, chunk, overlap), "spliced")
        done = left.drop("text").join(counted.where("n_tokens is not null"), "row")
        parts.append(done.select("doc_id", "n_bytes", "n_tokens"))
        left = left.join(counted.where("n_tokens is null"), "row", "left_semi")
        overlap *= 4
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.withColumn("over_limit", F.col("n_tokens") > limit)
