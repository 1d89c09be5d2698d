"""Near-duplicate detection by Order MinHash, verified by banded alignment.

A sketch of a text holds the few smallest hashes among its five-word shingles, each labelled with
how often it has occurred before, in the order they have in the text. Two texts share a
sketch the more often the smaller the edit distance between them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import blocks, keep_once, stored, texts

WORDS = 5
SIMILARITY = 0.8
SKETCHES = 16
# Shingles in a sketch: more of them tell texts apart better and find pairs less often.
ORDER = 2
# Members of a bucket whose pairs are listed; those of more are compared block against block,
# in blocks of about so many texts and shingles.
FEW = 16
BLOCK_TEXTS, BLOCK_SHINGLES = 1024, 1 << 20
# Buckets of more blocks than this are parted by the lengths of their texts first.
BANDED = 4
# Shingles whose owners are multiplied at once.
WIDE = 4096

_BYTES = np.zeros(256, np.uint8)
_BYTES[128:] = 1
for _c in b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _BYTES[_c] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _mix(x):
    """Scramble 64-bit numbers, in place where possible."""
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return x


def word_hashes(found):
    """Hashes of the words of all texts in one array, and the number of words of each.

    Words are runs of ASCII letters and digits, in lower case, and of all bytes beyond ASCII.
    A word's hash is a polynomial of its bytes, taken from the running sums of the whole array.
    """
    data = [text.encode("utf-8", "replace") for text in found]
    raw = np.frombuffer(b" ".join([*data, b""]), np.uint8)
    inside = _BYTES[raw].astype(bool)
    edge = np.diff(inside.astype(np.int8), prepend=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    base = np.uint64(0x100000001B3)
    powers = np.empty(len(raw) + 1, np.uint64)
    powers[0] = 1
    powers[1:] = base
    np.multiply.accumulate(powers, out=powers)
    sums = np.zeros(len(raw) + 1, np.uint64)
    # From the end on, so that a word's sum carries the power of what comes after it.
    np.cumsum(((_LOWER[raw].astype(np.uint64) + np.uint64(1)) * powers[:-1]), out=sums[1:])
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    back = np.empty(len(raw) + 1, np.uint64)
    back[0] = 1
    back[1:] = inverse
    np.multiply.accumulate(back, out=back)
    hashes = _mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))
    limits = np.cumsum([0] + [len(d) + 1 for d in data])
    counts = np.diff(np.searchsorted(starts, limits))
    return hashes, counts


def shingle_hashes(hashes, counts, words=WORDS):
    """Hashes of all runs of ``words`` words within a text; a shorter text is one run."""
    total = len(hashes)
    padded = np.concatenate([hashes, np.zeros(words, np.uint64)])
    shingles = np.zeros(total, np.uint64)
    owner = np.repeat(np.arange(len(counts)), counts)
    for i in range(words):
        shifted = padded[i:i + total]
        same = np.concatenate([owner[i:], np.full(min(i, total), -1)]) == owner
        shingles = _mix(shingles + np.where(same, shifted, np.uint64(i + 1)))
    place = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
    n = np.minimum(counts, np.maximum(1, counts - words + 1))
    return shingles[place < np.repeat(n, counts)], n


def label_occurrences(shingles, sizes):
    """Shingles with how often each has occurred in its text before mixed in."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((np.arange(len(shingles)), shingles, owner))
    s, o = shingles[order], owner[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (o[1:] != o[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))
    labels = np.empty(len(s), np.uint64)
    labels[order] = (np.arange(len(s)) - first).astype(np.uint64)
    return _mix(shingles + labels * np.uint64(0xA24BAED4963EE407))


def sketches(shingles, sizes, number=SKETCHES, order=ORDER):
    """A row of ``number`` sketches for each text that has shingles, as signed numbers."""
    out = np.zeros((len(sizes), number), np.uint64)
    rows = np.flatnonzero(sizes)
    if not len(rows):
        return out.view(np.int64)
    kept = sizes[rows]
    starts = np.cumsum(kept) - kept
    worst = np.uint64(0xFFFFFFFFFFFFFFFF)
    for i in range(number):
        h = _mix(shingles ^ np.uint64((i + 1) * 0xC2B2AE3D27D4EB4F & 0xFFFFFFFFFFFFFFFF))
        places, chosen = [], []
        for _ in range(order):
            least = np.minimum.reduceat(h, starts)
            at = np.flatnonzero(h == np.repeat(least, kept))
            # One place for each text: the first, should hashes ever be equal.
            text = np.searchsorted(starts, at, side="right") - 1
            _, first = np.unique(text, return_index=True)
            places.append(at[first])
            chosen.append(np.where(least == worst, np.uint64(0), shingles[at[first]]))
            h[at[first]] = worst
        places, chosen = np.stack(places), np.stack(chosen)
        chosen = np.take_along_axis(chosen, np.argsort(places, axis=0, kind="stable"), axis=0)
        value = np.zeros(len(rows), np.uint64)
        for row in chosen:
            value = _mix(value + row)
        out[rows, i] = value
    return out.view(np.int64)


def _sketch_udf(number, order, words):
    @F.pandas_udf("array<long>")
    def sketch(batches: pd.Series) -> pd.Series:
        out = []
        with np.errstate(over="ignore"):
            for block in blocks(batches, len):
                shingles, sizes = shingle_hashes(*word_hashes(block), words)
                rows = sketches(label_occurrences(shingles, sizes), sizes, number, order)
                out += [row if n else row[:0] for row, n in zip(rows, sizes)]
        return pd.Series(out)

    return sketch


def aligned_similarity(a, b, least=SIMILARITY):
    """One minus the edits between two arrays over the longer length; 0 if under ``least``.

    Only the diagonals that so many edits can reach are followed: for each number of edits, the
    furthest place on each diagonal that it leads to.
    """
    longest = max(len(a), len(b))
    if not longest:
        return 1.0
    band = int((1 - least) * longest + 1e-9)
    if abs(len(a) - len(b)) > band:
        return 0.0
    # Common ends need no edits.
    short = min(len(a), len(b))
    differs = np.flatnonzero(a[:short] != b[:short])
    head = differs[0] if len(differs) else short
    a, b = a[head:], b[head:]
    short = min(len(a), len(b))
    differs = np.flatnonzero(a[len(a) - short:][::-1] != b[len(b) - short:][::-1])
    tail = differs[0] if len(differs) else short
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    if not len(a) or not len(b):
        return 1 - max(len(a), len(b)) / longest
    # What one holds more often than the other has to be edited in any case.
    values, codes = np.unique(np.concatenate([a, b]), return_inverse=True)
    surplus = np.bincount(codes[:len(a)], minlength=len(values)) - np.bincount(
        codes[len(a):], minlength=len(values)
    )
    if max(surplus[surplus > 0].sum(), -surplus[surplus < 0].sum()) > band:
        return 0.0
    n, m = len(a), len(b)
    diagonals = np.arange(-band, band + 1)
    reach = np.full(2 * band + 3, -2)  # of -band - 1 to band + 1
    goal = m - n + band + 1
    for edits in range(band + 1):
        if edits == 0:
            new = np.where(diagonals == 0, 0, -2)
        else:
            new = np.maximum(np.maximum(reach[1:-1] + 1, reach[:-2]), reach[2:] + 1)
            new[np.abs(diagonals) > edits] = -2
        new = np.minimum(new, np.minimum(n, m - diagonals))
        live = np.flatnonzero((new >= 0) & (new + diagonals >= 0))
        x = new[live]
        while len(live):
            y = x + diagonals[live]
            going = (x < n) & (y < m)
            live, x, y = live[going], x[going], y[going]
            equal = a[x] == b[y]
            live, x = live[equal], x[equal] + 1
            new[live] = x
        reach[1:-1] = np.where(new + diagonals >= 0, new, -2)
        if reach[goal] >= n:
            return 1 - edits / longest
    return 0.0


def _similarity_udf(least):
    @F.pandas_udf("double")
    def similarity(left: pd.Series, right: pd.Series) -> pd.Series:
        pairs = zip(left, right)
        return pd.Series([
            aligned_similarity(np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32), least)
            for a, b in pairs
        ])

    return similarity


def _shingles_udf(words):
    @F.pandas_udf("binary")
    def shingle_bytes(batches: pd.Series) -> pd.Series:
        out = []
        with np.errstate(over="ignore"):
            for block in blocks(batches, len):
                shingles, sizes = shingle_hashes(*word_hashes(block), words)
                ends = np.cumsum(sizes)
                low = shingles.astype(np.uint32)
                out += [low[e - n:e].tobytes() for e, n in zip(ends, sizes)]
        return pd.Series(out)

    return shingle_bytes


def links_between(shingles, sketches, roots, sides, i, least=SIMILARITY):
    """Pairs of rows that are alike, enough of them to connect what links connect.

    Rows of side 0 are compared with those of side 1, or with each other if there is none. Left
    out are pairs of one root, and those that share a sketch before the ``i``-th: another bucket
    compares them. What two texts do not have in common has to be edited, so only pairs with
    enough common shingles are aligned, and of these only what is not connected yet.
    """
    sizes = np.array([len(s) for s in shingles])
    with np.errstate(over="ignore"):
        labelled = label_occurrences(np.concatenate(shingles).astype(np.uint64), sizes)
    _, codes, times = np.unique(labelled, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    common = times[codes] > 1
    codes, owner = (np.cumsum(times > 1) - 1)[codes[common]], owner[common]
    order = np.argsort(codes, kind="stable")
    codes, owner = codes[order], owner[order]
    left = np.flatnonzero(sides == 0)
    right = np.flatnonzero(sides == 1) if sides.any() else left
    shared = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, codes[-1] + 1 if len(codes) else 0, WIDE):
        low, high = np.searchsorted(codes, [start, start + WIDE])
        held = np.zeros((len(sizes), WIDE), np.float32)
        held[owner[low:high], codes[low:high] - start] = 1
        shared += held[left] @ held[right].T
    longest = np.maximum.outer(sizes[left], sizes[right])
    possible = longest - shared <= ((1 - least) * longest + 1e-9).astype(np.int64)
    possible &= roots[left][:, None] != roots[right]
    if right is left:
        possible = np.triu(possible, 1)
    for k in range(i):
        possible &= sketches[left, k][:, None] != sketches[right, k]
    x, y = np.nonzero(possible)
    best = np.argsort(-shared[x, y] / longest[x, y], kind="stable")
    parent = list(range(roots.max() + 1))

    def root(n):
        while parent[n] != n:
            parent[n] = n = parent[parent[n]]
        return n

    found = []
    for a, b in zip(left[x[best]].tolist(), right[y[best]].tolist()):
        u, v = root(roots[a]), root(roots[b])
        if u != v and aligned_similarity(shingles[a], shingles[b], least) >= least:
            parent[u] = v
            found.append((a, b))
    return found


def _links_of_cell(least):
    def run(rows):
        found = links_between(
            [np.frombuffer(s, np.uint32) for s in rows["shingles"]], np.stack(rows["sketches"]),
            pd.factorize(rows["root"])[0], rows["side"].to_numpy(), int(rows["i"].iloc[0]), least,
        )
        nodes = rows["node"].to_numpy()
        return pd.DataFrame({"a": [nodes[x] for x, _ in found], "b": [nodes[y] for _, y in found]})

    return run


def linked(docs: DataFrame, nodes: DataFrame, least=SIMILARITY, words=WORDS) -> DataFrame:
    """``node, root`` of the classes that verified links between different texts make.

    ``nodes`` holds a row per distinct text: ``node`` (its digest) and ``sketches``. Texts that
    share a sketch meet in a bucket, where each is first aligned with the first of them. In
    buckets that still hold several classes all pairs of different ones are compared, the class
    of the first too: pair by pair in buckets of up to ``FEW``, in larger ones block against
    block inside a task, so that rows are copied once per block and not once per partner.
    """
    members = stored(nodes.select("node", F.posexplode("sketches").alias("i", "sketch")).select(
        F.xxhash64("i", "sketch").alias("bucket"), "i", "node"
    ), "sketch-buckets")
    crowd = stored(_meeting(members), "bucket-members")
    wanted = crowd.select("node").distinct()
    shingled = docs.select("text", node_of(F.col("text")).alias("node")).join(
        wanted, "node", "left_semi"
    )
    shingled = shingled.groupBy("node").agg(F.first("text").alias("text"))
    shingled = stored(
        shingled.select("node", _shingles_udf(words)("text").alias("shingles")), "shingles"
    )
    pairs = crowd.where("node <> first").select(
        F.col("first").alias("a"), F.col("node").alias("b")
    ).distinct()
    judged = stored(_aligned(pairs, shingled, least), "aligned-pairs")
    roots = components(judged.where("alike"))
    rest = _rooted(_rooted(crowd, roots, "node"), roots, "first").select(
        "bucket", "i", "node", F.col("node_root").alias("root"),
        (F.col("node_root") != F.col("first_root")).alias("apart"),
    )
    rest = stored(rest, "rooted-members")
    sizes = rest.groupBy("bucket").agg(
        F.count("*").alias("n"), F.min("node").alias("least"),
        F.bit_xor(F.xxhash64("node")).alias("who"),
        F.min("root").alias("low"), F.max("root").alias("high"),
    )
    # Where all are of one class by now, nothing is left to find.
    sizes = stored(sizes.where("low <> high").drop("low", "high"), "unsettled-buckets")
    if sizes.isEmpty():
        return roots
    few = _small_sets(rest, sizes).distinct().join(judged, ["a", "b"], "left_anti")
    few = stored(_aligned(few, shingled, least), "aligned-pairs").where("alike").select("a", "b")
    many = stored(_across(rest, sizes, nodes, shingled, least), "block-links")
    known = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    return components(known.unionByName(few).unionByName(many))


def _rooted(rows, roots, column):
    """Add the root of a node column, the node itself where it has no link."""
    named = roots.select(F.col("node").alias(column), F.col("root").alias(f"{column}_root"))
    rooted = rows.join(named, column, "left")
    return rooted.withColumn(f"{column}_root", F.coalesce(f"{column}_root", column))


def _meeting(members):
    """Members of buckets that hold several texts, with the first of their bucket."""
    counted = members.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("first"))
    return members.join(counted.where("n > 1").drop("n"), "bucket")


def _small_sets(rest, sizes):
    """Pairs of members of buckets of up to ``FEW``; buckets with the same members count once."""
    sets = sizes.where(F.col("n").between(2, FEW)).groupBy("n", "least", "who").agg(
        F.min("bucket").alias("bucket")
    )
    member = rest.join(sets.select("bucket"), "bucket", "left_semi")
    left = member.select("bucket", F.col("node").alias("a"), F.col("root").alias("a_root"))
    right = member.select("bucket", F.col("node").alias("b"), F.col("root").alias("b_root"))
    return left.join(right, "bucket").where("a < b and a_root <> b_root").select("a", "b")


def _across(rest, sizes, nodes, shingled, least):
    """Links ``a, b`` between the members of buckets of more than ``FEW``.

    Members are dealt to blocks by their length and a hash, those of the first's class apart.
    Each two blocks that may hold a link make a cell: the first's class is not compared with
    itself, and lengths that differ more than links allow never meet.
    """
    large = sizes.where(F.col("n") > FEW).select("bucket", "n")
    size = shingled.select("node", (F.octet_length("shingles") / 4).alias("size"))
    # Texts with a link are of one band or of neighbouring ones.
    band = F.floor(F.log("size") / -np.log(0.99 * least))
    rows = rest.join(large, "bucket").join(size, "node").select(
        "bucket", "i", "node", "root", "apart", "size",
        F.when(F.col("n") > BANDED * BLOCK_TEXTS, band).otherwise(0).alias("band"),
    )
    part = ["bucket", "band", "apart"]
    parts = rows.groupBy(part).agg(F.greatest(
        F.ceil(F.count("*") / BLOCK_TEXTS), F.ceil(F.sum("size") / BLOCK_SHINGLES)
    ).alias("blocks"))
    parts = stored(parts, "bucket-parts")
    blocks_ = parts.select("bucket", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("block"),
                           "band", "apart")
    one, other = [
        blocks_.select("bucket", F.struct("band", "apart", "block").alias(name)) for name in ("l", "r")
    ]
    cells = one.join(other, "bucket").where(
        "l <= r and abs(l.band - r.band) <= 1 and (l.apart or r.apart)"
    )
    cells = stored(cells, "bucket-cells")
    sides = [cells.select("bucket", "l", "r", F.lit(0).alias("side"), f"{c}.band", f"{c}.apart",
                          f"{c}.block") for c in ("l", "r")]
    sides = sides[0].unionByName(sides[1].where("l <> r").withColumn("side", F.lit(1)))
    dealt = rows.join(parts, part).withColumn("block", F.expr("pmod(xxhash64(node), blocks)"))
    dealt = dealt.select(*part, "block", "i", "node", "root").join(sides, [*part, "block"])
    held = shingled.join(nodes, "node")
    dealt = dealt.join(held, "node").select(
        "bucket", "l", "r", "side", "i", "node", "root", "shingles", "sketches"
    )
    return dealt.groupBy("bucket", "l", "r").applyInPandas(
        _links_of_cell(least), "a binary, b binary"
    )


def _aligned(pairs, shingled, least):
    left = shingled.select(F.col("node").alias("a"), F.col("shingles").alias("_a"))
    right = shingled.select(F.col("node").alias("b"), F.col("shingles").alias("_b"))
    both = pairs.join(left, "a").join(right, "b")
    return both.select("a", "b", (_similarity_udf(least)("_a", "_b") >= least).alias("alike"))


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for each node of the graph, ``root`` the least node it is connected to.

    Alternates two steps that hang the neighbours of each node on the least one, the
    larger ones first and then the smaller ones, until all hang on the roots.
    """
    def hang(pairs):
        least = pairs.groupBy("u").agg(F.min("v").alias("m"))
        return pairs.join(least.select("u", F.least("u", "m").alias("m")), "u")

    def both_ways(pairs):
        return pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))

    def downwards(pairs):
        return pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where(
            "u <> v"
        ).distinct()

    def print_of(pairs):
        return pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()

    now = stored(downwards(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))), "edges")
    before = print_of(now)
    while True:
        larger = hang(both_ways(now)).where("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")
        )
        hung = hang(larger)
        smaller = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            hung.select("u", F.col("m").alias("v"))
        )
        now = stored(downwards(smaller), "edges")
        after = print_of(now)
        if after == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = after


def node_of(text):
    return F.unhex(F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 32))


def near_classes(
    docs: DataFrame, least=SIMILARITY, number=SKETCHES, order=ORDER, words=WORDS
) -> DataFrame:
    """Each document with its class of near copies: ``row, doc_id, digest, class_id, class_size, kept``.

    Two texts are near copies if the edits between their sequences of five-word shingles are at
    most a fifth of the longer one; classes are what such links connect. ``class_id`` is the
    largest ``doc_id`` of the class (a null one counts as smallest), and that row alone is
    kept. Texts of fewer words are one shingle. Texts without any word, null and empty ones
    too, are classes only with texts equal to theirs. Other columns are not looked at.
    """
    table = stored(texts(docs).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", node_of(F.col("text")).alias("digest"),
        _sketch_udf(number, order, words)("text").alias("sketches"),
    ), "sketches")
    nodes = stored(table.groupBy(F.col("digest").alias("node")).agg(
        F.first("sketches").alias("sketches")
    ), "distinct-texts")
    roots = linked(docs, nodes, least, words).select(F.col("node").alias("digest"), "root")
    rows = table.select("row", "doc_id", "digest")
    rooted = rows.join(roots, "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    rooted = stored(rooted, "rooted")
    last = F.max(F.struct("doc_id", "row")).alias("last")
    classes = rooted.groupBy("root").agg(last, F.count("*").alias("class_size"))
    return rooted.join(classes, "root").select(
        "row", "doc_id", "digest", F.col("last.doc_id").alias("class_id"), "class_size",
        (F.col("row") == F.col("last.row")).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """One document of each class, with all its columns."""
    return keep_once(docs, near_classes(docs, **options), node_of(F.col("text")))
