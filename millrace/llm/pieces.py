"""Piece encoding and decoding as a shortest path through a weighted transducer.

The transducer is compiled from a model file: the normaliser, as the model states it, writes spaces as
a mark and may put one before the text, arcs spell pieces, and characters without a piece leave as bytes. A state
is a place in the text with the piece that led there. In a model built by merging, an arc
weighs nothing where merging would leave the two pieces apart and is infinitely heavy where
it would join them, so that in the tropical semiring exactly one path is finite: the
model's own encoding. A merge that crosses the edge of two pieces is met, if at all, when
just those two stand alone, so looking at neighbours is enough.
"""

from __future__ import annotations

import re

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import blocks

MARK = "▁"
# Longer words are encoded one by one instead of side by side.
LONGEST = 64
REMEMBERED = 100_000
# Text encoded at once, and words that walk side by side: the more, the fewer steps, but the more memory.
BLOCK = 2 << 20
TOGETHER = 16384
NEVER = 1 << 30

WORDS = re.compile(f"{MARK}+[^{MARK}]*")
SPACES = re.compile(" +")
BASE = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1


class Normaliser:
    """How a model rewrites a text before pieces are looked for, as a function to words.

    What a model may ask for: a mark before the text (``prefix``), and no space at the ends nor more
    than one elsewhere (``squeeze``). Spaces become marks.
    """

    def __init__(self, prefix=True, squeeze=False):
        self.prefix, self.squeeze = prefix, squeeze

    def words(self, text):
        """The words a text is encoded as, each without the mark it begins with.

        The first one of a text that begins without a mark is ``None`` followed by that word.
        """
        if self.squeeze:
            text = SPACES.sub(" ", text.replace(MARK, " ")).strip(" ")
        if self.prefix or not text:
            return words_of(text)
        if text[0] in f" {MARK}":
            return words_of(text[1:]) or [""]
        first, *more = text.replace(MARK, " ").split(" ", 1)
        rest = words_of(more[0]) or [""] if more else []
        return [None, first, *rest]

    def spelt(self, text):
        """The text that decoding gives back."""
        text = text.replace(MARK, " ")
        return SPACES.sub(" ", text).strip(" ") if self.squeeze else text


class Transducer:
    """The compiled model: pieces with their weights, and how each of them comes about.

    ``ranks`` holds the cost of the merge that makes a piece. ``right`` and ``left`` list what
    stands at a piece's right and left end while it is merged: the piece there, when it
    came, and when it was merged away (times are the highest cost paid so far).
    """

    def __init__(self, pieces, scores, normal, byte_ids, normaliser):
        self.pieces, self.byte_ids, self.normaliser = pieces, byte_ids, normaliser
        self.ids = {pieces[i]: i for i in normal}
        self.ranks = {i: -scores[i] for i in normal}
        for piece in self.ids:
            if any(c not in self.ids for c in piece) or len(byte_ids) != 256:
                raise ValueError("pieces must consist of single-character pieces, and bytes of pieces")
        self.right, self.left, self.whole = {}, {}, set()
        for piece, i in self.ids.items():
            edges = self._edges(piece)
            if edges:
                self.whole.add(i)
                self.left[i], self.right[i] = edges
        self.longest = max(map(len, self.ids), default=1)

    def merge(self, text, seen=None):
        """The pieces of a short text by merging the cheapest pair, the leftmost first."""
        parts, at = list(text), 0
        while True:
            costs = [
                (self.ranks[i], k) for k in range(len(parts) - 1)
                if (i := self.ids.get(parts[k] + parts[k + 1])) is not None
            ]
            if not costs:
                return parts
            cost, k = min(costs)
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
            if seen is not None:
                seen(cost, parts, k)

    def _edges(self, piece):
        ends, time = ([[piece[0], -1, NEVER]], [[piece[-1], -1, NEVER]]), -1

        def seen(cost, parts, k):
            nonlocal time
            time = max(time, int(cost))
            for end, place in ((ends[0], 0), (ends[1], len(parts) - 1)):
                if k == place:
                    end[-1][2] = time
                    end.append([parts[k], time, NEVER])

        if len(self.merge(piece, seen)) > 1:
            return None
        return [[(self.ids[p], came, went) for p, came, went in end] for end in ends]

    def apart(self, a, b):
        """Whether merging leaves two neighbouring pieces apart."""
        text = self.pieces[a] + self.pieces[b]
        return self.merge(text) == [self.pieces[a], self.pieces[b]]

    def encode_word(self, word, memory):
        """The shortest path through one word, place by place."""
        last, n = [None] * (len(word) + 1), len(word)
        for end in range(1, n + 1):
            for start in range(end - 1, max(-1, end - 1 - self.longest), -1):
                i = self.ids.get(word[start:end])
                if i is None or i not in self.whole:
                    continue
                before = last[start]
                if before is not None and before >= 0:
                    key = (before, i)
                    if key not in memory:
                        memory[key] = self.apart(before, i)
                    if not memory[key]:
                        continue
                last[end] = i
                break
            else:
                last[end] = -1
        out, end = [], n
        while end:
            i = last[end]
            if i < 0:
                out += [self.byte_ids[b] for b in reversed(word[end - 1].encode("utf-8", "replace"))]
                end -= 1
            else:
                out.append(i)
                end -= len(self.pieces[i])
        return out[::-1]


class Tables:
    """The transducer as arrays, to walk through many words side by side.

    Made once, on the driver; tasks get the arrays, and remember for themselves what they found.
    """

    def __init__(self, transducer):
        self.t = t = transducer
        n = len(t.pieces)
        self.n, self.bytes = n, np.array(t.byte_ids, np.int32)
        with np.errstate(over="ignore"):
            self.powers = np.cumprod(np.r_[1, np.full(LONGEST + 1, BASE, np.uint64)].astype(np.uint64))
            inverse = pow(BASE, -1, 1 << 64)
            self.back = np.cumprod(np.r_[1, np.full(LONGEST + 1, inverse, np.uint64)].astype(np.uint64))
        self.hashes, self.lengths = np.zeros(n, np.uint64), np.zeros(n, np.int32)
        self.ranks, self.whole = np.zeros(n, np.int32), np.zeros(n, bool)
        for piece, i in t.ids.items():
            self.hashes[i] = sum((ord(c) + 1) * pow(BASE, k, 1 << 64) for k, c in enumerate(piece)) & MASK
            self.lengths[i], self.ranks[i], self.whole[i] = len(piece), t.ranks[i], i in t.whole
        self.lengths[self.bytes] = 1
        self._index(np.array(sorted(t.ids.values())))
        self.right, self.left = self._spines(t.right), self._spines(t.left)
        # From here on the arrays say what these did.
        t.right, t.left = {}, {}
        self._forget()

    def _forget(self):
        self.known = np.full(1 << 19, -1, np.int64)
        self.apart = np.zeros(1 << 19, bool)
        self.memory = {}

    def __getstate__(self):
        return {k: v for k, v in vars(self).items() if k not in ("known", "apart", "memory")}

    def __setstate__(self, state):
        vars(self).update(state)
        self._forget()

    def _index(self, ids):
        """Open addressing: a piece is within ``probes`` places of where its hash points."""
        bits = 19
        self.shift, size = np.uint64(64 - bits), 1 << bits
        self.keys, self.values = np.zeros(size, np.uint64), np.full(size, -1, np.int32)
        self.probes = 0
        for i, at in zip(ids, self._place(self.hashes[ids])):
            probe = 0
            while self.values[(at + probe) % size] >= 0:
                probe += 1
            self.keys[(at + probe) % size], self.values[(at + probe) % size] = self.hashes[i], i
            self.probes = max(self.probes, probe + 1)

    def _place(self, h):
        with np.errstate(over="ignore"):
            return ((h * np.uint64(0xD6E8FEB86659FD93)) >> self.shift).astype(np.int64)

    def find(self, h):
        """The pieces with these hashes, -1 where there is none."""
        at, out = self._place(h), np.full(len(h), -1, np.int32)
        left = None
        for probe in range(self.probes):
            where = at if left is None else at[left]
            where = (where + probe) % len(self.keys)
            ids = self.values[where]
            hit = (self.keys[where] == (h if left is None else h[left])) & (ids >= 0)
            if left is None:
                out[hit] = ids[hit]
                left = np.flatnonzero(~hit & (ids >= 0))
            else:
                out[left[hit]] = ids[hit]
                left = left[~hit & (ids >= 0)]
            if not len(left):
                break
        return out

    def _spines(self, ends):
        depth = max((len(e) for e in ends.values()), default=1)
        out = np.full((3, self.n, depth), -1, np.int32)
        for i, end in ends.items():
            out[:, i, :len(end)] = np.array(end).T
        return out

    def stay_apart(self, a, b):
        """For each pair of neighbours whether merging leaves them apart; answers are kept."""
        key = a.astype(np.int64) * self.n + b
        with np.errstate(over="ignore"):
            slot = ((key.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(45)).astype(np.int64)
        hit = self.known[slot] == key
        out = self.apart[slot]
        if not hit.all():
            miss = np.flatnonzero(~hit)
            pairs, where = np.unique(key[miss], return_inverse=True)
            answer = self._judge(pairs // self.n, pairs % self.n)[where]
            out[miss] = answer
            self.known[slot[miss]], self.apart[slot[miss]] = key[miss], answer
        return out

    def _judge(self, a, b):
        """A pair is joined if, while x ends the left and y begins the right one, x + y is cheapest.

        That is so if x + y costs less than what the two sides pay until one of them goes.
        Where the two are there in one instant only, the merges are replayed.
        """
        joined, unsure = np.zeros(len(a), bool), np.zeros(len(a), bool)
        for x, x_came, x_went in np.moveaxis(self.right, 2, 0):
            rows = np.flatnonzero((x[a] >= 0) & ~joined)
            left, right = a[rows], b[rows]
            first, first_came, first_went = x[left], x_came[left], x_went[left]
            for y, y_came, y_went in np.moveaxis(self.left, 2, 0):
                second = y[right]
                there = second >= 0
                if not there.all():
                    rows, right, second, first, first_came, first_went = (
                        v[there] for v in (rows, right, second, first, first_came, first_went)
                    )
                if not len(rows):
                    break
                came = np.maximum(first_came, y_came[right])
                second_went = y_went[right]
                both = np.flatnonzero(came <= np.minimum(first_went, second_went))
                one = first[both]
                with np.errstate(over="ignore"):
                    h = self.hashes[one] + self.hashes[second[both]] * self.powers[self.lengths[one]]
                z = self.find(h)
                some = np.flatnonzero(z >= 0)
                both, cost = both[some], self.ranks[z[some]]
                went = first_went[both]
                clear = came[both] < np.minimum(went, second_went[both])
                crosses = (cost < went) & (cost <= second_went[both])
                joined[rows[both[clear & crosses]]] = True
                unsure[rows[both[~clear]]] = True
        out = ~joined
        for k in np.flatnonzero(unsure & ~joined):
            out[k] = self.t.apart(int(a[k]), int(b[k]))
        return out

    def encode_words(self, words):
        """The ids of each word, as bytes of 32-bit numbers."""
        out = [None] * len(words)
        sizes = np.array([len(w) for w in words])
        order = np.argsort(sizes, kind="stable")
        for k in order[sizes[order] > LONGEST]:
            out[k] = np.array(self.t.encode_word(words[k], self.memory), np.int32).tobytes()
            if len(self.memory) > REMEMBERED:
                self.memory.clear()
        order = order[sizes[order] <= LONGEST]
        for part in np.array_split(order, max(1, len(order) // TOGETHER)):
            if len(part):
                for k, ids in zip(part, self._side_by_side([words[k] for k in part])):
                    out[k] = ids
        return out

    def _side_by_side(self, words):
        sizes = np.array([len(w) for w in words])
        width = sizes.max()
        points = np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-32-le", "replace"), "<u4")
        points = points.reshape(len(words), width).astype(np.uint64)
        sums = np.zeros((len(words), width + 1), np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum((points + np.uint64(1)) * self.powers[:width], axis=1, out=sums[:, 1:])
        last = np.full((width + 1, len(words)), -1, np.int32)
        sums = np.ascontiguousarray(sums.T)
        for end in range(1, width + 1):
            rows = np.flatnonzero(sizes >= end)
            for start in range(end - 1, max(-1, end - 1 - self.t.longest), -1):
                if not len(rows):
                    break
                with np.errstate(over="ignore"):
                    h = (sums[end][rows] - sums[start][rows]) * self.back[start]
                ids = self.find(h)
                fits = (ids >= 0) & self.whole[ids]
                tried = np.flatnonzero(fits)
                if start:
                    before = last[start][rows[tried]]
                    piece_before = (before < self.n) & self.whole[np.minimum(before, self.n - 1)]
                    both = tried[piece_before]
                    fits[both] = self.stay_apart(before[piece_before], ids[both])
                last[end][rows[fits]] = ids[fits]
                rows = rows[~fits]
            # No piece ends here: the character leaves as its byte, or marked n, as its bytes.
            points_here = points[rows, end - 1].astype(np.int64)
            last[end][rows] = np.where(points_here < 128, self.bytes[np.minimum(points_here, 127)], self.n)
        return self._walk_back(words, sizes, last)

    def _walk_back(self, words, sizes, last):
        width = len(last) - 1
        path = np.full((len(words), width), -1, np.int32)
        place, filled = sizes.copy(), np.full(len(words), width)
        rows = np.arange(len(words))
        lengths = np.r_[self.lengths, 1]
        while len(rows):
            ids = last[place[rows], rows]
            filled[rows] -= 1
            path[rows, filled[rows]] = ids
            place[rows] -= lengths[ids]
            rows = rows[place[rows] > 0]
        wide = (path == self.n).any(axis=1)
        out = []
        for k, word in enumerate(words):
            ids = path[k, filled[k]:]
            out.append(self._with_bytes(word, ids) if wide[k] else ids.tobytes())
        return out

    def _with_bytes(self, word, ids):
        out, at = [], 0
        for i in ids:
            if i == self.n:
                out += [self.t.byte_ids[b] for b in word[at].encode("utf-8", "replace")]
                at += 1
            else:
                out.append(i)
                at += self.lengths[i]
        return np.array(out, np.int32).tobytes()


def words_of(text):
    """What is encoded apart: pieces hold marks at their beginning only. Each lacks one mark."""
    if not text:
        return []
    if MARK not in text and "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    return [w[1:] for w in WORDS.findall(MARK + text.replace(" ", MARK))]


def _fields(message):
    """The numbered fields of a message in the format of model files: numbers, and bytes of the others."""
    at = 0

    def number():
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        field, kind = divmod(number(), 8)
        if kind == 0:
            yield field, number()
        else:
            size = number() if kind == 2 else {1: 8, 5: 4}[kind]
            yield field, message[at:at + size]
            at += size


def _normaliser(model):
    """The normaliser that a model states; one this module cannot compile is refused."""
    parts = {2: b"", 3: b""}
    for field, value in _fields(model):
        if field in parts:
            parts[field] += value  # a part given twice counts as one
    # Numbers of the fields, and what they are where they are left out.
    stated, trained = dict(_fields(parts[3])), dict(_fields(parts[2]))
    rules, prefix, squeeze, escape = (stated.get(k, v) for k, v in ((2, b""), (3, 1), (4, 1), (5, 1)))
    if rules or not escape or trained.get(24, 0):
        raise ValueError("the model's normaliser maps characters, keeps spaces, or marks the ends of words")
    return Normaliser(bool(prefix), bool(squeeze))


def load(path):
    """Compile a model file."""
    import sentencepiece

    with open(path, "rb") as file:
        data = file.read()
    model = sentencepiece.SentencePieceProcessor(model_proto=data)
    n = model.get_piece_size()
    byte_ids = [i for i in range(n) if model.is_byte(i)]
    normal = [
        i for i in range(n)
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    ]
    pieces = [model.id_to_piece(i) for i in range(n)]
    if any(MARK in p.lstrip(MARK) for p in pieces):
        raise ValueError("pieces must hold the mark at their beginning only")
    return Transducer(pieces, [model.get_score(i) for i in range(n)], normal, byte_ids, _normaliser(data))


def decoder(transducer):
    """A function from ids to text: pieces and bytes put together, without the space put first."""
    spelt = [p.replace(MARK, " ").encode() for p in transducer.pieces]
    for value, i in enumerate(transducer.byte_ids):
        spelt[i] = bytes([value])
    controls = set(range(len(spelt))) - set(transducer.ids.values()) - set(transducer.byte_ids)
    for i in controls:
        spelt[i] = b""
    first = b" " if transducer.normaliser.prefix else b""

    def decode(ids):
        return b"".join(map(spelt.__getitem__, ids)).removeprefix(first).decode("utf-8", "replace")

    return decode


def encoder(tables):
    """A function from texts to arrays of ids that remembers the words it has met."""
    known, bare = {}, {}
    words = tables.t.normaliser.words

    def learn(new, into, mark):
        into.update(zip(new, tables.encode_words([mark + w for w in new])))

    def encode(found):
        parts = [words(text) for text in found]
        firsts = {k: p[1] for k, p in enumerate(parts) if p and p[0] is None}
        for k in firsts:
            parts[k] = parts[k][2:]
        learn(list(set().union(*parts) - known.keys()), known, MARK)
        learn(list(set(firsts.values()) - bare.keys()), bare, "")
        out = []
        for k, part in enumerate(parts):
            start = bare[firsts[k]] if k in firsts else b""
            out.append(np.frombuffer(start + b"".join(map(known.__getitem__, part)), np.int32))
        for memory in (known, bare):
            if len(memory) > REMEMBERED:
                memory.clear()
        return out

    return encode


def _encode_udf(transducer):
    tables = Tables(transducer)

    @F.arrow_udf("ids array<int>, round_trip boolean")
    def encode_texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode, decode = encoder(tables), decoder(tables.t)
        spelt = tables.t.normaliser.spelt
        for batch in batches:
            ids, ends, same = [np.zeros(0, np.int32)], [0], []
            for block in blocks((text.as_py() for text in batch), len, BLOCK):
                found = encode(block)
                ids.append(np.concatenate(found))
                for mine, text in zip(found, block):
                    ends.append(ends[-1] + len(mine))
                    same.append(decode(mine.tolist()) == spelt(text))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids)))
            yield pa.StructArray.from_arrays([lists, pa.array(same, pa.bool_())], ["ids", "round_trip"])

    return encode_texts


def _decode_udf(transducer):
    transducer.right, transducer.left = {}, {}

    @F.arrow_udf("string")
    def decode_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decode = decoder(transducer)
        for batch in batches:
            yield pa.array([decode(ids.as_py()) for ids in batch], pa.string())

    return decode_ids


def with_pieces(docs: DataFrame, model) -> DataFrame:
    """Add ``ids``, the pieces of each whole text, and ``round_trip``: decoding gives the text back.

    ``model`` is the path of a model file on the driver. No begin or end pieces are added; a null
    or empty text has no ids. The text that decoding gives is the model's normal form: a mark in it is
    a space, and a model that squeezes spaces leaves out the others. Repeated rows are encoded
    each. Columns named ``ids`` or ``round_trip`` are replaced, others are kept as they are.
    """
    coded = _encode_udf(load(model))(F.coalesce(F.col("text"), F.lit("")))
    kept = [F.col(f"_row.`{c}`") for c in docs.columns if c not in ("ids", "round_trip")]
    # The row goes along as one column, so that no name of its own is in the way.
    rows = docs.select(F.struct(*docs.columns).alias("_row"), coded.alias("_coded"))
    return rows.select(*kept, "_coded.ids", "_coded.round_trip")


def decoded(ids, model):
    """The text of a column of ids."""
    return _decode_udf(load(model))(F.coalesce(ids, F.array().cast("array<int>")))
