"""Secret scan in DataFrame functions: fixed patterns and sliding-window entropy."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed patterns, in the order of the kinds: the least length counts for the last group.
ASSIGN = (
    r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
KINDS = (
    ("assign", ASSIGN, 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
ENTROPY = "entropy"

# Strings that may be secrets: whole runs of these characters of at least a window.
WINDOW = 20
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
# Character class: its characters, how to recognise it, bits a window must have.
CLASSES = (
    ("hex", "0123456789abcdef", r"^(?:[0-9a-f]+|[0-9A-F]+)$", 2.9),
    (
        "base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-",
        r"^[A-Za-z0-9+/_-]+$", 3.7,
    ),
)
# Shapes that are no secrets: words, numbers, universally unique ids, paths of words.
ALLOWED_SHAPES = (
    r"^[A-Za-z]?[a-z]*$", r"^[A-Z]*$", r"^[0-9]*$",
    r"^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^[A-Za-z]*(?:[/_+-]+[A-Za-z]*)+$",
)


SPANS = "array<struct<start:int,end:int,hit:string>>"


# Matches whose positions are summed up together.
CHUNK = 64


def _chunks(array, size=CHUNK):
    """An array cut into arrays of ``size``; together they take as long as one."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(array), F.lit(1)), F.lit(size))
    return F.transform(starts, lambda k: F.slice(array, k, size))


def _matches(pattern, keep):
    """Spans of all leftmost non-overlapping matches in ``text``.

    What lies between the matches and the matches themselves, put end to end, are the text,
    so their lengths in code points give the positions: first within a chunk of matches, then
    moved by what the chunks before it add up to, so that many matches take no square of
    their number. ``keep`` says which matches count. A text without a match costs one search.
    """
    parts = F.arrays_zip(
        F.split("text", pattern, -1).alias("gap"),
        F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("hit"),
    )
    none = F.array().cast(SPANS)

    def add(done, part):
        start = done["at"] + F.length(part["gap"])
        end = start + F.coalesce(F.length(part["hit"]), F.lit(0))
        span = F.struct(start.alias("start"), end.alias("end"), part["hit"].alias("hit"))
        wanted = part["hit"].isNotNull() & keep(part["hit"])
        spans = F.when(wanted, F.concat(done["spans"], F.array(span))).otherwise(done["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    zero = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    local = F.transform(_chunks(parts), lambda chunk: F.aggregate(chunk, zero, add))
    begins = F.aggregate(
        local,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("begins")),
        lambda done, chunk: F.struct(
            (done["at"] + chunk["at"]).alias("at"),
            F.concat(done["begins"], F.array(done["at"])).alias("begins"),
        ),
        lambda done: done["begins"],
    )
    moved = F.zip_with(local, begins, lambda chunk, begin: F.transform(
        chunk["spans"],
        lambda s: F.struct(
            (s["start"] + begin).alias("start"), (s["end"] + begin).alias("end"), s["hit"].alias("hit")
        ),
    ))
    return F.when(F.col("text").rlike(pattern), F.flatten(moved)).otherwise(none)


def _fixed(pattern, group, least):
    if not group:
        return _matches(pattern, lambda hit: F.length(hit) >= least)
    return _matches(pattern, lambda hit: F.length(F.regexp_extract(hit, pattern, group)) >= least)


def _random_part(hit, alphabet, bits, window):
    """Where the first window of ``hit`` with enough entropy starts and the last one ends.

    The counts of the characters are kept as the window moves on: an entering character
    adds to the sum of c log2 c, a leaving one takes away, and the entropy is
    log2 w - sum / w. Both are -1 if no window has enough.
    """
    codes = F.transform(F.split(hit, ""), lambda c: F.instr(F.lit(alphabet), c))
    moves = F.arrays_zip(
        codes.alias("enters"),
        F.concat(F.array_repeat(F.lit(0), window), codes).alias("leaves"),
    )
    terms = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)])

    def move(state, step):
        enters, leaves = step["enters"], step["leaves"]
        same = (enters == leaves).cast("int")
        new, old = F.get(state["counts"], enters) - same, F.get(state["counts"], leaves)
        gone = F.when(leaves > 0, F.get(terms, old) - F.get(terms, old - 1)).otherwise(0.0)
        total = state["total"] - gone + F.get(terms, new + 1) - F.get(terms, new)
        counts = F.transform(
            state["counts"],
            lambda c, k: c + (k == enters).cast("int") - ((k == leaves) & (k > 0)).cast("int"),
        )
        end = state["end"] + 1
        enough = (end >= window) & (math.log2(window) - total / window >= bits - 1e-9)
        first = F.when((state["from"] < 0) & enough, end - window).otherwise(state["from"])
        last = F.when(enough, end).otherwise(state["to"])
        return F.struct(
            counts.alias("counts"), total.alias("total"), end.alias("end"),
            first.cast("int").alias("from"), last.cast("int").alias("to"),
        )

    zero = F.struct(
        F.array_repeat(F.lit(0), len(alphabet) + 1).alias("counts"), F.lit(0.0).alias("total"),
        F.lit(0).alias("end"), F.lit(-1).alias("from"), F.lit(-1).alias("to"),
    )
    whole = F.filter(moves, lambda step: step["enters"].isNotNull())
    return F.aggregate(whole, zero, move, lambda s: F.struct(s["from"], s["to"]))


def _entropy_spans(window, allow):
    """Random-looking parts of candidate strings that are not allowed ones."""
    def candidate(hit):
        allowed = hit.isin(list(allow)) if allow else F.lit(False)
        for shape in ALLOWED_SHAPES:
            allowed = allowed | hit.rlike(shape)
        return ~allowed

    def parts(span):
        # Characters are told apart by the narrowest class that holds the whole string.
        found = F.lit(None).cast("struct<from:int,to:int>")
        for name, alphabet, shape, bits in reversed(CLASSES):
            hit = F.lower(span["hit"]) if name == "hex" else span["hit"]
            part = _random_part(hit, alphabet, bits, window)
            found = F.when(span["hit"].rlike(shape), part).otherwise(found)
        return F.struct(span["start"].alias("start"), found.alias("part"))

    found = F.transform(F.col("candidates"), parts)
    random = F.filter(found, lambda s: s["part"]["to"] > 0)
    spans = F.transform(random, lambda s: F.struct(
        (s["start"] + s["part"]["from"]).alias("start"), (s["start"] + s["part"]["to"]).alias("end")
    ))
    return _matches(CANDIDATE, candidate), spans


def _free_of(spans, others):
    """Those of ``spans`` that touch none of ``others``, which are in order of their starts.

    A span is held against a whole chunk first, and against what is in it only if it reaches into it.
    """
    wide = F.transform(_chunks(others), lambda chunk: F.struct(
        F.array_min(F.transform(chunk, lambda b: b["start"])).alias("start"),
        F.array_max(F.transform(chunk, lambda b: b["end"])).alias("end"),
        chunk.alias("inside"),
    ))

    def touches(s, b):
        return (b["start"] < s["end"]) & (s["start"] < b["end"])

    return lambda chunks: F.filter(spans, lambda s: ~F.exists(
        chunks, lambda c: F.coalesce(touches(s, c), F.lit(False)) & F.exists(c["inside"], lambda b: touches(s, b))
    )), wide


def scan_secrets(docs: DataFrame, window=WINDOW, allow=()) -> DataFrame:
    """Add ``secrets`` to documents: an array of ``(start, kind, end)`` in order of position.

    ``kind`` is a place in ``KINDS``, or one past them for what entropy finds; positions are
    code points, the end exclusive. Entropy adds strings that touch no fixed pattern's match.
    ``allow`` lists strings that are known to be harmless. A null or empty text has none. Spans
    that start together are in order of their kinds; repeated rows are scanned each. A column
    ``secrets`` is replaced, all others are kept as they are, whatever their names.
    """
    # The row goes along as one column, so that no name of its own is in the way.
    scanned = docs.select(
        F.struct(*docs.columns).alias("_row"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )
    for kind, pattern, group, least in KINDS:
        scanned = scanned.withColumn(f"_{kind}", _fixed(pattern, group, least))

    def of_kind(name, number):
        return F.transform(F.col(name), lambda s: F.struct(
            s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end")
        ))

    base = F.concat(*[of_kind(f"_{kind}", i) for i, (kind, *_) in enumerate(KINDS)])
    candidates, random = _entropy_spans(window, allow)
    scanned = scanned.withColumn("_base", F.array_sort(base)).withColumn("candidates", candidates)
    scanned = scanned.withColumn("_random", random)
    free, chunks = _free_of(F.col("_random"), F.col("_base"))
    scanned = scanned.withColumn("_chunks", chunks).withColumn("_new", free(F.col("_chunks")))
    both = F.array_sort(F.concat("_base", of_kind("_new", len(KINDS))))
    kept = [F.col(f"_row.`{c}`") for c in docs.columns if c != "secrets"]
    return scanned.select(*kept, both.alias("secrets"))


def spans_text(spans):
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*[F.lit(kind) for kind, *_ in KINDS], F.lit(ENTROPY))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
    )))
