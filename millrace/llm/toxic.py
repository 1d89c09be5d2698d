"""Toxicity by a string-kernel support vector machine that tolerates gaps in words.

Two words are alike in the measure of the letter triples they share as subsequences, each
weighted down by the room it takes, so ``idxiot`` is still close to ``idiot``. The machine
is fitted on labelled sentences through landmark words; because the kernel has the triples
as explicit features, what is fitted folds into one weight per triple. Only Latin script is
judged: letters from U+0250 on have one code, so their words differ by length alone.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import blocks, stored

# Labelled documents the fit takes at most of each class.
FIT_TOXIC, FIT_CLEAN = 2000, 4000
# Words the fit takes at most, and landmarks of each class.
FIT_WORDS, LANDMARKS = 12_000, 96
DECAY, SPAN, LONGEST = 0.7, 8, 24
# Letters from which on a word is scaled by its own length.
FULL = 5
LETTERS = 32
THRESHOLD = 0.7
# What a text without any word scores before calibration.
NO_WORD = -2.0
REMEMBERED = 600_000

SPELT_OUT = re.compile(r"(?<!\w)\w(?:[^\w\s]?[ \t]\w){3,}(?!\w)")


def _codes():
    """Letter classes of code points: a-z 1 to 26, other letters 27 to 31, the rest 0."""
    table = np.zeros(0x250, np.uint8)
    for point in range(0x250):
        c = chr(point)
        if c.isalpha():
            table[point] = point - 96 if "a" <= c <= "z" else 27 + point % 5
    return table


CODES = _codes()


def words_of(text):
    """The distinct words of a text in lower case, letters spelt out one by one as a word."""
    low = text.lower()
    found = set(low.split())
    if SPELT_OUT.search(low):
        found.update(re.sub(r"\W", "", m.group()) for m in SPELT_OUT.finditer(low))
    return found


def letters_of(words):
    """Codes of the letters of all words in one array, and how many each word has."""
    points = np.frombuffer("\n".join(words).encode("utf-32-le", "replace"), "<u4")
    breaks = np.flatnonzero(points == 10)
    codes = np.where(points < len(CODES), CODES[np.minimum(points, len(CODES) - 1)], 31)
    kept = codes > 0
    before = np.concatenate([[0], np.cumsum(kept)])
    ends = np.concatenate([before[breaks], [before[-1]]])
    return codes[kept].astype(np.int64), np.diff(ends, prepend=0)


def _triples(length):
    """Places (i, j, k) of the triples of a word and the weight of each."""
    for i in range(length):
        for k in range(i + 2, min(length, i + SPAN)):
            for j in range(i + 1, k):
                yield i, j, k, DECAY ** (k - i + 1)


def _scale(length):
    """One over the norm a word of this length has if its triples are all different.

    The very short ones count as longer, or a single triple would say all.
    """
    return 1 / np.sqrt(sum(w * w for *_, w in _triples(max(length, FULL))))


def _matrix(codes, starts, length):
    return codes[starts[:, None] + np.arange(length)]


def triple_scores(codes, sizes, weights):
    """The sum of the weights of each word's triples; a long word scores as its best part."""
    out = np.full(len(sizes), NO_WORD, np.float32)
    starts = np.cumsum(sizes) - sizes
    for length in np.unique(sizes):
        if length < 3:
            continue
        rows = np.flatnonzero(sizes == length)
        width = min(int(length), LONGEST)
        parts = [_triples_sum(_matrix(codes, starts[rows] + s, width), weights)
                 for s in {*range(0, length - width, LONGEST // 2), length - width}]
        out[rows] = np.max(parts, axis=0)
    return out


def _triples_sum(letters, weights):
    columns = [np.ascontiguousarray(c) for c in letters.T]
    total = np.zeros(len(letters), np.float32)
    for i, first in enumerate(columns):
        for j in range(i + 1, min(len(columns), i + SPAN) - 1):
            pair = (first * LETTERS + columns[j]) * LETTERS
            for k in range(j + 1, min(len(columns), i + SPAN)):
                total += np.float32(DECAY ** (k - i + 1)) * weights[pair + columns[k]]
    return total * np.float32(_scale(len(columns)))


def features(word):
    """The triples of a word as a vector."""
    codes, _ = letters_of([word])
    codes = codes[:LONGEST]
    out = np.zeros(LETTERS ** 3, np.float32)
    for i, j, k, w in _triples(len(codes)):
        out[(codes[i] * LETTERS + codes[j]) * LETTERS + codes[k]] += w
    return out * np.float32(_scale(len(codes)))


def fit_words(words, labels, importance, landmarks=LANDMARKS, epochs=30):
    """Triple weights and intercept of the machine, from words with label 0 or 1.

    Landmarks are the most important words of each class; each word is mapped to its
    kernels with them, whitened by the landmarks' own (Nystroem), and the hinge loss is
    brought down by subgradient steps over all words.
    """
    labels = np.asarray(labels)
    chosen = np.concatenate([
        np.flatnonzero(labels == y)[np.argsort(-importance[labels == y], kind="stable")][:landmarks]
        for y in (1, 0)
    ])
    marks = np.stack([features(words[i]) for i in chosen])
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    kept = values > 1e-6 * values[-1]
    whiten = vectors[:, kept] / np.sqrt(values[kept])
    base = (whiten.T @ marks).T.astype(np.float32)
    codes, sizes = letters_of(words)
    x = np.stack([triple_scores(codes, sizes, np.ascontiguousarray(c)) for c in base.T], axis=1)
    x = np.where(sizes[:, None] < 3, 0, x).astype(np.float64)
    sign = np.where(labels == 1, 1.0, -1.0)
    share = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum()))
    beta, bias, mean, mean_bias = np.zeros(x.shape[1]), 0.0, np.zeros(x.shape[1]), 0.0
    steps = epochs * 10
    for t in range(1, steps + 1):
        active = (sign * (x @ beta + bias) < 1) * share * sign
        rate = 20 / np.sqrt(t)
        beta += rate * (active @ x - 1e-4 * beta)
        bias += 0.2 * rate * active.sum()
        if t > steps // 2:
            mean, mean_bias = mean + beta, mean_bias + bias
    n = steps - steps // 2
    return (base.astype(np.float64) @ (mean / n)).astype(np.float32), float(mean_bias / n)


def _decision_udf(weights, bias):
    """A column function: the decision value of a text's worst word."""
    packed, bias = weights.tobytes(), float(bias)

    @F.pandas_udf("double")
    def decision(batches: pd.Series) -> pd.Series:
        known, out = {}, []
        table = np.frombuffer(packed, np.float32)
        for block in blocks(batches, len):
            found = [words_of(text) for text in block]
            new = [w for w in set().union(*found) if w not in known]
            if new:
                known.update(zip(new, triple_scores(*letters_of(new), table).tolist()))
            out += [max(map(known.__getitem__, words), default=NO_WORD - bias) for words in found]
            if len(known) > REMEMBERED:
                known.clear()
        return pd.Series(np.maximum(np.array(out, float) + bias, NO_WORD))

    return decision


def _evidence(sentences):
    """In how many different contexts each word is in toxic and in clean sentences.

    A context is the word before. What copies of a sentence repeat counts once, so that
    the words of a much copied document say no more than those of any other.
    """
    words = F.filter(F.transform(
        F.split(F.lower("sentence"), r"\s+"), lambda w: F.regexp_replace(w, r"[^\p{L}]+", "")
    ), lambda w: w != "")
    before = F.concat(F.array(F.lit("")), "words")
    pairs = sentences.withColumn("words", words).select("label", F.explode(
        F.filter(F.arrays_zip(before.alias("before"), F.col("words").alias("word")),
                 lambda p: F.length(p["word"]) >= 3)
    ).alias("p")).select("label", "p.before", "p.word").distinct()
    return pairs.groupBy("word").agg(
        F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")
    )


def _telling(counts, rate, tests):
    """Whether counts lean to toxic sentences by far more than the best of so many tests would."""
    toxic, clean = counts.toxic.to_numpy(float), counts.clean.to_numpy(float)
    n = toxic + clean
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(toxic > 0, toxic * np.log(toxic / (n * rate)), 0)
        gain = gain + np.where(clean > 0, clean * np.log(clean / (n * (1 - rate))), 0)
    return (toxic > n / 2) & (gain > np.log(max(2, tests)) + 3)


class ToxicModel:
    """Triple weights with an intercept and a logistic calibration of the decision value."""

    def __init__(self, weights=None, bias=0.0, slope=1.0, offset=-4.0):
        empty = np.zeros(LETTERS ** 3, np.float32)
        self.weights = empty if weights is None else weights
        self.bias, self.slope, self.offset = bias, slope, offset

    def probability(self, text):
        """The probability that a text column holds a toxic text; null and empty texts too."""
        value = _decision_udf(self.weights, self.bias)(F.coalesce(text, F.lit("")))
        return 1 / (1 + F.exp(-(self.slope * value + self.offset)))


def fit_toxic(docs: DataFrame, labels: DataFrame) -> ToxicModel:
    """Fit on at most ``FIT_TOXIC`` and ``FIT_CLEAN`` labelled documents, taken by a hash of ``doc_id``.

    ``labels`` holds ``doc_id, label``; rows with a null in either are not used. Without
    both classes, or without a word that tells them apart, the model rejects nothing.
    """
    known = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(
        F.max("label").alias("label")
    )
    taken = [
        known.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        for y, n in ((1, FIT_TOXIC), (0, FIT_CLEAN))
    ]
    sample = taken[0].unionByName(taken[1])
    # What each sampled label stands for among all, where a limit cuts the classes unevenly.
    of_all = dict(known.groupBy("label").count().collect())
    shares = [max(1.0, of_all.get(y, 0) / n) for y, n in ((0, FIT_CLEAN), (1, FIT_TOXIC))]
    # The sample's size is bounded by the two constants, so it may be sent to every task.
    fitted = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(sample), "doc_id"
    ).select("label", F.coalesce("text", F.lit("")).alias("text")), "labelled-texts")
    sentences = fitted.select(
        "label", F.explode(F.split("text", r"[.!?\n]+")).alias("sentence")
    )
    evidence = stored(_evidence(sentences), "word-evidence")
    toxic, clean = _words_to_fit(evidence)
    if toxic.empty or clean.empty:
        return ToxicModel()
    for again in (True, False):
        both = pd.concat([toxic, clean])
        labels = np.r_[np.ones(len(toxic), int), np.zeros(len(clean), int)]
        importance = both[["toxic", "clean"]].max(axis=1).to_numpy(float)
        weights, bias = fit_words(list(both.word), labels, importance)
        if again:
            # The clean words that look worst are what the second fit has to learn from.
            worst = _clean(evidence).withColumn("value", _decision_udf(weights, bias)("word"))
            worst = worst.orderBy(F.col("value").desc(), "word").limit(FIT_WORDS // 3).toPandas()
            clean = pd.concat([clean, worst[~worst.word.isin(toxic.word)]])
            clean = clean.drop_duplicates("word")
    values = fitted.select("label", _decision_udf(weights, bias)("text").alias("value")).collect()
    slope, offset = _calibrate(np.array(values, float), shares)
    return ToxicModel(weights, bias, slope, offset)


def _clean(evidence):
    return evidence.where("clean > 0 and toxic <= clean")


def _words_to_fit(evidence):
    """The words that tell of toxic sentences, and clean ones, with their counts.

    A toxic document's sentences hold clean words too, so a word counts as toxic only if it
    is found there far too often for chance, by itself or, for the words left, by how it begins.
    """
    sums = evidence.agg(F.sum("toxic"), F.sum("clean"), F.count("*")).first()
    if not sums[0] or not sums[1]:
        return evidence.limit(0).toPandas(), evidence.limit(0).toPandas()
    rate, tests = sums[0] / (sums[0] + sums[1]), sums[2]

    def most_toxic(counts):
        """Where toxic sentences prevail: the first ``FIT_WORDS``, most frequent first."""
        rows = counts.where("toxic > clean").orderBy(F.col("toxic").desc(), counts.columns[0])
        return rows.limit(FIT_WORDS).toPandas()

    leaning = most_toxic(evidence)
    told = set(leaning.word[_telling(leaning, rate, tests)])
    starts = F.explode(F.array(*[
        F.when(F.length("word") > k, F.substring("word", 1, k)) for k in (4, 5, 6)
    ])).alias("start")
    rest = evidence.where(~F.col("word").isin(list(told))) if told else evidence
    by_start = most_toxic(rest.select(starts, "toxic", "clean").where("start is not null").groupBy(
        "start"
    ).agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    begins = tuple(by_start.start[_telling(by_start, rate, tests)])
    toxic = leaning[[w in told or w.startswith(begins) for w in leaning.word]]
    clean = _clean(evidence)
    common = clean.orderBy(F.col("clean").desc(), "word").limit(FIT_WORDS // 2).toPandas()
    rare = clean.orderBy(F.xxhash64("word"), "word").limit(FIT_WORDS).toPandas()
    clean = pd.concat([common, rare]).drop_duplicates("word")
    return toxic, clean[~clean.word.isin(toxic.word)]


def _calibrate(values, shares=(1.0, 1.0)):
    """Slope and offset that give the label's probability from the decision value.

    ``shares``: how many labels each clean and each toxic row stands for.
    """
    y, x = values[:, 0], np.clip(values[:, 1], NO_WORD, None)
    slope, offset = 1.0, 0.0
    # Targets a little inside 0 and 1 keep the curve finite when classes part cleanly.
    weight = np.where(y == 1, shares[1], shares[0])
    toxic = weight[y == 1].sum()
    total = weight.sum()
    target = np.where(y == 1, 1 - 1 / (toxic + 2), 1 / (total - toxic + 2))
    for _ in range(3000):
        miss = (1 / (1 + np.exp(-(slope * x + offset))) - target) * weight / total
        slope -= 4 * (miss @ x)
        offset -= 4 * miss.sum()
    return float(slope), float(offset)
