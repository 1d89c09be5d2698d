"""Language-model scores by a log-bilinear model trained by noise-contrastive estimation.

The model predicts the class of the next token from the class of the one before: frequent words are
classes of their own, the others are classed by how they end. Within a class words have their
counts over all training tokens, each with a discount; what that frees goes to the one
outcome "a word that was not learnt", as the base score has it too. All outcomes together
have probability one after every token.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import blocks, stored, texts

END = b"\n"
# Words that are classes, endings that are classes, and words whose counts go to every task.
TOP, ENDINGS, HOT = 768, 255, 65_536
# Steps over all pairs, histories worked on at once, and noise for each pair.
WIDTH, STEPS, BATCH, NOISE = 32, 600, 4096, 256
PRIOR = 20.0
DISCOUNT = 0.75
BLOCK = 8 << 20


def tokens_of(text):
    """Words between ASCII white space with A-Z in lower case, then the end."""
    words = text.encode("utf-8", "replace").lower().split()
    words.append(END)
    return words


class LogBilinear:
    """log p(target | history) = target vector . sum of history vectors + bias, normalised."""

    def __init__(self, places, histories, targets, width=WIDTH, seed=7):
        self.rng = np.random.default_rng(seed)
        self.history = self.rng.normal(0, 0.1, (places, histories, width)).astype(np.float32)
        self.target = self.rng.normal(0, 0.1, (targets, width)).astype(np.float32)
        self.bias = np.full(targets, -np.log(targets), np.float32)

    def fit(self, histories, targets, weights, steps=STEPS, batch=BATCH, noise=NOISE, rate=0.15, prior=0.0):
        """Tell pairs counted by ``weights`` from ``noise`` times as many by frequency alone.

        Nothing is drawn: each step passes over all pairs, ``batch`` histories at a time, with
        the noise as its expected number for every target. ``prior``: pairs added to each history
        by frequency alone, so that rare ones are not learnt by heart.
        """
        if not len(targets):
            return self
        frequency = np.bincount(targets, weights, len(self.bias)) + 1e-3 * weights.sum() / len(self.bias)
        frequency /= frequency.sum()
        self.bias[:] = np.log(frequency)
        expected = (frequency * noise).astype(np.float32)
        log_noise = (np.log(frequency) + np.log(noise)).astype(np.float32)
        given, row = np.unique(histories, axis=0, return_inverse=True)
        row = row.ravel()
        order = np.argsort(row, kind="stable")
        row, targets = row[order], np.asarray(targets)[order]
        usual = (prior / np.sum(weights) * frequency).astype(np.float32)
        weights = (np.asarray(weights, float)[order] / np.sum(weights)).astype(np.float32)
        parts = range(0, len(given), batch)
        limits = [np.searchsorted(row, [start, start + batch]) for start in parts]
        # Small, for the gradient of a pair is as small as its share of all.
        sums = [np.full_like(p, 1e-16) for p in (self.history, self.target, self.bias)]
        for _ in range(steps):
            grads = [np.zeros_like(p) for p in (self.history, self.target, self.bias)]
            for start, (low, high) in zip(parts, limits):
                places = given[start:start + batch]
                seen = np.tile(usual, (len(places), 1))
                np.add.at(seen, (row[low:high] - start, targets[low:high]), weights[low:high])
                hidden = sum(self.history[k][places[:, k]] for k in range(places.shape[1]))
                scores = hidden @ self.target.T + (self.bias - log_noise)
                true = 1 / (1 + np.exp(np.clip(-scores, -60, 60)))
                miss = seen - (seen + seen.sum(axis=1, keepdims=True) * expected) * true
                by_hidden = miss @ self.target
                for k in range(places.shape[1]):
                    np.add.at(grads[0][k], places[:, k], by_hidden)
                grads[1] += miss.T @ hidden
                grads[2] += miss.sum(axis=0)
            for value, grad, total in zip((self.history, self.target, self.bias), grads, sums):
                total += grad * grad
                value += rate * grad / np.sqrt(total)
        return self

    def log10(self, histories):
        """Log10 probabilities of all targets after each history, as a matrix."""
        hidden = sum(self.history[k][histories[:, k]] for k in range(histories.shape[1]))
        scores = hidden @ self.target.T + self.bias
        scores -= scores.max(axis=1, keepdims=True)
        scores -= np.log(np.exp(scores).sum(axis=1, keepdims=True))
        return scores / np.float32(np.log(10))


class Classes:
    """Classes of words: 0 to ``len(top) - 1`` the top words, then endings, then all others."""

    def __init__(self, top, endings):
        self.top = {w: i for i, w in enumerate(top)}
        self.endings = {e: len(top) + i for i, e in enumerate(endings)}
        self.other = len(top) + len(endings)
        self.number = self.other + 1

    def of_ending(self, word):
        return self.endings.get(word[-2:], self.other)

    def of(self, word):
        found = self.top.get(word)
        return self.of_ending(word) if found is None else found


class WordTable:
    """Log10 probabilities of words within their classes, from counts and words of each class."""

    def __init__(self, classes, totals):
        self.classes, self.totals = classes, totals

    def within(self, words, counts):
        """``p(word | class)``; a word with count 0 stands for all that were not learnt."""
        kind = np.array([self.classes.of_ending(w) for w in words], np.int64)
        total, distinct = self.totals[kind].T
        rest = np.where(total > 0, DISCOUNT * distinct / np.maximum(total, 1), 1)
        return np.log10(np.where(counts > 0, (counts - DISCOUNT) / np.maximum(total, 1), rest))


def _count_words(frames):
    for frame in frames:
        rows = zip(frame["text"], frame["train"])
        for block in blocks(rows, lambda r: len(r[0]), BLOCK):
            learnt, other = Counter(), Counter()
            for text, train in block:
                (learnt if train else other).update(tokens_of(text))
            words = list(learnt | other)
            yield pd.DataFrame({
                "word": words, "train": [learnt[w] for w in words], "other": [other[w] for w in words],
            })


def _count_pairs(classes, known):
    size = classes.number

    def run(frames):
        cells = np.zeros(size * size, np.int64)
        for frame in frames:
            for block in blocks(frame["text"], len, BLOCK):
                before, after = [], []
                for text in block:
                    kinds = [known[w] if w in known else classes.of_ending(w) for w in tokens_of(text)]
                    before.append(0)
                    before += kinds[:-1]
                    after += kinds
                pair = np.array(before, np.int64) * size + np.array(after, np.int64)
                cells += np.bincount(pair, minlength=size * size)
        at = np.flatnonzero(cells)
        yield pd.DataFrame({"before": at // size, "after": at % size, "n": cells[at]})

    return run


class Model:
    """What scoring needs: bounded tables that go to the tasks, and the counts of all words."""

    def __init__(self, counts, tokens, words, classes, hot, after, table):
        self.counts, self.tokens, self.words = counts, tokens, words
        self.classes, self.hot, self.after, self.table = classes, hot, after, table


def fit_lm(docs: DataFrame) -> Model:
    """Fit on the rows of ``docs`` (``text, train``) with ``train`` set; the others' words are listed too."""
    counts = docs.mapInPandas(_count_words, "word binary, train long, other long")
    counts = stored(counts.groupBy("word").agg(F.sum("train").alias("n")), "word-counts")
    tokens, distinct = counts.agg(F.sum("n"), F.count_if(F.col("n") > 0)).first()
    most = counts.where("n > 0").orderBy(F.col("n").desc(), "word").limit(HOT).collect()
    hot = {bytes(r["word"]): r["n"] for r in most}
    top = [END] + [w for w in list(hot)[:TOP] if w != END][:TOP - 1]
    rare = counts.join(
        F.broadcast(counts.sparkSession.createDataFrame([(w,) for w in top], "word binary")),
        "word", "left_anti",
    )
    ending = F.when(F.length("word") > 2, F.expr("substring(word, -2, 2)")).otherwise(F.col("word"))
    sums = rare.where("n > 0").groupBy(ending.alias("ending")).agg(
        F.sum("n").alias("n"), F.count("*").alias("words")
    )
    named = sums.orderBy(F.col("n").desc(), "ending").limit(ENDINGS).collect()
    classes = Classes(top, [bytes(r["ending"]) for r in named])
    totals = np.zeros((classes.number, 2))
    for row in named:
        totals[classes.endings[bytes(row["ending"])]] = row["n"], row["words"]
    whole = sums.agg(F.sum("n"), F.sum("words")).first()
    totals[classes.other] = np.array([whole[0] or 0, whole[1] or 0]) - totals.sum(axis=0)

    known = {w: classes.of(w) for w in hot}
    pairs = docs.where("train").select("text").mapInPandas(
        _count_pairs(classes, known), "before long, after long, n long"
    ).groupBy("before", "after").agg(F.sum("n").alias("n")).toPandas()
    model = LogBilinear(1, classes.number, classes.number)
    model.fit(pairs[["before"]].to_numpy(np.int64), pairs["after"].to_numpy(np.int64),
              pairs["n"].to_numpy(float), prior=PRIOR)
    # The product of all history with all target vectors: each row is normalised.
    after = model.log10(np.arange(classes.number)[:, None])
    return Model(counts, tokens or 0, distinct, classes, hot, after, WordTable(classes, totals))


SCORED = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, "
    "score double, rare array<binary>"
)


def _score_texts(model):
    classes, after = model.classes, model.after
    hot = list(model.hot)
    counts = np.array([model.hot[w] for w in hot], float)
    kinds = np.array([classes.of(w) for w in hot], np.int64)
    inside = np.zeros(len(hot))
    lower = np.flatnonzero(kinds >= len(classes.top))
    if len(lower):
        inside[lower] = model.table.within([hot[i] for i in lower], counts[lower])
    size = model.tokens + model.words + 1
    base = np.log10((counts + 1) / size)
    number = {w: i for i, w in enumerate(hot)}
    # The end is a class even if no text was learnt from.
    end = classes.of(END)

    def run(frames):
        for frame in frames:
            sums = []
            for block in blocks(frame.pop("text"), len, BLOCK):
                for text in block:
                    words = tokens_of(text)
                    at = np.array([number.get(w, -1) for w in words], np.int64)
                    unknown = np.flatnonzero(at < 0)
                    rare = [words[i] for i in unknown if words[i] != END]
                    kind = kinds[at] if len(kinds) else np.full(len(at), end)
                    kind[unknown] = [classes.of(words[i]) for i in unknown]
                    found = at[at >= 0]
                    lost_end = len(unknown) - len(rare)
                    score = after[np.r_[end, kind[:-1]], kind].sum(dtype=float)
                    sums.append((
                        len(words), len(found),
                        base[found].sum() - lost_end * np.log10(size),
                        score + inside[found].sum(), rare,
                    ))
            columns = ["n_tokens", "n_known", "base", "score", "rare"]
            yield pd.concat([
                frame.reset_index(drop=True), pd.DataFrame(sums, columns=columns)
            ], axis=1)

    return run


def _value_words(model):
    table, total = model.table, model.tokens + model.words + 1

    def run(frames):
        for frame in frames:
            words = [bytes(w) for w in frame["word"]]
            counts = frame["n"].to_numpy(float)
            yield pd.DataFrame({
                "word": words, "known": counts > 0, "word_base": np.log10((counts + 1) / total),
                "word_score": table.within(words, counts) if words else [],
            })

    return run


def score_texts(docs: DataFrame, held_out) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every text.

    The model learns from the rows for which the column ``held_out`` is not true. ``score`` is
    the log10 probability of all tokens, the end included, ``base_score`` that of
    add-one counts. Null texts are empty: one token. Without a row to learn from all classes
    are equally likely. Rare words are joined with their counts, frequent ones are known to
    each task, so no word is hot in the join.
    """
    rows = texts(docs, F.coalesce(held_out, F.lit(False)).alias("held_out"))
    model = fit_lm(rows.select("text", (~F.col("held_out")).alias("train")))
    scored = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text")
    scored = stored(scored.mapInPandas(_score_texts(model), SCORED), "scored", compression="zstd")
    hot = model.counts.sparkSession.createDataFrame([(w,) for w in model.hot], "word binary")
    values = model.counts.join(F.broadcast(hot), "word", "left_anti").mapInPandas(
        _value_words(model), "word binary, known boolean, word_base double, word_score double"
    )
    rare = scored.select("row", F.explode("rare").alias("word")).join(values, "word").groupBy("row").agg(
        F.count_if("known").alias("rare_known"), F.sum("word_base").alias("rare_base"),
        F.sum("word_score").alias("rare_score"),
    )
    whole = scored.drop("rare").join(rare, "row", "left").na.fill(0)
    return whole.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.col("rare_known")).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("rare_base")).alias("base_score"),
        (F.col("score") + F.col("rare_score")).alias("score"),
    )
