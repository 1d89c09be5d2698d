"""Fitted operators: toxicity, URL filter, language model."""

import random
import re
from collections import Counter
from math import exp, log10, sqrt

import numpy as np
import pandas as pd
import pytest
from helpers import odd_documents, prose, table, with_clashes
from pyspark.sql import functions as F

from millrace.llm import lm, toxic, urls

INSULTS = ["dumbass", "wretchy", "scumbag"]


def labelled(n=400, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = prose(seed * 10_000 + i, 40).split()
        bad = rng.random() < 0.3
        if bad:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        rows.append((i, " ".join(words), int(bad)))
    return rows


@pytest.fixture(scope="module")
def fitted(spark):
    rows = labelled()
    docs = table(spark, [(i, t) for i, t, _ in rows])
    labels = table(spark, [(i, y) for i, _, y in rows] + [(None, 1), (5000, None)], "doc_id long, label int")
    return toxic.fit_toxic(with_clashes(docs), labels)


def scores(spark, model, texts):
    docs = table(spark, list(enumerate(texts)))
    scored = docs.withColumn("p", model.probability(F.col("text"))).orderBy("doc_id").collect()
    return [r.p for r in scored]


def test_toxicity_on_texts_not_learnt_from(spark, fitted):
    rows = labelled(200, seed=2)
    got = scores(spark, fitted, [t for _, t, _ in rows])
    right = sum((p >= toxic.THRESHOLD) == y for p, (_, _, y) in zip(got, rows))
    assert right >= 196


def test_toxicity_tolerates_inserted_and_spelt_out_letters(spark, fitted):
    clean = prose(3, 30)
    odd = [clean + " " + w + " " + clean for w in ("d.u.m.b.a.s.s", "dumb-ass!", "s c u m b a g", "dumbaxss")]
    got = scores(spark, fitted, [clean, *odd])
    assert got[0] < 0.3 and min(got[1:]) > got[0] + 0.3


def test_toxicity_of_odd_rows(spark, fitted):
    got = scores(spark, fitted, [t for _, t in odd_documents()])
    assert all(0 <= p < toxic.THRESHOLD for p in got)
    nothing = toxic.fit_toxic(table(spark, odd_documents()), table(spark, [], "doc_id long, label int"))
    assert all(p < toxic.THRESHOLD for p in scores(spark, nothing, ["dumbass", None, ""]))
    assert scores(spark, fitted, []) == []


def test_triple_scores_are_the_kernel():
    def kernel(s, t):
        def features(word):
            out = Counter()
            for i in range(len(word)):
                for j in range(i + 1, len(word)):
                    for k in range(j + 1, min(len(word), i + toxic.SPAN)):
                        out[word[i] + word[j] + word[k]] += toxic.DECAY ** (k - i + 1)
            return out

        def scale(word):
            n = max(len(word), toxic.FULL)
            return sqrt(sum(toxic.DECAY ** (2 * (k - i + 1)) * (k - i - 1)
                            for i in range(n) for k in range(i + 2, min(n, i + toxic.SPAN))))

        a, b = features(s), features(t)
        return sum(a[x] * b[x] for x in a) / scale(s) / scale(t)

    words = ["idiot", "idxiot", "kindness", "abc", "aaaa", "mississippi"]
    got = toxic.triple_scores(*toxic.letters_of(words), toxic.features("idiot"))
    assert got == pytest.approx([kernel(w, "idiot") for w in words], rel=1e-4)


URLS = [
    None, "", "no scheme/x", "http://org", "http://Sub.Example.ORG/es/1?q#f", "https://org/a", "ftp://example.org/en/1",
    "http://notorg/x", "http://a.com/de/x", "http://a.com/fr/", "http://com/de/", "x://é.org/ü?a#b", "http://a.b\nc/d",
    "http://h#f/p", "http://h?q/p", "a://b://c/d", "http://example.org/en/22",
]


def parsed(url):
    if not url or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), path


def ruled(host, path):
    fits = [
        (len(rule), rule, verdict) for verdict, rule in urls.RULES
        for domain, _, rest in [rule.partition("/")]
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + rest)
    ]
    return max(fits)[1:] if fits else (None, None)


def some_urls():
    rng = random.Random(2)
    hosts = ["a.example.org", "b.net", "c.com", "x.example.com", "d.example.net"]
    return URLS + [f"http://{rng.choice(hosts)}/{rng.choice(['de', 'fr', 'en', 'es'])}/{rng.randint(1, 99)}" for _ in range(200)]


def test_url_rules_and_scores_by_force(spark):
    pages = table(spark, list(enumerate(some_urls())), "page_id long, url string")
    got = urls.judge_urls(with_clashes(pages)).collect()
    labels = {}
    for url in some_urls():
        host, path = parsed(url)
        if ruled(host, path)[0]:
            labels[host, path] = int(ruled(host, path)[1] == "block")
    labels = table(spark, [(h, p, y) for (h, p), y in labels.items()], "host string, path string, label int")
    weights = urls.fit(labels)
    grams = {}
    for r in urls.with_host_and_path(pages).withColumn("g", urls.grams()).collect():
        grams[r.page_id] = r.g
    for r in got:
        host, path = parsed(r.url)
        rule, verdict = ruled(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        g = grams[r.page_id]
        score = sum(weights[i] for i in g) / sqrt(len(g)) + weights[-1]
        assert r.block_score == pytest.approx(1 / (1 + exp(-score)))
        assert r.verdict == (verdict or ("block" if r.block_score > 0.5 else "allow"))
    assert {r.verdict for r in got} == {"allow", "block"}


def test_url_model_learns_and_is_native(spark):
    rows = [(f"bad{i}.net", "/casino/x", 1) for i in range(60)] + [(f"good{i}.net", "/news/x", 0) for i in range(60)]
    fit = table(spark, rows, "host string, path string, label int")
    pages = table(spark, [(1, "http://new.net/casino/y"), (2, "http://other.net/news/y")], "page_id long, url string")
    got = urls.judge_urls(pages, fit, rules=())
    assert [r.verdict for r in got.orderBy("page_id").collect()] == ["block", "allow"]
    assert not re.search("Python|Pandas|Arrow|Exchange", got._jdf.queryExecution().toString())
    none = urls.judge_urls(table(spark, [(1, None)], "page_id long, url string"))
    assert none.first().verdict == "allow"
    assert urls.judge_urls(table(spark, [], "page_id long, url string")).count() == 0


def lm_docs():
    rng = random.Random(4)
    names = [prose(i, 1) for i in range(300)]
    docs = odd_documents()
    docs += [(1000 + i, " ".join(rng.choices(names, weights=range(300, 0, -1), k=40)).title()) for i in range(120)]
    return docs + [(2000, "Nie gesehen\x0bwörter\x1cbeside\u00a0nbsp")]


def test_lm_base_scores_and_counts_by_force(spark, monkeypatch):
    monkeypatch.setattr(lm, "HOT", 50)
    monkeypatch.setattr(lm, "TOP", 20)
    docs = lm_docs()
    held = F.col("doc_id") % 5 == 2
    got = lm.score_texts(with_clashes(table(spark, docs)), held).collect()
    split = [[w for w in re.split("[\x20\x09-\x0d]+", (t or "")) if w] for _, t in docs]
    tokens = [[re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in s] + ["\n"] for s in split]
    out = [i is not None and i % 5 == 2 for i, _ in docs]
    counts = Counter(w for t, h in zip(tokens, out) if not h for w in t)
    n, v = sum(counts.values()), len(counts)
    want = sorted(
        (i or -1, h, len(t), sum(counts[w] > 0 for w in t), n, round(sum(log10((counts[w] + 1) / (n + v + 1)) for w in t), 6))
        for (i, _), t, h in zip(docs, tokens, out)
    )
    assert sorted(
        (r.doc_id or -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got
    ) == want
    assert all(r.score < 0 for r in got)
    better = [r for r in got if r.held_out and r.n_tokens > 20]
    assert sum(r.score for r in better) > sum(r.base_score for r in better)


def test_lm_is_normalised(spark, monkeypatch):
    monkeypatch.setattr(lm, "TOP", 10)
    model = lm.fit_lm(table(spark, lm_docs()).selectExpr("coalesce(text, '') as text", "true as train"))
    assert np.allclose((10.0 ** model.after).sum(axis=1), 1, atol=1e-4)
    within = pd.Series(0.0, range(model.classes.number))
    words = [w for w in model.hot if w not in model.classes.top]
    kinds = [model.classes.of(w) for w in words]
    for kind, value in zip(kinds, 10 ** model.table.within(words, np.array([model.hot[w] for w in words], float))):
        within[kind] += value
    for word, kind in {k: w for w, k in zip(words, kinds)}.items():
        rest = 10 ** model.table.within([kind], np.zeros(1))[0]
        assert within[word] + rest == pytest.approx(1)


def test_lm_without_anything_to_learn(spark):
    got = lm.score_texts(table(spark, [(1, "a b"), (2, None)]), F.lit(True)).orderBy("doc_id").collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got] == [(3, 0, 0, 0.0), (1, 0, 0, 0.0)]
    assert lm.score_texts(table(spark, []), F.lit(False)).count() == 0


def test_noise_contrastive_estimation_finds_the_conditional():
    rng = np.random.default_rng(1)
    true = rng.dirichlet(np.full(6, 0.5), 4)
    before, after = np.divmod(np.arange(24), 6)
    model = lm.LogBilinear(1, 4, 6, width=8).fit(before[:, None], after, true.ravel(), steps=1500, batch=1024, noise=64)
    assert np.abs(10.0 ** model.log10(np.arange(4)[:, None]) - true).max() < 0.06


def test_the_rarest_pairs_are_learnt_too():
    before, after = np.r_[np.repeat(np.arange(10), 20), 10], np.r_[np.tile(np.arange(20), 10), 3]
    counts = np.r_[np.full(200, 1e7), 40.0]
    model = lm.LogBilinear(1, 11, 20).fit(before[:, None], after, counts)
    got = 10.0 ** model.log10(np.arange(11)[:, None])
    assert got[10, 3] > 0.5 and np.abs(got[:10] - 0.05).max() < 0.02


def test_calibration_means_the_same_when_a_class_is_cut():
    rng = np.random.default_rng(3)
    toxic_rows = np.c_[np.ones(100), rng.normal(0.6, 0.7, 100)]
    clean_rows = np.c_[np.zeros(100), rng.normal(-0.6, 0.7, 100)]
    whole = toxic._calibrate(np.r_[toxic_rows, np.repeat(clean_rows, 9, axis=0)])
    assert toxic._calibrate(np.r_[toxic_rows, clean_rows], (9.0, 1.0)) == pytest.approx(whole)
