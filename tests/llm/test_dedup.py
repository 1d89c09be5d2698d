"""Exact and near deduplication against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import odd_documents, prose, table, with_clashes

from millrace.llm import exact, near
from millrace.llm.common import keep_once


def rows_of(frame):
    return [tuple(r) for r in frame.collect()]


def test_perfect_hash_gives_each_digest_a_slot_and_strangers_none():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 63, (5000, 4)).astype(np.uint64)
    levels = exact.perfect_hash(words)
    assert sorted(exact.slots(levels, words)) == list(range(5000))
    strangers = exact.slots(levels, words + np.uint64(1))
    assert strangers.max() < 5000
    assert exact.perfect_hash(words[:0]) == []


def test_exact_dedup_of_odd_rows(spark):
    docs = odd_documents()
    got = exact.exact_dedup(with_clashes(table(spark, docs)))
    groups = defaultdict(list)
    for doc_id, text in docs:
        groups[text or ""].append(doc_id)
    assert got.count() == len(docs)
    kept = Counter()
    for r in got.collect():
        text = next(t for t in groups if hashlib.sha256(t.encode()).digest() == bytes(r.digest))
        ids = [i for i in groups[text] if i is not None]
        assert r.keep_id == max(ids, default=None) and r.group_size == len(groups[text]) and r.known
        kept[text] += r.kept
    assert set(kept.values()) == {1}


def test_strangers_to_the_index_are_grouped_apart(spark):
    old = exact.digest_table(table(spark, [(1, "a"), (2, "b"), (3, "b")]))
    new = exact.digest_table(table(spark, [(9, "b"), (4, "c"), (5, "c"), (6, "d")]))
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.known) for r in exact.judge(
        new, exact.build_index(old, digests_per_shard=1), registered=False).collect()}
    assert got == {9: (3, 2, False, True), 4: (5, 2, False, False), 5: (5, 2, True, False),
                   6: (6, 1, True, False)}


@pytest.mark.parametrize("drop", [exact.drop_repeats, near.drop_near_copies])
def test_dropping_keeps_columns_and_one_of_each(spark, drop):
    docs = with_clashes(table(spark, odd_documents()))
    got = drop(docs)
    assert got.columns == docs.columns
    texts = [r.text or "" for r in got.collect()]
    assert len(texts) == len(set(texts))
    assert set(texts) <= {t or "" for _, t in odd_documents()}
    assert drop(docs.limit(0)).count() == 0


def test_keep_once_of_rows_stored_twice(spark):
    docs = table(spark, [(1, "a"), (1, "a"), (2, "b")])
    judged = exact.digest_table(docs).selectExpr("doc_id", "digest", "doc_id = 1 as kept")
    from pyspark.sql import functions as F

    assert rows_of(keep_once(docs, judged, F.unhex(F.sha2("text", 256)))) == [(1, "a")]


def shingles(text):
    words = "".join(c if c.isalnum() or ord(c) > 127 else " " for c in text.lower()).split()
    return [tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))] if words else []


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_alignment_is_the_edit_similarity():
    rng = random.Random(4)
    for _ in range(300):
        a = [rng.randint(0, 6) for _ in range(rng.randint(0, 30))]
        b = [x for x in a if rng.random() > 0.1] if rng.random() < 0.8 else a[::-1]
        for _ in range(rng.randint(0, 3)):
            b.insert(rng.randint(0, len(b)), rng.randint(0, 6))
        longest = max(len(a), len(b))
        true = 1 - edits(a, b) / longest if longest else 1.0
        got = near.aligned_similarity(np.array(a, np.uint32), np.array(b, np.uint32), 0.6)
        assert got == pytest.approx(true if true >= 0.6 - 1e-9 else 0.0)


def test_occurrences_are_labelled_and_order_is_kept():
    def sketch(text):
        with np.errstate(over="ignore"):
            s, n = near.shingle_hashes(*near.word_hashes([text]), 1)
            labelled = near.label_occurrences(s, n)
            return labelled, near.sketches(labelled, n)[0]

    labelled, _ = sketch("a b a a")
    assert len(set(labelled.tolist())) == 4
    forward, backward = sketch("one two three four")[1], sketch("four three two one")[1]
    assert (forward != backward).all()


def classes_by_force(texts):
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    lists = [shingles(t) for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            a, b = lists[i], lists[j]
            longest = max(len(a), len(b))
            if texts[i] == texts[j] or longest and a and b and (
                abs(len(a) - len(b)) <= 0.2 * longest and edits(a, b) <= 0.2 * longest
            ):
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(texts))]


def near_corpus():
    rng = random.Random(9)
    base = [prose(100 + i, 60) for i in range(12)]
    texts = list(base)
    for i, text in enumerate(base):
        for _ in range(i % 4):
            words = text.split()
            for _ in range(rng.randint(1, 4)):
                words[rng.randrange(len(words))] = "changed%d" % rng.randint(0, 9)
            texts.append(" ".join(words))
    passage = prose(50, 25)  # shared by many texts that are otherwise strangers
    texts += [passage + " " + prose(200 + i, 30) for i in range(40)]
    texts += ["", "", "!!", "one two", "One, two!", "word " * 80, "word " * 70]
    return texts


def test_near_classes_against_all_pairs(spark):
    texts = near_corpus()
    docs = table(spark, list(enumerate(texts)))
    got = {r.doc_id: r for r in near.near_classes(with_clashes(docs)).collect()}
    roots = classes_by_force(texts)
    members = defaultdict(list)
    for i, r in enumerate(roots):
        members[r].append(i)
    for ids in members.values():
        for i in ids:
            assert (got[i].class_id, got[i].class_size) == (max(ids), len(ids))
            assert got[i].kept == (i == max(ids))


def pairs_in_a_crowd():
    """Pairs with similarity 0.81 of texts that share a passage, 0.78 alike with all others."""
    passage = prose(300, 82)
    texts = []
    for i in range(60):
        begin = prose(400 + i, 3)
        texts += [" ".join([passage, begin, prose(500 + 2 * i + k, 19)]) for k in (0, 1)]
    return texts


def test_crowded_buckets_lose_no_link_just_over_the_limit(spark, monkeypatch):
    docs = table(spark, list(enumerate(pairs_in_a_crowd())))
    for texts, shingles in ((near.BLOCK_TEXTS, near.BLOCK_SHINGLES), (7, 1000)):
        monkeypatch.setattr(near, "BLOCK_TEXTS", texts)
        monkeypatch.setattr(near, "BLOCK_SHINGLES", shingles)
        got = {r.doc_id: (r.class_id, r.class_size) for r in near.near_classes(docs).collect()}
        assert got == {i: (i | 1, 2) for i in range(120)}


def chains():
    """Texts f, a, b: f-a 0.95 alike, a-b 0.80, f-b less; f has the least digest of the three."""
    out = []
    for i in range(40):
        middle = prose(600 + i, 104).split()
        end = list(middle)
        for place in (10, 30, 70, 90):
            end[place] = f"other{i}"
        a, b = " ".join(middle), " ".join(end)
        for k in range(10_000):
            f = " ".join([*middle[:50], f"first{k}", *middle[51:]])
            digests = [hashlib.sha256(t.encode()).digest() for t in (f, a, b)]
            if digests[0] == min(digests):
                break
        out += [f, a, b]
    return out


def test_members_that_joined_a_class_still_meet_the_strangers(spark):
    docs = table(spark, list(enumerate(chains())))
    got = {r.doc_id: (r.class_id, r.class_size) for r in near.near_classes(docs).collect()}
    assert got == {i: (i // 3 * 3 + 2, 3) for i in range(120)}


def test_near_classes_of_odd_rows(spark):
    docs = odd_documents()
    got = near.near_classes(table(spark, docs)).collect()
    assert len(got) == len(docs)
    assert sum(r.kept for r in got) == len({r.digest for r in got if r.kept})
    by_id = {r.doc_id: r.class_id for r in got if r.doc_id}
    assert by_id[9] == by_id[10] == 10 and by_id[5] == by_id[6] == by_id[18] == 18
    assert near.near_classes(table(spark, [])).count() == 0


def test_components_hang_on_the_least_node(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (9, 3), (5, 6), (9, 8)], "a int, b int")
    assert sorted(rows_of(near.components(edges))) == [(2, 1), (3, 1), (6, 5), (8, 1), (9, 1)]
