"""Resampling, packing and clustering against brute force, and their registered queries."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict
from itertools import groupby

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from helpers import odd_documents, prose, table, with_clashes
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from millrace.llm import centroids, packing, resample

BPE = public_tokenizers.path("byte_bpe_50k.json")
CLIP = public_tokenizers.path("word_bpe_49k.json")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def rows_of(frame):
    return Counter(map(tuple, frame.collect()))


def parquet(sf_dir, name, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{sf_dir}/{name}.parquet'").fetchall()


# Importance resampling


def features(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def buckets(texts):
    return Counter(zlib.crc32(f.encode()) % 10000 for t in texts for f in features(t)[1])


def plain_resample(docs, target, share=5, least=20):
    s, t = buckets(x for _, x in docs), buckets(target)
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000))))
        for b in range(10000)
    ]
    out = []
    for doc_id, text in docs:
        n_words, found = features(text)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[zlib.crc32(f.encode()) % 10000] for f in found)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((n_words, doc_id, len(found), weight, score))
    chosen = sorted((o for o in out if o[0] >= least), key=lambda o: (-o[4], o[1] is None, o[1] or 0))
    rest = [o for o in out if o[0] < least]
    drawn = share * len(chosen) // 100
    ranks = [i + 1 if i < drawn else None for i in range(len(chosen))] + [None] * len(rest)
    return Counter((*o[1:], rank) for o, rank in zip(chosen + rest, ranks))


def test_resampling_equals_brute_force_on_odd_documents(spark):
    docs = odd_documents() + [(100 + i, prose(i, 25)) for i in range(60)]
    docs += [(300, "A b\x00C\nd_e\x7ff 12é日 " * 9), (301, "w" * 700 + " " + "w" * 700 + " q" * 20), (302, "Ä É x")]
    target = [prose(5, 30), None, prose(8, 20), "", docs[-2][1]]
    want = plain_resample(docs, target, share=30)
    got = resample.resample(
        with_clashes(table(spark, docs)).repartition(3), table(spark, [(i, t) for i, t in enumerate(target)]), share=30,
    )
    assert rows_of(got) == want
    # Equal rows tie in everything; ids decide otherwise.
    assert sum(1 for r in want.elements() if r[4]) == 30 * sum(features(t)[0] >= 20 for _, t in docs) // 100


def test_resampling_of_nothing(spark):
    empty = table(spark, [])
    some = table(spark, [(1, prose(1, 30)), (2, None)])
    assert resample.resample(empty, some).count() == 0
    assert rows_of(resample.resample(some, empty, share=100)) == plain_resample([(1, prose(1, 30)), (2, None)], [], 100)


def test_words_are_interned_by_their_bytes():
    texts = [prose(1, 200), "", "a a a b a a", "ab c", "a bc", prose(1, 200), "y" * 300 + " x " + "y" * 300]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    for words in (1 << 17, 7):
        want, got = [Counter(), Counter()], [Counter(), Counter()]
        for k, text in enumerate(texts):
            for f in features(text)[1]:
                want[" " in f][k, zlib.crc32(f.encode()) % 10000] += 1
        for tables in resample.interned(data, offsets, words):
            for kind, (table, slots, of) in enumerate(tables):
                assert (np.bincount(slots, minlength=len(table.count)) == table.count).all()
                got[kind].update(zip(of.tolist(), table.bucket[slots].tolist()))
        assert got == want


def test_hashes_and_sums_are_those_of_the_bytes():
    rng = np.random.default_rng(3)
    for width in (1, 2, 3):
        rows = rng.integers(-5, 1 << 40, (50, width))
        assert resample.hash_rows(rows).tolist() == [xxhash.xxh64_intdigest(r.tobytes()) for r in rows]
    data = rng.integers(0, 256, 400, np.uint8)
    sizes = np.array([*range(0, 40), 100, 0])
    starts = rng.integers(0, 400 - sizes + 1)
    assert resample.hash_strings(data, starts, sizes).tolist() == [
        xxhash.xxh64_intdigest(data[a:a + n].tobytes()) for a, n in zip(starts, sizes)
    ]
    for size in (0, 1, 7, 64, 65):
        first, second = b"some", bytes(rng.integers(0, 256, size, np.uint8))
        joined = resample.crc_joined(*(np.array([zlib.crc32(x)], np.uint32) for x in (first, second)), np.array([size]))
        assert joined.tolist() == [zlib.crc32(first + second)]


def test_strings_with_one_key_are_told_apart(monkeypatch):
    """All keys equal: only the bytes decide."""
    monkeypatch.setattr(resample, "hash_strings", lambda data, starts, sizes: np.full(len(starts), 5, np.uint64))
    monkeypatch.setattr(resample, "hash_rows", lambda rows: np.full(len(rows), 7, np.uint64))
    text = "aa ab ac aa " + "z" * 300 + " " + "z" * 299 + "y ab"
    data = np.frombuffer(text.encode(), np.uint8)
    (tables,) = resample.interned(data, np.array([0, len(data)]))
    found = Counter(n for table, _, _ in tables for n in table.count[table.used].tolist())
    assert found == Counter(Counter(features(text)[1]).values())


def test_interning_needs_little_memory():
    """A task holds tables of some ten thousand words, however long its texts."""
    text = prose(9, 400_000)
    batch = resample.pa.RecordBatch.from_pylist([{"doc_id": 1, "text": text}] * 2)
    tracemalloc.start()
    try:
        list(resample._weigh(np.ones(resample.BUCKETS, np.int64))(iter([batch])))
        assert tracemalloc.get_traced_memory()[1] < 64 << 20
    finally:
        tracemalloc.stop()


def test_query_resamples_the_given_tables(spark, sf_dir):
    docs = parquet(sf_dir, "documents", "doc_id, text")
    target = [t for t, in parquet(sf_dir, "benchmark", "text")]
    assert rows_of(entry.queries()["op11_importance_resample"](spark, sf_dir)) == plain_resample(docs, target)


def test_ranks_go_on_from_range_to_range(spark):
    rows = spark.range(10_000).withColumn("v", F.col("id") % 97).repartition(7)
    got = resample.ranked(rows, [F.col("v").desc(), F.col("id").asc()]).collect()
    want = sorted(range(10_000), key=lambda i: (-(i % 97), i))
    assert [r.id for r in sorted(got, key=lambda r: r["rank"])] == want


# Packing


def check_packed(rows, docs, library, window):
    """Every token once, crc of each piece, sequences without gaps and none too full."""
    ids_of = defaultdict(list)
    for doc_id, text in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        ids_of[doc_id].append(np.array(ids, "<u4"))
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    assert pieces.keys() == ids_of.keys()
    for doc_id, texts in ids_of.items():
        want = Counter()
        for ids in texts:
            starts = packing.cuts(len(ids), window, packing.PIECE)
            for a, b in zip(starts, [*starts[1:], len(ids)]):
                want[a, b - a, zlib.crc32(ids[a:b].tobytes()), len(ids)] += 1
        assert Counter((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in pieces[doc_id]) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window
    return sum(r.length for r in rows) / (len(sequences) * window)


@pytest.mark.parametrize("path, window, group", [(BPE, 2048, 2048), (BPE, 100, 40), (CLIP, 512, 300)])
def test_packing_keeps_every_token_once(spark, path, window, group):
    docs = odd_documents() + [(100 + i, prose(i, 10 + 7 * i)) for i in range(80)]
    docs += [(400, " " * 3000 + "é" * 3000), (401, "<|endoftext|> <|endoftext|>x")]
    got = packing.pack(with_clashes(table(spark, docs)).repartition(3), path, window=window, group=group).collect()
    fill = check_packed(got, docs, Tokenizer.from_file(path), window)
    assert fill > 0.9
    assert packing.pack(table(spark, []), path).count() == 0


def test_both_encoders_give_the_librarys_ids():
    for path in (BPE, CLIP):
        with open(path, encoding="utf-8") as file:
            encode = packing.ids_encoder(file.read())
        library = Tokenizer.from_file(path)
        rng = random.Random(4)
        texts = [t or "" for _, t in odd_documents()] + [
            "".join(rng.choice("abcdé ß.,' \n\t019_<|>日\x00🙂") for _ in range(500)) for _ in range(50)
        ]
        texts += ["it's WE'LL don't 's", "a" * 5000, " " * 5000 + "x", "<|endoftext|>" * 3 + "<|endoftext"]
        for text in texts:
            assert encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_windows_are_near_equal_and_hold_what_fits():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 512, 900)
    m = 130
    fullest, at = packing.divide(sizes, m)
    sums = np.bincount(at, sizes, m)
    assert fullest == sums.max() and sums.max() - sums.min() < 0.05 * sums.mean()
    for sizes in (sizes, np.full(500, 410), np.full(7, 2047), np.array([1]), rng.integers(900, 1200, 300)):
        found = packing.fit(sizes)
        sums = np.bincount(found, sizes)
        assert sums.max() <= 2048
        if (sizes == 410).all():
            assert len(sums) == 125  # four of them make a window
    assert [packing.divide([3, 5, 4], 1)[0], packing.divide([8, 7, 6, 5, 4], 2)[0]] == [12, 16]


def test_query_packs_the_given_documents(spark, sf_dir):
    got = entry.queries()["op12_packing"](spark, sf_dir).collect()
    fill = check_packed(got, parquet(sf_dir, "documents", "doc_id, text"), Tokenizer.from_file(BPE), 2048)
    assert fill > 0.98


# Clustering


def plain_cluster(vectors, clusters=8, rounds=10, dimensions=64):
    bound = 1 << 27
    kept = [
        (i, [max(-bound, min(bound, math.floor(max(-1e300, min(1e300, 1024.0 * float(x)))))) for x in v])
        for i, v in vectors
        if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)
    ]
    if not kept:
        return Counter()

    def name(i):
        return hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest()

    places = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, p)), c) for c, p in enumerate(places))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        places = [
            [sum(x) // len(members[c]) for x in zip(*members[c])] if members[c] else p
            for c, p in enumerate(places)
        ]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = Counter()
    for _, c, d in found:
        inertia[c] += d
    digest = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in places]
    return Counter((i, c, d, inertia[c], sum(inertia.values()), digest[c]) for i, c, d in found)


def vectors_table(spark, vectors):
    return spark.createDataFrame(vectors, "vec_id long, embedding array<float>")


def test_clusters_equal_brute_force_on_odd_vectors(spark):
    rng = random.Random(3)

    def vector(scale=1.0):
        return [float(np.float32(rng.gauss(0, scale))) for _ in range(64)]

    same = vector()
    vectors = [(i, vector()) for i in range(60)] + [(100 + i, same) for i in range(9)] + [(100, same), (None, vector())]
    vectors += [
        (200, None), (201, []), (202, vector()[:63]), (203, vector() + [1.0]), (204, [None, *vector()[1:]]),
        (205, [float("nan"), *vector()[1:]]), (206, [float("-inf"), *vector()[1:]]), (207, [0.0] * 64),
        (208, [3e38] * 64), (209, [-3e38, *vector()[1:]]),
    ]
    frame = vectors_table(spark, vectors).withColumns({
        c: F.lit("x") for c in ("at", "cluster", "distance", "name", "inertia")
    })
    assert rows_of(centroids.cluster(frame.repartition(3))) == plain_cluster(vectors)
    few = vectors[:3]
    assert rows_of(centroids.cluster(vectors_table(spark, few))) == plain_cluster(few)
    assert centroids.cluster(vectors_table(spark, [])).count() == 0


def test_the_walk_finds_the_nearest_and_stops_early():
    rng = np.random.default_rng(2)
    for spread, k in ((3, 8), (1000, 8), (3, 1), (1000, 40)):
        places = rng.integers(-spread, spread, (k, 16))
        vectors = np.concatenate([rng.integers(-spread, spread, (500, 16)), places, places + 1])
        found, best = centroids.Lists(places).nearest(vectors)
        all_pairs = ((vectors[:, None, :] - places[None]) ** 2).sum(axis=2)
        assert (found == all_pairs.argmin(axis=1)).all() and (best == all_pairs.min(axis=1)).all()


def test_query_clusters_the_given_vectors(spark, sf_dir):
    vectors = parquet(sf_dir, "embeddings", "vec_id, embedding")
    assert rows_of(entry.queries()["op13_clustering"](spark, sf_dir)) == plain_cluster(vectors)
