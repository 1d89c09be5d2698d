"""The registered queries over the given tables, against what their contracts say in plain Python."""

import math
import re
import zlib
from collections import Counter

import duckdb
import public_tokenizers
import pytest

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def documents(sf_dir):
    found = duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{sf_dir}/documents.parquet'").fetchall()
    return dict(found)


def rows(spark, sf_dir, name):
    return entry.queries()[name](spark, sf_dir).collect()


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def test_verdicts_follow_the_rules_and_else_the_model(spark, sf_dir):
    got = rows(spark, sf_dir, "op2_url_filter")
    pages = duckdb.sql(f"SELECT page_id FROM '{sf_dir}/pages.parquet'").fetchall()
    assert sorted((r.page_id,) for r in got) == sorted(pages)
    verdicts = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}
    for r in got:
        assert r.verdict == (verdicts[r.rule] if r.rule else "block" if r.block_score > 0.5 else "allow")
    assert {r.rule is None for r in got} == {True, False}


def test_base_scores_are_those_of_the_counts(spark, sf_dir, documents):
    def tokens(text):
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        return [*re.findall("[^\x20\x09-\x0d]+", lower), None]

    held = {i: crc(i) % 7 == 2 for i in documents}
    counts = Counter(t for i, text in documents.items() if not held[i] for t in tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    got = rows(spark, sf_dir, "op3_lm_scores")
    assert sorted(r.doc_id for r in got) == sorted(documents)
    for r in got:
        found = tokens(documents[r.doc_id])
        base = sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in found)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (
            held[r.doc_id], len(found), sum(counts[t] > 0 for t in found), total,
        )
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0


def test_pieces_of_the_table_are_the_librarys(spark, sf_dir, documents):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = rows(spark, sf_dir, "op4_pieces")
    assert sorted(r.doc_id for r in got) == sorted(documents)
    for r in got:
        assert list(r.ids) == library.encode(documents[r.doc_id]) and r.n_pieces == len(r.ids) and r.round_trip


def test_toxicity_is_learnt_from_its_part_and_holds_on_the_other(spark, sf_dir, documents):
    got = {r.doc_id: r for r in rows(spark, sf_dir, "op5_toxicity")}
    assert sorted(got) == sorted(documents)
    for r in got.values():
        assert r.held_out == (crc(r.doc_id) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    labels = duckdb.sql(f"SELECT doc_id, toxic FROM '{sf_dir}/labels.parquet'").fetchall()
    seen = [(toxic, got[i].score) for i, toxic in labels if i in got and not got[i].held_out]
    toxic, clean = ([s for t, s in seen if t == k] for k in (1, 0))
    assert sum(toxic) / len(toxic) > sum(clean) / len(clean)


def test_items_of_the_benchmark_are_found_in_its_documents(spark, sf_dir, documents):
    got = {r.doc_id: r for r in rows(spark, sf_dir, "op7_decontamination")}
    items = duckdb.sql(f"SELECT item_id, text FROM '{sf_dir}/benchmark.parquet'").fetchall()
    assert sorted(got) == sorted(documents)
    for r in got.values():
        assert r.leaked == bool(r.item_ids)
        whole = {i for i, text in items if text and text in documents[r.doc_id]}
        assert whole <= set(r.item_ids)


def test_token_counts_of_the_table_are_the_librarys(spark, sf_dir, documents):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = rows(spark, sf_dir, "op9_token_counts")
    assert sorted(r.doc_id for r in got) == sorted(documents)
    for r in got:
        text = documents[r.doc_id]
        n = len(library.encode(text, add_special_tokens=False))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 1024)


def test_classes_of_near_copies_are_whole(spark, sf_dir, documents):
    got = rows(spark, sf_dir, "op1_near_dedup")
    assert sorted(r.doc_id for r in got) == sorted(documents)
    members = {}
    for r in got:
        members.setdefault(r.class_id, []).append(r)
    for group in members.values():
        assert {r.class_size for r in group} == {len(group)} and sum(r.kept for r in group) == 1
    # Equal texts are always of one class.
    of_text = {}
    for r in got:
        of_text.setdefault(documents[r.doc_id], set()).add(r.class_id)
    assert all(len(classes) == 1 for classes in of_text.values())
