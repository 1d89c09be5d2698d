"""Tokens, pieces, repeats, leaks and secrets against brute force and the libraries."""

import hashlib
import random
import re
import subprocess
import sys
from collections import Counter
from math import log2

import public_tokenizers
import pytest
from helpers import odd_documents, prose, table, with_clashes
from pyspark.sql import functions as F

from millrace.llm import leaks, pieces, repeats, secrets, tokens

BPE = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def noise(seed, n):
    rng = random.Random(seed)
    alphabet = "abcdeéßñ.,'  \n\t 0129_<|>日"
    return "".join(rng.choice(alphabet) for _ in range(n))


def test_token_counts_equal_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BPE)
    docs = odd_documents() + [(100 + i, noise(i, 400)) for i in range(30)]
    docs += [(200, "it's we'll don't\n\nA.\nB ...x 12,3" * 20), (201, "<|endoftext|> <|endoftext|>" * 30)]
    # Small chunks and overlaps: texts without white space force wider and wider ones.
    for chunk, overlap in ((tokens.CHUNK, tokens.OVERLAP), (200, 70)):
        got = tokens.token_counts(with_clashes(table(spark, docs)), BPE, chunk=chunk, overlap=overlap)
        want = [
            (i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False)), n > 1024)
            for i, t in docs
        ]
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert tokens.token_counts(table(spark, []), BPE).count() == 0


def test_token_counts_start_no_threads():
    """A task has one core: threads of the library's own would each hold memory."""
    code = f"""
import os, sys
sys.path[:0] = {sys.path!r}
import pyarrow as pa
from millrace.llm import tokens
batch = pa.RecordBatch.from_pylist([dict(row=k, doc_id=k, n_bytes=9, text="one two 3 " * 50) for k in range(200)])
count = tokens._count_whole(open({str(BPE)!r}).read())
before = len(os.listdir("/proc/self/task"))
print(sum(b.num_rows for b in count(iter([batch]))), len(os.listdir("/proc/self/task")) - before)
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, check=True)
    assert done.stdout.split() == ["200", "0"]


def test_pieces_equal_the_library_and_decode_to_the_text(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = odd_documents() + [(100 + i, noise(i, 300)) for i in range(100)]
    docs += [(300, "x" * 90 + "é" * 10 + "日" * 80)]
    coded = pieces.with_pieces(with_clashes(table(spark, docs)), MODEL)
    coded = coded.withColumn("back", pieces.decoded(F.col("ids"), MODEL))
    for r in coded.collect():
        text = r.text or ""
        assert list(r.ids) == library.encode(text) and r.round_trip
        assert r.back == library.decode(list(r.ids)) == text.replace("▁", " ")
    assert pieces.with_pieces(table(spark, []), MODEL).count() == 0


@pytest.mark.parametrize("prefix", [0, 1])
@pytest.mark.parametrize("squeeze", [0, 1])
def test_the_models_own_normaliser_is_compiled(tmp_path, prefix, squeeze):
    import sentencepiece

    with open(MODEL, "rb") as file:
        data = file.read() + bytes([0x1A, 4, 0x18, prefix, 0x20, squeeze])
    path = tmp_path / "other.model"
    path.write_bytes(data)
    library = sentencepiece.SentencePieceProcessor(model_proto=data)
    transducer = pieces.load(str(path))
    encode, decode = pieces.encoder(pieces.Tables(transducer)), pieces.decoder(transducer)
    texts = ["", " ", "a", " a", "a ", "  a  b   c ", "some words here", "x\n y\t z", "é 日本  😀 "]
    texts += [noise(i, 80).strip(" ") + " end" for i in range(20)]
    for text, ids in zip(texts, encode(texts)):
        assert ids.tolist() == library.encode(text)
        assert decode(ids.tolist()) == transducer.normaliser.spelt(text)


def test_a_normaliser_that_maps_characters_is_refused(tmp_path):
    with open(MODEL, "rb") as file:
        data = file.read() + bytes([0x1A, 3, 0x12, 1, 65])
    path = tmp_path / "mapping.model"
    path.write_bytes(data)
    with pytest.raises(ValueError):
        pieces._normaliser(data)


def test_words_walk_alike_alone_and_side_by_side():
    transducer = pieces.load(MODEL)
    tables = pieces.Tables(transducer)
    rng = random.Random(3)
    words = ["▁" + "".join(rng.choice("theinganort▁é.") for _ in range(rng.randint(1, 20))) for _ in range(400)]
    words = [w for w in words if "▁" not in w.lstrip("▁")]
    import numpy as np

    for word, ids in zip(words, tables.encode_words(words)):
        assert np.frombuffer(ids, np.int32).tolist() == transducer.encode_word(word, {})


def cut_by_force(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = [False] * len(r)
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        kept = bytes(b for b, g in zip(r, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_repeats_against_all_positions(spark):
    rng = random.Random(5)
    texts = [t for _, t in odd_documents()]
    common = [prose(i, 45) for i in range(60, 66)]
    for i in range(60):  # passages in other surroundings, some cut short, some changed
        a, b = rng.choice(common), rng.choice(common)
        a = a[rng.randint(0, 60):len(a) - rng.randint(0, 60)]
        texts.append(prose(1000 + i, rng.randint(0, 30)) + a + prose(2000 + i, rng.randint(0, 9)) + b)
    texts += ["é" * 150, "é" * 120, "ab" * 300, "a" * 199, "a" * 200]
    docs = table(spark, list(enumerate(texts)))
    got = repeats.cut_repeats(with_clashes(docs)).orderBy("doc_id").collect()
    want = cut_by_force(texts, 200)
    for r, (n_bytes, n_removed, n_spans, sha) in zip(got, want):
        assert (r.n_bytes, r.n_removed, r.n_spans) == (n_bytes, n_removed, n_spans), r.doc_id
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == sha
    assert repeats.cut_repeats(table(spark, [])).count() == 0


def infix_by_force(item, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_infix_distance_by_bits():
    rng = random.Random(6)
    for _ in range(200):
        item = "".join(rng.choice("ab c") for _ in range(rng.randint(1, 25)))
        text = "".join(rng.choice("ab c") for _ in range(rng.randint(0, 40)))
        assert leaks.infix_distance(leaks.char_masks(item), len(item), text) == infix_by_force(item, text)


def test_leaks_against_all_alignments(spark):
    rng = random.Random(7)
    items = [prose(300 + i, 20 + i) for i in range(8)]
    bench = [(i, t) for i, t in enumerate(items)] + [(90, None), (91, ""), (92, "?!"), (None, "short one")]
    bench += [(93, items[0].upper())]
    docs = odd_documents()
    for i in range(40):
        item = list(rng.choice(items))
        for _ in range(rng.randint(0, int(len(item) * 0.08))):
            k = rng.randrange(len(item))
            item[k:k + 1] = rng.choice([[], ["q"], [item[k], "z"]])
        docs.append((100 + i, prose(400 + i, 10) + " " + "".join(item) + " " + prose(500 + i, 9)))
    docs += [(200, "Here: SHORT, one."), (201, items[3][:-40])]
    found = leaks.with_leaks(with_clashes(table(spark, docs)), table(spark, bench, "item_id long, text string"))
    got = {r.doc_id: dict(zip(r.leaks["items"], r.leaks["distances"])) for r in found.collect() if r.doc_id}

    def plain(t):
        return " ".join(re.findall(r"[^\W_]+", (t or "").lower()))

    for doc_id, text in docs:
        if doc_id and doc_id >= 100:
            want = {}
            for item_id, item in bench:
                item = plain(item)
                if item and (d := infix_by_force(item, plain(text))) <= len(item) * leaks.ERROR_RATE // 1:
                    want[item_id] = d
            assert got[doc_id] == want
    assert not any(got[i] for i in range(1, 9))
    empty = leaks.with_leaks(table(spark, odd_documents()), table(spark, [], "item_id long, text string"))
    assert empty.where(F.size("leaks.items") > 0).count() == 0
    assert leaks.with_leaks(table(spark, []), table(spark, bench, "item_id long, text string")).count() == 0


def base_spans(text):
    out = []
    for kind, (_, pattern, group, least) in enumerate(secrets.KINDS):
        for m in re.finditer(pattern, text):
            if len(m.group(group)) >= least:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def entropy(window):
    n = len(window)
    return -sum(c / n * log2(c / n) for c in Counter(window).values())


def entropy_spans(text, base):
    out = []
    for m in re.finditer(secrets.CANDIDATE, text):
        hit = m.group()
        if any(re.search(shape, hit) for shape in secrets.ALLOWED_SHAPES):
            continue
        name, _, _, bits = next(c for c in secrets.CLASSES if re.search(c[2], hit))
        chars = hit.lower() if name == "hex" else hit
        hot = [i for i in range(len(hit) - 19) if entropy(chars[i:i + 20]) >= bits - 1e-9]
        if hot:
            start, end = m.start() + hot[0], m.start() + hot[-1] + 20
            if not any(a < end and start < b for a, _, b in base):
                out.append((start, 3, end))
    return out


def test_secrets_against_regular_expressions(spark):
    rng = random.Random(8)
    chars = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
    texts = [t for _, t in odd_documents()] + [
        'é password = "hunter22x" token: abc TOKEN: secret : abcdef', "api_key=AKIA" + "Z" * 16,
        "AKIA" + "A1" * 9 + " AKIASHORT " + "0a" * 12 + " " + "f" * 23, "passwd=abc secret=token=abcdef",
        "id 123e4567-e89b-12d3-a456-426614174000 ok", "/usr/local/share/applications/things",
        "averyveryverylongwordindeedisthis", "1" * 60,
    ]
    texts += ["see " + "".join(rng.choice(chars) for _ in range(rng.randint(15, 60))) + " é end" for _ in range(60)]
    texts += ["key " + "".join(rng.choice("0123456789ABCDEF") for _ in range(40)) for _ in range(5)]
    docs = table(spark, list(enumerate(texts)))
    got = secrets.scan_secrets(with_clashes(docs)).collect()
    some = 0
    for r in got:
        text = texts[r.doc_id] or ""
        base = base_spans(text)
        want = sorted(base + entropy_spans(text, base))
        assert [tuple(s) for s in r.secrets] == want, text
        some += len(want) > len(base)
    assert some > 30
    known = "".join(rng.choice(chars) for _ in range(40))
    allowed = secrets.scan_secrets(table(spark, [(1, known)]), allow=[known])
    assert allowed.first().secrets == []
    assert secrets.scan_secrets(table(spark, [])).count() == 0


def test_secret_scan_stays_native(spark):
    plan = secrets.scan_secrets(table(spark, odd_documents()))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


@pytest.mark.parametrize("text, want", [("", ""), ("a", "")])
def test_no_spans_text(spark, text, want):
    r = secrets.scan_secrets(table(spark, [(1, text)])).select(secrets.spans_text(F.col("secrets")).alias("s"))
    assert r.first().s == want
