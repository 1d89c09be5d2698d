"""The pipeline, the registered queries, and the library without this subpackage."""

import subprocess
import sys
import textwrap
from pathlib import Path

import corpus_pipeline
import pytest
from helpers import odd_documents, prose, table, with_clashes

import __spark_entry__ as entry
from millrace.llm.queries import ORACLES, QUERIES

REPO = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with every kind of document that a stage looks for."""
    top = str(tmp_path_factory.mktemp("tables"))
    docs = [(i, prose(i, 60)) for i in range(300)]
    docs = [(i, t + " scumbag " + t[:20] if i % 4 == 0 else t) for i, t in docs]
    item = prose(9001, 30)
    docs += [(1000, docs[1][1]), (1001, docs[1][1]), (1002, docs[2][1] + " extra"), (1003, "x " + item + " y z")]
    docs += [(2000 + (i or 0), t) for i, t in odd_documents()] + [(None, prose(77, 20))]
    with_clashes(table(spark, docs)).write.parquet(f"{top}/documents.parquet")
    labels = [(i, int(i % 4 == 0)) for i in range(200)]
    table(spark, labels, "doc_id long, toxic int").write.parquet(f"{top}/labels.parquet")
    table(spark, [(5, item)], "item_id long, text string").write.parquet(f"{top}/benchmark.parquet")
    return top


def test_stages_are_the_ordered_five():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact dedup", "near dedup", "decontamination", "pieces"]


def test_pipeline_drops_what_it_should_and_no_more(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = corpus_pipeline.run(spark, folder)
    assert set(docs.columns) < set(got.columns)
    rows = got.collect()
    ids = {r.doc_id for r in rows}
    assert not ids & set(range(0, 300, 4))  # toxic
    assert {i for i in range(300) if i % 4} - ids == {1, 2}  # repeated by 1001, nearly by 1002
    assert 1001 in ids and 1000 not in ids and 1002 in ids
    assert 1003 not in ids  # holds a test item
    assert all(r.round_trip for r in rows)
    assert len([r for r in rows if not r.text]) == 1


def test_each_stage_takes_an_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0


def test_every_operator_has_a_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES if name[:2] == "op" and name[2].isdigit())
    assert numbers == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)
    assert "pipeline" in entry.queries()


def test_the_rest_stands_without_this_subpackage():
    script = textwrap.dedent("""
        import sys
        sys.modules["corpus_pipeline"] = None
        import __spark_entry__ as entry
        assert entry.queries() and not [q for q in entry.queries() if q.startswith("op") and q[2].isdigit()]
        assert "pipeline" not in entry.queries()
    """)
    subprocess.run([sys.executable, "-c", script], cwd=REPO, check=True, timeout=120)
