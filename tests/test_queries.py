"""Every registered query against its SQL, and what all of them must keep to."""

import os
import re

import pytest

import __spark_entry__ as entry
from check import compare, connect
from millrace.plans.oracles import ORACLES
from millrace.plans.queries import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["order_id", "user_id", "reason", "score"] and frame.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_oracle(spark, connection, sf_dir, name):
    assert compare(spark, connection, name, sf_dir) == ""


def sources():
    for folder, below, files in os.walk(os.path.join(ROOT, "millrace")):
        below[:] = [name for name in below if name != "llm"]  # has tests of its own
        for name in files:
            if name.endswith(".py"):
                with open(os.path.join(folder, name)) as source:
                    yield name, source.read()


def test_nothing_is_pulled_to_the_driver():
    """The only collect is the field list of schema inference, one row per field name."""
    found = [
        (name, call)
        for name, text in sources()
        for call in re.findall(r"\.(collect|toPandas|toLocalIterator|localCheckpoint|crossJoin)\(", text)
    ]
    assert found == [("infer.py", "collect")]


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    def plan(name):
        return entry.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()

    text = plan("velocity_alerts_1d")
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in text
    assert "IsNotNull(user_id)" in text
    text = plan("payments")
    assert "Exchange" not in text and "Window" not in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in text


def test_running_values_shuffle_rows_once(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = entry.queries()["stream_time"](spark, sf_dir)
        text = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    left = text[text.index("SortMergeJoin"):text.index("partial_max")]
    rows_side = left[:left.index("FileScan")]
    assert rows_side.count("Exchange") == 1


@pytest.mark.parametrize(
    "name, scans, shuffles",
    [("enriched_orders", 2, 0), ("idempotent_orders", 1, 1)],
)
def test_without_a_hot_key_the_plan_is_the_plain_one(spark, sf_dir, name, scans, shuffles):
    """Adaptive execution leaves out what is there for hot keys once it finds none."""
    frame = entry.queries()[name](spark, sf_dir)
    frame.collect()
    text = frame._jdf.queryExecution().executedPlan().toString()
    final = text[:text.index("Initial Plan")]
    assert final.count("FileScan") == scans
    assert final.count("Exchange hashpartitioning") == shuffles


def test_python_code_runs_where_the_package_is_missing(tmp_path):
    """Executors get functions and state processors by value."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    from millrace.functions.hashing import _murmur2
    from millrace.streaming.fraud import WindowCounter
    from millrace.streaming.keyed import ProfileAtArrival

    packed = cloudpickle.dumps(
        [_murmur2.func, WindowCounter("t", 1, 3), ProfileAtArrival("k", "s", ["n"], [], {})]
    )
    code = (
        "import sys, importlib.util, pandas as pd; from pyspark import cloudpickle\n"
        "assert importlib.util.find_spec('millrace') is None\n"
        "made = cloudpickle.loads(sys.stdin.buffer.read())\n"
        "print(made[0](pd.Series(['user-1']))[0], made[1].threshold)"
    )
    done = subprocess.run(
        [sys.executable, "-I", "-c", code], input=packed, cwd=tmp_path, capture_output=True
    )
    assert done.returncode == 0, done.stderr.decode()
    assert done.stdout.split()[1] == b"3"
