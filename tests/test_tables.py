from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.operators import counters, dedup, lag, notify, tables
from millrace.operators.partitioning import by_key, vip_partition
from millrace.operators.payments import charge


def test_last_record_of_a_key_wins(spark):
    log = spark.range(20).selectExpr(
        "'ada' AS key", "0 AS partition", "id AS offset", "concat('Ada Lovelace ', id + 1) AS name"
    )
    got = tables.latest_per_key(log, "key").collect()
    assert [(r.key, r.name) for r in got] == [("ada", "Ada Lovelace 20")]


def test_tombstones(spark):
    log = spark.createDataFrame(
        [("a", 0, "x"), ("a", 1, None), ("b", 0, None), ("b", 1, "y")], "key string, offset long, v string"
    )
    gone = F.col("v").isNull()
    got = tables.latest_per_key(log, "key", ("offset",), tombstone=gone).collect()
    assert [(r.key, r.v) for r in got] == [("b", "y")]
    kept = tables.latest_per_key(log, "key", ("offset",), tombstone=gone, drop_tombstones=False)
    assert kept.count() == 2


TARGET = "id string, a string, b string"
UPDATE = "id string, at long, a string, b string, c string"


def state(frame):
    return {r["id"]: tuple(r)[1:] for r in frame.collect()}


def test_relational_upsert_keeps_missing_fields_and_ignores_nulls(spark):
    target = spark.createDataFrame([("1", "a1", "b1"), ("2", "a2", "b2")], TARGET)
    updates = spark.createDataFrame(
        [("1", 1, "A", None, None), ("1", 2, None, None, "C"), ("2", 1, None, None, None),
         ("3", 5, "old", None, None), ("3", 6, "new", None, None), ("4", 1, None, None, None)],
        UPDATE,
    )
    got = tables.upsert(target, updates, "id", "at")
    assert got.columns == ["id", "a", "b", "c"]
    assert state(got) == {
        "1": ("A", "b1", "C"), "2": ("a2", "b2", None), "3": ("new", None, None),
    }


def test_document_upsert_replaces_and_deletes(spark):
    target = spark.createDataFrame([("1", "a1", "b1"), ("2", "a2", "b2"), ("5", "a5", "b5")], TARGET)
    updates = spark.createDataFrame(
        [("1", 1, "A", None, None), ("2", 1, "x", None, None), ("2", 2, None, None, None),
         ("3", 1, None, None, None), ("3", 2, "back", None, None)],
        UPDATE,
    )
    got = tables.upsert(target, updates, "id", "at", on_null="delete", missing="overwrite")
    assert state(got) == {
        "1": ("A", None, None), "3": ("back", None, None), "5": ("a5", "b5", None),
    }
    # Field by field, a deletion clears what came before it.
    got = tables.upsert(
        target,
        spark.createDataFrame(
            [("1", 1, None, None, None), ("1", 2, "A", None, None), ("2", 3, None, None, None)], UPDATE
        ),
        "id", "at", on_null="delete",
    )
    assert state(got) == {"1": ("A", None, None), "5": ("a5", "b5", None)}


def test_last_n_keeps_order_and_ignores_nulls(spark):
    alerts = spark.range(105).selectExpr("id AS offset", "concat('ord-', id) AS order_id")
    alerts = alerts.unionByName(spark.createDataFrame([(999, None)], "offset long, order_id string"))
    got = [r.order_id for r in tables.last_n(alerts, "offset", 100, value="order_id").collect()]
    assert got == [f"ord-{i}" for i in range(5, 105)]


def test_lookup(spark):
    table = spark.createDataFrame([("1", "x")], "order_id string, v string")
    assert tables.lookup(table, "order_id", "1").count() == 1
    assert tables.lookup(table, "order_id", "2").count() == 0
    asked = spark.createDataFrame([("1",), ("2",)], "order_id string")
    got = {r.order_id: (r.found, r.reason) for r in tables.lookup_many(table, asked, "order_id").collect()}
    assert got == {"1": (True, None), "2": (False, "not found")}


def test_search(spark):
    rows = spark.createDataFrame(
        [("1", "Ada Lovelace", "EUR"), ("2", "Alan Turing", "USD"), ("3", "Ada Yonath", "USD")],
        "order_id string, name string, currency string",
    )
    assert [r.order_id for r in tables.search_rows(rows, "ADA usd").collect()] == ["3", "1", "2"]
    assert [r.order_id for r in tables.search_rows(rows, "  ", 2).collect()] == ["1", "2"]
    assert tables.search_rows(rows, "*").count() == 3
    # Whole words only, and words of nothing but marks find nothing.
    assert tables.search_rows(rows, "lan").count() == 0 and tables.search_rows(rows, "?!").count() == 0
    canada = spark.createDataFrame([("9", "canada"), ("8", "Ada")], "order_id string, name string")
    assert [r.order_id for r in tables.search_rows(canada, "ada").collect()] == ["8"]


def test_idempotency_first_wins(spark):
    rows = spark.createDataFrame(
        [("k", 0, "o0", False), ("k", 1, "o1", False), ("f", 2, "o2", True), ("f", 3, "o3", False),
         ("f", 4, "o4", False), ("g", 5, "o5", True)],
        "idempotency_key string, offset long, order_id string, failed boolean",
    )
    got = {
        r.offset: (r.canonical_order_id, r.accepted)
        for r in dedup.dedup_first(rows, failed=F.col("failed")).collect()
    }
    assert got == {
        0: ("o0", True), 1: ("o0", False), 2: ("o2", False), 3: ("o3", True), 4: ("o3", False),
        5: ("o5", False),
    }
    parted = dedup.dedup_first(rows, failed=F.col("failed"), rows=2)
    assert {r.offset: (r.canonical_order_id, r.accepted) for r in parted.collect()} == got
    plain = {r.offset: r.accepted for r in dedup.dedup_first(rows.drop("failed")).collect()}
    assert [o for o, taken in plain.items() if taken] and sum(plain.values()) == 3


def test_submissions_without_a_key_stand_alone(spark):
    rows = spark.createDataFrame(
        [(None, 0, "o0", False), (None, 1, "o1", False), (None, 2, "o2", True), ("k", 3, "o3", False)],
        "idempotency_key string, offset long, order_id string, failed boolean",
    )
    got = {
        r.offset: (r.canonical_order_id, r.accepted)
        for r in dedup.dedup_first(rows, failed=F.col("failed")).collect()
    }
    assert got == {0: ("o0", True), 1: ("o1", True), 2: ("o2", False), 3: ("o3", True)}


def test_skip_processed_is_one_plain_join(spark):
    log = spark.range(20).selectExpr("cast(id % 2 as int) as partition", "id as offset", "id as v")
    left = dedup.skip_processed(log, log.where("offset < 15"))
    assert sorted(r.offset for r in left.collect()) == [15, 16, 17, 18, 19]
    assert left._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_redelivered_record_is_processed_once(spark):
    rows = spark.createDataFrame(
        [(4, 99, "a"), (4, 99, "a"), (4, 98, "b")], "partition int, offset long, order_id string"
    )
    ledger = spark.createDataFrame([(4, 98)], "partition int, offset long")
    got = dedup.ledger_dedup(rows, ledger)
    assert [(r.partition, r.offset, r.order_id) for r in got.collect()] == [(4, 99, "a")]
    assert dedup.ledger_rows(got).columns == ["partition", "offset", "order_id"]


def test_null_event_ids_always_pass(spark):
    rows = spark.createDataFrame(
        [("e", "1", 0), ("e", "1", 1), ("s", "1", 2), ("e", None, 3), ("e", None, 4)],
        "channel string, event_id string, offset long",
    )
    got = sorted(r.offset for r in dedup.dedup_events(rows).collect())
    assert got == [0, 2, 3, 4]


def test_payment_threshold_and_id(spark):
    orders = spark.createDataFrame(
        [("a", Decimal("9999.99")), ("b", Decimal("10000")), ("c", Decimal("10000.01"))],
        "order_id string, total_amount decimal(18,2)",
    ).withColumn("user_id", F.lit("u"))
    got = {r.order_id: (r.status, r.transaction_id) for r in charge(orders).collect()}
    assert got == {"a": ("PAID", "pay-a"), "b": ("FAILED", "pay-b"), "c": ("FAILED", "pay-c")}


def test_one_payment_is_one_email_and_one_sms(spark):
    payments = spark.createDataFrame(
        [("e1", "o", "u", "PAID", 0), ("e1", "o", "u", "PAID", 1)],
        "event_id string, order_id string, user_id string, status string, offset long",
    )
    shipments = spark.createDataFrame(
        [("e1", "s", "o", "u", 0)],
        "event_id string, shipment_id string, order_id string, user_id string, offset long",
    )
    got = {r.channel: r.message for r in notify.notifications(payments, shipments).collect()}
    assert got["payments-email"] == "Email sent orderId=o userId=u status=PAID group=notification-email"
    assert sorted(got) == ["payments-email", "payments-sms", "shipments-in"]


def test_lag(spark):
    groups = spark.createDataFrame([("g", "t"), ("h", "t")], "group_id string, topic string")
    bounds = spark.createDataFrame(
        [("t", 0, 5, 10), ("t", 1, 0, 4)],
        "topic string, partition int, begin_offset long, end_offset long",
    )
    committed = spark.createDataFrame(
        [("g", "t", 0, 7), ("g", "t", 1, 9)],
        "group_id string, topic string, partition int, committed_offset long",
    )
    rows = lag.consumer_lag(groups, bounds, committed)
    assert [(r.group_id, r.partition, r.lag) for r in rows.collect()] == [
        ("g", 0, 3), ("g", 1, 0), ("h", 0, 5), ("h", 1, 4),
    ]
    assert {r.group_id: r.total_lag for r in lag.group_lag(rows).collect()} == {"g": 3, "h": 9}


def test_lag_of_a_running_query():
    report = {
        "sources": [{"endOffset": {"t": {"0": 3, "1": 9}}, "latestOffset": {"t": {"0": 5, "1": 9, "2": 4}}}]
    }
    assert lag.progress_lag(report) == {("t", 0): 2, ("t", 1): 0, ("t", 2): 4}


def test_counters(spark):
    rows = spark.createDataFrame([("PAID",), ("PAID",), (None,)], "status string")
    assert {r.status: r.n for r in counters.counters(rows, "status").collect()} == {
        "PAID": 2, "unknown": 1,
    }
    assert {r.table_name: r.n for r in counters.table_counts({"a": rows}).collect()} == {"a": 3}


def test_counters_observed_while_a_job_runs(spark):
    from pyspark.sql import Observation

    seen = Observation("job")
    rows = spark.range(10)
    rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("id") > 6).alias("big")).count()
    assert seen.get == {"rows": 10, "big": 3}
    assert counters.observe_counts(rows, "again", big=F.col("id") > 6).count() == 10


def murmur2(data: bytes) -> int:
    m, mask = 0x5BD1E995, 0xFFFFFFFF
    h = 0x9747B28C ^ len(data)
    whole = len(data) // 4 * 4
    for i in range(0, whole, 4):
        k = int.from_bytes(data[i:i + 4], "little") * m & mask
        k = (k ^ k >> 24) * m & mask
        h = h * m & mask ^ k
    if data[whole:]:
        h = (h ^ int.from_bytes(data[whole:], "little")) * m & mask
    h = (h ^ h >> 13) * m & mask
    return h ^ h >> 15


@pytest.mark.parametrize("hash", ["md5", "murmur2"])
def test_vip_lane(spark, hash):
    keys = ["vip-ada", "vip-bob", "user-ada", "", None, "x", "ab", "abc", "abcd", "žluť", "user-ada"]
    frame = spark.createDataFrame([(k,) for k in keys], "key string")
    got = [r.partition for r in vip_partition(frame, "key", 6, hash=hash).collect()]
    assert got[:2] == [0, 0] and all(1 <= p <= 5 for p in got[2:])
    assert got[2] == got[-1] and got[3] == got[4]
    if hash == "murmur2":
        expected = [1 + (murmur2((k or "").encode()) & 0x7FFFFFFF) % 5 for k in keys[2:]]
        assert got[2:] == expected
    assert {r.partition for r in vip_partition(frame, "key", 1, hash=hash).collect()} == {0}


def test_by_key(spark):
    frame = spark.range(100).selectExpr("id AS offset", "id % 3 AS k")
    assert by_key(frame, "k", 5).rdd.getNumPartitions() == 5
    placed = by_key(frame, "k", 8).select("k", F.spark_partition_id().alias("p")).distinct()
    assert placed.count() == 3
    spread = by_key(frame, "k", 8, offset="offset", rows=5).select("k", F.spark_partition_id().alias("p"))
    assert spread.distinct().count() > 3
