import random
from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from millrace.operators import fraud
from millrace.operators.blocks import fill_forward, running_count, running_max

START = datetime(2026, 1, 1)
SCHEMA = "order_id string, user_id string, occurred_at timestamp_ntz, offset long, partition int"


def log(spark, rows):
    """(order, user, seconds after the start) in arrival order."""
    data = [
        (order, user, START + timedelta(seconds=at), offset, 0)
        for offset, (order, user, at) in enumerate(rows)
    ]
    return spark.createDataFrame(data, SCHEMA)


def test_third_order_in_a_window_fires_once(spark):
    rows = [("o1", "u", 0), ("o2", "u", 10)]
    assert fraud.velocity_alerts(log(spark, rows)).count() == 0
    alert = fraud.velocity_alerts(log(spark, [*rows, ("o3", "u", 20)])).collect()
    assert len(alert) == 1
    start_ms = int(START.timestamp() - datetime(1970, 1, 1).timestamp()) * 1000
    assert alert[0].order_id == f"velocity|u|{start_ms}"
    assert (alert[0].reason, alert[0].score, alert[0].n) == ("VELOCITY", 0.3, 3)


def test_orders_across_a_boundary_do_not_share_a_window(spark):
    rows = [("a", "u", 0), ("b", "u", 30), ("c", "u", 300), ("d", "u", 310)]
    assert fraud.velocity_alerts(log(spark, rows)).count() == 0


def test_every_order_past_the_third_fires(spark):
    alerts = fraud.velocity_alerts(log(spark, [(f"o{i}", "u", i) for i in range(14)]), chunk=4)
    got = sorted((a.n, a.score) for a in alerts.collect())
    assert got == [(n, min(1.0, n / 10)) for n in range(3, 15)]


def test_alerts_follow_the_running_count(spark):
    rng = random.Random(1)
    rows = [(f"o{i}", rng.choice(["hot", "hot", "a", "b", None]), rng.randrange(900)) for i in range(400)]
    frame = log(spark, rows)
    counted = fraud.running_counts(frame, rows=37).where("n >= 3")
    expected = sorted((r.user_id, r.n) for r in counted.collect())
    got = sorted((r.user_id, r.n) for r in fraud.velocity_alerts(frame).collect())
    assert got == expected and got


def test_high_value_is_strict(spark):
    orders = spark.createDataFrame(
        [("a", Decimal("10000.01")), ("b", Decimal("10000.00")), ("c", None)],
        "order_id string, total_amount decimal(18,2)",
    ).withColumns({"user_id": F.lit("u"), "trace_id": F.lit("t")})
    alerts = fraud.high_value_alerts(orders).collect()
    assert [(a.order_id, a.reason, a.score, a.trace_id) for a in alerts] == [
        ("a", "HIGH_VALUE", 1.0, "t")
    ]


LATE = [
    ("late-now-1", "in", 180), ("late-now-2", "in", 181), ("clock", "clock", 330),
    ("late-2m", "in", 60), ("drop-now", "out", 332),
    ("drop-1", "out", -870), ("drop-2", "out", -869), ("drop-3", "out", -868),
]


def test_two_minutes_late_counts_twenty_is_dropped(spark):
    alerts = fraud.velocity_alerts(fraud.drop_late(log(spark, LATE))).collect()
    assert [(a.user_id, a.n) for a in alerts] == [("in", 3)]


def test_late_orders_of_high_value_still_alert(spark):
    frame = log(spark, LATE).withColumns(
        {"trace_id": F.lit("t"), "total_amount": F.when(F.col("order_id") == "drop-1", 20000).otherwise(1)}
    )
    got = {(a.reason, a.user_id) for a in fraud.fraud_alerts(frame, grace="1 minute").collect()}
    assert got == {("HIGH_VALUE", "out"), ("VELOCITY", "in")}
    assert fraud.fraud_alerts(frame).where("reason = 'VELOCITY'").count() == 2


def test_two_minutes_late_is_dropped_once_the_window_is_closed(spark):
    rows = [("a", "u", 180), ("clock", "c", 361), ("late", "u", 241)]
    kept = {r.order_id for r in fraud.drop_late(log(spark, rows)).collect()}
    assert kept == {"a", "clock"}


def test_stream_time_is_kept_per_partition(spark):
    frame = log(spark, [("a", "u", 900), ("b", "u", 0)]).withColumn(
        "partition", F.col("offset").cast("int")
    )
    assert fraud.drop_late(frame).count() == 2


def test_drop_late_in_blocks_equals_the_rule(spark):
    rng = random.Random(3)
    rows = [(f"o{i}", "u", i * 5 - rng.choice([0, 0, 0, 100, 400, 1500])) for i in range(500)]
    best, expected = None, set()
    for order, _, at in rows:
        best = at if best is None else max(best, at)
        if (at // 300) * 300 + 300 > best - 60:
            expected.add(order)
    got = {r.order_id for r in fraud.drop_late(log(spark, rows), rows=23).collect()}
    assert got == expected and len(got) < 500


def test_event_time_falls_back(spark):
    t = START
    data = [
        (0, 0, t, t + timedelta(hours=1)),
        (0, 1, None, t + timedelta(seconds=5)),
        (0, 2, None, datetime(1969, 12, 31)),
        (0, 3, None, None),
        (1, 4, None, None),
    ]
    frame = spark.createDataFrame(
        data, "partition int, offset long, occurred_at timestamp_ntz, timestamp timestamp_ntz"
    )
    got = [r.event_time for r in fraud.event_time(frame, rows=2).orderBy("offset").collect()]
    late = t + timedelta(seconds=5)
    assert got == [t, late, late, late, None]


def test_late_candidates(spark):
    frame = log(spark, [("a", "u", 0), ("b", "u", 1)]).withColumn(
        "timestamp", F.lit(START + timedelta(seconds=60)).cast("timestamp_ntz")
    )
    assert [r.order_id for r in fraud.late_candidates(frame).collect()] == ["a"]


def test_blocks_equal_plain_running_values_under_skew(spark):
    """Half of the rows on one key, blocks far smaller than the key."""
    rng = random.Random(7)
    data = [
        (rng.choice(["hot", "hot", "a", "b", "c"]), i, rng.choice([None, rng.randrange(1000)]))
        for i in range(600)
    ]
    frame = spark.createDataFrame(data, "k string, offset long, v long")
    counts, best, last, expected = {}, {}, {}, {}
    for k, offset, v in data:
        counts[k] = counts.get(k, 0) + 1
        if v is not None:
            best[k] = max(best.get(k, v), v)
            last[k] = v
        expected[offset] = (counts[k], best.get(k), last.get(k))
    for split in ("hot", "all"):
        got = running_count(frame, ["k"], "offset", "n", rows=50, split=split)
        assert {r.offset: r.n for r in got.collect()} == {o: e[0] for o, e in expected.items()}
        got = running_max(frame, ["k"], "offset", "v", "m", rows=50, split=split)
        assert {r.offset: r.m for r in got.collect()} == {o: e[1] for o, e in expected.items()}
        got = fill_forward(frame, ["k"], "offset", "v", "f", rows=50, split=split)
        assert {r.offset: r.f for r in got.collect()} == {o: e[2] for o, e in expected.items()}


def test_no_task_gets_more_than_a_block(spark):
    """Rows of a hot key are hashed by block, so the groups a window sees stay small."""
    from millrace.operators.blocks import BLOCK, _cut

    frame = spark.range(10_000).selectExpr("id AS offset", "if(id % 3 = 0, 'hot', uuid()) AS k")
    blocked, cut = _cut(frame, ["k"], "offset", 100, "hot")
    largest = blocked.groupBy("k", BLOCK).count().agg(F.max("count")).first()[0]
    assert largest <= 100
    assert {r.k for r in cut.select("k").distinct().collect()} == {"hot"}


def test_record_without_a_user_does_not_move_the_clock(spark):
    start = datetime(2026, 1, 1)
    rows = [("u", start, 0, 0), (None, start + timedelta(hours=1), 1, 0)]
    rows += [("u", start + timedelta(seconds=i), 1 + i, 0) for i in (1, 2)]
    log = spark.createDataFrame(rows, "user_id string, occurred_at timestamp, offset long, partition int")
    assert fraud.drop_late(log).count() == 3
    assert fraud.velocity_alerts(fraud.drop_late(log)).count() == 1


def test_velocity_events_have_ids_of_their_own(spark):
    counts = spark.createDataFrame(
        [("u", datetime(2026, 1, 1), n) for n in (3, 4, 5, 6)], "user_id string, window_start timestamp, n long"
    )
    events = fraud.velocity_events(counts)
    assert events.select("event_id").distinct().count() == 4
    assert events.columns[:3] == ["event_id", "occurred_at", "trace_id"]
    assert {r.key for r in events.collect()} == {"u"}
