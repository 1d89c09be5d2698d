"""Streams give what the batch operators give, across micro-batches, restarts and failures."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.operators import fraud
from millrace.operators.counters import observe_counts
from millrace.operators.enrich import asof_enrich
from millrace.operators.inventory import reserve_stock
from millrace.sinks import tables as sinks
from millrace.sources.topics import table_stream
from millrace.streaming import jobs
from millrace.streaming.dedup import stream_dedup
from millrace.streaming.fraud import (
    _window_counts, stream_drop_late, stream_high_value, stream_velocity, stream_window_counts,
)
from millrace.streaming.keyed import enrich_log, stream_asof_enrich
from millrace.streaming.monitor import ProgressTable, counter_totals, read_progress
from millrace.streaming.tables import dedup_writer, enrich_writer, reserve_writer, velocity_writer

START = datetime(2026, 1, 1)
ORDERS = "order_id string, user_id string, occurred_at timestamp_ntz, offset long"


class Log:
    """A folder that grows by one file per micro-batch."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema, self.files = spark, str(folder), schema, 0

    def add(self, rows):
        self.files += 1
        frame = self.spark.createDataFrame(rows, self.schema).coalesce(1)
        frame.write.mode("append").parquet(self.folder)

    def stream(self):
        return table_stream(self.spark, self.folder, "*.parquet", max_files=1)

    def table(self):
        return self.spark.read.parquet(self.folder)


def order(name, user, seconds, offset=0):
    return (name, user, START + timedelta(seconds=seconds), offset)


@pytest.fixture
def orders(spark, tmp_path):
    return Log(spark, tmp_path / "orders", ORDERS)


def alerts(spark, path):
    return sorted((r.user_id, r.n) for r in sinks.read_batches(spark, path).collect())


@pytest.mark.parametrize("mode", ["update", "per_record"])
def test_count_goes_on_after_a_restart(spark, orders, tmp_path, mode):
    sink = "update" if mode == "update" else "append"
    folder = str(tmp_path / "job")
    orders.add([order("a", "u", 0), order("b", "u", 10)])
    jobs.run_to_table(stream_velocity(orders.stream(), mode=mode), folder, mode=sink)
    orders.add([order("c", "u", 20), order("x", "v", 20)])
    path = jobs.run_to_table(stream_velocity(orders.stream(), mode=mode), folder, mode=sink)
    assert alerts(spark, path) == [("u", 3)]
    got = sinks.read_batches(spark, path).collect()[0]
    assert got.order_id == f"velocity|u|{int((START - datetime(1970, 1, 1)).total_seconds()) * 1000}"


def test_every_increment_equals_batch(spark, orders, tmp_path):
    rng = random.Random(5)
    offset = 0
    for _ in range(4):
        rows = []
        for _ in range(60):
            rows.append(order(f"o{offset}", rng.choice(["hot", "hot", "a"]), offset * 2, offset))
            offset += 1
        orders.add(rows)
    path = jobs.run_to_table(stream_velocity(orders.stream(), mode="per_record"), str(tmp_path / "job"))
    batch = fraud.velocity_alerts(orders.table())
    assert alerts(spark, path) == sorted((r.user_id, r.n) for r in batch.collect())
    updates = jobs.run_to_table(stream_velocity(orders.stream()), str(tmp_path / "job2"), mode="update")
    top = sinks.read_batches(spark, updates).groupBy("order_id").agg(F.max("n").alias("n"))
    last = batch.groupBy("order_id").agg(F.max("n").alias("n"))
    assert sorted(map(tuple, top.collect())) == sorted(map(tuple, last.collect()))


@pytest.mark.parametrize("mode", ["update", "per_record"])
def test_late_orders(spark, orders, tmp_path, mode):
    """Two minutes late counts, twenty minutes late does not."""
    for row in [
        ("now-1", "in", 180), ("now-2", "in", 181), ("clock", "clock", 330), ("late", "in", 60),
        ("drop", "out", 332), ("d1", "out", -870), ("d2", "out", -869), ("d3", "out", -868),
    ]:
        orders.add([order(*row)])
    sink = "update" if mode == "update" else "append"
    path = jobs.run_to_table(
        stream_velocity(orders.stream(), mode=mode), str(tmp_path / "job"), mode=sink
    )
    assert alerts(spark, path) == [("in", 3)]


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_late_rule_over_micro_batches(spark, tmp_path, seed):
    """The same alerts as one batch over the whole log, with late records and three partitions."""
    rng = random.Random(seed)
    log = Log(spark, tmp_path / "e", f"{ORDERS}, partition int")
    offset = 0
    for _ in range(6):
        rows = []
        for _ in range(50):
            user = rng.choice(["hot", "hot", "a", "b"])
            late = rng.choice([0, 0, 0, 0, 120, 400, 1200])
            rows.append((*order(f"o{offset}", user, offset * 6 - late, offset), len(user) % 3))
            offset += 1
        log.add(rows)
    folder = str(tmp_path / "job")
    jobs.start(log.stream(), velocity_writer(folder), f"{folder}/checkpoint").awaitTermination()
    expected = fraud.velocity_alerts(fraud.drop_late(log.table()))
    got = sinks.read_batches(spark, f"{folder}/alerts")
    pick = ("order_id", "n", "score")
    assert sorted(map(tuple, got.select(*pick).collect())) == sorted(
        map(tuple, expected.select(*pick).collect())
    )
    assert fraud.drop_late(log.table()).count() < 300
    assert len(sinks._versions(spark, f"{folder}/counts")) == 3
    assert sinks.read_table(spark, f"{folder}/counts").count() < 10


def test_an_idle_partition_keeps_no_windows_of_others(spark, tmp_path):
    log = Log(spark, tmp_path / "e", f"{ORDERS}, partition int")
    log.add([(*order("i", "idle", 0, 0), 0)])
    for hour in range(1, 5):
        log.add([(*order(f"b{hour}", "busy", hour * 3600, hour), 1)])
    folder = str(tmp_path / "job")
    jobs.start(log.stream(), velocity_writer(folder), f"{folder}/checkpoint").awaitTermination()
    left = sinks.read_table(spark, f"{folder}/counts").groupBy("user_id").count().collect()
    assert {r["user_id"]: r["count"] for r in left} == {"idle": 1, "busy": 1}


def test_state_is_dropped_after_window_and_grace(spark, orders, tmp_path):
    folder = str(tmp_path / "job")
    orders.add([order("a", "u", 0)])
    orders.add([order("b", "u", 3600)])
    orders.add([order("c", "u", 3601)])
    jobs.run_to_table(stream_window_counts(orders.stream()), folder, mode="update")
    kept = jobs.read_state(spark, f"{folder}/checkpoint")
    assert kept.count() == 1


def test_high_value_stream(spark, tmp_path):
    log = Log(spark, tmp_path / "o", "order_id string, user_id string, trace_id string, total_amount decimal(18,2)")
    log.add([("a", "u", "t", Decimal("10000.01")), ("b", "u", "t", Decimal("10000"))])
    path = jobs.run_to_table(stream_high_value(log.stream()), str(tmp_path / "job"))
    assert [r.order_id for r in sinks.read_batches(spark, path).collect()] == ["a"]


LOG = "user_id string, offset long, log_side int, name string, email string, order_id string"


def mixed_log(spark, folder, files=5, size=60, seed=9):
    rng = random.Random(seed)
    log = Log(spark, folder, LOG)
    offset = 0
    for _ in range(files):
        rows = []
        for _ in range(size):
            user = rng.choice(["hot", "hot", "a", "b", "c"])
            if rng.random() < 0.2:
                name = None if rng.random() < 0.25 else f"n{offset}"
                rows.append((user, offset, 0, name, name, None))
            else:
                rows.append((user, offset, 1, None, None, f"o{offset}"))
            offset += 1
        log.add(rows)
    return log


def batch_enriched(log):
    rows = log.table()
    joined = asof_enrich(
        rows.where("log_side = 1").select("user_id", "offset", "order_id"),
        rows.where("log_side = 0").select("user_id", "offset", "name", "email"),
    )
    return sorted((r.order_id, r.user_name, r.user_email) for r in joined.collect())


def test_profile_at_arrival_with_table_state(spark, tmp_path):
    log = mixed_log(spark, tmp_path / "log")
    folder = str(tmp_path / "job")
    writer = enrich_writer(folder, fields=["name", "email"])
    jobs.start(log.stream(), writer, f"{folder}/checkpoint").awaitTermination()
    got = sinks.read_batches(spark, f"{folder}/orders").collect()
    assert len({r.batch_id for r in got}) == 5
    assert sorted((r.order_id, r.user_name, r.user_email) for r in got) == batch_enriched(log)


def test_profile_at_arrival_with_keyed_state(spark, tmp_path):
    log = mixed_log(spark, tmp_path / "log", seed=10)
    stream = log.stream()
    joined = stream_asof_enrich(
        stream.where("log_side = 1").select("user_id", "offset", "order_id"),
        stream.where("log_side = 0").select("user_id", "offset", "name", "email"),
    )
    path = jobs.run_to_table(joined, str(tmp_path / "job"))
    got = sinks.read_batches(spark, path).collect()
    assert sorted((r.order_id, r.user_name, r.user_email) for r in got) == batch_enriched(log)


def test_reservation_over_micro_batches(spark, tmp_path):
    rng = random.Random(2)
    log = Log(spark, tmp_path / "lines", "sku string, offset long, line int, quantity int")
    offset = 0
    for _ in range(3):
        rows = []
        for _ in range(80):
            rows.append((rng.choice(["hot", "hot", "b", "x"]), offset, 0, rng.randint(1, 30)))
            offset += 1
        log.add(rows)
    stock = spark.createDataFrame([("hot", 900), ("b", 120)], "sku string, quantity int")
    folder = str(tmp_path / "job")
    jobs.start(log.stream(), reserve_writer(folder, stock, rows=20), f"{folder}/checkpoint").awaitTermination()
    events, left = reserve_stock(log.table(), stock)
    pick = ("sku", "offset", "line", "quantity", "status")
    got = sinks.read_batches(spark, f"{folder}/events").select(*pick)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, events.select(*pick).collect()))
    now = sinks.read_table(spark, f"{folder}/stock")
    assert sorted(map(tuple, now.collect())) == sorted(map(tuple, left.collect()))


PAY = "order_id string, user_id string, total_amount decimal(18,2)"


def test_crash_between_write_and_commit_gives_one_payment(spark, tmp_path):
    log = Log(spark, tmp_path / "orders", PAY)
    log.add([("a", "u", Decimal("5.00"))])
    folder = str(tmp_path / "job")

    def crash(batch_id):
        raise RuntimeError("crash after the write")

    with pytest.raises(Exception, match="crash after the write"):
        jobs.stream_payments(log.stream(), folder, after_write=crash)
    path = jobs.stream_payments(log.stream(), folder)
    assert [(r.transaction_id, r.status) for r in sinks.read_batches(spark, path).collect()] == [
        ("pay-a", "PAID")
    ]
    log.add([("a", "u", Decimal("5.00")), ("b", "u", Decimal("10000"))])
    jobs.stream_payments(log.stream(), folder)
    got = sinks.read_committed(spark, path, ["transaction_id"]).collect()
    assert sorted((r.transaction_id, r.status) for r in got) == [("pay-a", "PAID"), ("pay-b", "FAILED")]


def test_crash_in_a_table_writer_repeats_the_batch(spark, tmp_path):
    log = Log(spark, tmp_path / "lines", "sku string, offset long, line int, quantity int")
    log.add([("a", 0, 0, 3)])
    stock = spark.createDataFrame([("a", 10)], "sku string, quantity int")
    folder = str(tmp_path / "job")
    reserve = reserve_writer(folder, stock)

    def failing(batch, batch_id):
        reserve(batch, batch_id)
        raise RuntimeError("crash after the write")

    with pytest.raises(Exception, match="crash after the write"):
        jobs.start(log.stream(), failing, f"{folder}/checkpoint").awaitTermination()
    for _ in range(2):
        jobs.start(log.stream(), reserve, f"{folder}/checkpoint").awaitTermination()
    assert [r.quantity for r in sinks.read_table(spark, f"{folder}/stock").collect()] == [7]
    assert sinks.read_batches(spark, f"{folder}/events").count() == 1


def test_stream_dedup(spark, tmp_path):
    log = Log(spark, tmp_path / "e", "channel string, event_id string, occurred_at timestamp_ntz")
    log.add([("e", "1", START), ("s", "1", START), ("e", None, START)])
    log.add([("e", "1", START + timedelta(minutes=1)), ("e", None, START), ("e", "2", START)])
    path = jobs.run_to_table(stream_dedup(log.stream(), horizon="1 day"), str(tmp_path / "job"))
    got = sorted((r.channel, r.event_id or "") for r in sinks.read_batches(spark, path).collect())
    assert got == [("e", ""), ("e", ""), ("e", "1"), ("e", "2"), ("s", "1")]


def test_dedup_against_earlier_batches(spark, tmp_path):
    """Half of all records are copies of one."""
    schema = "channel string, event_id string, occurred_at timestamp_ntz, offset long"
    log = Log(spark, tmp_path / "e", schema)
    expected, offset = set(), 0
    for batch in range(3):
        rows = []
        for i in range(40):
            event = "hot" if i % 2 else f"{batch}-{i % 7}" if i % 3 else None
            expected.add(event)
            rows.append(("e", event, START + timedelta(seconds=offset), offset))
            offset += 1
        log.add(rows)
    path = str(tmp_path / "out")
    jobs.start(log.stream(), dedup_writer(path), str(tmp_path / "c")).awaitTermination()
    got = [r.event_id for r in sinks.read_batches(spark, path).collect()]
    nulls = log.table().where("event_id IS NULL").count()
    assert sorted(e for e in got if e) == sorted(e for e in expected if e)
    assert got.count(None) == nulls and nulls > 0


UPDATES = "id string, at long, a string, b string"


def test_upserts_over_micro_batches(spark, tmp_path):
    log = Log(spark, tmp_path / "u", UPDATES)
    log.add([("1", 0, "a", "b"), ("2", 1, "x", None)])
    log.add([("1", 2, None, "B"), ("2", 3, None, None)])
    rows, docs = str(tmp_path / "rows"), str(tmp_path / "docs")
    writers = {
        "rows": sinks.upsert_writer(rows, "id", "at"),
        "docs": sinks.upsert_writer(docs, "id", "at", on_null="delete", missing="overwrite"),
    }
    for query in sinks.start_groups(log.stream(), writers, str(tmp_path / "groups")).values():
        query.awaitTermination()
    assert {r.id: (r.a, r.b) for r in sinks.read_table(spark, rows).collect()} == {
        "1": ("a", "B"), "2": ("x", None),
    }
    assert {r.id: (r.a, r.b) for r in sinks.read_table(spark, docs).collect()} == {"1": (None, "B")}


def test_fan_out_gives_every_writer_everything(spark, tmp_path):
    log = Log(spark, tmp_path / "u", UPDATES)
    log.add([("1", 0, "a", "b"), ("2", 1, "x", None)])
    paths = [str(tmp_path / name) for name in ("one", "two")]
    writer = sinks.fan_out([sinks.exactly_once_writer(p) for p in paths])
    jobs.start(log.stream(), writer, str(tmp_path / "c")).awaitTermination()
    assert [sinks.read_batches(spark, p).count() for p in paths] == [2, 2]


@pytest.mark.parametrize("seed", [1, 2])
def test_a_clock_for_each_partition_equals_the_batch_rule(spark, tmp_path, seed):
    """One partition lags hours behind the others and loses nothing by it; late records are dropped alike."""
    rng = random.Random(seed)
    log = Log(spark, tmp_path / "e", f"{ORDERS}, partition int")
    offset = 0
    for _ in range(3):
        rows = []
        for _ in range(60):
            user = rng.choice(["hot", "hot", "a", "bb"])
            partition = len(user) % 3
            late = rng.choice([0, 0, 0, 0, 120, 400, 1200]) + (9000 if partition == 2 else 0)
            rows.append((*order(f"o{offset}", user, offset * 6 - late, offset), partition))
            offset += 1
        rng.shuffle(rows)
        log.add(rows)
    accepted = fraud.drop_late(log.table())
    kept = jobs.run_to_table(stream_drop_late(log.stream()), str(tmp_path / "late"))
    got = sorted(r.offset for r in sinks.read_batches(spark, kept).collect())
    assert got == sorted(r.offset for r in accepted.collect()) and len(got) < offset
    alerts_of = stream_velocity(log.stream(), mode="per_record", partition="partition")
    path = jobs.run_to_table(alerts_of, str(tmp_path / "job"))
    want = fraud.velocity_alerts(accepted)
    pick = ("order_id", "n", "score")
    assert sorted(map(tuple, sinks.read_batches(spark, path).select(*pick).collect())) == sorted(
        map(tuple, want.select(*pick).collect())
    )


def test_records_are_counted_before_they_are_shuffled():
    """What a hot user sends to its task is a row per window and batch of rows, not its records."""
    import pyarrow as pa

    ms = [1_000 * i for i in range(1000)]
    stamp = pa.array(ms, pa.timestamp("ms")).cast(pa.timestamp("us", "UTC"))
    batch = pa.RecordBatch.from_arrays([pa.array(["hot"] * 1000), stamp, stamp], ["user_id", "ts", "clock"])
    (out,) = _window_counts(300_000)(iter([batch]))
    assert sorted(zip(*(out.column(c).to_pylist() for c in ("start_ms", "n")))) == [
        (0, 300), (300_000, 300), (600_000, 300), (900_000, 100),
    ]


def test_a_salted_profile_is_the_same_for_every_order(spark, tmp_path):
    log = Log(spark, tmp_path / "s", "user_id string, offset long, log_side int, name string, amount long")
    rng = random.Random(3)
    offset = 0
    for _ in range(2):
        rows = []
        for _ in range(80):
            change = rng.random() < 0.3
            name = rng.choice([None, f"n{offset}"]) if change else None
            rows.append((rng.choice(["hot", "u"]), offset, 0 if change else 1, name, offset))
            offset += 1
        log.add(rows)
    table = log.table()
    want = asof_enrich(
        table.where("log_side = 1").select("user_id", "offset", "amount"),
        table.where("log_side = 0").select("user_id", "offset", "name"),
    )
    joined = enrich_log(log.stream(), "user_id", "offset", ["name"], ["amount"], salts=3)
    path = jobs.run_to_table(joined, str(tmp_path / "job"))
    pick = ("user_id", "offset", "amount", "user_name")
    assert sorted(map(tuple, sinks.read_batches(spark, path).select(*pick).collect())) == sorted(
        map(tuple, want.select(*pick).collect())
    )


def test_users_of_a_bucket_keep_their_own_profiles(spark, tmp_path):
    """Over micro-batches, with tombstones and whole numbers that a double does not hold."""
    log = Log(spark, tmp_path / "s", "user_id long, offset long, log_side int, name string, email string, amount long")
    rng = random.Random(7)
    offset = 0
    for _ in range(4):
        rows = []
        for _ in range(150):
            change = rng.random() < 0.4
            name, email = (rng.choice([None, f"{f}{offset}"]) if change else None for f in "ne")
            rows.append((rng.randrange(40), offset, 0 if change else 1, name, email, None if change else 2**53 + offset))
            offset += 1
        log.add(rng.sample(rows, len(rows)))
    table = log.table()
    want = asof_enrich(
        table.where("log_side = 1").select("user_id", "offset", "amount"),
        table.where("log_side = 0").select("user_id", "offset", "name", "email"),
    )
    pick = ("user_id", "offset", "amount", "user_name", "user_email")
    want = sorted(want.select(*pick).collect(), key=lambda r: r.offset)
    for salts in (1, 2):
        joined = enrich_log(
            log.stream(), "user_id", "offset", ["name", "email"], ["amount"], salts=salts, buckets=3
        )
        path = jobs.run_to_table(joined, str(tmp_path / f"job-{salts}"))
        got = sinks.read_batches(spark, path).select(*pick).collect()
        assert sorted(got, key=lambda r: r.offset) == want


def test_a_call_serves_many_users_and_asks_for_few_profiles():
    """State is asked only for users with an order before their first change, and written once a user."""
    from types import SimpleNamespace

    import pandas as pd

    from millrace.streaming.keyed import ProfileAtArrival

    kept, asked, written = {(0,): ("old",), (1,): ("gone",)}, [], []
    state = SimpleNamespace(
        exists=lambda: bool(kept),
        containsKey=lambda user: asked.append(user) or user in kept,
        getValue=kept.get,
        updateValue=lambda user, value: written.append(user) or kept.update({user: value}),
        removeKey=lambda user: kept.pop(user, None),
    )
    processor = ProfileAtArrival("user_id", "offset", ["name"], [], {}, "bigint")
    processor.init(SimpleNamespace(getMapState=lambda *_: state))
    rows = [(u, 10 * u + k, k % 2, None if u == 1 or k % 2 else f"n{10 * u + k}") for u in range(1, 200) for k in range(4)]
    rows += [(0, 5, 1, None), (0, -1, 1, None), (500, 2, 1, None)]
    chunks = pd.DataFrame(rows, columns=["user_id", "offset", "log_side", "name"]).sample(frac=1, random_state=1)
    (out,) = processor.handleInputRows((0, 0), iter([chunks[:300], chunks[300:]]), None)
    want = {(u, 10 * u + k): f"n{10 * u + k - 1}" for u in range(2, 200) for k in (1, 3)} | {(0, 5): "old", (0, -1): "old"}
    assert dict(zip(zip(out["user_id"], out["offset"]), out["name"])) == want
    assert sorted(asked) == [(0,), (500,)] and sorted(written) == [(u,) for u in range(2, 200)]
    assert kept == {(0,): ("old",)} | {(u,): (f"n{10 * u + 2}",) for u in range(2, 200)}


def test_a_supervisor_begins_again_and_gives_up(spark, orders, tmp_path):
    orders.add([order("a", "u", 0), order("b", "u", 10)])
    faults = iter([True, True, False])

    def fault(batch_id):
        if next(faults, False):
            raise RuntimeError("before the commit")

    path = jobs.run_to_table(orders.stream(), str(tmp_path / "ok"), after_write=fault, restarts=2)
    assert sinks.read_batches(spark, path).count() == 2

    def broken(batch_id):
        raise RuntimeError("every time")

    with pytest.raises(Exception, match="every time"):
        jobs.run_to_table(orders.stream(), str(tmp_path / "no"), after_write=broken, restarts=1)


def test_reports_of_a_running_job_become_rows(spark, orders, tmp_path):
    for k in range(3):
        orders.add([order(f"a{k}", "u", k), order(f"b{k}", "v", k)])
    counted = observe_counts(orders.stream(), "orders", of_u=F.col("user_id") == "u")
    listener = ProgressTable(spark, str(tmp_path / "reports"), names=["counted"])
    spark.streams.addListener(listener)
    try:
        running = jobs.start_to_table(counted, str(tmp_path / "job"), name="counted")
        running.awaitTermination()
        assert listener.wait(running.runId)
    finally:
        spark.streams.removeListener(listener)
    progress = read_progress(spark, str(tmp_path / "reports"))
    assert progress.count() == 3
    assert {r.label: r.n for r in counter_totals(progress).collect()} == {"rows": 6, "of_u": 3}


def test_a_partitions_clock_holds_little():
    """Of a partition's share of a micro-batch there are few copies, whatever is let through."""
    import tracemalloc
    from types import SimpleNamespace

    import numpy as np
    import pandas as pd

    from millrace.streaming.fraud import PartitionClock

    n = 400_000
    state = SimpleNamespace(exists=lambda: False, update=lambda value: None)
    clock = PartitionClock(3_600_000, 60_000, "offset", "occurred_at", "_clock")
    clock.init(SimpleNamespace(getValueState=lambda *_: state))

    def chunks():
        for offsets in np.random.default_rng(1).permutation(n).reshape(-1, 10_000):
            times = pd.to_datetime(offsets * 1_000, unit="ms")
            yield pd.DataFrame({"partition": 0, "user_id": offsets % 9, "offset": offsets, "occurred_at": times})

    tracemalloc.start()
    try:
        passed = sum(len(kept) for kept in clock.handleInputRows((0,), chunks(), None))
        assert passed == n and tracemalloc.get_traced_memory()[1] < 96 * n
    finally:
        tracemalloc.stop()
