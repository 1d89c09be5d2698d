import json
import re
from collections import Counter
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas
from millrace.functions.envelope import event_id_of, with_envelope
from millrace.functions.scalar import default_currency, first_non_blank, order_total
from millrace.functions.trace import with_trace_id
from millrace.operators import orders as intake
from millrace.sinks.logs import stream_topic, to_topic_rows, write_topic
from millrace.sinks.tables import read_batches
from millrace.sources import cdc, decode
from millrace.sources.avro import decode_text_record
from millrace.sources.infer import infer_fields, infer_flatten
from millrace.sources.topics import read_topic, table_stream
from millrace.streaming import jobs

ORDER = {
    "eventId": "e1", "occurredAt": "2026-01-01T00:00:00.123Z", "traceId": "t1", "orderId": "o1",
    "userId": "u1", "items": [{"sku": "SKU-1", "quantity": 2, "price": 9.99}],
    "totalAmount": 19.98, "idempotencyKey": "k", "currency": "USD", "surprise": {"x": 1},
}


def values(spark, *texts):
    data = [(i, None if t is None else bytearray(t.encode())) for i, t in enumerate(texts)]
    return spark.createDataFrame(data, "offset long, value binary")


def test_topics_and_schemas():
    assert len(schemas.TOPICS) == 12 and schemas.TOPICS["orders"] == 6
    assert schemas.ORDER_CREATED.fieldNames()[:3] == ["eventId", "occurredAt", "traceId"]
    assert schemas.USER_PROFILE_V2["phone"].nullable and not schemas.USER_PROFILE_V2["email"].nullable


def test_typed_decode(spark):
    log = values(
        spark, json.dumps(ORDER), None, "", '{"broken', json.dumps(ORDER | {"items": None}),
        json.dumps(ORDER | {"totalAmount": "much"}), "[1]",
    )
    decoded = decode.decode_json(log, schemas.ORDER_CREATED, required=("items",))
    good, dead = decode.quarantine(decoded)
    rows = {r.offset: r.event for r in good.collect()}
    assert rows[0].totalAmount == Decimal("19.98")
    assert rows[0]["items"][0].price == Decimal("9.99")
    assert rows[0].occurredAt.microsecond == 123000
    assert rows[1] is None and rows[2] is None
    letters = {r.offset: (r.error, r.attempts) for r in dead.collect()}
    assert letters == {
        3: ("malformed", 1), 4: ("items is missing", 1), 5: ("malformed", 1), 6: ("malformed", 1),
    }
    assert [r.attempts for r in decode.quarantine(
        decoded.withColumn("attempts", F.lit(2)))[1].collect()] == [3] * 4


def test_enumerations_are_checked(spark):
    log = values(spark, '{"status": "PAID"}', '{"status": "LOST"}')
    decoded = decode.decode_json(
        log, schemas.PAYMENT_COMPLETED, allowed={"status": schemas.PAYMENT_STATUS}
    )
    assert [r.error for r in decoded.orderBy("offset").collect()] == [None, "status is unknown"]


def test_round_trip_through_a_topic(spark, tmp_path):
    log = values(spark, json.dumps(ORDER))
    event = decode.decode_json(log, schemas.ORDER_CREATED).select("event.*")
    columns = schemas.to_columns(event)
    assert "order_id" in columns.columns and schemas.to_wire(columns).columns == event.columns
    rows = to_topic_rows(event, "userId", "orders", trace="traceId")
    placed = rows.withColumns(
        {"partition": F.lit(1), "offset": F.lit(7).cast("long"),
         "timestamp": F.lit(datetime(2026, 1, 1)), "timestampType": F.lit(0)}
    )
    write_topic(placed, path=str(tmp_path / "log"))
    back = read_topic(spark, "orders", path=str(tmp_path / "log"))
    assert back.columns == schemas.TOPIC_LOG.fieldNames()
    row = back.collect()[0]
    assert (bytes(row.key), row.partition, row.offset) == (b"u1", 1, 7)
    assert bytes(row.headers[0].value) == b"t1"
    again = decode.decode_json(back, schemas.ORDER_CREATED).select("event.*").collect()
    assert again == event.collect()


def test_tolerant_parse(spark):
    log = values(spark, '{"a": 1, "b": "x"}', "plain", " ", None, '{"a": 1', "[1]")
    rows = decode.parse_or_raw(log).orderBy("offset").collect()
    assert [r.value_json for r in rows] == [{"a": "1", "b": "x"}, None, None, None, None, None]
    assert [r.value_raw for r in rows] == [None, "plain", None, None, '{"a": 1', "[1]"]


def test_frames(spark):
    rows = spark.createDataFrame([(7, "body"), (70000, "")], "id int, text string")
    framed = rows.select(decode.wire_frame("id", "text").alias("value"))
    got = decode.split_wire_frame(framed).collect()
    assert [(r.magic, r.schema_id, bytes(r.body)) for r in got] == [(0, 7, b"body"), (0, 70000, b"")]
    other = spark.createDataFrame([(bytearray(b"\x01\x00\x00\x00\x07x"),), (bytearray(b"\x00\x01"),), (None,)], "value binary")
    got = decode.split_wire_frame(other).collect()
    assert [(r.magic, r.schema_id, r.body) for r in got] == [(1, None, None), (0, None, None), (None,) * 3]


def test_schema_versions(spark):
    v1 = spark.createDataFrame([("1", "n", "e")], "user_id string, name string, email string")
    v2 = spark.createDataFrame([("2", "n", "e", "p")], "user_id string, name string, email string, phone string")
    both = decode.conform_all([v1, v2], schemas.USER_PROFILE_V2).collect()
    assert {r.user_id: r.phone for r in both} == {"1": None, "2": "p"}
    assert decode.conform(v2, schemas.USER_PROFILE_V1).columns == ["user_id", "name", "email"]
    with pytest.raises(ValueError, match="email"):
        decode.conform(v1.drop("email"), schemas.USER_PROFILE_V1)
    given = decode.conform(v1.drop("email"), schemas.USER_PROFILE_V1, {"email": "-"})
    assert given.collect()[0].email == "-"


DOCS = [
    '{"flag": true, "n": 1, "big": 1, "x": 1.5, "s": "a", "mix": 1, "gone": null, "deep": {"a": [1, 2]}, "items": [1]}',
    '{"flag": false, "n": -5, "big": 3000000000, "x": 2, "s": null, "mix": "two"}',
    "not json", None, '{"n": 3,',
]


def test_inference(spark):
    docs = spark.createDataFrame([(i, d) for i, d in enumerate(DOCS[:2])], "id int, doc string")
    kinds = {f.name: f.dataType.simpleString() for f in infer_fields(docs, "doc").fields}
    assert kinds == {
        "flag": "boolean", "n": "int", "big": "bigint", "x": "double", "s": "string",
        "mix": "string", "deep": "string",
    }
    flat = infer_flatten(docs, "doc", types={"x": T.DecimalType(18, 2)}).orderBy("id").collect()
    assert flat[0].deep == '{"a":[1,2]}' and flat[0].mix == "1" and flat[0].x == Decimal("1.50")
    assert flat[1].big == 3000000000 and flat[1].s is None and "items" not in flat[0].asDict()


def test_inference_lets_other_values_through(spark):
    docs = spark.createDataFrame([(i, d) for i, d in enumerate(DOCS)], "id int, doc string")
    rows = {r.id: r for r in infer_flatten(docs, "doc").collect()}
    assert rows[2].doc == "not json" and rows[3].doc is None and rows[0].n == 1
    assert rows[4].doc == '{"n": 3,' and rows[0].doc is None


def test_cdc(spark):
    changes = spark.createDataFrame(
        [("1", "c", ("1", "a"), 0, 0, "pg.public.users"), ("1", "u", ("1", "b"), 0, 1, "pg.public.users"),
         ("2", "c", ("2", "x"), 0, 2, "pg.public.users"), ("2", "d", None, 0, 3, "pg.public.users"),
         ("2", None, None, 0, 4, "pg.public.users")],
        "key string, op string, after struct<user_id:string,name:string>, partition int, offset long, topic string",
    )
    rows = cdc.reroute(cdc.cdc_unwrap(changes), ".*", "users-cdc").orderBy("offset").collect()
    assert [r.value and r.value.name for r in rows] == ["a", "b", "x", None, None]
    assert {r.topic for r in rows} == {"users-cdc"}
    assert [(r.key, r.value.name) for r in cdc.cdc_state(changes).collect()] == [("1", "b")]
    assert cdc.reroute(changes, "pg", "x").first().topic == "pg.public.users"


def header(*pairs):
    return [(k, bytearray(v.encode())) for k, v in pairs]


def test_trace_ids(spark):
    schema = "offset int, headers array<struct<key:string,value:binary>>, trace_id string, new_id string"
    log = spark.createDataFrame(
        [(0, header(("traceId", "old"), ("traceId", "h")), "p", "n"),
         (1, header(("lang", "en")), "p", "n"), (2, header(("traceId", "")), " ", "n"), (3, None, None, "n")],
        schema,
    )
    for prefer, first in (("header", "h"), ("payload", "p")):
        rows = with_trace_id(log, prefer=prefer, fallback="new_id").orderBy("offset").collect()
        assert [r.trace_id for r in rows] == [first, "p", "n", "n"]
        assert [h.key for h in rows[1].headers] == ["lang", "traceId"]
        assert all(bytes(r.headers[-1].value).decode() == r.trace_id for r in rows)
    assert with_trace_id(log).where("length(trace_id) = 36").count() == 2


def test_order_intake(spark):
    rows = spark.createDataFrame(
        [([("s", 2, Decimal("9.99"))], None, " "), ([("s", 2, Decimal("9.99"))], Decimal("5"), "EUR")],
        "items array<struct<sku:string,quantity:int,price:decimal(18,2)>>, total_amount decimal(18,2), currency string",
    )
    got = [(r.total_amount, r.currency) for r in intake.accept(rows).collect()]
    assert got == [(Decimal("19.98"), "USD"), (Decimal("5.00"), "EUR")]
    assert rows.select(order_total("items", F.lit(None))).first()[0] == Decimal("19.98")
    assert rows.select(default_currency(F.lit(None))).first()[0] == "USD"
    pick = spark.createDataFrame([("\t", "b"), (None, None)], "a string, b string")
    assert [r[0] for r in pick.select(first_non_blank("a", "b", fallback=F.lit("z"))).collect()] == ["b", "z"]
    assert len(pick.select(first_non_blank("a")).first()[0]) == 36


def test_validation(spark):
    rows = spark.createDataFrame(
        [("u", [("s", 1, Decimal("1"))]), (None, [("s", 1, Decimal("1"))]), ("u", []),
         ("u", [("s", 0, Decimal("1")), (" ", 1, None)]), (" ", None)],
        "user_id string, items array<struct<sku:string,quantity:int,price:decimal(18,2)>>",
    )
    valid, invalid = intake.validate(rows, intake.request_rules())
    assert valid.count() == 1
    assert [r.reasons for r in invalid.collect()] == [
        ["user_id is blank"], ["items is empty"],
        ["items has a line without sku", "items has a line below 1", "items has a line without price"],
        ["user_id is blank", "items is empty"],
    ]
    people = spark.createDataFrame(
        [("u", "n", "a@b.c"), ("u", "n", "nobody"), ("u", "n", None), ("u", "n", "")], "user_id string, name string, email string"
    )
    _, invalid = intake.validate(people, intake.profile_rules())
    assert [r.reasons for r in invalid.collect()] == [["email is not an address"], ["email is blank"], ["email is blank"]]
    extra = [intake.at_least("n", 1), intake.one_of("s", ("A",)), intake.not_null("n")]
    odd = spark.createDataFrame([(0, "B"), (None, None)], "n int, s string")
    assert [r.reasons for r in intake.with_reasons(odd, extra).collect()] == [
        ["n is below 1", "s is unknown"], ["n is null"],
    ]


def avro(*texts):
    """A record body: text fields, then for a fourth field the branch of its union."""
    out = b""
    for i, text in enumerate(texts):
        if i == 3:
            out += bytes([0 if text is None else 2])
            if text is None:
                continue
        data = text.encode()
        size, head = len(data) << 1, b""
        while size >= 0x80:
            head += bytes([size & 0x7F | 0x80])
            size >>= 7
        out += head + bytes([size]) + data
    return out


def test_profile_bodies(spark):
    long = "é" * 9000
    bodies = [avro("ada", "Ada", "a@b"), avro("", long, "x"), b"\x08ad", None]
    frame = spark.createDataFrame(
        [(i, None if b is None else bytearray(b)) for i, b in enumerate(bodies)], "id int, body binary"
    )
    rows = decode_text_record(frame, schemas.USER_PROFILE_V1).orderBy("id").collect()
    assert tuple(rows[0].event) == ("ada", "Ada", "a@b") and rows[1].event.name == long
    assert rows[2].event is None and rows[3].event is None
    second = spark.createDataFrame(
        [(bytearray(avro("a", "b", "c", "d")),), (bytearray(avro("a", "b", "c", None)),)], "body binary"
    )
    got = decode_text_record(second, schemas.USER_PROFILE_V2).select("event.*")
    assert [r.phone for r in got.collect()] == ["d", None]


def test_envelope_is_the_same_in_every_attempt(spark):
    alerts = spark.createDataFrame(
        [("o1", "HIGH_VALUE", "t"), ("o2", "HIGH_VALUE", None)], "order_id string, reason string, trace_id string"
    )
    at = F.lit(datetime(2026, 1, 1))
    first, again = (
        with_envelope(alerts, "reason", "order_id", occurred_at=at).collect() for _ in range(2)
    )
    assert first == again and len({r.event_id for r in first}) == 2
    assert first[0].trace_id == "t" and first[1].trace_id == first[1].event_id
    assert list(first[0].asDict()) == ["event_id", "occurred_at", "trace_id", "order_id", "reason"]
    assert len(first[0].event_id) == 36


def test_stream_to_a_topic_folder(spark, tmp_path):
    spark.range(3).selectExpr("cast(id AS string) AS user_id", "id AS n").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("user_id string, n long").parquet(str(tmp_path / "in"))
    query = stream_topic(
        to_topic_rows(stream, "user_id", "orders"), str(tmp_path / "check"), path=str(tmp_path / "log")
    )
    query.awaitTermination()
    back = read_topic(spark, "orders", path=str(tmp_path / "log"))
    assert sorted(bytes(r.key) for r in back.collect()) == [b"0", b"1", b"2"]
    again = read_topic(spark, "orders", streaming=True, max_per_trigger=1, path=str(tmp_path / "log"))
    assert again.isStreaming and again.columns == back.columns


def test_a_text_is_parsed_once(spark):
    """However many of its fields are looked at, and whatever is left out for what they hold."""
    log = values(spark, json.dumps(ORDER))
    decoded = decode.decode_json(log, schemas.ORDER_CREATED, required=("orderId", "userId"))
    for part in decode.quarantine(decoded):
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json(") == 1
        # Nor are its characters counted to see whether there is a text.
        assert not re.search(r"(?<!octet_)length\(", plan)


def test_members_of_a_group_share_a_topic(spark, tmp_path):
    """Each reads its own partition in micro-batches under its own cap, and goes on where it stopped."""
    log, job = str(tmp_path / "log"), str(tmp_path / "job")
    for first in (0, 60):
        records = spark.range(first, first + 60).selectExpr(
            "cast(id AS string) AS user_id", "id AS n", "cast(id % 3 AS int) AS partition"
        )
        rows = to_topic_rows(records.coalesce(1), "user_id", "orders", partition="partition")
        write_topic(rows, path=log, segment_records=5)
        members = {
            p: read_topic(
                spark, "orders", streaming=True, path=log, max_per_trigger=10, segment_records=5, partitions=[p]
            )
            for p in range(3)
        }
        table = jobs.run_members(members, job)
    got = [(int(r.key), r.partition, r.topic, r.member, r.batch_id) for r in read_batches(spark, table).collect()]
    assert sorted(r[0] for r in got) == list(range(120))
    assert all(n % 3 == partition == member and topic == "orders" for n, partition, topic, member, _ in got)
    # 20 records of each half and member, ten at a time.
    assert Counter((member, batch) for *_, member, batch in got) == {(m, b): 10 for m in range(3) for b in range(4)}
    some = read_topic(spark, "orders", path=log, partitions=[0, 2])
    assert {r.partition for r in some.collect()} == {0, 2} and some.count() == 80
    assert read_topic(spark, "orders", path=log).count() == 120


def test_files_of_the_orders_topic_do_not_grow_with_the_tasks(spark, sf_dir, monkeypatch):
    """A cap on micro-batches counts files: those of a few records each make many micro-batches."""
    from millrace.plans import queries

    paths = []
    monkeypatch.setattr(queries, "write_topic", lambda rows, **to: paths.append(to["path"]) or write_topic(rows, **to))
    many = {
        "spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {name: spark.conf.get(name) for name in many}
    try:
        for name, value in many.items():
            spark.conf.set(name, value)
        queries.QUERIES["stream_topic_orders"](spark, sf_dir)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert len(spark.read.parquet(paths[0]).inputFiles()) <= 2 * 6 * 4


def test_a_member_that_fails_leaves_the_others_alone(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "in"))
    stream = table_stream(spark, str(tmp_path), "in")
    bad = stream.select(F.raise_error(F.lit("broken")).alias("id"))
    with pytest.raises(StreamingQueryException, match="broken"):
        jobs.run_members({0: bad, 1: stream}, str(tmp_path / "job"))
    assert read_batches(spark, str(tmp_path / "job/table")).where("member = 1").count() == 4


def test_a_table_streams_from_a_file_or_a_folder(spark, tmp_path):
    spark.range(10).repartition(3).write.parquet(str(tmp_path / "t.parquet"))
    one = next((tmp_path / "t.parquet").glob("part-*.parquet"))
    count = spark.read.parquet(str(one)).count()
    for folder, name, rows in ((tmp_path, "t.parquet", 10), (one.parent, one.name, count)):
        out = tmp_path / f"out-{rows}"
        query = (
            table_stream(spark, str(folder), name, max_files=1)
            .writeStream.format("parquet")
            .option("checkpointLocation", str(out / "check"))
            .trigger(availableNow=True)
            .start(str(out / "data"))
        )
        query.awaitTermination()
        assert spark.read.parquet(str(out / "data")).count() == rows


def test_event_ids_tell_lists_of_values_apart(spark):
    rows = spark.createDataFrame(
        [("a|b", "c"), ("a", "b|c"), (None, "c"), ("", "c"), ("-", "c")], "x string, y string"
    )
    assert rows.select(event_id_of("x", "y").alias("id")).distinct().count() == 5


def test_a_blank_trace_header_is_a_trace(spark):
    headers = "array<struct<key:string,value:binary>>"
    rows = spark.createDataFrame(
        [([("traceId", b"  ")], "p"), ([("traceId", b"")], "p")], f"headers {headers}, trace_id string"
    )
    assert [r.trace_id for r in with_trace_id(rows).collect()] == ["  ", "p"]


def test_inference_keeps_what_gets_no_column(spark):
    docs = spark.createDataFrame(
        [(1, '{"a":1,"b":"x","c":true}'), (2, '{"a":2,"b":"y"}'), (3, '{"a":3,"d":{"e":1}}'), (4, "nothing")],
        "id int, doc string",
    )
    flat = infer_flatten(docs, "doc", most=2, rest="others").orderBy("id")
    assert flat.columns == ["id", "doc", "a", "b", "others"]
    text = F.transform_values("others", lambda k, v: v.cast("string"))
    got = [(r.id, r.doc, r.a, r.b, r.others) for r in flat.withColumn("others", text).collect()]
    assert got == [
        (1, None, 1, "x", {"c": "true"}), (2, None, 2, "y", {}), (3, None, 3, None, {"d": '{"e":1}'}),
        (4, "nothing", None, None, None),
    ]
