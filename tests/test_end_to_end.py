"""From a request to alerts, enriched orders, payments, stock and messages."""

from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from millrace.functions.envelope import with_envelope
from millrace.operators import dedup, enrich, fraud, inventory, notify, orders as intake, tables
from millrace.operators.partitioning import vip_partition
from millrace.operators.payments import charge
from millrace.schemas import ORDER_CREATED, TOPICS, to_columns, to_wire
from millrace.sinks.logs import to_topic_rows, write_topic
from millrace.sources.decode import decode_json, quarantine
from millrace.sources.topics import read_topic

REQUEST = (
    "order_id string, user_id string, items array<struct<sku:string,quantity:int,price:decimal(18,2)>>, "
    "total_amount decimal(18,2), currency string, idempotency_key string, offset long, at timestamp"
)


def test_from_request_to_messages(spark, tmp_path):
    def request(offset, user, quantity, total, key):
        item = ("SKU-1", quantity, Decimal("9.99"))
        return (f"o{offset}", user, [item], total, None, key, offset, datetime(2026, 1, 1, 0, 0, offset))

    submitted = spark.createDataFrame(
        [
            request(0, "vip-ada", 2, None, "a"),
            request(1, "vip-ada", 2, None, "a"),
            request(2, "vip-ada", 60, Decimal("20000"), "b"),
            request(3, "vip-ada", 50, Decimal("10000"), "c"),
            request(4, None, 1, None, "d"),
            request(5, "bob", 1, Decimal("5"), "e"),
        ],
        REQUEST,
    )
    valid, invalid = intake.validate(submitted, intake.request_rules())
    assert [r.reasons for r in invalid.collect()] == [["user_id is blank"]]
    placed = dedup.dedup_first(intake.accept(valid)).where("accepted")
    placed = placed.drop("canonical_order_id", "accepted")
    events = with_envelope(placed, "order_id", occurred_at="at").drop("at")

    wire = to_wire(vip_partition(events, "user_id", TOPICS["orders"]))
    fields = [f.name for f in ORDER_CREATED.fields]
    rows = to_topic_rows(wire, "userId", "orders", trace="traceId", partition="partition", fields=fields)
    log = rows.withColumn("value_text", F.col("value").cast("string"))
    offsets = F.get_json_object("value_text", "$.orderId").substr(2, 9).cast("long")
    log = log.withColumns(
        {"offset": offsets, "timestamp": F.lit(datetime(2026, 1, 1)), "timestampType": F.lit(0)}
    ).drop("value_text")
    write_topic(log, path=str(tmp_path / "log"))

    read = read_topic(spark, "orders", path=str(tmp_path / "log"))
    good, dead = quarantine(decode_json(read, ORDER_CREATED, required=("items",)))
    assert dead.count() == 0 and good.count() == 4
    lanes = {bytes(r.key).decode(): r.partition for r in good.collect()}
    assert lanes["vip-ada"] == 0 and lanes["bob"] > 0
    orders = to_columns(good.select("event.*", "partition", "offset"))
    first = orders.where("order_id = 'o0'").collect()[0]
    assert (first.total_amount, first.currency) == (Decimal("19.98"), "USD")

    alerts = fraud.fraud_alerts(orders, grace="1 minute").collect()
    assert sorted((a.reason, a.user_id) for a in alerts) == [
        ("HIGH_VALUE", "vip-ada"), ("VELOCITY", "vip-ada"),
    ]
    profiles = spark.createDataFrame([("vip-ada", "Ada", "a@b")], "user_id string, name string, email string")
    enriched = enrich.enrich(orders, profiles)
    assert {r.order_id: r.user_name for r in enriched.collect()} == {"o0": "Ada", "o2": "Ada", "o3": "Ada"}
    sink = tables.upsert(enriched.where("false").drop("items", "offset"), enriched.drop("items"), "order_id", "offset")
    assert sink.count() == 3 and "items" not in sink.columns

    payments = charge(orders)
    assert {r.order_id: r.status for r in payments.collect()} == {
        "o0": "PAID", "o2": "FAILED", "o3": "FAILED", "o5": "PAID",
    }
    told = with_envelope(payments, "transaction_id", occurred_at=F.lit(datetime(2026, 1, 2)))
    assert notify.notifications(told.withColumn("offset", F.lit(0))).count() == 8

    lines = intake.explode_lines(orders, ("order_id", "offset"))
    reserved, left = inventory.reserve_stock(lines, inventory.seed_stock(
        spark.createDataFrame([], "sku string, quantity int")))
    assert {r.order_id: r.status for r in reserved.collect()} == {
        "o0": "RESERVED", "o2": "RESERVED", "o3": "REJECTED", "o5": "RESERVED",
    }
    assert {r.sku: r.quantity for r in left.collect()} == {"SKU-1": 37, "SKU-LOAD": 1000}
