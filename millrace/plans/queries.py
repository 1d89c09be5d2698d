"""The registered queries. Each reads whole tables and returns flat columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.envelope import with_envelope
from millrace.functions.scalar import VELOCITY_THRESHOLD, first_non_blank, money, transaction_id
from millrace.functions.trace import with_trace_id
from millrace.operators import dedup, enrich, fraud, inventory, lag, ledger, notify, orders as intake
from millrace.operators import tables
from millrace.operators.counters import counters, observe_counts, table_counts
from millrace.operators.partitioning import by_key, vip_partition
from millrace.operators.payments import charge
from millrace.plans import inputs
from millrace.schemas import ORDER_CREATED, USER_PROFILE_V1, USER_PROFILE_V2, to_columns
from millrace.session import prepare, scratch_dir
from millrace.sinks.buckets import (
    bucket_of, bucket_writer, document_writer, insert_writer, read_buckets, read_inserted,
)
from millrace.sinks.logs import to_topic_rows, write_topic
from millrace.sinks.tables import (
    exactly_once_writer, read_batches, read_committed, read_table, start_groups, upsert_writer,
)
from millrace.sources import cdc, decode
from millrace.sources.avro import decode_text_record
from millrace.sources.infer import infer_flatten
from millrace.sources.topics import read_topic, table_stream
from millrace.streaming import jobs
from millrace.streaming.dedup import stream_dedup as dedup_stream
from millrace.streaming.fraud import stream_velocity as velocity_stream
from millrace.streaming.keyed import enrich_log
from millrace.streaming.monitor import ProgressTable, counter_totals, read_progress
from millrace.streaming.tables import (
    dedup_writer,
    enrich_writer,
    fraud_writer,
    reserve_writer,
    velocity_writer,
)

QUERIES = {}


def query(function):
    """Register a query under its name."""

    def run(spark, sf_dir) -> DataFrame:
        return function(prepare(spark), sf_dir)

    QUERIES[function.__name__] = run
    return run


# Fraud


@query
def high_value_alerts(spark, sf_dir):
    return fraud.high_value_alerts(inputs.orders_log(spark, sf_dir))


@query
def high_value_alerts_400k(spark, sf_dir):
    return fraud.high_value_alerts(inputs.orders_log(spark, sf_dir), 400_000)


@query
def velocity_alerts_5m(spark, sf_dir):
    return fraud.velocity_alerts(inputs.events_log(spark, sf_dir))


@query
def velocity_alerts_1d(spark, sf_dir):
    return fraud.velocity_alerts(inputs.events_log(spark, sf_dir), "1 day")


@query
def running_counts(spark, sf_dir):
    counted = fraud.running_counts(inputs.events_log(spark, sf_dir), "1 day")
    return counted.select("offset", "user_id", "window_start", "n")


@query
def window_counts(spark, sf_dir):
    return fraud.window_counts(inputs.events_log(spark, sf_dir), "1 hour")


@query
def fraud_alerts(spark, sf_dir):
    return fraud.fraud_alerts(inputs.orders_log(spark, sf_dir), "30 days")


@query
def velocity_events(spark, sf_dir):
    """Velocity alerts as complete events, one for each count from the threshold up, keyed by user."""
    counted = fraud.running_counts(inputs.events_log(spark, sf_dir), "1 day")
    return fraud.velocity_events(counted.where(F.col("n") >= VELOCITY_THRESHOLD))


@query
def fraud_counters(spark, sf_dir):
    return counters(fraud.fraud_alerts(inputs.orders_log(spark, sf_dir), "30 days"), "reason")


@query
def stream_time(spark, sf_dir):
    timed = fraud.with_stream_time(inputs.late_log(spark, sf_dir))
    return timed.select("offset", "partition", "occurred_at", "stream_time")


@query
def late_accepted(spark, sf_dir):
    return fraud.drop_late(inputs.late_log(spark, sf_dir)).select(
        "offset", "user_id", "occurred_at"
    )


@query
def late_filtered_velocity(spark, sf_dir):
    accepted = fraud.drop_late(inputs.late_log(spark, sf_dir), size="1 hour")
    return fraud.velocity_alerts(accepted, "1 hour", 2)


@query
def late_candidates(spark, sf_dir):
    return fraud.late_candidates(inputs.late_log(spark, sf_dir)).select(
        "offset", "user_id", "lag_ms"
    )


@query
def event_times(spark, sf_dir):
    log = inputs.late_log(spark, sf_dir)
    known = log.withColumns(
        {
            "occurred_at": F.when(~F.col("event_type").isin("error", "click"), F.col("occurred_at")),
            "timestamp": F.when(F.col("event_type") != "error", F.col("timestamp")),
        }
    )
    return fraud.event_time(known).select("offset", "partition", "event_time")


# Enrichment and keyed tables


def _enriched(spark, sf_dir):
    return enrich.enrich(
        inputs.orders_log(spark, sf_dir), inputs.profiles(spark, sf_dir)
    ).select(
        "order_id", "event_id", "occurred_at", "trace_id", "user_id", "total_amount",
        "user_name", "user_email", "offset", "priority",
    )


@query
def enriched_orders(spark, sf_dir):
    return _enriched(spark, sf_dir)


@query
def enriched_broadcast(spark, sf_dir):
    """Orders joined with all profiles sent to every task, at the instant they were processed."""
    joined = enrich.enrich(
        inputs.orders_log(spark, sf_dir), inputs.profiles(spark, sf_dir), broadcast_rows=1_000_000,
        processed_at=F.lit("2026-01-01 00:00:00").cast("timestamp_ntz"),
    )
    return joined.select("order_id", "event_id", "occurred_at", "user_id", "user_name", "user_email")


@query
def asof_enriched(spark, sf_dir):
    events = inputs.events_log(spark, sf_dir)
    return enrich.asof_enrich(
        inputs.shape_purchases(events), inputs.shape_profile_changes(events)
    )


@query
def asof_enriched_tombstones(spark, sf_dir):
    events = inputs.events_log(spark, sf_dir)
    return enrich.asof_enrich(
        inputs.shape_purchases(events),
        inputs.shape_profile_changes(events, ("signup", "error")),
    )


@query
def latest_profile(spark, sf_dir):
    events = inputs.events_log(spark, sf_dir).select("user_id", "offset", "event_type", "value")
    return tables.latest_per_key(
        events, "user_id", ("offset",), tombstone=F.col("event_type") == "error"
    )


@query
def cdc_unwrapped(spark, sf_dir):
    rows = cdc.reroute(cdc.cdc_unwrap(inputs.changes_log(spark, sf_dir)), ".*", "users-cdc")
    return rows.select(
        "key", "topic", "partition", "offset", "value.event_type", "value.value"
    )


@query
def cdc_state(spark, sf_dir):
    return cdc.cdc_state(inputs.changes_log(spark, sf_dir)).select(
        "key", "offset", "value.event_type", "value.value"
    )


@query
def last_100_alerts(spark, sf_dir):
    alerts = fraud.high_value_alerts(inputs.orders_log(spark, sf_dir), keep=("offset",))
    return tables.last_n(alerts, "offset", 100)


@query
def last_50_cdc(spark, sf_dir):
    rows = cdc.cdc_unwrap(inputs.changes_log(spark, sf_dir))
    return tables.last_n(rows, "offset", 50).select("key", "offset", "value.event_type")


@query
def topic_upsert(spark, sf_dir):
    """Customers updated by events: fields a record leaves out keep their value."""
    target = inputs.profiles(spark, sf_dir)
    kind = F.col("event_type")
    text = F.col("offset").cast("string")
    updates = inputs.events_log(spark, sf_dir).select(
        "user_id",
        "offset",
        F.when(kind == "signup", F.concat(F.lit("name-"), text)).alias("name"),
        F.when(kind.isin("signup", "view"), F.concat(F.lit("mail-"), text)).alias("email"),
        F.when(kind == "purchase", F.concat(F.lit("phone-"), text)).alias("phone"),
    )
    table = tables.upsert(target, updates, "user_id", "offset")
    return tables.with_ingested_at(table, F.expr("TIMESTAMP_NTZ'2026-01-01 00:00:00'"))


@query
def document_upsert(spark, sf_dir):
    """The same as whole documents: a null record deletes."""
    target = inputs.profiles(spark, sf_dir)
    kind = F.col("event_type")
    text = F.col("offset").cast("string")
    updates = inputs.events_log(spark, sf_dir).select(
        "user_id",
        "offset",
        F.when(kind != "error", F.concat(F.lit("name-"), text)).alias("name"),
        F.when(kind.isin("signup", "view"), F.concat(F.lit("mail-"), text)).alias("email"),
    )
    return tables.upsert(
        target, updates, "user_id", "offset", on_null="delete", missing="overwrite"
    )


@query
def order_lookup(spark, sf_dir):
    """Every order a line item names, looked up in the enriched orders."""
    wanted = inputs.table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 2).cast("string").alias("order_id")
    ).distinct()
    found = tables.lookup_many(_enriched(spark, sf_dir), wanted, "order_id")
    return found.select("order_id", "user_name", "total_amount", "found", "reason")


@query
def search_orders(spark, sf_dir):
    found = tables.search_rows(
        _enriched(spark, sf_dir), "Customer.000000001 1-urgent", columns=["user_email", "priority"]
    )
    return found.select("order_id", "user_email", "priority", "matched")


@query
def search_all_columns(spark, sf_dir):
    """The same over every text column, with words of several of them."""
    found = tables.search_rows(_enriched(spark, sf_dir), "Customer.000000001@example.com trace 7 2-HIGH")
    return found.select("order_id", "user_name", "priority", "matched")


# Payments, notifications, counters, lag


@query
def payments(spark, sf_dir):
    return charge(inputs.orders_log(spark, sf_dir))


@query
def payment_counters(spark, sf_dir):
    return counters(charge(inputs.orders_log(spark, sf_dir)), "status")


@query
def notifications(spark, sf_dir):
    return notify.notifications(
        inputs.payments_log(spark, sf_dir), inputs.shipments_log(spark, sf_dir)
    )


@query
def notification_counters(spark, sf_dir):
    sent = notify.notifications(
        inputs.payments_log(spark, sf_dir), inputs.shipments_log(spark, sf_dir)
    )
    return counters(sent, "channel")


def _lag(spark, sf_dir):
    log = inputs.events_log(spark, sf_dir).withColumn("topic", F.lit("payments"))
    bounds = lag.log_bounds(log)
    groups = bounds.select("topic").distinct().select(
        F.explode(F.array(F.lit("notification-email"), F.lit("notification-sms"))).alias("group_id"),
        "topic",
    )
    # Email has read up to 20 January, sms up to the 10th and nothing of partition 5.
    read = [
        ("notification-email", F.col("occurred_at") < F.lit("2024-01-20").cast("timestamp_ntz")),
        (
            "notification-sms",
            (F.col("occurred_at") < F.lit("2024-01-10").cast("timestamp_ntz"))
            & (F.col("partition") != 5),
        ),
    ]
    reached = log.groupBy("topic", "partition").agg(
        *[(F.max(F.when(done, F.col("offset"))) + 1).alias(group) for group, done in read]
    )
    committed = reached.unpivot(
        ["topic", "partition"], [group for group, _ in read], "group_id", "committed_offset"
    ).where(F.col("committed_offset").isNotNull())
    return lag.consumer_lag(groups, bounds, committed)


@query
def consumer_lag(spark, sf_dir):
    return _lag(spark, sf_dir)


@query
def group_lag(spark, sf_dir):
    return lag.group_lag(_lag(spark, sf_dir))


@query
def enrichment_counters(spark, sf_dir):
    """Orders read and orders joined, of purchases with the profile at arrival."""
    events = inputs.events_log(spark, sf_dir)
    orders = inputs.shape_purchases(events)
    joined = enrich.asof_enrich(orders, inputs.shape_profile_changes(events))
    return table_counts({"consumed": orders, "joined": joined})


@query
def row_counts(spark, sf_dir):
    names = ("orders", "lineitem", "events", "part")
    return table_counts({name: inputs.table(spark, sf_dir, name) for name in names})


# Intake


@query
def order_totals(spark, sf_dir):
    return intake.accept(inputs.requests(spark, sf_dir)).select(
        "order_id", "user_id", "total_amount", "currency"
    )


@query
def order_lines(spark, sf_dir):
    return intake.explode_lines(inputs.requests(spark, sf_dir))


@query
def order_validation(spark, sf_dir):
    checked = intake.with_reasons(inputs.defective_orders(spark, sf_dir), intake.order_rules())
    return checked.select("order_id", F.array_join("reasons", "; ").alias("reasons"))


@query
def invalid_orders(spark, sf_dir):
    _, invalid = intake.validate(inputs.defective_orders(spark, sf_dir), intake.order_rules())
    return invalid.select("order_id", F.explode("reasons").alias("reason"))


def _idempotent(spark, sf_dir):
    """The key comes from the header, else the body, else the record's own place."""
    log = inputs.events_log(spark, sf_dir)
    day = F.date_format("occurred_at", "yyyy-MM-dd")
    header = F.when(
        F.col("event_type").isin("purchase", "signup"),
        F.concat_ws("|", F.col("user_id").cast("string"), F.col("event_type"), day),
    ).when(F.col("event_type") == "click", F.lit(" "))
    body = F.when(F.col("event_type") == "click", F.concat_ws("|", F.col("user_id").cast("string"), day))
    place = F.concat(F.lit("offset-"), F.col("offset").cast("string"))
    requests = log.select(
        "offset",
        first_non_blank(header, body, fallback=place).alias("idempotency_key"),
        F.concat(F.lit("ord-"), F.col("offset").cast("string")).alias("order_id"),
    )
    return dedup.dedup_first(requests)


@query
def idempotent_orders(spark, sf_dir):
    return _idempotent(spark, sf_dir)


@query
def idempotent_null_keys(spark, sf_dir):
    """Two thirds of the requests have no key: each of them stands for itself."""
    keyed = F.col("user_id") % 3 == 0
    requests = inputs.events_log(spark, sf_dir).select(
        "offset",
        F.when(keyed, F.concat_ws("|", F.col("user_id").cast("string"), "event_type")).alias("idempotency_key"),
        F.concat(F.lit("ord-"), F.col("offset").cast("string")).alias("order_id"),
    )
    return dedup.dedup_first(requests)


@query
def intake_counters(spark, sf_dir):
    """Orders taken and repeats answered."""
    result = F.when(F.col("accepted"), "success").otherwise("duplicate")
    return counters(_idempotent(spark, sf_dir).withColumn("result", result), "result")


@query
def ledger_ranges(spark, sf_dir):
    """The ledger of all but a few records: as many ranges as there are gaps."""
    done = inputs.events_log(spark, sf_dir).where("offset % 1000 <> 7")
    return ledger.ranges_of(done.select(F.lit(0).alias("partition"), "offset"), rows=1 << 12)


@query
def processed_by_ranges(spark, sf_dir):
    """The whole log delivered twice against the ranges of its first nine days, with odd records out of turn."""
    log = inputs.events_log(spark, sf_dir).select("partition", "offset", "user_id", "event_type", "occurred_at")
    early = F.col("occurred_at") < F.lit("2024-01-10").cast("timestamp")
    done = ledger.ranges_of(log.where(early | (F.col("offset") % 11 == 5)))
    once = ledger.once_by_ranges(log.unionByName(log), done, few=100)
    return once.drop("occurred_at")


@query
def ledger_dedup(spark, sf_dir):
    """The whole log delivered twice to a consumer that has done the first nine days."""
    log = inputs.events_log(spark, sf_dir).select("partition", "offset", "user_id", "event_type")
    done = inputs.events_log(spark, sf_dir).where(
        F.col("occurred_at") < F.lit("2024-01-10").cast("timestamp_ntz")
    )
    return dedup.ledger_dedup(log.unionByName(log), done)


# Stock


@query
def reserve_stock(spark, sf_dir):
    events, _ = inventory.reserve_stock(
        inputs.lines_log(spark, sf_dir), inputs.stock(spark, sf_dir), inputs.LINE_ORDER
    )
    return events.select("offset", "line", "sku", "quantity", "status")


@query
def reserve_stock_ample(spark, sf_dir):
    """Stock for most of the demand, so that most lines need no folding."""
    events, _ = inventory.reserve_stock(
        inputs.lines_log(spark, sf_dir), inputs.stock(spark, sf_dir, 40), inputs.LINE_ORDER
    )
    return events.select("offset", "line", "sku", "quantity", "status")


@query
def reserve_odd_lines(spark, sf_dir):
    """Lines without a quantity, of none, and of less than none, which gives stock back."""
    number = F.col("offset") % 5
    quantity = F.when(number == 1, F.lit(None)).when(number == 2, 0).when(
        number == 3, -F.col("quantity")
    ).otherwise(F.col("quantity"))
    lines = inputs.lines_log(spark, sf_dir).withColumn("_given", F.col("quantity"))
    order = tuple("_given" if c == "quantity" else c for c in inputs.LINE_ORDER)
    events, _ = inventory.reserve_stock(
        lines.withColumn("quantity", quantity), inputs.stock(spark, sf_dir, 3), order
    )
    return events.select("offset", "line", "sku", "quantity", "status")


@query
def reserve_hot_returns(spark, sf_dir):
    """All lines on fifty SKUs, a fifth of them returns, in blocks of a thousand orders."""
    quantity = F.when(F.col("offset") % 5 == 3, -F.col("quantity")).otherwise(F.col("quantity"))
    lines = inputs.lines_log(spark, sf_dir).withColumn("part", F.col("sku"))
    lines = lines.withColumns({"sku": F.col("sku") % 50, "given": F.col("quantity"), "quantity": quantity})
    stock = inputs.stock(spark, sf_dir).where("sku < 50")
    order = ("offset", "line", "part", "supplier", "given", "price", "discount", "tax", "shipped")
    events, _ = inventory.reserve_stock(lines, stock, order, rows=1000)
    return events.select("offset", "line", "part", "sku", "quantity", "status")


@query
def reservation_events(spark, sf_dir):
    """Reservations as events that carry on the trace of their order, keyed by it."""
    events, _ = inventory.reserve_stock(
        inputs.lines_log(spark, sf_dir), inputs.stock(spark, sf_dir), inputs.LINE_ORDER
    )
    # What a line's order gives it is put to it when all shuffles are done.
    named = inventory.reservation_events(inputs.with_order(events), inputs.LINE_ORDER)
    header = F.col("headers")[0]["value"].cast("string")
    return named.withColumn("header", header).drop("headers")


@query
def stock_after(spark, sf_dir):
    _, left = inventory.reserve_stock(
        inputs.lines_log(spark, sf_dir), inputs.stock(spark, sf_dir), inputs.LINE_ORDER
    )
    return left


@query
def restock(spark, sf_dir):
    returned = inputs.table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R").select(
        F.col("l_partkey").alias("sku"), F.col("l_quantity").cast("int").alias("quantity")
    )
    return inventory.restock(inputs.stock(spark, sf_dir), returned)


@query
def inventory_counters(spark, sf_dir):
    events, _ = inventory.reserve_stock(
        inputs.lines_log(spark, sf_dir), inputs.stock(spark, sf_dir), inputs.LINE_ORDER
    )
    return counters(events, "status")


@query
def seeded_stock(spark, sf_dir):
    """Parts that have stock, and the seeds of a new shop."""
    named = inputs.stock(spark, sf_dir).withColumn("sku", F.concat(F.lit("SKU-"), "sku"))
    return inventory.seed_stock(named)


# Sources, decoding, placement


def _vip(spark, sf_dir, hash):
    customer = inputs.table(spark, sf_dir, "customer")
    vip = F.col("c_mktsegment") == "AUTOMOBILE"
    number = F.col("c_custkey").cast("string")
    keyed = customer.select(
        "c_custkey",
        F.when(vip, F.concat(F.lit("vip-"), number))
        .otherwise(F.concat(F.lit("user-"), number))
        .alias("key"),
    )
    return vip_partition(keyed, "key", 6, hash=hash)


@query
def vip_partition_md5(spark, sf_dir):
    return _vip(spark, sf_dir, "md5")


@query
def vip_partition_murmur2(spark, sf_dir):
    return _vip(spark, sf_dir, "murmur2")


@query
def partitions_of_keys(spark, sf_dir):
    """Events brought together by user: how many partitions each user is in."""
    placed = by_key(inputs.events_log(spark, sf_dir).select("user_id", "offset"), "user_id", 6)
    marked = placed.withColumn("p", F.spark_partition_id())
    return marked.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("p").alias("partitions")
    )


@query
def json_quarantine(spark, sf_dir):
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    decoded = decode.decode_json(inputs.topic_log(spark, sf_dir), schema, required=("k",))
    good, dead = decode.quarantine(decoded)
    return (
        good.select("offset", F.col("event.k").alias("k"))
        .withColumn("error", F.lit(None).cast("string"))
        .withColumn("attempts", F.lit(0))
        .unionByName(dead.select("offset", F.lit(None).cast("int").alias("k"), "error", "attempts"))
    )


@query
def tolerant_parse(spark, sf_dir):
    parsed = decode.parse_or_raw(inputs.topic_log(spark, sf_dir))
    return parsed.select(
        "offset", F.col("value_json").getItem("k").alias("k"), F.col("value_raw").alias("raw")
    )


@query
def trace_headers(spark, sf_dir):
    log = inputs.topic_log(spark, sf_dir)
    payload = F.when(
        F.col("event_type").isin("view", "signup"),
        F.concat(F.lit("p-"), F.col("offset").cast("string")),
    )
    fallback = F.concat(F.lit("new-"), F.col("offset").cast("string"))
    settled = with_trace_id(
        log.withColumn("trace_id", payload).withColumn("new_id", fallback),
        prefer="payload",
        fallback="new_id",
    )
    return settled.select(
        "offset",
        "trace_id",
        F.size("headers").alias("n_headers"),
        F.element_at("headers", -1)["value"].cast("string").alias("header"),
    )


@query
def wire_frames(spark, sf_dir):
    """Customer names behind a frame; one segment has no valid frame."""
    customer = inputs.table(spark, sf_dir, "customer")
    good = decode.wire_frame("c_nationkey", "c_name")
    value = F.when(F.col("c_mktsegment") == "MACHINERY", F.encode("c_name", "UTF-8")).otherwise(good)
    framed = decode.split_wire_frame(customer.select("c_custkey", value.alias("value")))
    return framed.select(
        "c_custkey", "magic", "schema_id", F.col("body").cast("string").alias("body")
    )


@query
def decoded_profiles(spark, sf_dir):
    """Profiles through their wire form: a frame with the schema id, then the record."""

    def text(column):
        size = F.lpad(F.hex(F.octet_length(column).cast("long") * 2), 2, "0")
        return F.concat(F.unhex(size), F.encode(column, "UTF-8"))

    number = F.col("user_id").cast("string")
    profile = inputs.profiles(spark, sf_dir).withColumn("user_id", number)
    record = F.concat(text("user_id"), text("name"), text("email"))
    framed = profile.select(F.concat(F.unhex(F.lit("0000000007")), record).alias("value"))
    read = decode_text_record(decode.split_wire_frame(framed), USER_PROFILE_V1)
    return read.select("schema_id", "event.*")


@query
def conformed_profiles(spark, sf_dir):
    """Customers of the first schema version and suppliers of the second, under the second."""
    v1 = inputs.profiles(spark, sf_dir).select(F.col("user_id").cast("string"), "name", "email")
    v2 = inputs.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("user_id"),
        F.col("s_name").alias("name"),
        F.concat(F.col("s_suppkey").cast("string"), F.lit("@supplier.example")).alias("email"),
        F.concat(F.lit("+"), F.col("s_nationkey").cast("string")).alias("phone"),
        F.lit("dropped").alias("extra"),
    )
    return decode.conform_all([v1, v2], USER_PROFILE_V2)


@query
def inferred_flat(spark, sf_dir):
    """Orders as schemaless JSON, flattened; money stays a decimal because the caller says so."""
    orders = inputs.table(spark, sf_dir, "orders")
    document = F.to_json(
        F.struct(
            F.col("o_orderkey").cast("string").alias("orderId"),
            F.col("o_custkey").alias("userId"),
            (F.col("o_orderkey") + 3_000_000_000).alias("bigId"),
            money("o_totalprice").alias("totalAmount"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") / 4).alias("quarter"),
            (F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
            F.lit(None).cast("string").alias("nothing"),
            F.struct(F.col("o_orderstatus").alias("status")).alias("state"),
            F.array(F.struct(F.lit("SKU-1").alias("sku"))).alias("items"),
        )
    )
    return infer_flatten(
        orders.select("o_orderkey", document.alias("doc")), "doc",
        types={"totalAmount": T.DecimalType(18, 2)},
    ).drop("doc")


@query
def topic_rows(spark, sf_dir):
    alerts = fraud.high_value_alerts(inputs.orders_log(spark, sf_dir))
    rows = to_topic_rows(
        alerts, "user_id", "fraud-alerts", fields=["order_id", "user_id", "reason"]
    )
    return rows.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        F.col("headers")[0]["value"].cast("string").alias("trace"),
    )


@query
def alert_events(spark, sf_dir):
    """High-value alerts as complete events, named by what they are about."""
    alerts = fraud.high_value_alerts(inputs.orders_log(spark, sf_dir), keep=("occurred_at",))
    return with_envelope(alerts, "reason", "order_id", occurred_at="occurred_at")


@query
def payment_events(spark, sf_dir):
    """Payments as complete events that carry on the trace of their order, keyed by it."""
    orders = inputs.orders_log(spark, sf_dir)
    paid = charge(orders, keep=("occurred_at", "trace_id")).withColumn("_kind", F.lit("PAYMENT"))
    events = with_envelope(paid, "_kind", "transaction_id", occurred_at="occurred_at")
    return fraud.rekey(events.drop("_kind"), "order_id")


@query
def processed_once(spark, sf_dir):
    """The log without what a ledger of its first nine days holds."""
    log = inputs.events_log(spark, sf_dir).select(
        "partition", "offset", "user_id", "event_type", "occurred_at"
    )
    done = log.where(F.col("occurred_at") < F.lit("2024-01-10").cast("timestamp"))
    return dedup.skip_processed(log, done).drop("occurred_at")


@query
def dead_letters(spark, sf_dir):
    """What cannot be decoded, as records of the dead-letter topic."""
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    log = inputs.topic_log(spark, sf_dir)
    _, dead = decode.quarantine(decode.decode_json(log, schema, required=("k",)))
    return dead.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        F.lit("orders-dlq").alias("topic"), "partition", "offset", "error", "attempts",
    )


# Streams: the table's files as a stream, into a table of the job's own


@query
def stream_velocity(spark, sf_dir):
    events = inputs.shape_events(table_stream(spark, sf_dir, "events.parquet"))
    alerts = velocity_stream(events, "1 day")
    written = jobs.run_to_table(alerts, scratch_dir(spark, "velocity"), mode="update")
    return tables.latest_per_key(read_batches(spark, written), "order_id", ("batch_id",)).drop(
        "batch_id"
    )


@query
def stream_fraud_alerts(spark, sf_dir):
    """Both kinds of alert; of a window the last one."""
    orders = inputs.shape_orders(table_stream(spark, sf_dir, "orders.parquet"))
    written = jobs.stream_fraud(orders, scratch_dir(spark, "fraud"), "30 days")
    columns = ["order_id", "user_id", "reason", "score"]
    high = read_batches(spark, written["HIGH_VALUE"]).select(columns)
    fast = tables.latest_per_key(
        read_batches(spark, written["VELOCITY"]), "order_id", ("batch_id",)
    )
    return high.unionByName(fast.select(columns))


def _in_thousands(log):
    """Events as orders worth their value in thousands."""
    return log.withColumns(
        {
            "order_id": F.concat(F.lit("ord-"), F.col("offset").cast("string")),
            "trace_id": F.lit(None).cast("string"),
            "total_amount": money(F.col("value") * 1000),
        }
    )


@query
def fraud_alerts_with_grace(spark, sf_dir):
    """Late events are not counted; every event is worth its value in thousands."""
    log = _in_thousands(inputs.late_log(spark, sf_dir))
    return fraud.fraud_alerts(log, "1 hour", 90_000, 2, grace="1 minute")


@query
def stream_fraud_one_read(spark, sf_dir):
    """The same on a stream that is read once for both kinds of alert."""
    events = inputs.shape_late(inputs.shape_events(table_stream(spark, sf_dir, "events.parquet")))
    folder = scratch_dir(spark, "fraud-one-read")
    writer = fraud_writer(folder, "1 hour", "1 minute", 90_000, 2)
    jobs.start(_in_thousands(events), writer, f"{folder}/checkpoint").awaitTermination()
    columns = ["order_id", "user_id", "reason", "score"]
    high = read_batches(spark, f"{folder}/high-value").select(columns)
    return high.unionByName(read_batches(spark, f"{folder}/velocity/alerts").select(columns))


@query
def stream_velocity_exact(spark, sf_dir):
    """Late events left out by the same rule as in a batch."""
    events = inputs.shape_events(table_stream(spark, sf_dir, "events.parquet"))
    folder = scratch_dir(spark, "velocity-exact")
    writer = velocity_writer(folder, "1 hour", threshold=2)
    jobs.start(inputs.shape_late(events), writer, f"{folder}/checkpoint").awaitTermination()
    return read_batches(spark, f"{folder}/alerts").drop("batch_id")


@query
def stream_velocity_per_record(spark, sf_dir):
    events = inputs.shape_events(table_stream(spark, sf_dir, "events.parquet"))
    alerts = velocity_stream(events, "1 day", mode="per_record")
    written = jobs.run_to_table(alerts, scratch_dir(spark, "velocity-each"))
    return read_batches(spark, written).drop("batch_id")


@query
def stream_velocity_clock(spark, sf_dir):
    """Late events left out by a clock for each partition, chained before the counter of each user."""
    events = inputs.shape_late(inputs.shape_events(table_stream(spark, sf_dir, "events.parquet")))
    alerts = velocity_stream(events, "1 hour", mode="per_record", threshold=2, partition="partition")
    written = jobs.run_to_table(alerts, scratch_dir(spark, "velocity-clock"))
    return read_batches(spark, written).drop("batch_id")


def _hourly(events):
    """One key per user, kind and hour; views have none."""
    return events.select(
        F.when(
            F.col("event_type") != "view", F.date_format("occurred_at", "yyyy-MM-dd HH")
        ).alias("event_id"),
        F.concat_ws("|", F.col("user_id").cast("string"), "event_type").alias("channel"),
        "occurred_at",
        "offset",
    )


@query
def stream_dedup(spark, sf_dir):
    """One record per key; which of the copies is not settled by a stream."""
    events = inputs.shape_events(table_stream(spark, sf_dir, "events.parquet"))
    kept = dedup_stream(_hourly(events), horizon="60 days")
    written = jobs.run_to_table(kept, scratch_dir(spark, "dedup"))
    return read_batches(spark, written).select("channel", "event_id")


def _purchases_and_signups(spark, sf_dir, **options):
    events = inputs.shape_events(table_stream(spark, sf_dir, "events.parquet", **options))
    text = F.concat(
        F.lit("user-"), F.col("user_id").cast("string"), F.lit("-v"), F.col("offset").cast("string")
    )
    change = F.col("event_type") == "signup"
    return events.where(F.col("event_type").isin("signup", "purchase")).select(
        "user_id",
        "offset",
        F.when(change, 0).otherwise(1).alias("log_side"),
        F.when(change, text).alias("name"),
        F.when(change, F.concat(text, F.lit("@example.com"))).alias("email"),
        money("value").alias("total_amount"),
    )


@query
def stream_dedup_table(spark, sf_dir):
    """The same against the table written so far."""
    events = inputs.shape_events(table_stream(spark, sf_dir, "events.parquet"))
    folder = scratch_dir(spark, "dedup-table")
    writer = dedup_writer(f"{folder}/table", horizon="60 days")
    jobs.start(_hourly(events), writer, f"{folder}/checkpoint").awaitTermination()
    return read_batches(spark, f"{folder}/table").select("channel", "event_id", "offset")


@query
def stream_enrich(spark, sf_dir):
    """Profile at arrival, with the profiles in a versioned table."""
    folder = scratch_dir(spark, "enrich")
    writer = enrich_writer(folder, fields=["name", "email"])
    log = _purchases_and_signups(spark, sf_dir)
    jobs.start(log, writer, f"{folder}/checkpoint").awaitTermination()
    return read_batches(spark, f"{folder}/orders").drop("batch_id")


@query
def stream_enrich_keyed(spark, sf_dir):
    """Profile at arrival, with the profiles in per-key state and small micro-batches."""
    log = _purchases_and_signups(spark, sf_dir, max_bytes=1 << 30)
    joined = enrich_log(log, "user_id", "offset", ["name", "email"], ["total_amount"], salts=4)
    written = jobs.run_to_table(joined, scratch_dir(spark, "enrich-keyed"))
    return read_batches(spark, written).drop("batch_id")


@query
def stream_reserve(spark, sf_dir):
    lines = inputs.shape_lines(table_stream(spark, sf_dir, "lineitem.parquet"))
    folder = scratch_dir(spark, "reserve")
    writer = reserve_writer(folder, inputs.stock(spark, sf_dir), inputs.LINE_ORDER)
    jobs.start(lines, writer, f"{folder}/checkpoint").awaitTermination()
    events = read_batches(spark, f"{folder}/events")
    return events.select("offset", "line", "sku", "quantity", "status")


@query
def stream_payments(spark, sf_dir):
    orders = inputs.shape_orders(table_stream(spark, sf_dir, "orders.parquet"))
    written = jobs.stream_payments(orders, scratch_dir(spark, "payments"))
    return read_committed(spark, written, ["transaction_id"])


@query
def stream_upsert(spark, sf_dir):
    """Latest values per user, upserted from the event stream."""
    events = inputs.shape_events(table_stream(spark, sf_dir, "events.parquet"))
    updates = events.select(
        "user_id",
        "offset",
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
    )
    folder = scratch_dir(spark, "upsert")
    writer = upsert_writer(
        f"{folder}/table", "user_id", "offset", on_null="delete", missing="overwrite"
    )
    jobs.start(updates, writer, f"{folder}/checkpoint").awaitTermination()
    return read_table(spark, f"{folder}/table")


@query
def stream_upsert_buckets(spark, sf_dir):
    """Customers, then what events say of them in three parts: each batch rewrites the buckets it touches."""
    kind = F.col("event_type")
    text = F.col("offset").cast("string")
    known = inputs.profiles(spark, sf_dir).withColumns(
        {"offset": F.lit(-1).cast("long"), "phone": F.lit(None).cast("string")}
    )
    updates = inputs.events_log(spark, sf_dir).select(
        "user_id",
        "offset",
        F.when(kind == "signup", F.concat(F.lit("name-"), text)).alias("name"),
        F.when(kind.isin("signup", "view"), F.concat(F.lit("mail-"), text)).alias("email"),
        F.when(kind == "purchase", F.concat(F.lit("phone-"), text)).alias("phone"),
    )
    days = [F.col("offset") % 3 == k for k in range(3)]
    turns = [updates.where(day).withColumn("turn", F.lit(k)) for k, day in enumerate(days)]
    parts = [known.withColumn("turn", F.lit(-1)), *turns]
    folder = inputs.arrivals(spark, "arrivals", [p.select(*parts[0].columns) for p in parts], bucket_of(["user_id"], 32))
    job = scratch_dir(spark, "upsert-buckets")
    writer = bucket_writer(f"{job}/table", "user_id", ["turn", "offset"], buckets=32)
    stream = table_stream(spark, folder, "*.parquet", max_files=1)
    jobs.start(stream, writer, f"{job}/checkpoint").awaitTermination()
    return read_buckets(spark, f"{job}/table")


@query
def stream_documents(spark, sf_dir):
    """The last document of each user, and the records put aside, of a log that comes in two parts."""
    log = inputs.raw_documents(spark, sf_dir)
    middle = F.lit("2024-01-15").cast("timestamp")
    parts = [log.where(F.col("timestamp") < middle), log.where(F.col("timestamp") >= middle)]
    folder = inputs.arrivals(spark, "documents", parts, bucket_of([F.col("key").cast("string")], 32))
    job = scratch_dir(spark, "documents")
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("email", T.StringType())])
    writer = document_writer(job, schema, required=("name",), buckets=32)
    stream = table_stream(spark, folder, "*.parquet", max_files=1)
    jobs.start(stream, writer, f"{job}/checkpoint").awaitTermination()
    kept = read_buckets(spark, f"{job}/table")
    dead = read_batches(spark, f"{job}/dead").select("offset", F.col("key").cast("string").alias("id"), "error")
    return kept.unionByName(dead, allowMissingColumns=True)


@query
def stream_reserve_redelivered(spark, sf_dir):
    """Lines in two parts; the second brings a third of the first again, and takes no stock for it."""
    lines = inputs.order_lines_log(spark, sf_dir)
    middle = lines.agg(F.percentile_approx("offset", 0.5).alias("middle")).first().middle
    again = (F.col("offset") >= middle) | (F.col("offset") % 3 == 0)
    parts = [lines.where(F.col("offset") < middle), lines.where(again)]
    folder, job = scratch_dir(spark, "lines"), scratch_dir(spark, "reserve-once")
    coordinate = ("partition", "offset")
    writer = reserve_writer(job, inputs.stock(spark, sf_dir), inputs.LINE_ORDER, coordinate=coordinate)
    for part in parts:
        # The job is stopped and started again between the parts.
        part.write.mode("append").parquet(folder)
        jobs.start(table_stream(spark, folder, "*.parquet"), writer, f"{job}/checkpoint").awaitTermination()
    return read_batches(spark, f"{job}/events").select("offset", "line", "sku", "quantity", "status")


@query
def stream_retained_windows(spark, sf_dir):
    """Windows that are still kept when the log has been read: those that can grow yet."""
    events = inputs.shape_events(table_stream(spark, sf_dir, "events.parquet"))
    folder = scratch_dir(spark, "velocity-retained")
    writer = velocity_writer(folder, "1 hour", threshold=2)
    jobs.start(inputs.shape_late(events), writer, f"{folder}/checkpoint").awaitTermination()
    return read_table(spark, f"{folder}/counts").select("user_id", "window_start", "window_end", "n")


class _Once:
    """A fault that strikes the first time only, after a batch was written and before it counts."""

    def __init__(self):
        self.struck = False

    def __call__(self, batch_id):
        if not self.struck:
            self.struck = True
            raise RuntimeError("the job dies before the commit")


@query
def stream_payments_restarted(spark, sf_dir):
    """The job dies after its first write; begun again by its supervisor it pays every order once."""
    orders = inputs.shape_orders(table_stream(spark, sf_dir, "orders.parquet"))
    folder = scratch_dir(spark, "payments-restarted")
    written = jobs.stream_payments(orders, folder, _Once(), restarts=1)
    return read_batches(spark, written).drop("batch_id")


@query
def stream_notification_groups(spark, sf_dir):
    """Two consumer groups over one log, each with its own progress; one of them dies and goes on alone."""
    folder = scratch_dir(spark, "groups")
    payments = inputs.payments_log(spark, sf_dir)
    log = inputs.arrivals(spark, "payments-log", [payments], "event_id")
    stream = table_stream(spark, log, "*.parquet")
    faults = {"notification-email": None, "notification-sms": _Once()}

    def sent(group):
        return lambda batch: notify.payment_notifications(batch).where(F.col("group_id") == group)

    writers = {
        group: exactly_once_writer(f"{folder}/{group}", sent(group), fault) for group, fault in faults.items()
    }
    for group, running in start_groups(stream, writers, f"{folder}/progress").items():
        first = iter([running])

        def begin(group=group, first=first):
            again = {group: writers[group]}
            return next(first, None) or start_groups(stream, again, f"{folder}/progress")[group]

        jobs.supervise(begin, restarts=1)
    tables_of = [read_batches(spark, f"{folder}/{group}").drop("batch_id") for group in writers]
    return tables_of[0].unionByName(tables_of[1])


@query
def stream_state_lookup(spark, sf_dir):
    """Every customer looked up in the state of the running enrichment: the profile, or why there is none."""
    folder = scratch_dir(spark, "enrich-state")
    log = _purchases_and_signups(spark, sf_dir)
    joined = enrich_log(log, "user_id", "offset", ["name", "email"], ["total_amount"])
    jobs.run_to_table(joined, folder)
    state = jobs.read_state(spark, f"{folder}/checkpoint", "profile")
    state = state.select("user_map_key.user_id", "user_map_value.*")
    wanted = inputs.profiles(spark, sf_dir).select("user_id")
    return tables.lookup_many(state, wanted, "user_id")


@query
def stream_counters(spark, sf_dir):
    """Payments by status, counted while the job ran and read from the table of its reports."""
    orders = inputs.shape_orders(table_stream(spark, sf_dir, "orders.parquet"))
    folder = scratch_dir(spark, "payments-counted")
    paid = F.col("status") == "PAID"
    counted = observe_counts(charge(orders), "payments", paid=paid, failed=~paid)
    listener = ProgressTable(spark, f"{folder}/progress", names=["payments-counted"])
    spark.streams.addListener(listener)
    try:
        running = jobs.start_to_table(counted, folder, name="payments-counted")
        running.awaitTermination()
        listener.wait(running.runId)
    finally:
        spark.streams.removeListener(listener)
    return counter_totals(read_progress(spark, f"{folder}/progress"))


@query
def stream_topic_orders(spark, sf_dir):
    """Orders with their lines from a topic, decoded by their schema in capped micro-batches, a member of the
    group for each partition; the job is stopped in between."""
    events = inputs.order_events(spark, sf_dir)
    log, job = scratch_dir(spark, "orders-topic"), scratch_dir(spark, "orders-read")
    for half in (0, 1):
        some = events.where(F.col("offset") % 2 == half)
        # By half the offset, as offsets of one half leave only three remainders of six: every member has a share.
        placed = some.withColumn("partition", (F.floor(F.col("offset") / 2) % 6).cast("int"))
        # Four writers a partition, whatever the number of tasks before: all but their last files are full.
        placed = placed.repartition("partition", F.floor(F.col("offset") / 12) % 4)
        rows = to_topic_rows(
            placed, "userId", "orders", trace="traceId", partition="partition", fields=ORDER_CREATED.fieldNames(),
        )
        write_topic(rows.withColumns({
            "offset": F.lit(0).cast("long"), "timestamp": F.lit("2026-01-01").cast("timestamp"), "timestampType": F.lit(0),
        }), path=log, segment_records=20_000)
        members = {}
        for partition in range(6):
            topic = read_topic(
                spark, "orders", streaming=True, path=log, max_per_trigger=40_000, segment_records=20_000,
                partitions=[partition],
            )
            decoded = decode.decode_json(topic, ORDER_CREATED, required=("orderId", "userId"))
            good, _ = decode.quarantine(decoded)
            members[partition] = to_columns(good.select("event.*"))
        jobs.run_members(members, job)
    orders = intake.accept(read_batches(spark, f"{job}/table"))
    return orders.select(
        "event_id", F.col("occurred_at").cast("timestamp_ntz").alias("occurred_at"), "order_id", "user_id",
        "total_amount", "currency",
        F.size("items").cast("long").alias("n_items"),
        F.array_join(F.transform("items", lambda i: i["sku"]), ",").alias("skus"),
    )


@query
def stream_payments_inserted(spark, sf_dir):
    """Most orders come twice, in batches of their own; the table has one payment each as it lies there."""
    orders = inputs.orders_log(spark, sf_dir)
    parts = [orders.where("offset % 4 <> 0"), orders.where("offset % 4 <> 1")]
    log = inputs.arrivals(spark, "orders-twice", parts, bucket_of([transaction_id("order_id")], 32))
    job = scratch_dir(spark, "payments-inserted")
    writer = insert_writer(f"{job}/table", "transaction_id", "amount", buckets=32, transform=charge)
    stream = table_stream(spark, log, "*.parquet", max_files=1)
    jobs.start(stream, writer, f"{job}/checkpoint").awaitTermination()
    return read_inserted(spark, f"{job}/table")
