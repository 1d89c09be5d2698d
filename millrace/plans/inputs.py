"""The given tables as the logs and tables the operators work on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.scalar import money
from millrace.session import scratch_dir


def arrivals(spark, name, parts, key) -> str:
    """A folder of files that arrive one part after the other, for a stream to read.

    Inside a part, files hold different keys, so it does not matter which of them comes first. With the bucket
    of a key as ``key``, no two files of a part have a bucket in common either: a table in buckets that takes
    them one by one rewrites or reads each bucket once for a part, however many files it has.
    """
    folder = scratch_dir(spark, name)
    for part in parts:
        part.repartition(key).write.mode("append").parquet(folder)
    return folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shape_orders(orders: DataFrame) -> DataFrame:
    """Orders as a log: the order key is the offset, the customer the user."""
    key = F.col("o_orderkey").cast("string")
    return orders.select(
        F.col("o_orderkey").alias("offset"),
        F.concat(F.lit("evt-"), key).alias("event_id"),
        F.col("o_orderdate").alias("occurred_at"),
        F.concat(F.lit("trace-"), key).alias("trace_id"),
        key.alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        money("o_totalprice").alias("total_amount"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderpriority").alias("priority"),
    )


def orders_log(spark, sf_dir):
    return shape_orders(table(spark, sf_dir, "orders"))


def shape_events(events: DataFrame) -> DataFrame:
    """Events as a log: ids are offsets in time order, six partitions by user."""
    return events.select(
        F.col("event_id").alias("offset"),
        (F.col("user_id") % 6).cast("int").alias("partition"),
        "user_id",
        F.col("ts").alias("occurred_at"),
        "event_type",
        "value",
        "props",
    )


def events_log(spark, sf_dir):
    return shape_events(table(spark, sf_dir, "events"))


def shape_late(log: DataFrame) -> DataFrame:
    """Events of which some happened 2 or 20 minutes before they were recorded."""
    recorded = F.col("occurred_at")
    happened = (
        F.when(F.col("offset") % 17 == 0, recorded - F.expr("INTERVAL 20 MINUTES"))
        .when(F.col("offset") % 11 == 0, recorded - F.expr("INTERVAL 2 MINUTES"))
        .otherwise(recorded)
    )
    return log.withColumns({"timestamp": recorded, "occurred_at": happened})


def late_log(spark, sf_dir):
    return shape_late(events_log(spark, sf_dir))


def profiles(spark, sf_dir):
    """Customers as user profiles."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lower(F.translate("c_name", "#", ".")), F.lit("@example.com")).alias("email"),
    )


def shape_profile_changes(events: DataFrame, kinds=("signup",)) -> DataFrame:
    """Sign-ups as profile changes; errors, where asked for, as tombstones."""
    text = F.concat(
        F.lit("user-"), F.col("user_id").cast("string"), F.lit("-v"), F.col("offset").cast("string")
    )
    present = F.col("event_type") == "signup"
    return events.where(F.col("event_type").isin(*kinds)).select(
        "user_id",
        "offset",
        F.when(present, text).alias("name"),
        F.when(present, F.concat(text, F.lit("@example.com"))).alias("email"),
    )


def shape_purchases(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == "purchase").select(
        "user_id", "offset", money("value").alias("total_amount")
    )


def changes_log(spark, sf_dir):
    """Events as captured row changes of a user table."""
    op = (
        F.when(F.col("event_type") == "signup", "c")
        .when(F.col("event_type") == "error", "d")
        .otherwise("u")
    )
    return events_log(spark, sf_dir).select(
        F.col("user_id").alias("key"),
        "partition",
        "offset",
        F.lit("shop.public.users").alias("topic"),
        op.alias("op"),
        F.struct("user_id", "event_type", "value").alias("after"),
    )


def shape_lines(lineitem: DataFrame) -> DataFrame:
    """Order lines in log order. Order and line number are not unique: the other columns
    break ties."""
    return lineitem.select(
        F.col("l_orderkey").alias("offset"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("sku"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_suppkey").alias("supplier"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        F.col("l_shipdate").alias("shipped"),
    )


LINE_ORDER = ("offset", "line", "supplier", "quantity", "price", "discount", "tax", "shipped")


def lines_log(spark, sf_dir):
    return shape_lines(table(spark, sf_dir, "lineitem"))


def stock(spark, sf_dir, per_size=10):
    """Parts as stock."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("sku"), (F.col("p_size") * per_size).alias("quantity")
    )


def requests(spark, sf_dir):
    """Line items as order requests of two items, with gaps left for intake to fill."""
    given = F.when(F.col("l_linestatus") == "F", money("l_extendedprice"))
    currency = F.when(F.col("l_returnflag") == "R", "EUR").when(
        F.col("l_returnflag") == "A", "  "
    )
    items = F.array(
        F.struct(
            F.col("l_partkey").cast("string").alias("sku"),
            F.col("l_quantity").cast("int").alias("quantity"),
            money("l_extendedprice").alias("price"),
        ),
        F.struct(
            F.lit("shipping").alias("sku"),
            F.col("l_linenumber").alias("quantity"),
            money(F.col("l_tax") * 100).alias("price"),
        ),
    )
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("offset"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_suppkey").cast("string").alias("user_id"),
        items.alias("items"),
        given.alias("total_amount"),
        currency.alias("currency"),
    )


def defective_orders(spark, sf_dir):
    """Orders of which some break one or more of the rules."""
    fault = F.col("offset") % 50
    line = F.struct(
        F.when(fault == 2, " ").otherwise("SKU-1").alias("sku"),
        F.when(fault == 3, 0).otherwise(1).alias("quantity"),
        F.when(fault != 4, F.col("total_amount")).alias("price"),
    )
    no_lines = F.array().cast("array<struct<sku:string,quantity:int,price:decimal(18,2)>>")
    items = F.when(fault == 1, no_lines).otherwise(F.array(line))
    return orders_log(spark, sf_dir).select(
        "offset",
        "order_id",
        F.when(fault != 5, F.col("event_id")).alias("event_id"),
        F.when(fault != 6, F.col("occurred_at")).alias("occurred_at"),
        F.when(fault == 7, "").otherwise(F.col("trace_id")).alias("trace_id"),
        F.when(~fault.isin(3, 8), F.col("user_id").cast("string")).alias("user_id"),
        items.alias("items"),
        F.when(fault != 9, F.col("total_amount")).alias("total_amount"),
        F.concat(F.lit("idem-"), F.col("order_id")).alias("idempotency_key"),
        F.when(fault == 10, "\t").otherwise("USD").alias("currency"),
    )


def payments_log(spark, sf_dir):
    """Payments, each delivered twice; some carry no event id."""
    from millrace.operators.payments import charge

    orders = orders_log(spark, sf_dir)
    once = charge(orders).withColumns(
        {
            "event_id": F.when(
                F.col("order_id").cast("long") % 97 != 0,
                F.concat(F.lit("pay-evt-"), F.col("order_id")),
            ),
            "offset": F.col("order_id").cast("long"),
        }
    )
    again = once.withColumn("offset", F.col("offset") + 1_000_000_000_000)
    return once.unionByName(again)


def shipments_log(spark, sf_dir):
    """A shipment per order, delivered twice."""
    once = orders_log(spark, sf_dir).select(
        F.concat(F.lit("ship-evt-"), F.col("order_id")).alias("event_id"),
        F.concat(F.lit("ship-"), F.col("order_id")).alias("shipment_id"),
        "order_id",
        "user_id",
        "offset",
    )
    again = once.withColumn("offset", F.col("offset") + 1_000_000_000_000)
    return once.unionByName(again)


def topic_log(spark, sf_dir):
    """Events as raw records; some values are cut short, some are empty."""
    fault = F.col("offset") % 13
    text = (
        F.when(fault == 1, F.substring("props", 1, 4))
        .when(fault == 2, F.lit(""))
        .when(fault == 3, F.lit('{"k": "many"}'))
        .when(fault == 4, F.lit('{"other": 1}'))
        .otherwise(F.col("props"))
    )
    trace = F.concat(F.lit("h-"), F.col("offset").cast("string"))

    def header(key, value):
        return F.struct(F.lit(key).alias("key"), F.encode(value, "UTF-8").alias("value"))

    kind = F.col("event_type")
    own = header("traceId", trace)
    headers = (
        F.when(kind == "click", F.array(header("traceId", F.lit("old")), own))
        .when(kind == "view", F.array(own, header("lang", F.lit("en"))))
        .when(kind == "error", F.array(header("traceId", F.lit(""))))
        .otherwise(F.array().cast("array<struct<key:string,value:binary>>"))
    )
    return events_log(spark, sf_dir).select(
        F.encode(F.col("user_id").cast("string"), "UTF-8").alias("key"),
        F.encode(text, "UTF-8").alias("value"),
        F.lit("events").alias("topic"),
        "partition",
        "offset",
        F.col("occurred_at").alias("timestamp"),
        headers.alias("headers"),
        "event_type",
        "user_id",
    )


def raw_documents(spark, sf_dir):
    """Events as documents about their user; some are cut short, lack a name or have no key, errors have no value."""
    fault = F.col("offset") % 29
    text = F.col("offset").cast("string")
    document = F.to_json(F.struct(
        F.when(fault != 1, F.concat(F.lit("name-"), text)).alias("name"),
        F.when(F.col("event_type") != "view", F.concat(F.lit("mail-"), text)).alias("email"),
    ))
    value = F.when(fault == 2, F.substring(document, 1, 9)).otherwise(document)
    return events_log(spark, sf_dir).select(
        F.when(fault != 3, F.encode(F.col("user_id").cast("string"), "UTF-8")).alias("key"),
        F.when(F.col("event_type") != "error", F.encode(value, "UTF-8")).alias("value"),
        F.lit("profiles").alias("topic"),
        "partition",
        "offset",
        F.col("occurred_at").alias("timestamp"),
        F.array().cast("array<struct<key:string,value:binary>>").alias("headers"),
    )


def order_lines_log(spark, sf_dir):
    """Order lines as they are on a log of one partition."""
    return lines_log(spark, sf_dir).withColumn("partition", F.lit(0))


def with_order(lines):
    """Lines, or what became of them, with what the events of their order carry on: it follows from the line."""
    order = F.col("offset").cast("string")
    return lines.withColumns({
        "order_id": order,
        "trace_id": F.concat(F.lit("trace-"), order),
        "occurred_at": F.col("shipped"),
    })


def order_events(spark, sf_dir):
    """Orders with their list of lines, as events under their wire names; totals and currencies have gaps."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").cast("string").alias("sku"),
        F.col("l_quantity").cast("int").alias("quantity"),
        money("l_extendedprice").alias("price"),
    ))).alias("lines"))
    orders = orders_log(spark, sf_dir).join(lines, F.col("offset") == F.col("l_orderkey"), "left")
    items = F.transform("lines", lambda i: F.struct(i["sku"], i["quantity"], i["price"]))
    none = F.array().cast("array<struct<sku:string,quantity:int,price:decimal(18,2)>>")
    return orders.select(
        "offset",
        F.col("event_id").alias("eventId"),
        F.col("occurred_at").cast("timestamp").alias("occurredAt"),
        F.col("trace_id").alias("traceId"),
        F.col("order_id").alias("orderId"),
        F.col("user_id").cast("string").alias("userId"),
        F.coalesce(items, none).alias("items"),
        F.when(F.col("order_status") != "P", F.col("total_amount")).alias("totalAmount"),
        F.concat(F.lit("idem-"), F.col("order_id")).alias("idempotencyKey"),
        F.when(F.col("order_status") != "O", F.lit("EUR")).alias("currency"),
    )
