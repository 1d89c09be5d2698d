"""Topic names and event schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# Topic name -> partition count.
TOPICS = {
    "orders": 6,
    "users": 3,
    "payments": 6,
    "inventory-events": 6,
    "fraud-alerts": 3,
    "orders-enriched": 6,
    "shipments": 6,
    "orders-dlq": 3,
    "orders-retry-5s": 3,
    "orders-retry-1m": 3,
    "audit-log": 3,
    "users-cdc": 3,
}

# Enumerations carried as strings.
PAYMENT_STATUS = ("PAID", "FAILED")
INVENTORY_STATUS = ("RESERVED", "REJECTED", "RELEASED")
FRAUD_REASON = ("HIGH_VALUE", "VELOCITY")

MONEY = T.DecimalType(18, 2)


def _fields(*pairs):
    return [T.StructField(name, kind) for name, kind in pairs]


def _event(*pairs):
    """An event: the common envelope followed by its own fields."""
    return T.StructType(
        _fields(
            ("eventId", T.StringType()),
            ("occurredAt", T.TimestampType()),
            ("traceId", T.StringType()),
            *pairs,
        )
    )


ITEM = T.StructType(
    _fields(("sku", T.StringType()), ("quantity", T.IntegerType()), ("price", MONEY))
)

_ORDER_FIELDS = (
    ("orderId", T.StringType()),
    ("userId", T.StringType()),
    ("items", T.ArrayType(ITEM)),
    ("totalAmount", MONEY),
    ("idempotencyKey", T.StringType()),
    ("currency", T.StringType()),
)

ORDER_CREATED = _event(*_ORDER_FIELDS)
ENRICHED_ORDER = _event(
    *_ORDER_FIELDS, ("userName", T.StringType()), ("userEmail", T.StringType())
)
PAYMENT_COMPLETED = _event(
    ("orderId", T.StringType()),
    ("userId", T.StringType()),
    ("amount", MONEY),
    ("status", T.StringType()),
    ("transactionId", T.StringType()),
)
INVENTORY_RESERVED = _event(
    ("orderId", T.StringType()),
    ("sku", T.StringType()),
    ("quantity", T.IntegerType()),
    ("status", T.StringType()),
)
FRAUD_ALERT = _event(
    ("orderId", T.StringType()),
    ("userId", T.StringType()),
    ("reason", T.StringType()),
    ("score", T.DoubleType()),
)
SHIPMENT_CREATED = _event(
    ("shipmentId", T.StringType()),
    ("orderId", T.StringType()),
    ("userId", T.StringType()),
    ("status", T.StringType()),
)
AUDIT_ENTRY = _event(
    ("entityId", T.StringType()),
    ("action", T.StringType()),
    ("payload", T.StringType()),
    ("timestamp", T.TimestampType()),
)

USER_PROFILE_V1 = T.StructType(
    [T.StructField(name, T.StringType(), False) for name in ("user_id", "name", "email")]
)
USER_PROFILE_V2 = T.StructType(
    USER_PROFILE_V1.fields + [T.StructField("phone", T.StringType(), True)]
)

TOPIC_LOG = T.StructType(
    _fields(
        ("key", T.BinaryType()),
        ("value", T.BinaryType()),
        ("topic", T.StringType()),
        ("partition", T.IntegerType()),
        ("offset", T.LongType()),
        ("timestamp", T.TimestampType()),
        ("timestampType", T.IntegerType()),
        (
            "headers",
            T.ArrayType(
                T.StructType(_fields(("key", T.StringType()), ("value", T.BinaryType())))
            ),
        ),
    )
)

# Event fields use the wire names; columns of the tables use snake case.
_WIRE = {
    "eventId": "event_id",
    "occurredAt": "occurred_at",
    "traceId": "trace_id",
    "orderId": "order_id",
    "userId": "user_id",
    "totalAmount": "total_amount",
    "idempotencyKey": "idempotency_key",
    "userName": "user_name",
    "userEmail": "user_email",
    "transactionId": "transaction_id",
    "shipmentId": "shipment_id",
    "entityId": "entity_id",
}


def to_columns(df):
    """Wire names to column names."""
    return df.withColumnsRenamed(_WIRE)


def to_wire(df):
    """Column names to wire names."""
    return df.withColumnsRenamed({column: wire for wire, column in _WIRE.items()})
