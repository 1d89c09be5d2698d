"""Notifications from payments and shipments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalar import col
from millrace.operators.dedup import dedup_events

# Channel names, their consumer groups and message texts.
EMAIL = ("payments-email", "notification-email", "Email sent")
SMS = ("payments-sms", "notification-sms", "SMS sent")
TRACKING = ("shipments-in", "notification-email", "tracking link sent")

COLUMNS = ["channel", "group_id", "event_id", "order_id", "user_id", "message"]


def _text(opening, fields, group):
    parts = [F.lit(opening)]
    for label, column in fields:
        value = F.coalesce(col(column).cast("string"), F.lit("null"))
        parts.append(F.concat(F.lit(f"{label}="), value))
    parts.append(F.lit(f"group={group}"))
    return F.concat_ws(" ", *parts)


def _entry(channel, fields):
    name, group, opening = channel
    return F.struct(
        F.lit(name).alias("channel"),
        F.lit(group).alias("group_id"),
        _text(opening, fields, group).alias("message"),
    )


def payment_notifications(payments: DataFrame, order="offset") -> DataFrame:
    """An email and an sms per payment event.

    Both channels see the same log, so a repeated event is found once, before the fan-out,
    and the log is read and shuffled once rather than once per channel.
    """
    fields = [("orderId", "order_id"), ("userId", "user_id"), ("status", "status")]
    once = dedup_events(payments, ("event_id",), (order,))
    both = F.array(_entry(EMAIL, fields), _entry(SMS, fields))
    return once.select("event_id", "order_id", "user_id", F.explode(both).alias("_n")).select(
        "_n.channel", "_n.group_id", "event_id", "order_id", "user_id", "_n.message"
    )


def tracking_notifications(shipments: DataFrame, order="offset") -> DataFrame:
    """A tracking link per shipment event."""
    fields = [("shipmentId", "shipment_id"), ("orderId", "order_id"), ("userId", "user_id")]
    once = dedup_events(shipments, ("event_id",), (order,))
    return once.withColumn("_n", _entry(TRACKING, fields)).select(
        "_n.channel", "_n.group_id", "event_id", "order_id", "user_id", "_n.message"
    )


def notifications(payments: DataFrame, shipments: DataFrame | None = None, order="offset"):
    """All messages of all channels, each event once per channel."""
    sent = payment_notifications(payments, order)
    if shipments is None:
        return sent
    return sent.unionByName(tracking_notifications(shipments, order))
