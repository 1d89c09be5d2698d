"""Order intake: totals, currency, lines and validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalar import col, default_currency, has_text, order_total
from millrace.operators.blocks import all_of

# Fixed value: the shape of an e-mail address, local part, at sign, domain.
EMAIL = r"^[^\s@]+@[^\s@.]+(\.[^\s@.]+)*$"


def accept(requests: DataFrame) -> DataFrame:
    """Fill in what a request may leave out: the total and the currency."""
    return requests.withColumns(
        {
            "total_amount": order_total("items", "total_amount"),
            "currency": default_currency("currency"),
        }
    )


def explode_lines(orders: DataFrame, keep=("order_id", "offset")) -> DataFrame:
    """One row per item in item order, numbered from zero in ``line``."""
    return orders.select(*keep, F.posexplode("items").alias("line", "_item")).select(
        *keep, "line", "_item.*"
    )


def not_null(column):
    return f"{column} is null", col(column).isNotNull()


def not_blank(column):
    return f"{column} is blank", has_text(column)


def not_empty(column):
    return f"{column} is empty", F.coalesce(F.size(col(column)) > 0, F.lit(False))


def at_least(column, low):
    """Null passes, as for any rule on an optional value."""
    return f"{column} is below {low}", F.coalesce(col(column) >= low, F.lit(True))


def email(column):
    """Null and empty pass; combine with ``not_blank`` where the address is required."""
    fits = (F.length(col(column)) == 0) | col(column).rlike(EMAIL)
    return f"{column} is not an address", F.coalesce(fits, F.lit(True))


def one_of(column, allowed):
    return f"{column} is unknown", F.coalesce(col(column).isin(*allowed), F.lit(True))


def each(column, name, test):
    """``test`` holds for each element of an array; an absent array passes."""
    return f"{column} has {name}", F.coalesce(F.forall(col(column), test), F.lit(True))


def valid_items(column="items"):
    """The rules every order line has to meet."""
    return [
        each(column, "a line without sku", lambda i: F.coalesce(i["sku"].rlike(r"\S"), F.lit(False))),
        each(column, "a line below 1", lambda i: F.coalesce(i["quantity"] >= 1, F.lit(False))),
        each(column, "a line without price", lambda i: i["price"].isNotNull()),
    ]


def request_rules():
    """Rules of an incoming order request."""
    return [not_blank("user_id"), not_empty("items"), *valid_items()]


def order_rules():
    """Rules of an order on the log."""
    return [
        *[not_null(c) for c in ("event_id", "occurred_at", "total_amount")],
        *[
            not_blank(c)
            for c in ("trace_id", "order_id", "user_id", "idempotency_key", "currency")
        ],
        not_empty("items"),
        *valid_items(),
    ]


def profile_rules():
    """Rules of a profile upsert."""
    return [not_blank("user_id"), not_blank("name"), not_blank("email"), email("email")]


def with_reasons(df: DataFrame, rules) -> DataFrame:
    """Add ``reasons``, the names of the rules a row breaks, in rule order."""
    broken = F.array(*[F.when(~holds, F.lit(name)) for name, holds in rules])
    return df.withColumn("reasons", F.filter(broken, lambda r: r.isNotNull()))


def validate(df: DataFrame, rules):
    """Rows that meet every rule, and the others with their ``reasons``."""
    meets_all = all_of([holds for _, holds in rules])
    return df.where(meets_all), with_reasons(df.where(~meets_all), rules)
