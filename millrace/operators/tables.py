"""Keyed tables: latest per key, upserts, last rows, lookups and search."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# A word of a search: the same for the documents and for what is asked.
WORD = r"\w+(?:\.\w+)*"


def latest_per_key(
    log: DataFrame, key, order=("partition", "offset"), *, tombstone=None, drop_tombstones=True
):
    """The last record of each key, one row per key.

    ``tombstone`` is the condition of a deleting record; keys that end in one are left out
    unless ``drop_tombstones`` is off. Aggregated before the shuffle, so updates of a hot
    key collapse where they are read.
    """
    keys = [key] if isinstance(key, str) else list(key)
    marked = log if tombstone is None else log.withColumn("_gone", tombstone)
    rest = [c for c in marked.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order))
    table = marked.groupBy(*keys).agg(last.alias("_last")).select(*keys, "_last.*")
    if tombstone is None:
        return table
    kept = table.where(~F.coalesce("_gone", F.lit(False))) if drop_tombstones else table
    return kept.drop("_gone")


def upsert(
    target: DataFrame, updates: DataFrame, keys, order_by, *, on_null="ignore",
    missing="keep", tombstone=None,
):
    """The table after the updates: inserts, and updates by key in ``order_by`` order.

    A null record (all its fields null, or ``tombstone`` where given) is ignored or, with
    ``on_null="delete"``, removes the key until a later record brings it back. A field
    that is null in a record keeps the value it had (``missing="keep"``, a relational
    upsert that writes only the columns a record has) or becomes null
    (``"overwrite"``, a document replaced as a whole). Columns new to the table are added.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order_by = [order_by] if isinstance(order_by, str) else list(order_by)
    fields = [c for c in updates.columns if c not in keys and c not in order_by]
    columns = list(dict.fromkeys([*target.columns, *fields]))
    values = [c for c in columns if c not in keys]
    empty = tombstone if tombstone is not None else F.coalesce(
        *[F.col(c).cast("string") for c in fields]
    ).isNull()

    old = target.select(
        "*", F.lit(False).alias("_null"), F.lit(0).alias("_round")
    )
    new = updates.select(
        *keys, *fields, empty.alias("_null"), F.lit(1).alias("_round"),
        F.struct(*order_by).alias("_order"),
    )
    if on_null == "ignore":
        new = new.where(~F.col("_null"))
    log = old.unionByName(new, allowMissingColumns=True).withColumn(
        "_at", F.struct("_round", "_order")
    )
    grouped = log.groupBy(*keys)
    if missing == "overwrite":
        last = F.max_by(F.struct("_null", *values), F.col("_at"))
        table = grouped.agg(last.alias("_last")).select(*keys, "_last.*")
        return table.where(~F.col("_null")).select(*columns)

    # Per field the last value that was given, and when; a deletion clears what is older.
    last_given = [
        F.max_by(F.struct("_at", c), F.when(F.col(c).isNotNull(), F.col("_at"))).alias(c)
        for c in values
    ]
    table = grouped.agg(
        *last_given,
        F.max(F.when(F.col("_null"), F.col("_at"))).alias("_deleted"),
        F.max(F.when(~F.col("_null"), F.col("_at"))).alias("_written"),
    )
    alive = F.col("_deleted").isNull() | (F.col("_written") > F.col("_deleted"))
    survives = {
        c: F.when(
            F.col("_deleted").isNull() | (F.col(f"{c}._at") > F.col("_deleted")), F.col(f"{c}.{c}")
        )
        for c in values
    }
    return table.where(F.col("_written").isNotNull() & alive).select(
        *[survives[c].alias(c) if c in survives else F.col(c) for c in columns]
    )


def with_ingested_at(df: DataFrame, ts) -> DataFrame:
    """Add ``ingested_at``: a column of the record, or one instant for the batch."""
    return df.withColumn("ingested_at", F.col(ts) if isinstance(ts, str) else ts)


def last_n(df: DataFrame, order, n=100, value=None) -> DataFrame:
    """The ``n`` most recent rows, oldest first; rows whose ``value`` is null are ignored.

    Each task keeps its own ``n`` rows, so nothing is sorted as a whole.
    """
    order = [order] if isinstance(order, str) else list(order)
    rows = df if value is None else df.where(F.col(value).isNotNull())
    recent = rows.orderBy(*[F.col(c).desc() for c in order]).limit(n)
    return recent.orderBy(*order)


def lookup(table: DataFrame, key, value) -> DataFrame:
    """The row with this key; empty if there is none. The filter reaches the scan."""
    return table.where(F.col(key) == F.lit(value))


def lookup_many(table: DataFrame, requests: DataFrame, key) -> DataFrame:
    """Each requested key with its row, or with ``found`` false and the reason. Requests are distinct."""
    found = table.withColumn("found", F.lit(True))
    answered = requests.join(found, key, "left")
    hit = F.coalesce("found", F.lit(False))
    return answered.withColumn("found", hit).withColumn(
        "reason", F.when(~hit, F.lit("not found"))
    )


def search_rows(df: DataFrame, q, limit=10, *, columns=None, tie="order_id") -> DataFrame:
    """Rows holding words of ``q`` in a text column, most matched words first.

    Words are runs of letters, digits and single dots between them, on both sides, and match as a
    whole. Case does not matter. A blank query or ``*`` finds every row. ``tie`` orders rows with
    the same rank.
    """
    text_columns = columns or [name for name, kind in df.dtypes if kind == "string"]
    words = list(dict.fromkeys(re.findall(WORD, (q or "").lower())))
    if (q or "").strip() in ("", "*"):
        ranked = df.withColumn("matched", F.lit(0))
    else:
        held = F.regexp_extract_all(F.lower(F.concat_ws("\n", *text_columns)), F.lit("(?U)" + WORD), F.lit(0))
        asked = F.array(*[F.lit(word) for word in words]).cast("array<string>")
        total = F.size(F.array_intersect(asked, held))
        ranked = df.withColumn("matched", total).where(F.col("matched") > 0)
    return ranked.orderBy(F.col("matched").desc(), tie).limit(limit)
