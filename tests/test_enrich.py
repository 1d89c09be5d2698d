import random

from pyspark.sql import functions as F

from millrace.operators.blocks import join_skewed
from millrace.operators.enrich import asof_enrich, enrich, fits

CHANGES = "user_id string, offset long, name string, email string"
ORDERS = "user_id string, offset long, order_id string"


def test_hit_and_miss(spark):
    orders = spark.createDataFrame([("ada", 1, "ord-1"), ("bob", 2, "ord-2"), (None, 3, "x")], ORDERS)
    profiles = spark.createDataFrame(
        [("ada", "Ada Lovelace", "ada@example.com")], "user_id string, name string, email string"
    )
    for rows in (None, 10, 0):
        got = enrich(orders, profiles, broadcast_rows=rows).collect()
        assert [(r.order_id, r.user_name, r.user_email) for r in got] == [
            ("ord-1", "Ada Lovelace", "ada@example.com")
        ]


def test_broadcast_is_checked(spark):
    assert fits(spark.range(20), 20) and not fits(spark.range(20), 19)


def test_skewed_join_equals_a_join(spark):
    """A third of the rows on one key, with keys missing on either side and null keys."""
    rows = spark.range(900).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN null ELSE concat('k', id % 40) END AS k")
    for names in (["hot", "k1", "k2", "zz"], ["k1", "k2", "zz"], []):
        table = spark.createDataFrame([(n, n.upper()) for n in names], "k string, v string")
        for how in ("inner", "left", "left_semi", "left_anti"):
            for limit in (30, 10_000):
                got = join_skewed(rows, table, ["k"], how, limit)
                expected = rows.join(table, "k", how)
                assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_order_before_profile_is_dropped_and_not_replayed(spark):
    orders = spark.createDataFrame([("u", 0, "ord-early"), ("u", 2, "ord-late")], ORDERS)
    changes = spark.createDataFrame([("u", 1, "N", "e")], CHANGES)
    assert [r.order_id for r in asof_enrich(orders, changes).collect()] == ["ord-late"]


def test_orders_see_the_profile_of_their_time(spark):
    orders = spark.createDataFrame([("u", 1, "ord-old"), ("u", 3, "ord-new")], ORDERS)
    changes = spark.createDataFrame([("u", 0, "I", "e"), ("u", 2, "II", "e")], CHANGES)
    got = {r.order_id: r.user_name for r in asof_enrich(orders, changes).collect()}
    assert got == {"ord-old": "I", "ord-new": "II"}


def test_tombstone_and_same_offset(spark):
    orders = spark.createDataFrame([("u", 1, "a"), ("u", 3, "b"), ("u", 5, "c")], ORDERS)
    changes = spark.createDataFrame(
        [("u", 1, "I", None), ("u", 2, None, None), ("u", 5, "V", None)], CHANGES
    )
    got = {r.order_id: r.user_name for r in asof_enrich(orders, changes).collect()}
    assert got == {"a": "I", "c": "V"}


def test_profiles_from_before_the_log(spark):
    orders = spark.createDataFrame([("u", 1, "a"), ("u", 3, "b")], ORDERS)
    changes = spark.createDataFrame([("u", 2, "II", "e")], CHANGES)
    before = spark.createDataFrame([("u", "I", "e")], "user_id string, name string, email string")
    got = {r.order_id: r.user_name for r in asof_enrich(orders, changes, before=before).collect()}
    assert got == {"a": "I", "b": "II"}


def test_hot_user_in_blocks_equals_the_rule(spark):
    rng = random.Random(11)
    orders, changes, now, expected = [], [], {}, {}
    for offset in range(700):
        user = rng.choice(["hot", "hot", "a", "b"])
        if rng.random() < 0.1:
            gone = rng.random() < 0.3
            now[user] = None if gone else f"v{offset}"
            changes.append((user, offset, now[user], now[user]))
        else:
            orders.append((user, offset, f"o{offset}"))
            if now.get(user):
                expected[f"o{offset}"] = now[user]
    got = asof_enrich(
        spark.createDataFrame(orders, ORDERS), spark.createDataFrame(changes, CHANGES), rows=40
    )
    assert {r.order_id: r.user_name for r in got.collect()} == expected
    assert got.select(F.count("*")).first()[0] == len(expected)
