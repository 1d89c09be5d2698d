import random

import numpy as np
import pytest

from millrace.operators import inventory
from millrace.operators.inventory import reserve_stock, restock, seed_stock


def fold(lines, stock):
    """The rule, one line at a time."""
    left = dict(stock)
    out = []
    for sku, offset, line, want in sorted(lines, key=lambda r: (r[1], r[2])):
        if sku in left and left[sku] >= want:
            left[sku] -= want
            out.append((sku, offset, line, want, "RESERVED"))
        else:
            out.append((sku, offset, line, want, "REJECTED"))
    return sorted(out), sorted(left.items())


def run(spark, lines, stock, **options):
    lines = spark.createDataFrame(lines, "sku string, offset long, line int, quantity int")
    stock = spark.createDataFrame(stock, "sku string, quantity int")
    events, remaining = reserve_stock(lines, stock, **options)
    got = [(r.sku, r.offset, r.line, r.quantity, r.status) for r in events.collect()]
    return sorted(got), sorted((r.sku, r.quantity) for r in remaining.collect())


def test_reserves_and_decrements(spark):
    events, left = run(spark, [("a", 11, 0, 3)], [("a", 10)])
    assert events == [("a", 11, 0, 3, "RESERVED")] and left == [("a", 7)]


def test_insufficient_leaves_stock(spark):
    events, left = run(spark, [("a", 1, 0, 5)], [("a", 1)])
    assert events[0][-1] == "REJECTED" and left == [("a", 1)]


def test_lines_stand_alone_and_unknown_sku_is_rejected(spark):
    events, left = run(
        spark, [("a", 1, 0, 5), ("b", 1, 1, 2), ("x", 1, 2, 1), ("a", 2, 0, 1)], [("a", 3), ("b", 2)]
    )
    assert [e[-1] for e in events] == ["REJECTED", "RESERVED", "RESERVED", "REJECTED"]
    assert left == [("a", 2), ("b", 0)]


def test_lines_without_a_sku(spark):
    lines = [(None, 1, 0, 1), ("a", 2, 0, 1), (None, 3, 0, 1)]
    frame = spark.createDataFrame(lines, "sku string, offset long, line int, quantity int")
    stock = spark.createDataFrame([("a", 3)], "sku string, quantity int")
    events, left = reserve_stock(frame, stock)
    assert sorted((r.offset, r.status) for r in events.collect()) == [
        (1, "REJECTED"), (2, "RESERVED"), (3, "REJECTED"),
    ]
    assert left.first().quantity == 2


@pytest.mark.parametrize("seed", range(4))
def test_hot_sku_in_blocks_equals_the_fold(spark, seed):
    """A third of all lines on one SKU, cut into many blocks, adversarial sizes."""
    rng = random.Random(seed)
    lines, stock = [], [("hot", 4000 + seed * 1777), ("warm", 900), ("cold", 50), ("none", 0)]
    for offset in range(600):
        for line in range(3):
            sku = "hot" if line == 0 else rng.choice(["warm", "cold", "none", "absent", "hot"])
            size = rng.choice([1, 2, 3, 7, 64, 100, 500, 2000, 3999]) if seed else rng.randint(1, 60)
            lines.append((sku, offset, line, size))
    expected = fold(lines, stock)
    assert run(spark, lines, stock, rows=40) == expected


def test_restock_adds_and_creates(spark):
    stock = spark.createDataFrame([("a", 1)], "sku string, quantity int")
    more = spark.createDataFrame([("a", 2), ("b", 5), ("c", 0)], "sku string, quantity int")
    got = {r.sku: r.quantity for r in restock(stock, more).collect()}
    assert got == {"a": 3, "b": 5}


def test_hot_skus_nobody_has_to_fold(spark):
    """Many lines, but either enough stock for all, none at all, or an unknown SKU."""
    lines = [(sku, i, 0, 2) for i in range(50) for sku in ("plenty", "empty", "absent")]
    stock = [("plenty", 1000), ("empty", 0)]
    expected = fold(lines, stock)
    assert run(spark, lines, stock, rows=10) == expected
    assert run(spark, [r for r in lines if r[0] != "empty"], stock, rows=10) == fold(
        [r for r in lines if r[0] != "empty"], stock
    )


def test_seeding_keeps_what_is_there(spark):
    stock = spark.createDataFrame([("SKU-1", 7)], "sku string, quantity int")
    assert {r.sku: r.quantity for r in seed_stock(stock).collect()} == {"SKU-1": 7, "SKU-LOAD": 1000}


def test_splitting_skewed_joins_does_not_split_a_fold(spark):
    """With everything counted as skewed and no broadcast, a SKU's lines stay in one task."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "0",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rng = random.Random(8)
        lines = [(rng.choice("aab"), i, 0, rng.randint(1, 9)) for i in range(3000)]
        stock = [("a", 5000), ("b", 2000)]
        expected = fold(lines, stock)
        assert run(spark, lines, stock) == expected
        assert run(spark, lines, stock, rows=500) == expected
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_many_hot_skus_at_once_equal_the_fold(spark):
    """Eighty SKUs of very different sizes and stocks, all of them cut into blocks."""
    rng = random.Random(99)
    lines, stock = [], []
    sizes = {}
    for i in range(80):
        sku = f"s{i:02d}"
        top = rng.choice([1, 2, 3, 10, 64, 65, 1000, 1 << 20, (1 << 31) - 1])
        sizes[sku] = sorted({rng.randint(0, top) for _ in range(rng.choice([1, 2, 5, 40]))})
        stock.append((sku, min((1 << 31) - 1, rng.choice([0, 1, top, top * 3, top * 20, top * 60]))))
    for offset in range(120):
        for line, sku in enumerate(sorted(sizes)):
            lines.append((sku, offset, line, rng.choice(sizes[sku])))
    expected = fold(lines, stock)
    assert run(spark, lines, stock, rows=9) == expected


def test_odd_quantities_follow_the_log(spark):
    rows = [
        ("a", 1, 0, 8), ("a", 2, 0, -5), ("a", 3, 0, 8), ("a", 4, 0, None), ("a", 5, 0, 0),
        ("b", 6, 0, None), ("c", 7, 0, 1), (None, 8, 0, 1),
    ]
    lines = spark.createDataFrame(rows, "sku string, offset long, line int, quantity int")
    stock = spark.createDataFrame([("a", 5), ("b", 1)], "sku string, quantity int")
    for most in (1 << 20, 2):
        events, left = inventory.reserve_stock(lines, stock, rows=most)
        got = {r.offset: r.status for r in events.collect()}
        assert got == {
            1: "REJECTED", 2: "RESERVED", 3: "RESERVED", 4: "REJECTED", 5: "RESERVED",
            6: "REJECTED", 7: "REJECTED", 8: "REJECTED",
        }
        assert sorted(map(tuple, left.collect())) == [("a", 2), ("b", 1)]


def test_redelivered_records_take_no_stock(spark):
    schema = "partition int, offset long, line int, sku string, quantity int"
    lines = spark.createDataFrame([(4, 99, 0, "a", 2), (4, 99, 1, "a", 1), (4, 99, 0, "a", 2)], schema)
    stock = spark.createDataFrame([("a", 5)], "sku string, quantity int")
    ledger = spark.createDataFrame([], "partition int, offset long")
    events, left, ledger = inventory.reserve_once(lines, stock, ledger)
    assert events.count() == 2 and left.first().quantity == 2 and ledger.count() == 1
    events, again, ledger = inventory.reserve_once(lines, left, ledger)
    assert events.count() == 0 and again.first().quantity == 2 and ledger.count() == 1


def growing(rng, n, offsets, sizes, back):
    """Lines of which a share gives stock back."""
    return [
        (rng.choice(list(sizes)), offset, line, -rng.randint(1, 6) if rng.random() < back else rng.randint(0, 9))
        for offset in range(offsets) for line in range(n)
    ]


@pytest.mark.parametrize("seed, pieces", [(1, 4096), (2, 4096), (3, 1), (4, 3)])
def test_hot_sku_with_returns_in_blocks_equals_the_fold(spark, monkeypatch, seed, pieces):
    """Blocks with few pieces are maps; those with more are folded on the way."""
    monkeypatch.setattr(inventory, "PIECES", pieces)
    rng = random.Random(seed)
    stock = {"a": 30, "b": 0, "c": 7, "d": -3}
    lines = growing(rng, 2, 150, stock, 0.3)
    assert run(spark, lines, list(stock.items()), rows=9) == fold(lines, stock)


@pytest.mark.parametrize("short", [0, 1 << 20])
def test_blocks_pass_on_maps_or_quantities(spark, monkeypatch, short):
    """What is passed on is never longer than the lines, whichever way; the result is that of the fold."""
    monkeypatch.setattr(inventory, "SHORT", short)
    rng = random.Random(6)
    stock = {"a": 30, "b": 0, "c": 7}
    lines = growing(rng, 2, 400, stock, 0.3)
    assert run(spark, lines, list(stock.items()), rows=40) == fold(lines, stock)
    rows = [(sku, o // 40, o, line, q, stock[sku], 5_000) for sku, o, line, q in lines]
    eligible = spark.createDataFrame(
        rows, "sku string, _block long, offset long, line int, quantity int, _stock long, _most long"
    )
    maps = inventory._maps(eligible, ["offset", "line"]).collect()
    assert sum(len(r["_first"] or r["_wants"]) for r in maps) <= len(lines)
    assert short == 0 or sum(len(r["_wants"]) for r in maps) == len(lines)


def test_a_block_is_a_map_of_the_stock():
    rng = random.Random(5)
    for _ in range(60):
        wants = np.array([rng.randint(-4, 12) for _ in range(rng.randint(1, 30))])
        first, shift = inventory._pieces(wants, -5, 60, 4096)
        assert first[0] == -5 and (np.diff(first) > 0).all() and (np.diff(shift) != 0).all()
        for stock in range(-5, 61):
            left = stock
            for want in wants.tolist():
                left -= want if want <= left else 0
            assert left == stock - shift[np.searchsorted(first, stock, side="right") - 1]
