"""Stock: reservation in log order, restocking."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.envelope import with_envelope
from millrace.functions.trace import set_trace_header
from millrace.operators.blocks import BLOCK, block_of
from millrace.operators.dedup import ledger_dedup
from millrace.operators.fraud import rekey
from millrace.session import cut_lineage, job_dir, on_disk

# Lines of one SKU a single task folds; a SKU with more is cut into blocks of the log.
FOLD_ROWS = 1 << 20

_NEVER = 1 << 62

# Pieces of a block's map, and quantities in a row of a block that has more of them, at most.
PIECES = 4096

# Lines of a block that is passed on as its quantities at once: folding them costs no more than making a map.
SHORT = 256

# What a new shop starts with.
SEEDS = {"SKU-1": 100, "SKU-LOAD": 1000}


def seed_stock(stock: DataFrame, seeds=None) -> DataFrame:
    """Stock with a row for each seeded SKU that has none yet."""
    rows = list((SEEDS if seeds is None else seeds).items())
    start = stock.sparkSession.createDataFrame(rows, "sku string, quantity int")
    return stock.select("sku", "quantity").unionByName(start.join(stock, "sku", "left_anti"))


def restock(stock: DataFrame, additions: DataFrame) -> DataFrame:
    """Stock after the additions (at least one piece each); new SKUs get a row."""
    received = additions.where(F.col("quantity") >= 1)
    return (
        stock.select("sku", F.col("quantity").cast("long").alias("quantity"))
        .unionByName(received.select("sku", F.col("quantity").cast("long").alias("quantity")))
        .groupBy("sku")
        .agg(F.sum("quantity").alias("quantity"))
    )


def reserve_stock(lines: DataFrame, stock: DataFrame, seq=("offset", "line"), rows=FOLD_ROWS):
    """Reserve each line from its SKU's stock in log order.

    A line is RESERVED if what is left covers it, which then shrinks; otherwise it is
    REJECTED and nothing changes. Lines stand alone: one rejected line of an order does not
    touch the others. Unknown and missing SKUs and missing quantities are rejected. Returns ``(events, remaining)``.

    ``lines`` has ``sku``, ``quantity`` and the columns of ``seq``, a total order whose
    first column is the log offset (of an order: a block holds ``rows`` orders at most);
    other columns are passed on.

    Lines are shuffled once, by SKU. All lines of a SKU whose demand fits its stock are
    reserved, and a line larger than the stock is rejected, by comparing columns (both with
    what lines below zero give back in mind); the rest are folded in order while sorted partitions stream by. A SKU with more than ``rows``
    lines is cut into blocks of the log, shuffled by block, and the stock each block starts
    with is worked out first, so its blocks fold side by side: by ``_block_starts`` where stock only
    shrinks, by ``_mapped_starts`` for a SKU with lines below zero.
    """
    seq = list(seq)
    # Lines without a SKU or a quantity need no place in the shuffle.
    whole = F.col("sku").isNotNull() & F.col("quantity").isNotNull()
    nameless = lines.where(~whole)
    columns, lines = lines.columns, lines.where(whole)
    # One row per SKU, kept: it is used three times and takes a pass over the lines.
    demand = cut_lineage(
        lines.groupBy("sku").agg(
            F.sum(F.greatest("quantity", F.lit(0))).alias("_demand"),
            F.sum(F.greatest(-F.col("quantity"), F.lit(0))).alias("_back"),
            F.count(F.lit(1)).alias("_n"),
        )
    )
    cut_up = F.col("_n") > rows
    shelf = stock.select("sku", F.col("quantity").cast("long").alias("_stock"))
    fits = F.coalesce("_demand", F.lit(0)) <= F.col("_stock")
    cold = shelf.join(demand.where(~cut_up), "sku").select(
        "sku", F.lit(0).cast("long").alias(BLOCK), F.col("_stock").alias("_left"),
        fits.alias("_fits"), (F.col("_stock") + F.col("_back")).alias("_most"),
    )
    # At most count / rows SKUs have more than ``rows`` lines, so they may be broadcast.
    # Whether there is one is asked here: it decides the plan.
    hot = demand.where(cut_up)
    if hot.isEmpty():
        cut = lines.withColumn(BLOCK, F.lit(0).cast("long"))
        starts = cold
    else:
        hot = cut_lineage(
            hot.join(shelf, "sku", "left").select("sku", "_stock", "_back", fits.alias("_hot_fits"))
        )
        names = F.broadcast(hot.select("sku", "_hot_fits", F.lit(True).alias("_hot")))
        block = F.when(F.col("_hot"), block_of(seq[0], rows) + 1).otherwise(F.lit(0).cast("long"))
        cut = lines.join(names, "sku", "left").withColumn(BLOCK, block).drop("_hot")
        contested = hot.where(~F.col("_hot_fits")).withColumn("_most", F.col("_stock") + F.col("_back"))
        starts = cold
        for kind, found in ((F.col("_back") == 0, _block_starts), (F.col("_back") > 0, _mapped_starts)):
            some = contested.where(kind).select("sku", "_stock", "_back", "_most")
            if some.isEmpty():
                continue
            eligible = (
                cut.join(F.broadcast(some), "sku")
                .where(F.col("quantity") <= F.col("_most"))
                .select("sku", "quantity", BLOCK, "_stock", "_most", *[c for c in seq if c != "quantity"])
            )
            begun = found(eligible, some, seq).join(F.broadcast(some.select("sku", "_back")), "sku")
            starts = starts.unionByName(
                begun.select(
                    "sku", BLOCK, F.col("_start").alias("_left"), F.lit(False).alias("_fits"),
                    (F.col("_start") + F.col("_back")).alias("_most"),
                )
            )
    keys = ["sku", BLOCK]
    placed = cut.repartition(*keys).join(starts, keys, "left")
    all_fit = F.coalesce("_hot_fits", "_fits") if "_hot_fits" in cut.columns else F.col("_fits")
    never = F.col("_left").isNull() | (F.col("quantity") > F.col("_most"))
    known = placed.withColumn(
        "status", F.when(all_fit, F.lit("RESERVED")).when(never, F.lit("REJECTED"))
    ).drop("_fits", "_hot_fits", "_most")
    folded = _fold(known.sortWithinPartitions(*keys, *seq)).select(*columns, "status")
    events = folded.unionByName(nameless.withColumn("status", F.lit("REJECTED")))
    return events, stock_left(stock, events)


def reserve_once(lines: DataFrame, stock: DataFrame, ledger: DataFrame, seq=("offset", "line"),
                 keys=("partition", "offset"), rows=FOLD_ROWS):
    """Reserve the lines of the log records that the ledger does not hold yet.

    Returns ``(events, remaining, ledger)``; the ledger then holds these records too, so one
    that is delivered again, in this batch or a later one, takes nothing. Copies of a line within
    the batch are one line.
    """
    new = ledger_dedup(lines, ledger, tuple(dict.fromkeys([*keys, *seq])), coordinate=keys)
    events, left = reserve_stock(new, stock, seq, rows)
    return events, left, ledger.select(*keys).unionByName(new.select(*keys).distinct())


def reservation_events(events: DataFrame, seq=("offset", "line"), *, occurred_at="occurred_at") -> DataFrame:
    """Reserved and rejected lines as complete events, keyed by their order.

    An event is named by its order, its SKU and its place in the log, and carries on the order's
    trace, in its fields and as its header.
    """
    named = with_envelope(events, "order_id", "sku", *seq, occurred_at=occurred_at)
    fields = named.select(
        "event_id", "occurred_at", "trace_id", "order_id", "sku", "quantity", "status",
        set_trace_header(F.lit(None).cast("array<struct<key:string,value:binary>>"), "trace_id").alias("headers"),
    )
    return rekey(fields, "order_id")


def stock_left(stock: DataFrame, events: DataFrame) -> DataFrame:
    """Stock after the reserved lines."""
    taken = (
        events.where(F.col("status") == "RESERVED")
        .groupBy("sku")
        .agg(F.sum("quantity").alias("_taken"))
    )
    left = F.col("quantity").cast("long") - F.coalesce("_taken", F.lit(0))
    return stock.join(taken, "sku", "left").select("sku", left.alias("quantity"))


def _fold(lines):
    """Fold each (sku, block) from ``_left`` in order, where ``status`` is not known yet.

    Sorted partitions stream through in Arrow batches; what is left of the current group is
    carried from batch to batch, so no group has to fit in memory. Lines whose status is
    known do not take part: they are either too large for the stock or belong to a SKU
    nobody has to fold.
    """

    def run(batches):
        group, left = None, 0
        for batch in batches:
            status = batch.column("status")
            open_rows = np.flatnonzero(status.is_null().to_numpy(zero_copy_only=False))
            if len(open_rows):
                part = batch.select(["sku", BLOCK, "quantity", "_left"]).take(pa.array(open_rows))
                skus, blocks, wants, starts = (column.to_pylist() for column in part.columns)
                found = []
                for here, want, start in zip(zip(skus, blocks), wants, starts):
                    if here != group:
                        group, left = here, start
                    if want <= left:
                        left -= want
                        found.append("RESERVED")
                    else:
                        found.append("REJECTED")
                filled = status.to_numpy(zero_copy_only=False).copy()
                filled[open_rows] = found
                at = batch.schema.get_field_index("status")
                batch = batch.set_column(at, "status", pa.array(filled, pa.string()))
            yield batch

    return lines.mapInArrow(run, lines.schema)


def _level(stock):
    """Number of binary digits; zero for nothing left."""
    return F.when(stock > 0, F.length(F.bin(stock))).otherwise(F.lit(0))


def _summaries(lines, seq):
    """What a block does to a stock of each size, without knowing the stock.

    With a stock of ``d`` binary digits, lines of fewer digits fit as long as the stock
    keeps ``d`` digits, lines of more never fit, and a line of exactly ``d`` fits only if
    it leaves the stock with fewer. So while no such line fits and the small ones do not
    use up the leading digit, a block takes exactly its small lines. Per size this needs
    two numbers: the sum of the small lines, and the least stock at which a line of
    exactly ``d`` digits fits. The quantities go along in order, as packed numbers.
    """

    def summarise(key, pdf):
        pdf = pdf.sort_values(seq, kind="stable", na_position="first")
        want = pdf["quantity"].to_numpy(dtype=np.int64)
        digits = np.frexp(want.astype(np.float64))[1]
        small, need = [0] * 64, [_NEVER] * 64
        total = 0
        present = sorted(set(digits.tolist()))
        for size in range(64):
            small[size] = total
            if size in present:
                mine = digits == size
                before = np.cumsum(np.where(digits < size, want, 0))
                need[size] = int((want + before)[mine].min())
                total += int(want[mine].sum())
        return pd.DataFrame(
            {
                "sku": [key[0]], BLOCK: [key[1]], "_small": [small], "_need": [need],
                "_wants": [want.tobytes()],
            }
        )

    sku = lines.schema["sku"].dataType.simpleString()
    shape = f"sku {sku}, {BLOCK} long, _small array<long>, _need array<long>, _wants binary"
    return lines.groupBy("sku", BLOCK).applyInPandas(summarise, shape)


def _block_starts(lines, hot, seq):
    """Stock at the start of every block of the hot SKUs.

    Each round takes every SKU forward to the first block in which its stock loses a binary
    digit, using sums over block summaries only, and folds that one block. A stock has at
    most 63 digits and every round takes one away, so the rounds are few however long the
    log is; in practice a stock runs out within one or two blocks. The rounds read the
    summaries, never the lines again.
    """
    spark = lines.sparkSession
    path = job_dir(spark, "stock-blocks")
    _summaries(lines, seq).write.parquet(path)
    blocks = spark.read.parquet(path)
    pending = hot.select(
        "sku", F.col("_stock").alias("_now"), F.lit(-1).cast("long").alias("_from")
    )
    order = Window.partitionBy("sku").orderBy(BLOCK)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("sku")
    found = None
    while found is None or not pending.isEmpty():
        ahead = blocks.join(F.broadcast(pending), "sku").where(F.col(BLOCK) > F.col("_from"))
        level = _level(F.col("_now"))
        small = F.element_at("_small", level + 1)
        need = F.element_at("_need", level + 1)
        walked = ahead.select(
            "sku", BLOCK, "_now", level.alias("_level"), small.alias("_uses"), need.alias("_needs")
        )
        walked = walked.withColumn(
            "_start", F.col("_now") - F.coalesce(F.sum("_uses").over(before), F.lit(0))
        )
        floor = F.expr("shiftleft(CAST(1 AS BIGINT), _level - 1)")
        drops = (F.col("_level") > 0) & (
            (F.col("_start") - F.col("_uses") < floor) | (F.col("_needs") <= F.col("_start"))
        )
        walked = walked.withColumn("_stop", F.min(F.when(drops, F.col(BLOCK))).over(whole))
        reached = F.col("_stop").isNull() | (F.col(BLOCK) <= F.col("_stop"))
        done = cut_lineage(walked.where(reached).select("sku", BLOCK, "_start", "_stop"))
        step = done.select("sku", BLOCK, "_start")
        found = step if found is None else found.unionByName(step)
        crossing = done.where(F.col(BLOCK) == F.col("_stop")).select("sku", BLOCK, "_start")
        pending = cut_lineage(_after(blocks, crossing))
    files, root = on_disk(spark, path)
    files.delete(root, True)
    return found


def _pieces(wants, least, most, limit):
    """What lines in order make of each stock from ``least`` to ``most``: a map that is a shift on each piece.

    Returns the first stock of each piece and what is taken from the stocks in it (less than
    nothing where stock comes back), or nothing where there are more than ``limit`` pieces. A line
    that some stocks of a piece cover and others do not cuts it; pieces that have come to the
    same shift are joined again.
    """
    first, shift = np.array([least], np.int64), np.zeros(1, np.int64)
    for want in wants.tolist():
        left = first - shift
        if want <= left.min():
            shift += want
            continue
        highest = np.append(first[1:], most + 1) - 1 - shift
        cut = np.flatnonzero((left < want) & (want <= highest))
        if len(cut):
            first = np.insert(first, cut + 1, want + shift[cut])
            shift = np.insert(shift, cut + 1, shift[cut])
        shift[first - shift >= want] += want
        new = np.r_[True, shift[1:] != shift[:-1]]
        first, shift = first[new], shift[new]
        if len(first) > limit:
            return None
    return first, shift


def _maps(lines, seq):
    """Each block as a map from the stock it starts with to what it leaves: rows in order of ``_part``.

    A block is passed on as its quantities, some in each row, where a map would have more pieces than the
    block has lines, or than ``PIECES``. Lines stream through in order; of a block only quantities are held.
    """
    keys = ["sku", BLOCK]
    names = [*keys, "_part", "_first", "_shift", "_wants"]
    placed = lines.repartition(*keys).sortWithinPartitions(*keys, *seq)
    sku = lines.schema["sku"].dataType.simpleString()
    shape = f"sku {sku}, {BLOCK} long, _part long, _first array<long>, _shift array<long>, _wants array<long>"

    def rows_of(key, wants, stock, most):
        pieces = None
        if len(wants) > SHORT:
            pieces = _pieces(wants, min(0, stock), most, min(PIECES, len(wants)))
        if pieces is not None:
            return [(*key, 0, *pieces, None)]
        return [(*key, k, None, None, wants[k:k + PIECES]) for k in range(0, len(wants), PIECES)]

    def run(batches):
        kinds, key, held = None, None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            if kinds is None:
                longs = pa.list_(pa.int64())
                kinds = [*(batch.schema.field(c).type for c in keys), pa.int64(), longs, longs, longs]
            new = np.zeros(batch.num_rows, bool)
            for c in keys:
                column = batch.column(c)
                new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
            starts = [0, *np.flatnonzero(new).tolist()]
            wants = batch.column("quantity").to_numpy(zero_copy_only=False).astype(np.int64)
            of = zip(*(batch.column(c).take(pa.array(starts)).to_pylist() for c in (*keys, "_stock", "_most")))
            out = []
            for a, b, (*here, stock, most) in zip(starts, [*starts[1:], None], of):
                if key is not None and here != key:
                    out += rows_of(key, np.concatenate(held), *ends)
                    held = []
                key, ends = here, (stock, most)
                held.append(wants[a:b])
            if out:
                yield _batch(out, kinds)
        if key is not None:
            yield _batch(rows_of(key, np.concatenate(held), *ends), kinds)

    def _batch(rows, kinds):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return placed.select(*keys, "quantity", "_stock", "_most").mapInArrow(run, shape)


def _mapped_starts(lines, hot, seq):
    """Stock at the start of every block of the hot SKUs, whose stock may grow as well.

    The blocks are turned into maps side by side. What is left of a SKU is then carried from map to
    map, in one pass over sorted partitions: per block one search in a short list, or its lines where they are few.
    """
    begin = F.broadcast(hot.select("sku", "_stock"))
    maps = _maps(lines, seq).join(begin, "sku")
    placed = maps.repartition("sku").sortWithinPartitions("sku", BLOCK, "_part")

    def run(batches):
        sku, left = None, 0
        for batch in batches:
            starts = []
            skus, stocks, parts = (batch.column(c).to_pylist() for c in ("sku", "_stock", "_part"))
            firsts, shifts, wanted = (batch.column(c) for c in ("_first", "_shift", "_wants"))
            numbers, ends = wanted.values.to_numpy(zero_copy_only=False), wanted.offsets.to_pylist()
            for k, (here, stock, mapped) in enumerate(zip(skus, stocks, firsts.is_valid().to_pylist())):
                if sku is None or here != sku:
                    sku, left = here, stock
                starts.append(left)
                if mapped:
                    piece = np.searchsorted(firsts[k].values.to_numpy(), left, side="right") - 1
                    left -= shifts[k].values[int(piece)].as_py()
                else:
                    for want in numbers[ends[k]:ends[k + 1]].tolist():
                        if want <= left:
                            left -= want
            found = pa.RecordBatch.from_arrays(
                [batch.column("sku"), batch.column(BLOCK), pa.array(starts, pa.int64())],
                names=["sku", BLOCK, "_start"],
            )
            yield found.filter(pa.array([part == 0 for part in parts], pa.bool_()))

    shape = T.StructType([
        lines.schema["sku"], T.StructField(BLOCK, T.LongType()), T.StructField("_start", T.LongType()),
    ])
    return cut_lineage(placed.mapInArrow(run, shape))


def _after(blocks, crossing):
    """Stock after folding one block of each SKU (one row per hot SKU: broadcast)."""

    @F.pandas_udf(T.LongType())
    def fold(wants: pd.Series, starts: pd.Series) -> pd.Series:
        ends = []
        for packed, left in zip(wants, starts.tolist()):
            for want in np.frombuffer(packed, dtype=np.int64).tolist():
                if want <= left:
                    left -= want
            ends.append(left)
        return pd.Series(ends, dtype="int64")

    chosen = blocks.select("sku", BLOCK, "_wants").join(F.broadcast(crossing), ["sku", BLOCK])
    return chosen.select("sku", fold("_wants", "_start").alias("_now"), F.col(BLOCK).alias("_from"))
