"""Velocity counting on a stream.

Late data differs from the batch operator in one respect, unless the query has a clock of its own. The
batch operator keeps stream time per partition and moves it with every record. A streaming query has
one watermark for all partitions, moved between micro-batches. So a stream may take a record up to a batch or
two later than the batch rule allows, and may drop records of a partition that lags behind
the others by more than the grace. ``stream_drop_late`` keeps the batch rule: a clock for each partition.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from millrace.functions.scalar import GRACE, VELOCITY_THRESHOLD, WINDOW_SIZE
from millrace.operators.fraud import high_value_alerts, velocity_rows

# How far, in event time, a partition with a clock of its own may lag behind the first one.
LAG = "7 days"
# Alerts of one window that one task writes out.
CHUNK = 1 << 20
# Records a partition's clock lets through at once.
SLICE = 1 << 16


def stream_window_counts(stream: DataFrame, size=WINDOW_SIZE, grace=GRACE, *,
                         user="user_id", ts="occurred_at") -> DataFrame:
    """Count per user and window, for update mode.

    State is dropped when the watermark passes the window's end, so a window is kept for
    its size plus the grace.
    """
    return (
        stream.where(F.col(user).isNotNull())
        .select(F.col(user).alias("user_id"), F.col(ts).cast("timestamp").alias(ts))
        .withWatermark(ts, grace)
        .groupBy("user_id", F.window(ts, size).alias("_w"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("user_id", F.col("_w.start").alias("window_start"), "n")
    )


def stream_velocity(stream: DataFrame, size=WINDOW_SIZE, grace=GRACE, mode="update",
                    threshold=VELOCITY_THRESHOLD, *, user="user_id", ts="occurred_at",
                    partition=None, offset="offset", lag=LAG):
    """Velocity alerts on a stream, as soon as a window reaches the threshold.

    ``mode="update"`` (write with update mode): one alert per window and micro-batch in
    which its count grew; counting starts before the shuffle, so a hot user is cheap.
    ``mode="per_record"`` (write with append mode): one alert for each count from the
    threshold up, as the batch operator gives. Records are counted per window before they are
    shuffled, the state of a user adds the counts up, and the alerts are written out by all tasks.
    With ``partition``, the column with the log's partition, records are dropped as late by
    their partition's own clock; see ``stream_drop_late``. What no record of a user closes is then forgotten
    when the first partition is ``lag`` ahead of it, so no partition may lag by more.
    """
    if mode == "update":
        counts = stream_window_counts(stream, size, grace, user=user, ts=ts)
        return velocity_rows(counts.where(F.col("n") >= threshold))
    size_ms, grace_ms = _seconds(size) * 1000, _seconds(grace) * 1000
    known = stream.where(F.col(user).isNotNull())
    if partition is not None:
        # A partition's clock holds its share of a micro-batch: of each record only what is needed.
        known = known.select(*dict.fromkeys([user, partition, offset, ts]))
        known = stream_drop_late(
            known, size, grace, partition=partition, offset=offset, ts=ts, keep_time="_clock"
        )
    clock = F.col(ts) if partition is None else F.col("_clock")
    rows = known.select(
        F.col(user).alias("user_id"), F.col(ts).cast("timestamp").alias("ts"),
        clock.cast("timestamp").alias("clock"),
    )
    kind = rows.schema["user_id"].dataType.simpleString()
    counts = rows.mapInArrow(
        _window_counts(size_ms), f"user_id {kind}, start_ms long, n long, clock timestamp"
    )
    # Spark's watermark: it drops nothing whose window is open, and says when windows close.
    delay = size_ms + grace_ms if partition is None else max(_seconds(lag) * 1000, size_ms + grace_ms)
    grown = counts.withWatermark("clock", f"{delay // 1000} seconds").groupBy("user_id").transformWithStateInPandas(
        WindowCounter("clock", size_ms, threshold, None if partition is None else grace_ms),
        f"user_id {kind}, start_ms long, low long, high long", "append", "eventTime",
    )
    begins = F.explode(F.sequence("low", "high", F.lit(CHUNK).cast("long")))
    ranges = grown.select("user_id", "start_ms", "high", begins.alias("low"))
    spread = ranges.repartition("user_id", "start_ms", "low")
    numbers = F.explode(F.sequence("low", F.least("high", F.col("low") + CHUNK - 1)))
    return velocity_rows(
        spread.select("user_id", F.timestamp_millis("start_ms").alias("window_start"), numbers.alias("n"))
    )


def _seconds(interval: str) -> int:
    """Length of an interval such as ``5 minutes``."""
    return int(pd.Timedelta(interval).total_seconds())


def _window_counts(size_ms):
    """Records per user and window within a batch of rows, with the latest clock among them."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ms = pc.cast(pc.cast(batch.column("ts"), pa.timestamp("ms"), safe=False), pa.int64())
            ms = ms.to_numpy(zero_copy_only=False)
            rows = pa.table({
                "user_id": batch.column("user_id"), "start_ms": pa.array(ms - ms % size_ms),
                "clock": batch.column("clock"),
            })
            grouped = rows.group_by(["user_id", "start_ms"]).aggregate([("clock", "count"), ("clock", "max")])
            yield from grouped.select(["user_id", "start_ms", "clock_count", "clock_max"]).rename_columns(
                ["user_id", "start_ms", "n", "clock"]
            ).to_batches()

    return run


class WindowCounter(StatefulProcessor):
    """Adds up the counts of a user's open windows and says from where to where each one grew.

    Without ``grace_ms`` the watermark closes windows: it trails the newest record by grace plus window
    size. Spark drops records older than that, which is never one whose window is open; the
    window's own rule (its end lies after newest minus grace) is applied here. With ``grace_ms``
    only records in time arrive, and the clock they bring closes their user's windows; the watermark,
    far behind, those of users that do not come back.
    """

    def __init__(self, clock, size_ms, threshold, grace_ms=None):
        self.clock, self.size, self.threshold, self.grace = clock, size_ms, threshold, grace_ms

    def init(self, handle):
        self.handle = handle
        self.open = handle.getValueState("open", "starts array<long>, counts array<long>")

    def _load(self):
        if not self.open.exists():
            return {}
        starts, counts = self.open.get()
        return dict(zip(starts, counts))

    def _store(self, windows):
        if windows:
            starts = sorted(windows)
            self.open.update((starts, [windows[s] for s in starts]))
            self.handle.registerTimer(starts[-1] + (0 if self.grace is None else self.size))
        else:
            self.open.clear()

    def handleInputRows(self, key, rows, timerValues):
        added, newest = {}, None
        for pdf in rows:
            for start, n in zip(pdf["start_ms"].tolist(), pdf["n"].tolist()):
                added[start] = added.get(start, 0) + n
            last = pdf[self.clock].max()
            newest = last if newest is None else max(newest, last)
        if self.grace is None:
            closed = timerValues.getCurrentWatermarkInMs() + self.size
            taken = closed
        else:
            # What arrives is in time; it closes what lies behind it.
            closed, taken = int(newest.value // 1_000_000) - self.grace, None
        windows = self._load()
        grown = []
        for start, more in added.items():
            if taken is not None and start + self.size <= taken:
                continue
            before = windows.get(start, 0)
            windows[start] = before + more
            if before + more >= self.threshold:
                grown.append((key[0], start, max(self.threshold, before + 1), before + more))
        self._store({s: n for s, n in windows.items() if s + self.size > closed})
        if grown:
            yield pd.DataFrame(grown, columns=["user_id", "start_ms", "low", "high"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        closed_until = timerValues.getCurrentWatermarkInMs() + (self.size if self.grace is None else 0)
        self._store({s: n for s, n in self._load().items() if s + self.size > closed_until})
        return iter(())

    def close(self):
        pass


def stream_drop_late(stream: DataFrame, size=WINDOW_SIZE, grace=GRACE, *, partition="partition",
                     offset="offset", ts="occurred_at", keep_time=None) -> DataFrame:
    """Records whose window was still open when they arrived, by the clock of their own partition.

    The rule of ``drop_late``, record by record, whatever the micro-batches: state is the highest
    event time of each log partition, so one that lags behind the others loses nothing. Records
    of a partition are worked through in the order of their offsets: one partition's share of a
    micro-batch is held in memory, which the cap on micro-batches bounds. ``keep_time`` names a
    column for the clock. Write with append mode; other stateful operators may follow.
    """
    size_ms, grace_ms = _seconds(size) * 1000, _seconds(grace) * 1000
    fields = stream.schema
    if keep_time is not None:
        fields = stream.withColumn(keep_time, F.col(ts)).schema
    clock = PartitionClock(size_ms, grace_ms, offset, ts, keep_time)
    return stream.groupBy(partition).transformWithStateInPandas(clock, fields, "append", "none")


class PartitionClock(StatefulProcessor):
    """Keeps the highest event time of a log partition and lets through what is in time."""

    def __init__(self, size_ms, grace_ms, offset, ts, keep_time):
        self.size, self.grace, self.offset, self.ts, self.keep_time = size_ms, grace_ms, offset, ts, keep_time

    def init(self, handle):
        self.clock = handle.getValueState("clock", "micros long")

    def handleInputRows(self, key, rows, timerValues):
        chunks = list(rows)
        pdf = chunks[0] if len(chunks) == 1 else pd.concat(chunks, ignore_index=True)
        del chunks
        order = np.argsort(pdf[self.offset].to_numpy(), kind="stable")
        lowest = np.iinfo(np.int64).min
        times = pdf[self.ts].to_numpy().astype("datetime64[us]")[order]
        # What is no time is the lowest number, and the lowest time.
        micros = times.view(np.int64)
        before = self.clock.get()[0] if self.clock.exists() else lowest
        clock = np.maximum(np.maximum.accumulate(micros), before)
        if clock[-1] > lowest:
            self.clock.update((int(clock[-1]),))
        for at in range(0, len(order), SLICE):
            part = slice(at, at + SLICE)
            end = micros[part] - micros[part] % (self.size * 1000) + self.size * 1000
            in_time = (micros[part] > lowest) & (end > clock[part] - self.grace * 1000)
            kept = pdf.take(order[part][in_time])
            if self.keep_time is not None:
                kept = kept.assign(**{self.keep_time: clock[part][in_time].astype("datetime64[us]")})
            if len(kept):
                yield kept

    def close(self):
        pass


def stream_high_value(stream: DataFrame, **options) -> DataFrame:
    """High-value alerts on a stream: stateless, any output mode."""
    return high_value_alerts(stream, **options)
