"""Sources that fall silent and come back, as a stream of transitions."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

QUIET_SECONDS = 600
LATENESS = "1 hour"
ACTIVE, SLOWED = "active", "slowed"
OUTPUT = "source string, at timestamp, state string"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def merged(intervals: np.ndarray) -> np.ndarray:
    """Rows of (start, end) that touch or overlap, joined; sorted by start."""
    if not len(intervals):
        return intervals.reshape(0, 2)
    intervals = intervals[np.argsort(intervals[:, 0], kind="stable")]
    reach = np.maximum.accumulate(intervals[:, 1])
    heads = np.flatnonzero(np.r_[True, intervals[1:, 0] > reach[:-1]])
    ends = np.r_[heads[1:], len(intervals)] - 1
    return np.column_stack([intervals[heads, 0], reach[ends]])


class SilenceProcessor(StatefulProcessor):
    """Keeps, for a source, the intervals in which it counts as active, in microseconds.

    An event makes its source active for ``quiet`` seconds. What lies before the watermark cannot
    change any more and is told, once: where an interval begins and where it ends. So the result
    does not depend on how the events are dealt over batches, nor on their order. Only intervals
    that the watermark has not passed are kept, however many events there are.
    """

    def __init__(self, quiet: int):
        self.quiet = quiet * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.starts = handle.getValueState("intervals", "starts array<long>, ends array<long>, told long")

    def _known(self) -> tuple[np.ndarray, int]:
        if not self.starts.exists():
            return np.empty((0, 2), np.int64), -(1 << 62)
        starts, ends, told = self.starts.get()
        return np.column_stack([np.array(starts, np.int64), np.array(ends, np.int64)]), told

    def _tell(self, key, known: np.ndarray, told: int, watermark: int) -> Iterator[pd.DataFrame]:
        """Transitions after ``told`` and up to the watermark; what is left waits for a timer."""
        rows = []
        for start, end in known:
            rows += [(at, s) for at, s in ((start, ACTIVE), (end, SLOWED)) if told < at <= watermark]
        left = known[known[:, 1] > watermark]
        told = max(told, watermark)
        waiting = [int(at) for pair in left for at in pair if at > told]
        if len(left):
            self.starts.update((left[:, 0].tolist(), left[:, 1].tolist(), told))
        else:
            self.starts.clear()
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if waiting:
            # Timers have milliseconds; a moment is told at the first one that is not before it.
            self.handle.registerTimer(-(-min(waiting) // 1000))
        if rows:
            at, state = zip(*sorted(rows), strict=True)
            moments = pd.to_datetime(np.array(at), unit="us")
            yield pd.DataFrame({"source": key[0], "at": moments, "state": state})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known, told = self._known()
        for batch in rows:
            moments = batch["event_time"].to_numpy().astype("datetime64[us]").astype(np.int64)
            known = merged(np.vstack([known, np.column_stack([moments, moments + self.quiet])]))
        yield from self._tell(key, known, told, timerValues.getCurrentWatermarkInMs() * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        known, told = self._known()
        yield from self._tell(key, known, told, timerValues.getCurrentWatermarkInMs() * 1000)

    def close(self) -> None:
        pass


def transitions(
    messages: DataFrame, quiet: int = QUIET_SECONDS, delay: str = LATENESS
) -> DataFrame:
    """(source, at, state): ``slowed`` where a source has had no event for ``quiet`` seconds,
    ``active`` at its first event and where it comes back.

    ``messages`` is a stream with event_time; a message without one is left out, and one without a
    source belongs to ``unknown``. A transition is final, so it is told when the watermark
    (``delay`` behind the newest event) has passed it. Two columns of a message are shuffled.
    """
    timed = messages.where(F.col("event_time").isNotNull()).select(
        F.coalesce("source", F.lit("unknown")).alias("source"), "event_time"
    )
    return (
        timed.withWatermark("event_time", delay)
        .groupBy("source")
        .transformWithStateInPandas(SilenceProcessor(quiet), OUTPUT, "Append", "EventTime")
    )


@contextmanager
def rocks_state(spark: SparkSession) -> Iterator[None]:
    """Timers need state in RocksDB; a query keeps the store it was started with."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)
