"""Live request state as arbitrary stateful processing (T3, A10): replaced by STARTED, dropped by a timer.

A request's state is that of its last run: from its last STARTED on, up to the first time no event came for ``idle``.  The state of an
earlier run goes with the next STARTED; events without a run are ignored.  That is a property of the events alone, whatever
micro-batches they come in, as long as they are no later than the watermark's delay:

* Events newer than the watermark are kept one by one (an older STARTED may still come before them); older ones are folded into
  counts.  So a request's state is bounded by its events within the delay.
* An event-time timer at the last event plus ``idle`` emits the final state with ``closed`` and removes everything.

``transformWithState`` keeps state in RocksDB under the query's checkpoint (``rocksdb_session``), so a restart goes on with it.  A request is
handled by one task per micro-batch: bound the micro-batch (``rows.read_rows``), since a busy request may be most of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from graphmill.model import DONE, ERROR, STARTED, STATUS_EVENTS

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: A run so far: times in microseconds; ``last`` is its last event.
RUN = "start long, start_seq long, status string, end long, n_events long, n_errors long, last long"
#: All of a request's state in one value, since each access is a call to the state store: the run, the time of its timer (ms), and
#: the events that are newer than the watermark.
STATE = f"run struct<{RUN.replace(' long', ': long').replace(' string', ': string')}>, timer long, recent array<struct<at: long, seq: long, event_type: string>>"
OUT = "request_id string, status string, start_us long, end_us long, n_events long, n_errors long, closed boolean"
RUN_ROW = Row(*[c.split()[0] for c in OUT.split(", ")])


def rocksdb_session(spark: SparkSession) -> SparkSession:
    """A session of its own whose streaming queries keep their state in RocksDB, as ``transformWithState`` needs."""
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return own


def fold(run: tuple | None, events: list[tuple[int, int, str]], idle: int) -> tuple[tuple | None, tuple | None]:
    """(the run after ``events``, which are in order; the last run that an idle time ended, if it was not started again)."""
    closed = None
    for at, seq, kind in events:
        if run is not None and at - run[6] > idle:
            run, closed = None, run
        if kind == STARTED:
            run, closed = (at, seq, STARTED, None, 1, 0, at), None
        elif run is not None:
            start, start_seq, status, end, n, errors, _ = run
            status = kind if kind in STATUS_EVENTS else status
            run = (start, start_seq, status, at if kind == DONE else end, n + 1, errors + (kind == ERROR), at)
    return run, closed


class RequestRuns(StatefulProcessor):
    def __init__(self, idle_us: int):
        self.idle = idle_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", STATE)

    def _held(self) -> tuple[tuple | None, int | None, list[tuple[int, int, str]]]:
        held = self.state.get()
        if held is None:
            return None, None, []
        run, timer, recent = held
        return tuple(run) if run is not None else None, timer, [tuple(e) for e in recent or []]

    def _row(self, key: Any, run: tuple, closed: bool) -> Row:
        return RUN_ROW(key[0], run[2], run[0], run[3], run[4], run[5], closed)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803 - Spark's names
        before, timer, events = self._held()
        events += [(r["at"], r["seq"], r["event_type"]) for r in rows]
        events.sort(key=lambda e: e[:2])
        run, closed = fold(before, events, self.idle)
        # what a later batch can no longer precede is folded for good
        watermark = max(0, timerValues.getCurrentWatermarkInMs()) * 1000
        n = sum(1 for e in events if e[0] < watermark)
        settled, _ = fold(before, events[:n], self.idle)
        if settled is None and not events[n:]:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.state.clear()
        else:
            last = max(events[-1][0], settled[6] if settled is not None else 0)
            due = (last + self.idle) // 1000 + 1
            if due != timer:
                if timer is not None:
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(due)
            self.state.update((settled, due, events[n:]))
        if run is not None:
            yield self._row(key, run, False)
        elif closed is not None:
            yield self._row(key, closed, True)

    def handleExpiredTimer(self, key: Any, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        before, _, events = self._held()
        run, closed = fold(before, events, self.idle)  # kept in order
        self.state.clear()
        last = run if run is not None else closed
        if last is not None:
            yield self._row(key, last, True)

    def close(self) -> None:
        pass


def live_runs(events: DataFrame, delay: str, idle_seconds: int) -> DataFrame:
    """A stream of (request_id, status, start_at, end_at, n_events, n_errors, closed): per micro-batch the requests whose run changed, and
    once, with ``closed``, those without an event for ``idle_seconds``.  The session comes from ``rocksdb_session``.

    Defined results: events without a request id, a time or a type are ignored; of equal times ``seq`` decides (null first)."""
    at = F.col("timestamp").cast("timestamp")
    rows = events.where("request_id is not null and timestamp is not null and event_type is not null").select(
        "request_id", at.alias("timestamp"), F.unix_micros(at).alias("at"), F.coalesce("seq", F.lit(-(2**63))).cast("long").alias("seq"), "event_type"
    )
    found = rows.withWatermark("timestamp", delay).groupBy("request_id").transformWithState(
        RequestRuns(idle_seconds * 1_000_000), outputStructType=OUT, outputMode="Update", timeMode="EventTime"
    )
    times = [F.timestamp_micros(f"{c}_us").cast("timestamp_ntz").alias(f"{c}_at") for c in ("start", "end")]
    return found.select("request_id", "status", *times, "n_events", "n_errors", "closed")
