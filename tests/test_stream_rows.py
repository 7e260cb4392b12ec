"""Row-bounded stream reads and live request state in runs."""

import datetime as dt
import json
import os
import random

import pytest
from conftest import SF
from pyspark.sql import Row
from pyspark.sql import functions as F

from graphmill.model import DONE, ERROR, EVENT_SCHEMA, STARTED
from graphmill.operators import progress as P
from graphmill.plans import catalog
from graphmill.streaming import rows as R
from graphmill.streaming import state as ST
from graphmill.streaming import stream as SS


def sizes_of(out):
    """A sink that notes each batch's size and rows."""

    def sink(batch, batch_id):
        out.append((batch_id, sorted(tuple(r) for r in batch.collect())))

    return sink


def test_batches_of_at_most_n_rows(spark, tmp):
    src, ckpt = f"{tmp}/src", f"{tmp}/ckpt"
    df = spark.range(1000).select(F.col("id"), F.concat(F.lit("v"), "id").alias("v"))
    df.repartitionByRange(3, "id").write.option("parquet.block.size", 1024).parquet(src)
    got = []
    R.run_until_idle(R.read_rows(spark, src, df.schema, ckpt, 150, split=40), sizes_of(got), ckpt, 1.0)
    sizes = [len(rows) for _, rows in got if rows]
    assert sizes == [150] * 6 + [100]  # files hold about 333 rows: batches begin and end inside them
    assert sorted(r for _, rows in got for r in rows) == [(i, f"v{i}") for i in range(1000)]
    # the checkpoint is the bookmark: new files only, also if they are older by their times
    old = f"{src}/aa-late.parquet"
    spark.range(1000, 1010).select("id", F.lit("w").alias("v")).toPandas().to_parquet(old)
    os.utime(old, (1, 1))
    again = []
    R.run_until_idle(R.read_rows(spark, src, df.schema, ckpt, 150), sizes_of(again), ckpt, 1.0)
    assert sorted(r[0] for _, rows in again for r in rows) == list(range(1000, 1010))


def test_a_batch_that_failed_comes_again_with_the_same_rows(spark, tmp):
    src, ckpt = f"{tmp}/src", f"{tmp}/ckpt"
    spark.range(100).repartitionByRange(2, "id").write.parquet(src)
    first, second = [], []

    def failing(batch, batch_id):
        sizes_of(first)(batch, batch_id)
        if batch_id == 2:
            raise ValueError("sink down")

    with pytest.raises(Exception, match="sink down"):
        R.run_until_idle(R.read_rows(spark, src, "id long", ckpt, 15), failing, ckpt, 1.0)
    R.run_until_idle(R.read_rows(spark, src, "id long", ckpt, 15), sizes_of(second), ckpt, 1.0)
    assert dict(first)[2] == dict(second)[2] and min(dict(second)) == 2
    done = {b: rows for b, rows in [*first, *second]}
    assert sorted(r[0] for rows in done.values() for r in rows) == list(range(100))


def test_offsets_over_files(tmp):
    log = R.FileLog(f"{tmp}/nothing", f"{tmp}/log")
    log.refresh()
    log.files = [("a", 3), ("b", 0), ("c", 5)]
    assert log.after((0, 0), 2) == (0, 2) and log.after((0, 2), 1) == (2, 0) and log.after((0, 2), 4) == (2, 3) and log.after((2, 3), 9) == (3, 0)
    assert [(r.path, r.first, r.last) for r in log.ranges((0, 1), (2, 3), 2)] == [("a", 1, 3), ("c", 0, 2), ("c", 2, 3)]
    assert log.ranges((3, 0), (3, 0), 2) == [] and log.ranges((2, 3), (2, 3), 2) == []


def test_types_missing_columns_and_odd_options(spark, tmp):
    src, ckpt = f"{tmp}/src", f"{tmp}/ckpt"
    ev = spark.read.parquet(f"{SF}/events.parquet").limit(50)
    ev.write.parquet(src)
    schema = ev.withColumn("extra", F.lit(None).cast("array<string>")).schema
    got = []
    R.run_until_idle(R.read_rows(spark, src, schema, ckpt, 50), sizes_of(got), ckpt, 1.0)
    assert sorted((r[:-1] for _, rows in got for r in rows), key=repr) == sorted((tuple(r) for r in ev.collect()), key=repr)
    assert all(r[-1] is None for _, rows in got for r in rows)
    with pytest.raises(ValueError, match="at least 1"):
        R.read_rows(spark, src, schema, ckpt, 0)


T0 = dt.datetime(2024, 1, 1)


def events(spark, rows):
    """(minute, seq, request, type) rows as events."""
    return spark.createDataFrame([(T0 + dt.timedelta(minutes=m), s, rid, t, "", {}) for m, s, rid, t in rows], EVENT_SCHEMA)


def run_states(spark, tmp, batches, idle_minutes=1000, delay="0 seconds"):
    """The rows that come out of a stream of batches of events, in order."""
    src, ckpt, out = f"{tmp}/src", f"{tmp}/ckpt", []
    own = ST.rocksdb_session(spark)
    for i, rows in enumerate(batches):
        events(spark, rows).coalesce(1).write.parquet(f"{src}/{i:03d}")
        stream = own.readStream.schema(EVENT_SCHEMA).option("recursiveFileLookup", "true").parquet(src)

        def sink(batch, batch_id):
            out.extend(sorted((r.asDict() for r in batch.collect()), key=lambda r: (r["request_id"], r["closed"])))

        SS.run_to_end(ST.live_runs(stream, delay, 60 * idle_minutes), sink, ckpt, mode="update")
    return out


def test_started_replaces_the_state(spark, tmp):
    batches = [
        [(0, 0, "a", STARTED), (1, 1, "a", ERROR), (1, 2, "b", ERROR), (2, 3, "c", STARTED)],
        [(5, 4, "a", DONE), (6, 5, "c", "FETCHING_DATA_AND_MODELS")],
        [(10, 6, "a", STARTED), (11, 7, "a", "FETCHING_DATA_AND_MODELS"), (11, 8, "b", ERROR)],
    ]
    out = run_states(spark, tmp, batches)
    last = {r["request_id"]: r for r in out}
    want = {r["request_id"]: r for r in P.request_state(events(spark, sum(batches, []))).collect()}
    assert set(last) == set(want) == {"a", "c"}  # b never started
    for rid, w in want.items():
        got = last[rid]
        assert (got["status"], got["n_events"], got["n_errors"]) == (w["status"], w["n_events"], w["n_errors"])
        assert str(got["start_at"]) == w["start_time"] and (got["end_at"] and str(got["end_at"])) == w["end_time"]
    a = [(r["n_events"], r["n_errors"], r["end_at"] is not None) for r in out if r["request_id"] == "a"]
    assert a == [(2, 1, False), (3, 1, True), (2, 0, False)]


def test_a_timer_drops_idle_requests(spark, tmp):
    batches = [[(0, 0, "a", STARTED), (1, 1, "a", DONE)], [(200, 2, "b", STARTED)], [(201, 3, "a", ERROR), (202, 4, "b", ERROR)], [(203, 5, "a", STARTED)]]
    out = run_states(spark, tmp, batches, idle_minutes=60)
    a = [(r["status"], r["n_events"], r["closed"]) for r in out if r["request_id"] == "a"]
    assert a[0] == (DONE, 2, False) and a.count((DONE, 2, True)) == 1 and a[-1] == (STARTED, 1, False)
    assert not any(r["n_errors"] for r in out if r["request_id"] == "a")  # an event without a run


def test_late_within_the_delay_equals_the_batch_form(spark, tmp):
    rng = random.Random(4)
    kinds = [STARTED, ERROR, DONE, "FETCHING_DATA_AND_MODELS", "PUSHED_GRAPH_ELEMENTS_INTO_NEO"]
    rows = [(m, m, f"r{rng.randrange(6)}", rng.choices(kinds, [1, 2, 1, 3, 3])[0]) for m in range(240)]
    mixed = sorted(rows, key=lambda r: r[0] + rng.uniform(0, 25))  # at most 25 minutes late
    out = run_states(spark, tmp, [mixed[i : i + 40] for i in range(0, 240, 40)], delay="30 minutes")
    last = {r["request_id"]: (r["status"], r["n_events"], r["n_errors"]) for r in out}
    want = {r["request_id"]: (r["status"], r["n_events"], r["n_errors"]) for r in P.request_state(events(spark, rows)).collect()}
    assert last == want


def test_fold_does_not_depend_on_batches():
    rng = random.Random(9)
    for _ in range(200):
        at, evs = 0, []
        for i in range(rng.randint(1, 30)):
            at += rng.choice([1, 2, 50])
            evs.append((at, i, rng.choice([STARTED, ERROR, DONE, "X"])))
        whole = ST.fold(None, evs, 20)
        run, closed = None, None
        for e in evs:
            run, c = ST.fold(run, [e], 20)
            closed = c if c is not None else (None if run is not None else closed)
        assert run == whole[0]
        assert closed == whole[1]


def test_offsets_are_logged_as_json(spark, tmp):
    src, ckpt = f"{tmp}/src", f"{tmp}/ckpt"
    spark.range(10).coalesce(1).write.parquet(src)
    R.run_until_idle(R.read_rows(spark, src, "id long", ckpt, 4), sizes_of([]), ckpt, 1.0)
    log = f"{ckpt}/offsets"
    last = max((n for n in os.listdir(log) if n.isdigit()), key=int)
    with open(f"{log}/{last}") as f:
        assert json.loads(f.read().splitlines()[2]) == {"file": 1, "row": 0}


def test_a_request_is_rows_in_and_a_row_out():
    """No frame per request and micro-batch: those cost more than the run's own work."""

    class Held:
        value = None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    class Timers:
        due = []

        def registerTimer(self, at):  # noqa: N802
            self.due.append(at)

        def deleteTimer(self, at):  # noqa: N802
            self.due.remove(at)

        def getCurrentWatermarkInMs(self):  # noqa: N802
            return 0

    runs, event = ST.RequestRuns(60_000_000), Row("request_id", "timestamp", "at", "seq", "event_type")
    runs.handle, runs.state = Timers(), Held()
    out = list(runs.handleInputRows(("a",), iter([event("a", T0, 5_000_000, 1, DONE), event("a", T0, 1_000_000, 0, STARTED)]), Timers()))
    assert out == [ST.RUN_ROW("a", DONE, 1_000_000, 5_000_000, 2, 0, False)] and Timers.due == [65_001]


def test_live_runs_uses_every_core(spark, monkeypatch):
    class Seen(Exception):
        pass

    def read_rows(session, *_):
        raise Seen(session.conf.get("spark.sql.shuffle.partitions"))

    monkeypatch.setattr(R, "read_rows", read_rows)
    with pytest.raises(Seen, match=f"^{spark.sparkContext.defaultParallelism}$"):
        catalog.QUERIES["live_runs"](spark, SF)
