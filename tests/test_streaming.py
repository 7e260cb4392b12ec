"""Structured Streaming forms: stream read in bounded batches, stream merge = batch merge, live state."""

import datetime as dt
import os

from pyspark.sql import functions as F

from graphmill.model import EVENT_SCHEMA
from graphmill.operators import merge as M
from graphmill.plans.store import GraphStore
from graphmill.streaming import stream as SS


def test_stream_in_batches(spark, tmp, persons):
    # FIXTURES 8: the 1,050 nodes, read in micro-batches; all entities arrive
    src = os.path.join(tmp, "src")
    persons.repartition(11).write.parquet(src)
    out = os.path.join(tmp, "out")
    SS.run_to_end(SS.read_stream(spark, src, persons.schema, max_files_per_trigger=1), SS.copy_to_sink(out), os.path.join(tmp, "ckpt"))
    got = spark.read.schema(persons.schema).parquet(out)
    assert got.count() == 1050
    assert len([d for d in os.listdir(out) if d.startswith("batch=")]) == 11
    # the checkpoint is the bookmark: a second run finds nothing new
    SS.run_to_end(SS.read_stream(spark, src, persons.schema, max_files_per_trigger=1), SS.copy_to_sink(out), os.path.join(tmp, "ckpt"))
    assert spark.read.schema(persons.schema).parquet(out).count() == 1050


def test_stream_merge_equals_batch(spark, tmp):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(F.col("user_id").alias("_uid"), "event_id", "ts", "event_type")
    src = os.path.join(tmp, "src")
    ev.repartition(4, "_uid").write.parquet(src)
    store = GraphStore(spark, os.path.join(tmp, "graph"))
    SS.merge_stream_into_store(SS.read_stream(spark, src, ev.schema, max_files_per_trigger=1), store, "User", "2024-02-01", os.path.join(tmp, "ckpt"), ["ts", "event_id"])
    batch = M.merge_nodes(None, ev, "2024-02-01", ["ts", "event_id"])
    cols = ["_uid", "event_id", "event_type", "_created", "_last_updated"]
    assert sorted(tuple(r) for r in store.nodes("User").select(*cols).collect()) == sorted(tuple(r) for r in batch.select(*cols).collect())
    marker = store._current(store._node_dir("User"))[1]
    assert list(marker["batches"].values()) == [3]  # four batches; the last one's number is kept


def test_live_state_and_sessions(spark, tmp):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(minutes=m), m, rid, t, "", {}) for m, rid, t in [
        (0, "a", "STARTED_PROCESSING_REQUEST"), (5, "a", "ERROR"), (10, "a", "DONE_PROCESSING_REQUEST"),
        (200, "a", "PUSHED_GRAPH_ELEMENTS_INTO_NEO"), (1, "b", "STARTED_PROCESSING_REQUEST"), (400, "b", "FETCHING_DATA_AND_MODELS"),
    ]]
    ev = spark.createDataFrame(rows, EVENT_SCHEMA)
    src = os.path.join(tmp, "src")
    ev.repartition(2).write.parquet(src)
    out = os.path.join(tmp, "state")
    SS.run_to_end(SS.live_state(SS.read_stream(spark, src, EVENT_SCHEMA, max_files_per_trigger=1)), SS.copy_to_sink(out, "complete"), os.path.join(tmp, "c1"), mode="complete")
    st = {r["request_id"]: r for r in spark.read.parquet(out).collect()}
    assert st["a"]["status"] == "DONE_PROCESSING_REQUEST" and st["a"]["n_errors"] == 1 and st["a"]["n_events"] == 4
    assert st["b"]["status"] == "FETCHING_DATA_AND_MODELS"
    out2 = os.path.join(tmp, "sessions")
    SS.run_to_end(SS.closed_sessions(SS.read_stream(spark, src, EVENT_SCHEMA), "1 hour", "1 hour"), SS.copy_to_sink(out2), os.path.join(tmp, "c2"))
    sess = sorted((r["request_id"], r["n_events"]) for r in spark.read.parquet(out2).collect())
    # watermark = 400 min - 1 h: a's two sessions and b's first are closed; b's last one is still open
    assert sess == [("a", 1), ("a", 3), ("b", 1)]


def test_fan_out_batches(spark, tmp, persons):
    src = os.path.join(tmp, "src")
    persons.repartition(3).write.parquet(src)
    copy = os.path.join(tmp, "copy")

    def broken(batch, batch_id):
        raise ValueError("sink down")

    sink = SS.fan_out_batches([("copy", SS.copy_to_sink(copy)), ("broken", broken)], os.path.join(tmp, "outcomes"))
    SS.run_to_end(SS.read_stream(spark, src, persons.schema, max_files_per_trigger=1), sink, os.path.join(tmp, "ckpt"))
    assert spark.read.schema(persons.schema).parquet(copy).count() == 1050
    out = spark.read.parquet(os.path.join(tmp, "outcomes"))
    assert out.where("sink = 'copy' and ok").count() == 3 and out.where("sink = 'broken' and not ok").count() == 3


def test_closed_sessions_feed_the_dump(spark, tmp):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(minutes=m), m, rid, "FETCHING_DATA_AND_MODELS", "", {}) for m, rid in [(0, "a"), (10, "a"), (100, "b"), (300, "b")]]
    src = os.path.join(tmp, "src")
    spark.createDataFrame(rows, EVENT_SCHEMA).write.parquet(src)
    out = os.path.join(tmp, "dump")
    SS.dump_closed_sessions(SS.read_stream(spark, src, EVENT_SCHEMA), out, "1 hour", "1 hour", os.path.join(tmp, "ckpt"))
    got = sorted((r["request_id"], r["n_events"]) for r in spark.read.option("recursiveFileLookup", "true").json(out).collect())
    assert got == [("a", 2), ("b", 1)]  # b's last session (300 min) is still open under the watermark


def test_two_streams_and_a_replay_into_one_label(spark, tmp):
    """Rows of a uid spread over micro-batches; a second stream starts at batch 0 again; a batch whose stream
    failed right after its merge changes nothing when it comes again."""
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(F.col("user_id").alias("_uid"), "event_id", "ts", "event_type")
    halves = [ev.where("event_id % 2 = 0"), ev.where("event_id % 2 = 1").withColumn("_uid", F.col("_uid") + 1_000_000)]
    store = GraphStore(spark, os.path.join(tmp, "g"))
    for i, half in enumerate(halves):
        src = os.path.join(tmp, f"src{i}")
        half.repartitionByRange(3, "event_id").write.parquet(src)
        stream = SS.read_stream(spark, src, ev.schema, max_files_per_trigger=1)
        SS.merge_stream_into_store(stream, store, "User", "2024-02-01", os.path.join(tmp, f"ckpt{i}"), ["ts", "event_id"])
        if i == 0:
            before = sorted(map(str, store.nodes("User").collect()))
            for kind in ("commits", "offsets"):  # as if the driver died after the last merge, before its commit
                if kind == "commits":
                    last = max(int(n) for n in os.listdir(os.path.join(tmp, "ckpt0", kind)) if n.isdigit())
                    for n in (f"{last}", f".{last}.crc"):
                        path = os.path.join(tmp, "ckpt0", kind, n)
                        if os.path.exists(path):
                            os.remove(path)
            SS.merge_stream_into_store(stream, store, "User", "2024-03-01", os.path.join(tmp, "ckpt0"), ["ts", "event_id"])
            assert sorted(map(str, store.nodes("User").collect())) == before
    assert {r["_uid"] for r in store.nodes("User").select("_uid").collect()} == {r[0] for h in halves for r in h.select("_uid").distinct().collect()}


def test_a_dumped_batch_may_come_again(spark, tmp):
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m), i, u, "ERROR", "", {}) for i, (u, m) in enumerate([("a", 0), ("a", 10), ("b", 300)])]
    src, out = os.path.join(tmp, "ev"), os.path.join(tmp, "dump")
    spark.createDataFrame(rows, EVENT_SCHEMA).write.parquet(src)
    for _ in range(2):
        SS.dump_closed_sessions(SS.read_stream(spark, src, EVENT_SCHEMA), out, "1 hour", "1 hour", os.path.join(tmp, "ckpt"))
        n = spark.read.option("recursiveFileLookup", "true").json(out).count()
        commits = os.path.join(tmp, "ckpt", "commits")
        last = max(int(x) for x in os.listdir(commits) if x.isdigit())
        for x in (f"{last}", f".{last}.crc"):
            if os.path.exists(os.path.join(commits, x)):
                os.remove(os.path.join(commits, x))
    assert n == 1
