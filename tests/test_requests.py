"""Requests at once, lookups in a stored index, listeners that fail alone, one merge for all edge types."""

import datetime as dt
import json
import os
import threading
import time

from pyspark.sql import functions as F

from graphmill.model import FROM_UID, TO_UID, Graph
from graphmill.operators import merge as M
from graphmill.operators import progress as P
from graphmill.plans.requests import RequestControl, handle_requests
from graphmill.plans.store import GraphStore
from graphmill.plans.translate import IdentityTranslator
from graphmill.sources import kv as KV
from graphmill.sources.providers import Source
from graphmill.streaming import stream as SS


class Slow:
    """Sources whose rows wait, and the times at which each request asked for them."""

    def __init__(self, spark, seconds):
        self.spark, self.seconds, self.asked = spark, seconds, {}

    def get_data_and_model_for(self, names):
        self.asked[names[0]] = time.monotonic()
        wait = F.udf(lambda i, s=self.seconds.get(names[0], 0): time.sleep(s) or i, "long")
        return [Source(n, self.spark.range(8).repartition(2).select(F.concat(F.lit(f"{n}-"), wait("id").cast("string")).alias("_uid"), F.col("id").alias("v")), None) for n in names]


def requests_of(spark, tmp, names):
    rows = []
    for n in names:
        with open(f"{tmp}/{n}.txt", "w") as f:
            f.write(n)
        rows.append((json.dumps({"request_type": "white_list", "request_id": n, "file_path": f"{tmp}/{n}.txt", "content": "x"}),))
    return spark.createDataFrame(rows, "request string").coalesce(1)


def test_requests_overlap_and_one_is_cancelled(spark, tmp):
    provider = Slow(spark, {"gone": 30, "late": 0.2})
    control = RequestControl(spark)
    store = GraphStore(spark, f"{tmp}/g")
    reqs = requests_of(spark, tmp, ["gone", "fine", "late", "never"])
    control.cancel("never")  # before it begins

    def stop():
        while not {"gone", "fine", "late"} <= set(provider.asked):
            time.sleep(0.05)
        time.sleep(1)
        control.cancel("gone")

    watcher = threading.Thread(target=stop)
    watcher.start()
    began = time.monotonic()
    res = handle_requests(spark, reqs, provider, store, dt.datetime(2024, 1, 1), translator=IdentityTranslator(), parallel=3, control=control)
    watcher.join()
    assert time.monotonic() - began < 60  # "gone" alone would wait for two minutes
    assert max(provider.asked[n] for n in ("gone", "fine", "late")) - min(provider.asked.values()) < 20
    assert sorted(r.request_id.split("_")[0] for r in res.ingested) == ["fine", "late"] and set(res.failed) == {"gone", "never"}
    assert store.nodes("MockPerson").count() == 16
    events = res.events.where("request_id is not null and event_type <> 'RECEIVED_REQUEST'")
    last = {r["request_id"].split("_")[0]: r["status"] for r in P.request_state(events).collect()}
    assert last == {"fine": "DONE_PROCESSING_REQUEST", "late": "DONE_PROCESSING_REQUEST", "gone": "ERROR", "never": "ERROR"}


def test_a_failing_request_fails_alone(spark, tmp):
    class Broken(Slow):
        def get_data_and_model_for(self, names):
            if names == ["bad"]:
                raise LookupError("no such source")
            return super().get_data_and_model_for(names)

    res = handle_requests(spark, requests_of(spark, tmp, ["bad", "good"]), Broken(spark, {}), GraphStore(spark, f"{tmp}/g"), dt.datetime(2024, 1, 1), translator=IdentityTranslator(), parallel=1)
    assert [r.request_id.split("_")[0] for r in res.ingested] == ["good"] and res.failed == {"bad": "no such source"}
    assert res.events.where("event_type = 'ERROR' and request_id = 'bad'").count() == 1


def files_read(spark, df):
    """How many files the scan of ``df`` opened."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan()
        plan.executeCollectPublic()
        return plan.collectLeaves().head().metrics().apply("numFiles").value()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_lookups_read_only_the_buckets_they_need(spark, tmp):
    store = spark.range(5000).select(F.format_string("k%d", "id").alias("key"), F.col("id").cast("string").alias("value"))
    KV.write_store(store.unionByName(spark.createDataFrame([(None, "x")], "key string, value string")), f"{tmp}/kv", buckets=32)
    few = spark.createDataFrame([(0, "k7"), (1, "none"), (2, "k7"), (3, "k4999"), (4, None)], "pos long, key string")
    got = KV.get_stored(few, f"{tmp}/kv")
    assert sorted((r["pos"], r["value"]) for r in got.collect()) == [(0, "7"), (1, None), (2, "7"), (3, "4999"), (4, None)]
    assert sorted(map(str, got.collect())) == sorted(map(str, KV.multi_get(few, store).collect()))
    rows = KV.stored_rows(few, f"{tmp}/kv")
    assert files_read(spark, KV.stored_rows(few, f"{tmp}/kv")) <= 3 and files_read(spark, spark.read.parquet(f"{tmp}/kv")) == 32
    assert "In(key, [" in rows._jdf.queryExecution().executedPlan().toString()
    many = spark.range(3000).select(F.col("id").alias("pos"), F.format_string("k%d", "id").alias("key"))
    assert KV.get_stored(many, f"{tmp}/kv").where("value = cast(pos as string)").count() == 3000
    KV.write_store(store.limit(0), f"{tmp}/kv", buckets=32)  # overwritten by nothing
    assert KV.get_stored(few, f"{tmp}/kv").where("value is not null").isEmpty()


def test_stored_hashes(spark, tmp):
    store = spark.createDataFrame([("a", "x", "1"), ("a", "y", "2"), ("b", "x", "3")], "key string, field string, value string")
    KV.write_store(store, f"{tmp}/kv", buckets=4)
    asked = spark.createDataFrame([(0, "b"), (1, "a"), (2, "c")], "pos long, key string")
    assert sorted(map(str, KV.get_stored(asked, f"{tmp}/kv").collect())) == sorted(map(str, KV.multi_get_hash(asked, store).collect()))


def test_listeners_fail_and_catch_up_alone(spark, tmp):
    src, tries = f"{tmp}/src", []
    spark.range(60).repartitionByRange(3, "id").write.parquet(src)
    stream = SS.read_stream(spark, src, spark.range(1).schema, max_files_per_trigger=1)

    def flaky(batch, batch_id):
        tries.append(batch_id)
        if batch_id == 1 and tries.count(1) == 1:
            raise ValueError("down for a moment")
        SS.copy_to_sink(f"{tmp}/flaky")(batch, batch_id)

    def broken(batch, batch_id):
        raise ValueError("down")

    listeners = [("copy", SS.copy_to_sink(f"{tmp}/copy")), ("flaky", flaky), ("broken", broken)]
    got = {name: (ok, n, error) for name, ok, n, error in SS.run_listeners(stream, listeners, f"{tmp}/ckpt", attempts=2)}
    assert got["copy"] == (True, 1, None) and got["flaky"] == (True, 2, None)
    assert got["broken"][:2] == (False, 2) and "down" in got["broken"][2]
    for name in ("copy", "flaky"):
        assert sorted(r["id"] for r in spark.read.schema("id long").parquet(f"{tmp}/{name}").collect()) == list(range(60))
    assert tries == [0, 1, 1, 2]
    # mended later, it gets everything it missed
    again = SS.run_listeners(stream, [("broken", SS.copy_to_sink(f"{tmp}/late"))], f"{tmp}/ckpt")
    assert again == [("broken", True, 1, None)] and spark.read.schema("id long").parquet(f"{tmp}/late").count() == 60


def test_one_merge_for_all_edge_types(spark, tmp):
    nodes = spark.range(50).select(F.col("id").alias("_uid"))
    rows = [(i % 60, (i * 7) % 60, t) for i in range(300) for t in ("A", "B C", "", None, "x=1/2", "7")[i % 6 : i % 6 + 1]]
    e = spark.createDataFrame(rows, f"{FROM_UID} long, {TO_UID} long, _edgeType string")
    e = e.unionByName(spark.createDataFrame([(None, 1, "A"), (1, None, "A"), (1, 2, "A"), (1, 2, "A")], e.schema))
    g = M.merge_typed_edges(Graph({"N": nodes}, {}), e, "N", "N", path=f"{tmp}/one")
    want = {(t, a, b) for a, b, t in [*rows, (1, 2, "A")] if t is not None and a < 50 and b < 50}
    assert {k[0] for k in g.edges} == {"A", "B C", "", "x=1/2", "7"}
    assert sorted((k[0], r[0], r[1]) for k, df in g.edges.items() for r in df.collect()) == sorted(want)
    more = spark.createDataFrame([(1, 2, "A"), (3, 4, "A"), (5, 6, "new"), (5, 99, "new")], e.schema)
    g2 = M.merge_typed_edges(g, more, "N", "N", path=f"{tmp}/two")
    assert sorted((k[0], r[0], r[1]) for k, df in g2.edges.items() for r in df.collect()) == sorted(want | {("A", 3, 4), ("new", 5, 6)})
    fresh = sorted(tuple(r) for r in spark.read.parquet(f"{tmp}/two/fresh").collect())
    assert fresh == sorted({("A", 3, 4), ("new", 5, 6), ("new", 5, 99)} - {("A", 3, 4)} if ("A", 3, 4) in want else {("A", 3, 4), ("new", 5, 6), ("new", 5, 99)})  # known pairs never reach the ends' checks
    assert os.path.exists(f"{tmp}/two/edges")
    one = M.merge_typed_edges(g, more, "N", "N", edge_type="all")
    assert one.edges[("all", "N", "N")].count() == 3
