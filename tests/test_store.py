"""The graph store's commits: writers at the same time, killed writes, replays, touched buckets."""

import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from graphmill.operators import merge as M
from graphmill.plans import store as store_module
from graphmill.plans.store import ConflictError, GraphStore
from graphmill.streaming import stream as SS

AT, LATER = "2024-01-01", "2024-02-01"


def frame(spark, start, stop, name="n"):
    return spark.range(start, stop).select(F.col("id").alias("_uid"), F.concat(F.lit(name), F.col("id")).alias("name"))


def uids(store, label="L"):
    return sorted(r["_uid"] for r in store.nodes(label).select("_uid").collect())


def at_once(*calls):
    """Runs calls in threads of their own; their results and errors."""
    out, gate = [None] * len(calls), threading.Barrier(len(calls))

    def run(i, call):
        gate.wait()
        try:
            out[i] = call()
        except Exception as e:  # noqa: BLE001 - the test looks at it
            out[i] = e

    threads = [threading.Thread(target=run, args=(i, c)) for i, c in enumerate(calls)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    return out


@pytest.mark.parametrize("buckets", [None, 4])
@pytest.mark.parametrize("small", [False, True])
def test_writers_at_the_same_time_lose_nothing(spark, tmp, buckets, small):
    store = GraphStore(spark, tmp, buckets=buckets)
    store.merge_nodes("L", frame(spark, 0, 100), AT)
    others = [GraphStore(spark, tmp, buckets=buckets) for _ in range(3)]
    done = at_once(*[lambda i=i, o=o: o.merge_nodes("L", frame(spark, 100 + 100 * i, 200 + 100 * i), AT, batch=(f"q{i}", 0), small=small) for i, o in enumerate(others)])
    assert [d["created"] for d in done] == [100] * 3
    assert uids(store) == list(range(400))
    assert all(store.has_batch("L", (f"q{i}", 0)) for i in range(3)) and not store.has_batch("L", ("q0", 1))
    assert store.merge_nodes("L", frame(spark, 900, 950), AT, batch=("q1", 0)) == {}
    assert uids(store) == list(range(400))
    assert store._versions(store._node_dir("L"))[-1] == 4


def test_edges_and_first_versions_at_the_same_time(spark, tmp):
    nodes = frame(spark, 0, 50)
    edges = [spark.range(10 * i, 10 * i + 10).select(F.col("id").alias("_fromUid"), (F.col("id") % 7).alias("_toUid")) for i in range(3)]
    key = ("T", "L", "L")
    done = at_once(*[lambda e=e: GraphStore(spark, tmp).merge_edges(key, e, nodes, nodes) for e in edges])
    assert [d["created"] for d in done] == [10] * 3
    assert GraphStore(spark, tmp).edges(key).count() == 30


@pytest.mark.parametrize("buckets", [None, 4])
def test_a_killed_write_blocks_nothing(spark, tmp, buckets):
    store = GraphStore(spark, tmp, buckets=buckets)
    store.merge_nodes("L", frame(spark, 0, 10), AT)
    folder = store._node_dir("L")
    os.makedirs(f"{folder}/part-dead/_temporary/0")  # killed while its tasks wrote
    frame(spark, 500, 600).write.parquet(f"{folder}/part-whole")  # killed between the write and the marker
    with open(f"{folder}/_versions/_draft-dead", "w") as f:  # killed while it wrote the marker
        f.write('{"parts"')
    assert uids(store) == list(range(10))
    assert store.merge_nodes("L", frame(spark, 10, 20), AT, batch=("q", 0))["created"] == 10
    assert uids(GraphStore(spark, tmp)) == list(range(20))
    assert store.sweep(3600) == 0 and os.path.exists(f"{folder}/part-dead")
    assert store.sweep(-60) == 2 and not os.path.exists(f"{folder}/part-dead")
    assert uids(store) == list(range(20))


def test_a_failed_write_leaves_the_table(spark, tmp):
    store = GraphStore(spark, tmp, buckets=2)
    store.merge_nodes("L", frame(spark, 0, 10), AT)
    with pytest.raises(Exception, match="torn"):
        store.merge_nodes("L", frame(spark, 0, 20).withColumn("name", F.when(F.col("_uid") == 15, F.raise_error(F.lit("torn"))).otherwise("x")), AT)
    assert uids(store) == list(range(10)) and store.nodes("L").where("name = 'x'").isEmpty()
    assert store.merge_nodes("L", frame(spark, 5, 20), AT) == {"created": 10, "updated": 5, "kept": 5, "_rows": 15}


@pytest.mark.parametrize("local", [True, False])
def test_a_version_is_created_once(spark, tmp, local):
    store = GraphStore(spark, tmp)
    store._local = local  # a hard link here, Hadoop's rename elsewhere
    store._fs.mkdirs(store._Path(f"{tmp}/t/_versions"))
    assert store._publish(f"{tmp}/t", 1, {"parts": [], "batches": {"a": 1}})
    assert not store._publish(f"{tmp}/t", 1, {"parts": [], "batches": {"b": 2}})
    assert store._version(f"{tmp}/t", 1)["batches"] == {"a": 1}
    assert [n for n in os.listdir(f"{tmp}/t/_versions") if n.startswith("_draft")] == []


def test_a_writer_that_never_wins_says_so(spark, tmp, monkeypatch):
    store = GraphStore(spark, tmp)
    monkeypatch.setattr(store_module, "MAX_ATTEMPTS", 3)
    monkeypatch.setattr(store, "_publish", lambda *a: False)
    with pytest.raises(ConflictError):
        store.merge_nodes("L", frame(spark, 0, 10), AT)
    assert [n for n in os.listdir(store._node_dir("L")) if n.startswith("part-")] == []


def read_by(df):
    return {f.split("_")[-1].split(".")[0] for f in df.inputFiles()}


def test_a_small_batch_rewrites_only_its_buckets(spark, tmp):
    store = GraphStore(spark, tmp, buckets=16)
    store.merge_nodes("L", frame(spark, 0, 1000), AT)
    folder = store._node_dir("L")
    before = {n: os.path.getmtime(f"{folder}/{n}") for n in os.listdir(folder) if n.startswith("part-")}
    batch = frame(spark, 7, 8, "new").unionByName(frame(spark, 2000, 2001, "new"))
    hit = {r[0] for r in batch.select(store._bucket(folder, 16)).collect()}
    assert store.merge_nodes("L", batch, LATER, small=True)["created"] == 1
    version, marker = store._current(folder)
    (new, own), (old, left) = marker["parts"]
    assert set(own) == hit and set(left) == set(range(16)) - hit and old in before
    assert len([f for f in os.listdir(f"{folder}/{new}") if f.endswith(".parquet")]) <= len(hit)
    rows = {r["_uid"]: r["name"] for r in store.nodes("L").collect()}
    assert len(rows) == 1001 and rows[7] == "new7" and rows[8] == "n8" and rows[2000] == "new2000"
    # the whole table again, by a merge that is not small
    assert store.merge_nodes("L", frame(spark, 0, 10, "z"), LATER)["kept"] == 991
    assert len(store._current(folder)[1]["parts"]) == 1 and len(uids(store)) == 1001


def test_many_small_batches(spark, tmp, monkeypatch):
    monkeypatch.setattr(store_module, "MAX_PARTS", 3)
    store, plain = GraphStore(spark, f"{tmp}/a", buckets=8), GraphStore(spark, f"{tmp}/b")
    parts = []
    for i in range(7):
        for s in (store, plain):
            s.merge_nodes("L", frame(spark, 3 * i, 3 * i + 4, f"v{i}-"), AT, small=True, batch=("q", i))
        parts.append(len(store._current(store._node_dir("L"))[1]["parts"]))
    assert max(parts) <= 4 and min(parts[1:]) == 1
    assert sorted(map(tuple, store.nodes("L").collect()), key=repr) == sorted(map(tuple, plain.nodes("L").collect()), key=repr)
    named = {p for v in store._versions(store._node_dir("L")) for p, _ in store._version(store._node_dir("L"), v)["parts"]}
    assert {n for n in os.listdir(store._node_dir("L")) if n.startswith("part-")} == named  # retired versions took their folders along


def test_a_small_batch_with_new_columns_or_no_keys(spark, tmp):
    store = GraphStore(spark, tmp, buckets=4)
    store.merge_nodes("L", frame(spark, 0, 100), AT)
    assert store.merge_nodes("L", spark.range(5).select(F.col("id").alias("_uid"), F.lit(1).alias("vip")), LATER, small=True)["updated"] == 5
    assert store.nodes("L").where("vip = 1").count() == 5 and store.nodes("L").where("name is null").isEmpty()
    nothing = frame(spark, 0, 0).withColumn("_uid", F.lit(None).cast("long"))
    assert store.merge_nodes("L", nothing, LATER, small=True, batch=("q", 3))["created"] == 0
    assert store.has_batch("L", ("q", 3)) and len(uids(store)) == 100


def test_streams_at_the_same_time_into_one_label(spark, tmp):
    store = GraphStore(spark, f"{tmp}/g", buckets=4)
    streams = []
    for i in range(2):
        src = f"{tmp}/src{i}"
        frame(spark, 60 * i, 60 * i + 60).repartitionByRange(3, "_uid").write.parquet(src)
        streams.append(SS.read_stream(spark, src, "_uid long, name string", max_files_per_trigger=1))
    done = at_once(*[lambda i=i, s=s: SS.merge_stream_into_store(s, GraphStore(spark, f"{tmp}/g", buckets=4), "L", AT, f"{tmp}/ckpt{i}") for i, s in enumerate(streams)])
    assert done == [None, None]
    assert uids(store) == list(range(120))
    assert sorted(store._current(store._node_dir("L"))[1]["batches"].values()) == [2, 2]


def test_a_stream_restarts_after_a_killed_batch(spark, tmp):
    src, ckpt = f"{tmp}/src", f"{tmp}/ckpt"
    frame(spark, 0, 90).repartitionByRange(3, "_uid").write.parquet(src)
    stream = SS.read_stream(spark, src, "_uid long, name string", max_files_per_trigger=1)
    store = GraphStore(spark, f"{tmp}/g", buckets=2)
    whole = SS.merge_sink(store, "L", AT)

    def killed(batch, batch_id):
        if batch_id == 1:
            os.makedirs(f"{store._node_dir('L')}/part-dead/_temporary", exist_ok=True)  # its folder stays behind
            raise ValueError("killed")
        whole(batch, batch_id)

    with pytest.raises(Exception, match="killed"):
        SS.run_to_end(stream, killed, ckpt)
    assert len(uids(store)) < 90
    SS.merge_stream_into_store(stream, store, "L", AT, ckpt)
    assert uids(store) == list(range(90))


def test_ordinary_property_names(spark, tmp):
    names = ["a.b", "_n_in", "_ex", "e0", "i1", "n", "old", "o`k", "_in"]
    rows = [(i, *[f"{c}-{i}" for c in names]) for i in range(3)]
    df = spark.createDataFrame(rows, ["_uid", *names])
    once = M.merge_nodes(None, df, AT)
    twice = M.merge_nodes(once, df.where("_uid < 2").withColumnRenamed("n", "new.n"), LATER)
    got = {r["_uid"]: r.asDict() for r in twice.collect()}
    assert got[0]["a.b"] == "a.b-0" and got[1]["new.n"] == "n-1" and got[2]["_ex"] == "_ex-2" and got[0]["n"] == "n-0"
    store = GraphStore(spark, tmp, buckets=2)
    ordinary = df.drop("a.b", "o`k")
    store.merge_nodes("L", ordinary, AT)
    assert store.merge_nodes("L", ordinary, LATER)["updated"] == 3
    with pytest.raises(ValueError, match="_action"):
        M.merge_nodes(None, df.withColumn("_action", F.lit(1)), AT)


def test_another_key_type_is_an_error_before_any_job(spark, tmp):
    store = GraphStore(spark, tmp)
    store.merge_nodes("L", frame(spark, 0, 3), AT)
    with pytest.raises(ValueError, match="bigint.*string"):
        store.merge_nodes("L", spark.createDataFrame([("x", "y")], "_uid string, name string"), AT)


def test_counts_come_from_the_writing_job(spark, tmp):
    store = GraphStore(spark, tmp, buckets=4)
    twice = frame(spark, 0, 10).unionByName(frame(spark, 5, 10))
    assert store.merge_nodes("L", twice, AT) == {"created": 10, "updated": 0, "kept": 0, "_rows": 15}
    edges = spark.createDataFrame([(1, 2), (1, 2), (3, 4), (1, 99), (None, 1)], "_fromUid long, _toUid long")
    nodes = store.nodes("L")
    counts = store.merge_edges(("T", "L", "L"), edges, nodes, nodes)
    assert (counts["created"], counts["dangling"], counts["_rows"]) == (2, 2, 5)
    counts = store.merge_edges(("T", "L", "L"), edges, nodes, nodes)
    assert (counts["created"], counts["kept"]) == (0, 2) and store.edges(("T", "L", "L")).count() == 2
    assert json.loads(json.dumps(counts)) == counts
