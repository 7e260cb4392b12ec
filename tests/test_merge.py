"""J1-J4 on the reference's fixtures plus the merge details the survey pins."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from graphmill.model import FROM_UID, TO_UID, Graph
from graphmill.operators import delete as D
from graphmill.operators import merge as M

T1 = "2024-01-01 00:00:00"
T2 = "2024-02-01 00:00:00"


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_merge_nodes_creates_all(persons):
    flagged = M.merge_nodes_flagged(None, persons, T1)
    counters = {r["counter"]: r["value"] for r in M.node_counters(flagged, persons, "Person").collect()}
    assert counters["nodes_created"] == 1050
    assert counters["labels_added"] == 1050
    # name, age, email non-null + _created per row
    assert counters["properties_set"] == 1050 * 4
    out = M.merge_nodes(None, persons, T1)
    assert out.where(F.col("_created") == F.lit(T1).cast("timestamp_ntz")).count() == 1050
    assert out.where(F.col("_last_updated").isNotNull()).count() == 0


def test_merge_edges_creates_all_and_keeps_self_loop(persons, person_edges):
    flagged = M.merge_edges_flagged(None, person_edges, persons, persons)
    c = {r["counter"]: r["value"] for r in M.edge_counters(flagged, "EDGE_TYPE", "Person", "Person").collect()}
    assert c["relationships_created"] == 500
    assert flagged.where((F.col(FROM_UID) == 0) & (F.col(TO_UID) == 0)).count() == 1


def test_upsert_twice_equals_once(persons, person_edges):
    once = M.merge_nodes(None, persons, T1)
    twice = M.merge_nodes(once, persons, T1)
    assert rows(once, "_uid", "name", "age", "email", "_created") == rows(twice, "_uid", "name", "age", "email", "_created")
    e1 = M.merge_edges(None, person_edges, persons, persons)
    f2 = M.merge_edges_flagged(e1, person_edges, persons, persons)
    assert f2.where(F.col(M.ACTION) == M.CREATED_ACTION).count() == 0
    assert f2.count() == 500


def test_null_overwrites_absent_keeps(spark):
    existing = M.merge_nodes(None, spark.createDataFrame([(1, "a", 10, "x")], "_uid long, name string, age long, city string"), T1)
    incoming = spark.createDataFrame([(1, None, 11), (2, "b", 20)], "_uid long, name string, age long")
    out = {r["_uid"]: r for r in M.merge_nodes(existing, incoming, T2).collect()}
    assert out[1]["name"] is None  # in the incoming schema: null wins
    assert out[1]["age"] == 11
    assert out[1]["city"] == "x"  # not in the incoming schema: kept
    assert out[1]["_created"] == dt.datetime(2024, 1, 1)
    assert out[1]["_last_updated"] == dt.datetime(2024, 2, 1)
    assert out[2]["city"] is None and out[2]["_created"] == dt.datetime(2024, 2, 1) and out[2]["_last_updated"] is None


def test_duplicate_uid_in_batch_last_wins(spark):
    inc = spark.createDataFrame([(7, 1, "first"), (7, 3, "last"), (7, 2, "middle"), (8, 1, "only")], "_uid long, seq long, v string")
    out = {r["_uid"]: r for r in M.merge_nodes(None, inc, T1, order_by=["seq"]).collect()}
    assert out[7]["v"] == "last"
    assert out[7]["_last_updated"] is not None  # later rows matched the node the first one created
    assert out[8]["_last_updated"] is None


def test_incoming_created_column(spark):
    inc = spark.createDataFrame([(1, dt.datetime(2000, 1, 1))], "_uid long, _created timestamp_ntz")
    created = M.merge_nodes(None, inc, T1).collect()[0]
    assert created["_created"] == dt.datetime(2024, 1, 1)  # on create the merge time wins
    base = M.merge_nodes(None, spark.createDataFrame([(1,)], "_uid long"), T1)
    matched = M.merge_nodes(base, inc, T2).collect()[0]
    assert matched["_created"] == dt.datetime(2000, 1, 1)  # on match the incoming value overwrites


def test_null_uids_and_null_ends_drop(spark, persons):
    inc = spark.createDataFrame([(None, "x"), (1, "y")], "_uid long, name string")
    assert M.merge_nodes(None, inc, T1).count() == 1
    e = spark.createDataFrame([(None, 1), (1, None), (1, 2)], "_fromUid long, _toUid long")
    assert rows(M.merge_edges(None, e, persons, persons), FROM_UID, TO_UID) == [(1, 2)]


def test_dangling_edges(spark, persons):
    e = spark.createDataFrame([(1, 2), (1, 5000), (6000, 3), (7000, 8000)], "_fromUid long, _toUid long")
    d = rows(M.dangling_edges(e, persons, persons), FROM_UID, TO_UID, "missing_from", "missing_to")
    assert d == [(1, 5000, False, True), (6000, 3, True, False), (7000, 8000, True, True)]


def test_edges_have_both_ends(spark):
    nodes = spark.range(0, 100).select(F.col("id").alias("_uid"))
    e = spark.range(0, 1000).select((F.col("id") % 150).alias(FROM_UID), (F.col("id") % 130).alias(TO_UID))
    out = M.merge_edges(None, e, nodes, nodes)
    assert out.join(nodes, out[FROM_UID] == nodes["_uid"], "left_anti").count() == 0
    assert out.join(nodes, out[TO_UID] == nodes["_uid"], "left_anti").count() == 0
    assert out.count() == out.distinct().count()


def test_supernode_split_path_equals_plain(spark):
    # a third of all edges leave node 0: salted, forced by a low threshold
    nodes = spark.range(0, 300).select(F.col("id").alias("_uid"))
    hot = spark.range(0, 3000).select(F.lit(0).cast("long").alias(FROM_UID), (F.col("id") % 400).alias(TO_UID))
    cold = spark.range(0, 6000).select((F.col("id") % 350).alias(FROM_UID), (F.col("id") % 280).alias(TO_UID))
    e = hot.unionByName(cold)
    split = M.merge_edges(None, e, nodes, nodes, hot_min_rows=500)
    plain = M.merge_edges(None, e, nodes, nodes, hot_min_rows=None)
    assert rows(split, FROM_UID, TO_UID) == rows(plain, FROM_UID, TO_UID)
    d1 = M.dangling_edges(e, nodes, nodes, hot_min_rows=500)
    d2 = M.dangling_edges(e, nodes, nodes, hot_min_rows=None)
    assert rows(d1, FROM_UID, TO_UID, "missing_from", "missing_to") == rows(d2, FROM_UID, TO_UID, "missing_from", "missing_to")


def _graph(persons, person_edges):
    return Graph({"Person": persons}, {("EDGE_TYPE", "Person", "Person"): M.merge_edges(None, person_edges, persons, persons)})


def test_detach_delete(persons, person_edges):
    g = _graph(persons, person_edges)
    before = g.nodes["Person"].count()
    res = D.detach_delete(g, "Person", [("name", "Person0")], indexed={"*": ["_uid"], "Person": ["name"]})
    s = res.summary.collect()[0]
    assert s["total"] == 1 and s["batches"] == 1
    assert before - res.graph.nodes["Person"].count() == s["total"]
    edges = res.graph.edges[("EDGE_TYPE", "Person", "Person")]
    assert edges.where((F.col(FROM_UID) == 0) | (F.col(TO_UID) == 0)).count() == 0
    assert s["edges_deleted"] == 1  # the self-loop 0 -> 0


def test_detach_delete_removes_both_directions(persons, person_edges):
    g = _graph(persons, person_edges)
    res = D.detach_delete(g, "Person", [("age", 10)], indexed={"Person": ["age"]})
    edges = res.graph.edges[("EDGE_TYPE", "Person", "Person")]
    assert rows(edges.where((F.col(FROM_UID) == 10) | (F.col(TO_UID) == 10)), FROM_UID) == []
    # 5 -> 10 and 10 -> 20 are gone
    assert res.summary.collect()[0]["edges_deleted"] == 2


def test_delete_typed_literal_and_guard(persons, person_edges):
    g = _graph(persons, person_edges)
    res = D.detach_delete(g, "Person", [("age", "5")], indexed={"Person": ["age"]})
    assert res.summary.collect()[0]["total"] == 0  # a quoted number never matches a number
    with pytest.raises(D.PropertyNotIndexedError):
        D.detach_delete(g, "Person", [("email", "x")], indexed={"*": ["_uid"]})


def test_delete_batches(spark):
    nodes = spark.range(2500).select(F.col("id").alias("_uid"), F.lit("Same Name").alias("name"))
    res = D.detach_delete(Graph({"Person": nodes}, {}), "Person", [("name", "Same Name")], indexed={"Person": ["name"]})
    s = res.summary.collect()[0]
    assert (s["total"], s["batches"], s["edges_deleted"]) == (2500, 3, 0)


def test_store_delete_nodes(spark, tmp, persons, person_edges):
    import os

    from graphmill.plans.store import GraphStore

    for b in (None, 4):
        store = GraphStore(spark, os.path.join(tmp, f"s{b}"), buckets=b)
        store.write_nodes("Person", persons)
        store.write_edges(("EDGE_TYPE", "Person", "Person"), M.merge_edges(None, person_edges, persons, persons))
        s = store.delete_nodes("Person", [("age", 10)], indexed={"Person": ["age"]})
        assert s == {"label": "Person", "total": 1, "batches": 1, "edges_deleted": 2}
        assert store.nodes("Person").count() == 1049
        assert store.edges(("EDGE_TYPE", "Person", "Person")).where("_fromUid = 10 or _toUid = 10").count() == 0


def test_map_properties_merge(spark):
    inc = spark.createDataFrame([(1, 1, {"a": "x"}), (1, 2, {"a": "y"}), (2, 1, None)], "_uid long, seq long, tags map<string,string>")
    out = {r["_uid"]: r for r in M.merge_nodes(None, inc, T1, order_by=["seq"]).collect()}
    assert out[1]["tags"] == {"a": "y"} and out[1]["_last_updated"] is not None
    assert M.merge_nodes(None, inc, T1).count() == 2  # default order skips the map column


def test_merge_into_table_without_timestamps(spark, persons):
    plain = persons.select("_uid", "name")
    out = {r["_uid"]: r for r in M.merge_nodes(plain, persons.where("_uid < 3").select("_uid", "age"), T2).collect()}
    assert out[1]["age"] == 1 and out[1]["name"] == "Person1" and out[1]["_created"] is None
    assert out[1]["_last_updated"] == dt.datetime(2024, 2, 1) and out[5]["_last_updated"] is None


def test_unique_uids_fast_path(spark, persons):
    inc = persons.where("_uid >= 400").withColumn("name", F.upper("name"))
    slow = M.merge_nodes(M.merge_nodes(None, persons.where("_uid < 600"), T1), inc, T2)
    fast = M.merge_nodes(M.merge_nodes(None, persons.where("_uid < 600"), T1, unique_uids=True), inc, T2, unique_uids=True)
    assert rows(slow, *slow.columns) == rows(fast, *slow.columns)
    assert "SortAggregate" not in fast._jdf.queryExecution().executedPlan().toString()
