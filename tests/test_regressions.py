"""Cases that once lost rows or failed: odd keys, hot keys of every kind, odd names, times, replays."""

import datetime as dt
import decimal
import os

import pytest
from pyspark.sql import functions as F

from graphmill.functions import keys as K
from graphmill.functions import rows as R
from graphmill.model import EVENT_SCHEMA, Graph
from graphmill.operators import delete as D
from graphmill.operators import merge as M
from graphmill.operators import progress as P
from graphmill.operators import skew as S
from graphmill.operators import staging as ST
from graphmill.plans.ingest import IngestError, ingest, load_staged
from graphmill.plans.store import GraphStore
from graphmill.sources.index import as_string_array
from graphmill.sources.providers import Source

AT = "2024-01-01"


def rows(df):
    return sorted(map(str, df.collect()))


def test_text_that_only_looks_like_a_list(spark):
    df = spark.createDataFrame([("[sic] hello",), ('["a","b"]',), ("x",), (None,), ("[",), (" [1, 2]",)], "c string")
    assert [r[0] for r in df.select(as_string_array("c")).collect()] == [["[sic] hello"], ["a", "b"], ["x"], None, ["["], ["1", "2"]]


@pytest.mark.parametrize("kind", ["int", "long", "string", "decimal(20,3)", "date", "timestamp_ntz", "double", "binary"])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_of_every_key_type(spark, kind, how):
    text = F.concat(F.lit("2024-01-0"), (F.col("id") % 3 + 1).cast("string")) if kind in ("date", "timestamp_ntz") else (F.col("id") % 3).cast("string")
    key = F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(text).cast(kind)
    big = spark.range(60).select(key.alias("k"), F.col("id").alias("v"), F.create_map(F.lit("a"), F.col("id")).alias("m"))
    small = big.select(F.col("k").alias("sk")).where("k is not null").distinct().orderBy("sk").limit(2).withColumn("p", F.lit(1))
    small = spark.createDataFrame(small.collect(), small.schema)
    assert rows(S.split_join(big, small, "k", "sk", how, min_rows=3)) == rows(S.split_join(big, small, "k", "sk", how, min_rows=None))


def test_hot_requests_with_the_event_schema(spark):
    t = dt.datetime(2024, 1, 1)
    ev = [(t, 0, "r", "STARTED_PROCESSING_REQUEST", "", {"a": "1"})] + [(t, i, "r", "ERROR", f"e{i}", {"b": str(i)}) for i in range(1, 40)]
    ev = spark.createDataFrame(ev + [(t, 0, "s", "STARTED_PROCESSING_REQUEST", "", None)], EVENT_SCHEMA)
    for f in (P.request_state, P.status_times, P.request_errors, P.request_report):
        assert rows(f(ev, hot_min_rows=5)) == rows(f(ev, hot_min_rows=None))


def test_dangling_edges_with_nulls_repeats_and_hot_ends(spark):
    e = spark.createDataFrame([(None, 1)] * 50 + [(1, 2)] * 30 + [(1, None), (7, 7), (2, 1)], "_fromUid int, _toUid int")
    n = spark.createDataFrame([(1,), (2,)], "_uid long")
    assert rows(M.dangling_edges(e, n, n, 5)) == rows(M.dangling_edges(e, n, n, None))
    assert M.dangling_edges(e, n, n, 5).count() == 52


def test_decimal_ids_in_edges(spark):
    e = spark.range(100).select(F.lit(1).cast("decimal(20,0)").alias("_fromUid"), F.col("id").cast("decimal(20,0)").alias("_toUid"))
    n = e.select(F.col("_toUid").alias("_uid"))
    assert M.merge_edges(None, e, n, n, 5).count() == 100


@pytest.mark.parametrize("glob,key,ok", [("a[[]b?*", "a[bc", True), ("a[&&b]c", "a&c", True), ("a[^\\]]c", "abc", True), ("a[]c", "a[]c", True), ("a[!b-d]e", "ace", False), ("[a-c]:*", "b:x", True)])
def test_globs(spark, glob, key, ok):
    df = spark.createDataFrame([(key,)], "k string")
    assert df.select(K.matches_glob("k", glob)).first()[0] is ok


def test_staged_keys_come_back_as_they_went(spark, tmp):
    path = os.path.join(tmp, "st")
    keys = [("01", ""), ("1", "a"), ("20240201", "007"), ("1", "\\e"), ("1", "\\"), ("1.0", "null")]
    for i, (job, args) in enumerate(keys):
        ST.write_set_add(spark, ST.stage(spark.createDataFrame([(i,)], "_uid int"), job, "nodes_ingest", args), path)
    got = {(r.job_name, r.arguments) for r in ST.read_staging(spark, path).collect()}
    assert got == set(keys)
    for n, (job, args) in enumerate(keys):
        assert ST.drop_keys(spark, path, [(job, "nodes_ingest", args)]) == 1
        assert ST.read_staging(spark, path).count() == len(keys) - n - 1


def test_staged_times_keep_microseconds(spark, tmp):
    at = [dt.datetime(2024, 1, 1, 0, 0, 0, us) for us in (1, 2, 123456)]
    df = spark.createDataFrame([(i, t, t) for i, t in enumerate(at)], "_uid int, a timestamp, b timestamp_ntz")
    staged = ST.stage(df, "j", "nodes_ingest", "L")
    ST.write_set_add(spark, staged, os.path.join(tmp, "st"))
    back = ST.read_staging(spark, os.path.join(tmp, "st"))
    assert back.select("payload").distinct().count() == 3
    assert rows(ST.decode(back, back.first()["schema"])) == rows(df)
    assert [r[0] for r in R.row_to_json(df.select("b")).collect()][0].count("000001") == 1


def test_publish_reports_every_key(spark, tmp):
    path = os.path.join(tmp, "st")
    df = spark.range(100).select(F.col("id").alias("_uid"))
    args = F.concat(F.lit("L"), (F.col("_uid") % 30).cast("string"))
    ST.publish(spark, ST.stage_columns(df.where("_uid < 40"), "j", "nodes_ingest", args, ["_uid"]), path)
    with pytest.raises(ST.PublishError) as e:
        ST.publish(spark, ST.stage_columns(df, "j", "nodes_ingest", args, ["_uid"]), path)
    assert e.value.report.count() == 30
    assert ST.purge_storage(spark, path) == 30 and ST.read_staging(spark, path).count() == 0


def test_delete_keys_with_a_hot_key(spark):
    staged = spark.createDataFrame([("j", "nodes_ingest", "hot", "s", str(i)) for i in range(50)] + [("j", "nodes_ingest", None, "s", "x"), ("j", "nodes_ingest", "b", "s", "y")], ST.STAGING_DDL)
    gone = staged.where("arguments = 'hot'")
    assert rows(ST.delete_keys(staged, gone, 5).select("payload")) == rows(staged.where("payload in ('x', 'y')").select("payload"))


@pytest.mark.parametrize("buckets", [None, 4])
def test_odd_names_in_a_store(spark, tmp, buckets):
    store = GraphStore(spark, os.path.join(tmp, "nodes", "g"), buckets=buckets)
    n = spark.range(20).select(F.col("id").alias("_uid"), (F.col("id") % 2).alias("odd"))
    e = spark.range(20).select(F.col("id").alias("_fromUid"), F.col("id").alias("_toUid"))
    for label in ("Part", "part", "a__b", "x~y"):
        store.merge_nodes(label, n, AT)
    store.merge_edges(("LIVES__IN", "a__b", "Part"), e, n, n)
    store.merge_edges(("IS", "part", "part"), e, n, n)
    assert store.labels() == ["Part", "a__b", "part", "x~y"]
    assert store.edge_keys() == [("IS", "part", "part"), ("LIVES__IN", "a__b", "Part")]
    with pytest.raises(D.PropertyNotIndexedError):
        store.delete_nodes("a__b", [("odd", 1)])
    declared = {"a__b": ["odd", "gone"]}
    assert store.delete_nodes("a__b", [("gone", 1)], indexed=declared)["total"] == 0
    assert store.delete_nodes("nobody", [("_uid", 1)])["total"] == 0
    versions = store._versions(store._edge_dir(("IS", "part", "part")))
    s = store.delete_nodes("a__b", [("odd", 1)], indexed=declared)
    assert (s["total"], s["edges_deleted"]) == (10, 10)
    assert store.edges(("LIVES__IN", "a__b", "Part")).count() == 10 and store.nodes("a__b").count() == 10
    assert store._versions(store._edge_dir(("IS", "part", "part"))) == versions


def test_delete_of_unknown_labels_and_properties(spark):
    n = spark.range(3).select(F.col("id").alias("_uid"))
    g = Graph({"A": n}, {("T", "A", "A"): n.select(F.col("_uid").alias("_fromUid"), F.col("_uid").alias("_toUid"))})
    assert D.detach_delete(g, "B", [("_uid", 1)]).summary.first()["total"] == 0
    assert D.detach_delete(g, "A", [("x", 1)], indexed=None).summary.first()["total"] == 0
    with pytest.raises(D.PropertyNotIndexedError):
        D.detach_delete(g, "A", [("x", 1)])


def test_the_last_row_wins_over_all_shapes(spark, tmp):
    path = os.path.join(tmp, "st")
    five = spark.createDataFrame([(1, 5, "five"), (2, 1, "one")], "_uid long, ts long, name string")
    one = spark.createDataFrame([(1, 1, "old", True), (3, 9, None, False)], "_uid long, ts long, name string, vip boolean")
    for f in (five, one):
        ST.write_set_add(spark, ST.stage(f, "01", "nodes_ingest", "L"), path)
    store = GraphStore(spark, os.path.join(tmp, "g"))
    store.merge_nodes("L", spark.createDataFrame([(2, True)], "_uid long, vip boolean"), AT)
    load_staged(spark, path, store, "01", "r", dt.datetime(2024, 2, 1), order_by=["ts"])
    got = {r["_uid"]: (r["ts"], r["name"], r["vip"], r["_last_updated"] is None) for r in store.nodes("L").collect()}
    assert got == {1: (5, "five", True, False), 2: (1, "one", True, False), 3: (9, None, False, True)}
    assert ST.read_staging(spark, path).count() == 0


def test_progress_from_the_events_of_an_ingest(spark, tmp, persons):
    from graphmill.model import NodeMapping

    store = GraphStore(spark, os.path.join(tmp, "g"))
    res = ingest(spark, [Source("p", persons, [NodeMapping("Person", "_uid", {"name": "name"})])], store, "r", dt.datetime(2024, 2, 1))
    ev = res.events
    expected, done = P.of_ingest(ev)
    got = P.progress(expected, done).collect()
    assert [(r["cardinality"], r["percent"]) for r in got] == [(1050, 100.0)]
    assert [r["complete"] for r in P.completeness(expected, done).collect()] == [True]


def test_a_failing_load_logs_its_error(spark, tmp):
    path = os.path.join(tmp, "st")
    ST.write_set_add(spark, ST.stage(spark.createDataFrame([("x" * 5000,)], "nothing string"), "7", "nodes_ingest", "L"), path)
    with pytest.raises(IngestError) as e:
        load_staged(spark, path, GraphStore(spark, os.path.join(tmp, "g")), "7", "r", dt.datetime(2024, 2, 1))
    assert [r["status"] for r in P.request_state(e.value.events).collect()] == ["ERROR"]
    assert ST.read_staging(spark, path).count() == 1


def test_decimal_keys_are_typed(spark):
    df = spark.createDataFrame([(decimal.Decimal("1.50"),)] * 9, "k decimal(10,2)")
    assert S.hot_keys(df, "k", 3) == [(decimal.Decimal("1.50"), 9)]


def test_labels_with_a_comma_are_rejected(spark, tmp, persons):
    from graphmill.model import NodeMapping

    with pytest.raises(IngestError, match="comma"):
        ingest(spark, [Source("p", persons, [NodeMapping("a,b", "_uid", {"name": "name"})])], GraphStore(spark, os.path.join(tmp, "g")), "r", dt.datetime(2024, 2, 1))
    assert GraphStore(spark, os.path.join(tmp, "g")).labels() == []


def test_report_is_one_pass(spark):
    rows = [(0, 0, "a", "STARTED_PROCESSING_REQUEST", {}), (1, 1, "a", "ERROR", {}), (2, 2, "a", "STARTED_PROCESSING_REQUEST", {}), (5, 6, "c", "ERROR", {})]
    rows += [(3, 3 + i, "a", "PUSHED_GRAPH_ELEMENTS_INTO_NEO", {"element_type": "NODES", "element_properties": "L", "nodes_created": "5", "how_many": "9"}) for i in range(2)]
    rows += [(4, 5, "a", "DONE_PROCESSING_REQUEST", {}), (4, 7, "b", "STARTED_PROCESSING_REQUEST", {})]
    ev = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, m), s, r, t, "", a) for m, s, r, t, a in rows], EVENT_SCHEMA)
    report = P.request_report(ev, None)
    got = {r["request_id"]: r for r in report.collect()}
    assert set(got) == {"a", "b"} and got["b"]["counters"] is None
    a = got["a"]
    assert (a["status"], a["n_events"], a["n_errors"], a["end_time"]) == ("DONE_PROCESSING_REQUEST", 4, 0, "2024-01-01 00:04:00")
    assert a["counters"] == {"NODES_L": {"nodes_created": 10}}
    assert set(a["map_status_to_timestamp"]) >= {"STARTED_PROCESSING_REQUEST", "DONE_PROCESSING_REQUEST"}
    state = {r["request_id"]: r.asDict() for r in P.request_state(ev, None).collect()}
    assert all({k: got[i][k] for k in s} == s for i, s in state.items())
    assert report._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") <= 2  # the events, and their last starts
