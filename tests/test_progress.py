"""Events, request state, whole-request ingest, validation and the admin log."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from graphmill.model import EVENT_SCHEMA
from graphmill.operators import progress as P
from graphmill.operators import validate as V
from graphmill.plans.ingest import ingest, load_staged
from graphmill.plans.store import GraphStore
from graphmill.plans.translate import IdentityTranslator
from graphmill.sources.providers import mock_sources

T0 = dt.datetime(2024, 1, 1)


def ev(spark, rows):
    return spark.createDataFrame([(T0 + dt.timedelta(seconds=s), s, rid, t, m, {}) for s, rid, t, m in rows], EVENT_SCHEMA)


def test_request_state_and_errors(spark):
    rows = [(0, "r1", "STARTED_PROCESSING_REQUEST", "")]
    rows += [(i, "r1", "ERROR", f"Oh noez {i}") for i in range(1, 11)]
    rows += [(20, "r2", "STARTED_PROCESSING_REQUEST", ""), (21, "r2", "ERROR", "old"), (22, "r2", "STARTED_PROCESSING_REQUEST", "")]
    rows += [(23, "r2", "FETCHING_DATA_AND_MODELS", ""), (24, "r2", "PUSHED_GRAPH_ELEMENTS_INTO_NEO", ""), (25, "r2", "DONE_PROCESSING_REQUEST", "")]
    rows += [(30, "r3", "FETCHING_DATA_AND_MODELS", "")]  # never started: no state
    e = ev(spark, rows)
    st = {r["request_id"]: r for r in P.request_state(e).collect()}
    assert set(st) == {"r1", "r2"}
    assert st["r1"]["status"] == "ERROR" and st["r1"]["n_errors"] == 10 and st["r1"]["end_time"] is None
    # a new STARTED replaces the state: the old error is gone, DONE is the status (PUSHED does not set status)
    assert st["r2"]["status"] == "DONE_PROCESSING_REQUEST" and st["r2"]["n_errors"] == 0 and st["r2"]["n_events"] == 4
    assert st["r2"]["start_time"] == "2024-01-01 00:00:22" and st["r2"]["end_time_unix"] == int((T0 + dt.timedelta(seconds=25)).replace(tzinfo=dt.timezone.utc).timestamp())
    errs = P.request_errors(e).where("request_id = 'r1'").orderBy("error_no").collect()
    assert [r["message"] for r in errs] == [f"Oh noez {i}" for i in range(1, 11)]
    times = {r["status"]: r["at"] for r in P.status_times(e).where("request_id = 'r2'").collect()}
    assert times["STARTED_PROCESSING_REQUEST"] == "2024-01-01 00:00:22" and "ERROR" not in times


def test_counters_progress_completeness(spark):
    counters = spark.createDataFrame(
        [("r", "NODES", "Person", "nodes_created", 10), ("r", "NODES", "Person", "nodes_created", 5), ("r", "EDGES", "T_A_B", "relationships_created", 3)],
        "request_id string, element_type string, element_properties string, counter string, value long",
    )
    roll = {(r["key"], r["counter"]): r["value"] for r in P.counter_rollup(counters).collect()}
    assert roll == {("NODES_Person", "nodes_created"): 15, ("EDGES_T_A_B", "relationships_created"): 3}
    card = spark.createDataFrame([("r", "k1", 8), ("r", "k2", 8), ("r", "k3", 0)], "request_id string, key string, cardinality long")
    proc = spark.createDataFrame([("r", "k1", 1), ("r", "k1", 2), ("r", "k2", 8)], "request_id string, key string, how_many long")
    pr = {r["key"]: (r["processed"], r["percent"]) for r in P.progress(card, proc).collect()}
    assert pr == {"k1": (3, 38.0), "k2": (8, 100.0), "k3": (0, None)}
    fin = proc.select("request_id", "key").distinct()
    assert [r["key"] for r in P.missing_keys(card, fin).collect()] == ["k3"]
    c = P.completeness(card, fin).collect()[0]
    assert (c["n_expected"], c["n_missing"], c["complete"]) == (3, 1, False)


def test_outcome_summary(spark):
    o = spark.createDataFrame([("a", True), ("a", False), ("b", True), ("c", False)], "request_id string, ok boolean")
    s = {r["request_id"]: (r["total"], r["succeeded"], r["failed"], r["all_ok"], r["verdict"]) for r in P.outcome_summary(o).collect()}
    assert s == {"a": (2, 1, 1, False, "FAILED_WRITERS"), "b": (1, 1, 0, True, "ALL_OK"), "c": (1, 0, 1, False, "FAILED_WRITERS")}


def test_ingest_two_mock_sources(spark, tmp):
    """End to end like the reference's integration test: two sources of 10 rows -> 20 MockPerson nodes."""
    store = GraphStore(spark, os.path.join(tmp, "graph"))
    srcs = mock_sources(spark.range(10).withColumnRenamed("id", "i"))
    res = ingest(spark, srcs, store, "my_request_id", dt.datetime(2024, 5, 6, 7, 8, 9), staging_path=os.path.join(tmp, "stage"), translator=IdentityTranslator())
    assert res.request_id == "my_request_id_2024_5_6_7_8_9"
    assert store.nodes("MockPerson").count() == 20
    seq = [r["event_type"] for r in res.events.orderBy("seq").collect()]
    assert seq == [
        "STARTED_PROCESSING_REQUEST",
        "FETCHING_DATA_AND_MODELS",
        "FINISHED_FETCHING_DATA_AND_MODELS",
        "WRITING_GRAPH_ELEMENTS_INTO_REDIS",
        "WRITING_GRAPH_ELEMENTS_INTO_REDIS",
        "REDIS_IS_READY_FOR_CONSUMPTION",
        "WRITING_FROM_REDIS_TO_NEO",
        "PUSHED_GRAPH_ELEMENTS_INTO_NEO",
        "DELETING_REDIS_KEYS",
        "WRITING_FROM_REDIS_TO_NEO",
        "PUSHED_GRAPH_ELEMENTS_INTO_NEO",
        "DELETING_REDIS_KEYS",
        "DONE_PROCESSING_REQUEST",
    ]
    st = P.request_state(res.events).collect()[0]
    assert st["status"] == "DONE_PROCESSING_REQUEST"
    assert not os.path.exists(os.path.join(tmp, "stage", "job_name=my_request_id_2024_5_6_7_8_9_source-1"))
    # a second run of the same data matches every node and creates none
    res2 = ingest(spark, srcs, store, "again", dt.datetime(2024, 5, 7), translator=IdentityTranslator())
    assert [x["nodes_created"] for x in res2.loaded] == [0, 0]
    assert store.nodes("MockPerson").where(F.col("_last_updated").isNotNull()).count() == 20
    assert V.events_of_request(res.events, "my_request_id").count() == 13


def test_load_staged_two_shapes(spark, tmp, persons, person_edges):
    from graphmill.operators import staging as ST

    path = os.path.join(tmp, "stage")
    ST.write_set_add(spark, ST.stage(person_edges, "Awesome", "edges_ingest", "EDGE_TYPE,Person,Person"), path)
    ST.write_set_add(spark, ST.stage(persons, "Awesome", "nodes_ingest", "Person"), path)
    ST.write_set_add(spark, ST.stage(persons.where("_uid < 10").select("_uid", F.lit("nick").alias("nickname")), "Awesome", "nodes_ingest", "Person"), path)
    store = GraphStore(spark, os.path.join(tmp, "graph"))
    res = load_staged(spark, path, store, "Awesome", "req", dt.datetime(2024, 1, 1))
    assert [x["element_type"] for x in res.loaded] == ["NODES", "NODES", "EDGES"]
    nodes = store.nodes("Person")
    assert nodes.count() == 1050 and nodes.where("nickname = 'nick'").count() == 10 and nodes.where("name is null").count() == 0
    assert store.edges(("EDGE_TYPE", "Person", "Person")).count() == 500
    assert ST.read_staging(spark, path, must_exist=True).count() == 0


REQ_PATH = "/lists/white_list.txt"


def test_validate_requests(spark):
    # FIXTURES 11
    reqs = spark.createDataFrame(
        [
            (1, "{}"),
            (2, '{"name": "someone"}'),
            (3, '{"request_type": "nothing", "request_id": "123"}'),
            (4, '{"request_type": "white_list", "request_id": "123"}'),
            (5, '{"request_type": "white_list", "file_path": 1, "request_id": "123"}'),
            (6, '{"request_type": "white_list", "file_path": "' + REQ_PATH + '", "request_id": "123"}'),
            (7, "not json"),
        ],
        "n int, request string",
    )
    out = {r["n"]: (r["valid"], "; ".join(r["problems"])) for r in V.validate_requests(reqs).collect()}
    assert not out[1][0] and "request_type" in out[1][1]
    assert not out[2][0] and "request_type" in out[2][1]
    assert out[3] == (False, "Unsupported request type: nothing.")
    assert not out[4][0] and "missing" in out[4][1]
    assert not out[5][0] and "must be of type" in out[5][1]
    assert out[6] == (True, "")
    assert not out[7][0]


def test_uid_checks(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,)], "_uid long")
    assert [tuple(r) for r in V.uid_duplicates(df).collect()] == [(1, 2)]
    assert V.uid_nulls(df, "X").collect()[0]["n_null"] == 1


def test_admin_log(spark, tmp):
    # FIXTURES 10: 100 rows of one job
    entries = spark.range(100).select(
        F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("timestamp"),
        F.lit("Unique-123").alias("job_id"),
        F.lit("Reading Table").alias("category"),
        F.col("id").alias("int_value"),
        F.format_string("Finished with %d rows.", "id").alias("string_value"),
    )
    registry = spark.createDataFrame([("Unique-123", "MyNodes")], "job_id string, job_name string")
    named = P.name_entries(entries, registry)
    assert named.where("job_name = 'MyNodes'").count() == 100
    with pytest.raises(P.DuplicateJobError):
        P.check_registry(registry.unionByName(registry))
    loc = os.path.join(tmp, "admin")
    P.create_admin_table(spark, "admin_log_test", loc)
    P.create_admin_table(spark, "admin_log_test", loc)  # if absent: second call is a no-op
    outcome = P.fan_out(
        named.select("timestamp", "job_name", "job_id", "category", "int_value", "string_value"),
        [("table", lambda d: d.write.insertInto("admin_log_test")), ("broken", lambda d: 1 / 0), ("files", lambda d: d.write.parquet(os.path.join(tmp, "copy")))],
    )
    assert [(n, ok) for n, ok, _ in outcome] == [("table", True), ("broken", False), ("files", True)]
    assert spark.table("admin_log_test").count() == 100
    spark.sql("DROP TABLE admin_log_test")


def test_dump_and_lookup(spark, tmp):
    e = ev(spark, [(0, "a", "STARTED_PROCESSING_REQUEST", ""), (1, "b", "STARTED_PROCESSING_REQUEST", ""), (2, "b", "DONE_PROCESSING_REQUEST", "")])
    full = P.request_state(e)
    P.dump_states(P.request_state(e.where("seq < 2")), os.path.join(tmp, "dump"), "2024-01-01")
    P.dump_states(full, os.path.join(tmp, "dump"), "2024-01-02")
    dumped = P.read_dumped(spark, os.path.join(tmp, "dump"), full.schema)
    assert dumped.count() == 2
    live = P.request_state(e.where("request_id = 'a'"))
    got = {r["request_id"]: (r["status"], r["source"]) for r in P.progress_lookup(live, dumped).collect()}
    assert got == {"a": ("STARTED_PROCESSING_REQUEST", "memory"), "b": ("DONE_PROCESSING_REQUEST", "dump")}


def test_bucketed_store_matches_plain(spark, tmp, persons, person_edges):
    from graphmill.model import NodeMapping, EdgeMapping
    from graphmill.sources.providers import Source

    nodes = NodeMapping("Person", "_uid", {"name": "name", "age": "age"})
    edges = EdgeMapping("EDGE_TYPE", "Person", "_fromUid", "Person", "_toUid")
    out = {}
    for b in (None, 4):
        store = GraphStore(spark, os.path.join(tmp, f"g{b}"), buckets=b)
        ingest(spark, [Source("p", persons, [nodes])], store, "r1", dt.datetime(2024, 1, 1))
        ingest(spark, [Source("e", person_edges, [edges])], store, "r2", dt.datetime(2024, 1, 2))
        upd = persons.where("_uid % 2 = 0").withColumn("name", F.upper("name"))
        res = ingest(spark, [Source("p", upd, [nodes]), Source("e", person_edges.union(person_edges.limit(3)), [edges])], store, "r3", dt.datetime(2024, 1, 3))
        out[b] = (
            sorted(tuple(r) for r in store.nodes("Person").collect()),
            sorted(tuple(r) for r in store.edges(("EDGE_TYPE", "Person", "Person")).collect()),
            [(x["element_type"], x.get("nodes_created"), x.get("nodes_matched"), x.get("relationships_created")) for x in res.loaded],
        )
        if b:
            folder = store._node_dir("Person")
            assert len(store.files(folder, store._version(folder, 2))) == b  # the merge output partitions are the buckets
    assert out[None] == out[4]
    assert out[4][2] == [("NODES", 0, 525, None), ("EDGES", None, None, 0)]


def test_sequence_check(spark, tmp):
    store = GraphStore(spark, os.path.join(tmp, "graph"))
    srcs = mock_sources(spark.range(10).withColumnRenamed("id", "i"))
    res = ingest(spark, srcs, store, "seq", dt.datetime(2024, 5, 6), translator=IdentityTranslator())
    expected = [r["event_type"] for r in res.events.orderBy("seq").collect()]
    ok = P.sequence_check(res.events, expected).collect()[0]
    assert ok["matches"] and ok["n_events"] == 13 and ok["first_mismatch"] is None
    bad = P.sequence_check(res.events, expected[:5] + ["ERROR"] + expected[6:]).collect()[0]
    assert not bad["matches"] and bad["first_mismatch"] == 6


def test_bucket_count_travels_with_the_files(spark, tmp, persons):
    root = os.path.join(tmp, "g")
    GraphStore(spark, root, buckets=4).write_nodes("Person", persons)
    other = GraphStore(spark, root, buckets=8)  # a reader configured differently
    df = other.nodes("Person")
    assert df.count() == 1050
    assert spark.catalog.getTable(other._table(other._node_dir("Person"), 1)).name
    plain = GraphStore(spark, os.path.join(tmp, "p"))
    plain.write_nodes("Person", persons)
    assert plain.nodes("Person").count() == 1050
    spec = spark.sql(f"DESCRIBE TABLE EXTENDED {other._table(other._node_dir('Person'), 1)}").where("col_name = 'Num Buckets'").collect()
    assert spec and spec[0]["data_type"] == "4"


def test_handle_requests(spark, tmp):
    from graphmill.plans.requests import handle_requests
    from graphmill.sources.providers import Source

    class Mock:
        def get_data_and_model_for(self, names):
            by_name = {s.name: s for s in mock_sources(spark.range(10).withColumnRenamed("id", "i"))}
            return [by_name[n] for n in names]

    wl = os.path.join(tmp, "white_list.txt")
    with open(wl, "w") as f:
        f.write("source-1\nsource-2\n")
    reqs = spark.createDataFrame(
        [("{}",), ('{"request_type": "white_list", "request_id": "123"}',), ('{"request_type": "white_list", "file_path": "' + wl + '", "request_id": "my_request_id"}',)],
        "request string",
    )
    store = GraphStore(spark, os.path.join(tmp, "graph"))
    res = handle_requests(spark, reqs, Mock(), store, dt.datetime(2024, 1, 2, 3, 4, 5), translator=IdentityTranslator())
    assert res.checked.where("valid").count() == 1
    assert [r.request_id for r in res.ingested] == ["my_request_id_2024_1_2_3_4_5"]
    assert store.nodes("MockPerson").count() == 20
    mine = res.events.where(F.col("request_id").contains("my_request_id")).orderBy("seq").collect()
    # the reference's integration test: 14 events in this order for two sources
    assert [e["event_type"] for e in mine] == [
        "RECEIVED_REQUEST",
        "STARTED_PROCESSING_REQUEST",
        "FETCHING_DATA_AND_MODELS",
        "FINISHED_FETCHING_DATA_AND_MODELS",
        "WRITING_GRAPH_ELEMENTS_INTO_REDIS",
        "WRITING_GRAPH_ELEMENTS_INTO_REDIS",
        "REDIS_IS_READY_FOR_CONSUMPTION",
        "WRITING_FROM_REDIS_TO_NEO",
        "PUSHED_GRAPH_ELEMENTS_INTO_NEO",
        "DELETING_REDIS_KEYS",
        "WRITING_FROM_REDIS_TO_NEO",
        "PUSHED_GRAPH_ELEMENTS_INTO_NEO",
        "DELETING_REDIS_KEYS",
        "DONE_PROCESSING_REQUEST",
    ]
    assert "request_content" in mine[0]["arguments"] and "my_request_id" in mine[1]["message"]
    assert res.events.where("event_type = 'RECEIVED_REQUEST'").count() == 3


def test_merge_typed_edges(spark, persons):
    from graphmill.model import Graph
    from graphmill.operators import merge as M

    e = spark.createDataFrame([(1, 2, "A"), (2, 4, "B"), (3, 6, None), (1, 2, "A")], "_fromUid long, _toUid long, _edgeType string")
    g = M.merge_typed_edges(Graph({"Person": persons}, {}), e, "Person", "Person")
    assert sorted(k[0] for k in g.edges) == ["A", "B"] and g.edges[("A", "Person", "Person")].count() == 1
    g2 = M.merge_typed_edges(g, e, "Person", "Person", edge_type="A")
    assert g2.edges[("A", "Person", "Person")].count() == 3


def test_two_mappings_one_label_keep_presence(spark, tmp, persons):
    from graphmill.model import NodeMapping
    from graphmill.sources.providers import Source

    names = NodeMapping("Person", "_uid", {"name": "name"})
    ages = NodeMapping("Person", "_uid", {"age": "age"})
    for staged in (None, os.path.join(tmp, "stage")):
        store = GraphStore(spark, os.path.join(tmp, f"g{bool(staged)}"))
        res = ingest(spark, [Source("p", persons, [names, ages])], store, "r", dt.datetime(2024, 1, 1), staging_path=staged)
        nodes = store.nodes("Person")
        assert nodes.count() == 1050 and nodes.where("name is null or age is null").count() == 0
        assert res.loaded[0]["nodes_created"] == 1050 and res.loaded[0]["nodes_matched"] == 1050


def test_failed_key_raises_with_error_event(spark, tmp, persons):
    import pytest

    from graphmill.model import NodeMapping
    from graphmill.plans.ingest import IngestError
    from graphmill.sources.providers import Source

    bad = NodeMapping("Person", F.col("_uid").cast("string"), {"x": F.raise_error(F.lit("source row rejected"))})
    store = GraphStore(spark, os.path.join(tmp, "g"))
    stage = os.path.join(tmp, "stage")
    with pytest.raises(IngestError) as err:
        ingest(spark, [Source("p", persons, [bad])], store, "bad", dt.datetime(2024, 1, 1), staging_path=stage)
    st = P.request_state(err.value.events).collect()[0]
    assert st["status"] == "ERROR" and st["n_errors"] == 1


def test_bucketed_version_reregistered_after_catalog_loss(spark, tmp, persons):
    store = GraphStore(spark, os.path.join(tmp, "g"), buckets=4)
    store.write_nodes("Person", persons)
    name = store._table(store._node_dir("Person"), 1)
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # external table: the files stay
    assert not spark.catalog.tableExists(name)
    again = GraphStore(spark, os.path.join(tmp, "g"))  # a reader that does not know the bucket count
    df = again.nodes("Person")
    assert df.count() == 1050
    assert spark.catalog.tableExists(name)
    spec = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Num Buckets'").collect()
    assert spec[0]["data_type"] == "4"


def test_request_report_from_ingest(spark, tmp, persons, person_edges):
    from graphmill.model import EdgeMapping, NodeMapping
    from graphmill.sources.providers import Source

    store = GraphStore(spark, os.path.join(tmp, "g"))
    nodes = NodeMapping("Person", "_uid", {"name": "name"})
    edges = EdgeMapping("EDGE_TYPE", "Person", "_fromUid", "Person", "_toUid")
    res = ingest(spark, [Source("p", persons, [nodes]), Source("e", person_edges, [edges])], store, "rep", dt.datetime(2024, 3, 1))
    rep = P.request_report(res.events).collect()[0]
    assert rep["status"] == "DONE_PROCESSING_REQUEST"
    assert rep["map_status_to_timestamp"]["DONE_PROCESSING_REQUEST"] == "2024-03-01 00:00:00"
    assert rep["counters"]["NODES_Person"]["nodes_created"] == 1050
    assert rep["counters"]["EDGES_EDGE_TYPE_Person_Person"]["relationships_created"] == 500
    P.dump_states(P.request_report(res.events), os.path.join(tmp, "dump"), "2024-03-01")
    back = spark.read.json(os.path.join(tmp, "dump")).collect()[0]
    assert back["counters"]["NODES_Person"]["nodes_created"] == 1050
