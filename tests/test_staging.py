"""Staged sets, keys, ordering, batching and keyed lookups."""

import itertools
import os

import pytest
from pyspark.sql import functions as F

from graphmill.functions import keys as K
from graphmill.operators import staging as ST
from graphmill.sources import kv as KV


def keys_df(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "key string")


CORRECT_ORDER = [
    "test_table:nodes_ingest:Person1",
    "test_table:nodes_ingest:Person2",
    "test_table:nodes_ingest:Person3",
    "test_table:nodes_ingest:Person4",
    "test_table:edges_ingest:Person1",
    "test_table:edges_ingest:Person2",
    "test_table:edges_ingest:Person3",
]


def test_order_jobs_from_any_permutation(spark):
    # The reference sorts all 5,040 permutations; each permutation is a Spark job here, so a spread sample.
    perms = list(itertools.permutations(CORRECT_ORDER))
    for perm in perms[:: len(perms) // 6]:
        parsed = ST.parse_keys(keys_df(spark, perm)).select("job_name", "operation", F.array_join("arguments", ",").alias("arguments"))
        out = ST.order_jobs(parsed).orderBy("job_order").collect()
        assert [r["key"] for r in out] == CORRECT_ORDER
        assert [r["job_order"] for r in out] == list(range(1, 8))


def test_parse_key(spark):
    ks = [
        "Awesome:nodes_ingest:Person",
        "Awesome:edges_ingest:EDGE_TYPE,Person,Person",
        "AwesomeJob:edges_ingest:EDGE_TYPE,LabelOfFromNode,LabelOfToNode",
        "two:parts",
        "four:nodes_ingest:Person:extra",
        ":nodes_ingest:Person",
        "job:merge_ingest:Person",
        "my_nodes_job:edges_ingest:T,A,B",
    ]
    out = {r["key"]: r for r in ST.parse_keys(keys_df(spark, ks)).withColumn("kind", K.element_kind("operation")).collect()}
    assert out["Awesome:nodes_ingest:Person"]["arguments"] == ["Person"] and out["Awesome:nodes_ingest:Person"]["error"] is None
    assert out["Awesome:edges_ingest:EDGE_TYPE,Person,Person"]["arguments"] == ["EDGE_TYPE", "Person", "Person"]
    assert out["two:parts"]["error"] == "Expected 3 parts in two:parts but got 2"
    assert "but got 4" in out["four:nodes_ingest:Person:extra"]["error"]
    assert out[":nodes_ingest:Person"]["error"].startswith("Job name must not be empty")
    assert out["job:merge_ingest:Person"]["error"] == "Operation merge_ingest is not supported."
    assert out["my_nodes_job:edges_ingest:T,A,B"]["kind"] == "Edges"  # parsed operation, not a substring test


def test_set_add_publish_and_cardinality(spark, persons, person_edges):
    nodes = ST.stage(persons, "Awesome", "nodes_ingest", "Person")
    edges = ST.stage(person_edges, "Awesome", "edges_ingest", "EDGE_TYPE,Person,Person")
    staged = ST.set_add(ST.set_add(None, nodes), edges.unionByName(nodes))
    card = {r["arguments"]: r["cardinality"] for r in ST.cardinality(staged).collect()}
    assert card == {"Person": 1050, "EDGE_TYPE,Person,Person": 500}
    ok = ST.publish_check(ST.stage(persons.where("_uid < 100"), "Awesome", "nodes_ingest", "Person"), nodes).collect()[0]
    assert (ok["n_items"], ok["n_new"], ok["ok"]) == (1050, 950, False)
    again = ST.publish_check(nodes, nodes).collect()[0]
    assert again["ok"] and again["n_new"] == 0
    fresh = ST.publish_check(None, nodes).collect()[0]
    assert fresh["ok"] and fresh["n_new"] == 1050


def test_stored_sets(spark, tmp, persons):
    path = os.path.join(tmp, "staging")
    nodes = ST.stage(persons, "Awesome", "nodes_ingest", "Person")
    ST.write_set_add(spark, nodes.where("payload like '%Person1%'"), path)
    ST.write_set_add(spark, nodes, path)
    ST.write_set_add(spark, nodes, path)  # set semantics: nothing new
    ST.write_set_add(spark, ST.stage(persons.limit(5), "Other", "nodes_ingest", "Person"), path)
    staged = ST.read_staging(spark, path)
    assert staged.where("job_name = 'Awesome'").count() == 1050
    members = ST.scan_key(staged, "Awesome:nodes_ingest:*")
    decoded = ST.decode(members, members.select(ST.SCHEMA).first()[0])
    assert decoded.columns == ["_uid", "name", "age", "email"] and decoded.count() == 1050
    with pytest.raises(ST.MissingKeyError):
        ST.scan_key(staged, "*:nodes_ingest:Person")  # two keys match
    with pytest.raises(ST.MissingKeyError):
        ST.keys_of_translation(staged, "Nothing")
    assert ST.drop_keys(spark, path, [("Awesome", "nodes_ingest", "Person"), ("Missing", "nodes_ingest", "X")]) == 1
    assert ST.read_staging(spark, path).count() == 5


def test_delete_keys_prefix_purge(spark, persons):
    staged = ST.stage(persons, "test_table", "nodes_ingest", "Person1").unionByName(
        ST.stage(persons.limit(3), "test_table", "edges_ingest", "Person1")
    ).unionByName(ST.stage(persons.limit(2), "keep", "nodes_ingest", "Person1"))
    gone = spark.createDataFrame([("test_table", "nodes_ingest", "Person1")], "job_name string, operation string, arguments string")
    assert ST.delete_keys(staged, gone).count() == 5
    left, summary = ST.delete_prefix(staged, "test_table:")
    s = summary.collect()[0]
    assert s["keys_deleted"] == 2 and s["rows_remaining"] == 2 and left.count() == 2
    assert ST.purge(staged).count() == 0 and ST.purge(staged).columns == staged.columns


def test_keys_by_pattern(spark):
    k = ST.parse_keys(keys_df(spark, CORRECT_ORDER)).select("job_name", "operation", F.array_join("arguments", ",").alias("arguments"))
    got = lambda p: sorted(r[0] for r in ST.keys_by_pattern(k, p).select(ST.key_column()).collect())
    assert got("test_table:nodes_ingest:*") == CORRECT_ORDER[:4]
    assert got("*:edges_ingest:Person[12]") == CORRECT_ORDER[4:6]
    assert got("test_table:?odes_ingest:Person?") == CORRECT_ORDER[:4]
    assert K.glob_to_regex("a.b*") == "^a\\.b.*$"


def test_batch_numbers_and_sample(spark):
    df = spark.range(0, 1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    b = ST.batch_numbers(df, ["k"], ["v"], 100)
    sizes = {(r["k"], r["batch_no"]): r["n"] for r in b.groupBy("k", "batch_no").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sizes[(0, 0)] == 100 and sizes[(0, 3)] == 34 and max(bn for _, bn in sizes) == 3
    staged = ST.stage_columns(df, "job", "nodes_ingest", F.col("k"), ["v"])
    s = ST.key_sample(staged, 2).collect()
    assert len(s) == 6 and all(r["size"] in (333, 334) for r in s) and {r["type"] for r in s} == {"Nodes"}


def test_multi_get(spark):
    store = spark.range(1000).select(F.format_string("Person-%d", "id").alias("key"), F.format_string("This is person-%d", "id").alias("value"))
    req = spark.range(1010).select(F.col("id").alias("pos"), F.format_string("Person-%d", "id").alias("key"))
    out = {r["pos"]: r["value"] for r in KV.multi_get(req, store).collect()}
    assert len(out) == 1010 and out[7] == "This is person-7" and out[1005] is None


def test_multi_get_hash(spark):
    store = spark.createDataFrame([("h1", "a", "1"), ("h1", "b", "2"), ("h2", "a", "3")], "key string, field string, value string")
    req = spark.createDataFrame([(0, "h1"), (1, "h3")], "pos long, key string")
    out = sorted(tuple(r) for r in KV.multi_get_hash(req, store).collect())
    assert out == [(0, "h1", "a", "1"), (0, "h1", "b", "2"), (1, "h3", None, None)]
    maps = {r["key"]: r["fields"] for r in KV.hash_maps(store).collect()}
    assert maps["h1"] == {"a": "1", "b": "2"}


def test_keyed_overwrite(spark, tmp):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "_uid long, seq long, v string")
    KV.write_keyed(df, os.path.join(tmp, "kv"), ["seq"])
    KV.write_keyed(df.where("_uid = 2"), os.path.join(tmp, "kv"), ["seq"])
    assert sorted(tuple(r) for r in spark.read.parquet(os.path.join(tmp, "kv")).collect()) == [(2, 1, "c")]
    assert sorted(tuple(r) for r in KV.keyed_rows(df, ["seq"]).collect()) == [(1, 2, "b"), (2, 1, "c")]


def test_purge_storage_and_graph(spark, tmp, persons, person_edges):
    from graphmill.operators import merge as M
    from graphmill.plans.store import GraphStore

    path = os.path.join(tmp, "staging")
    ST.write_set_add(spark, ST.stage(persons, "A", "nodes_ingest", "Person"), path)
    ST.write_set_add(spark, ST.stage(person_edges, "A", "edges_ingest", "E,Person,Person"), path)
    assert ST.purge_storage(spark, path) == 2 and ST.read_staging(spark, path).count() == 0
    store = GraphStore(spark, os.path.join(tmp, "g"), buckets=2)
    store.write_nodes("Person", persons)
    store.write_edges(("E", "Person", "Person"), M.merge_edges(None, person_edges, persons, persons))
    assert store.purge() == 2
    assert store.nodes("Person").count() == 0 and store.edges(("E", "Person", "Person")).count() == 0
    assert store.labels() == ["Person"]


def test_table_provider(spark):
    from graphmill.sources.providers import TableProvider

    p = TableProvider(spark, "/root/testdata/sf0.001", {"customer": ["customer model"]})
    got = p.get_data_and_model_for(["customer", "nation"])
    assert [s.name for s in got] == ["customer", "nation"] and got[0].graph_model == ["customer model"] and got[1].graph_model is None
    assert got[1].data.count() == 25


def test_publish_strict_and_parse_strict(spark, tmp, persons):
    path = os.path.join(tmp, "staging")
    nodes = ST.stage(persons, "A", "nodes_ingest", "Person")
    ST.publish(spark, nodes.where("payload like '%\"_uid\":1,%'"), path)
    with pytest.raises(ST.PublishError):
        ST.publish(spark, nodes, path)  # one old member among new ones: refused, nothing written
    assert ST.read_staging(spark, path).count() == 1
    ST.publish(spark, nodes.where("payload like '%\"_uid\":1,%'"), path)  # nothing new: accepted, no-op
    assert ST.read_staging(spark, path).count() == 1
    ok = ST.parse_keys(keys_df(spark, ["a:nodes_ingest:P"]), strict=True).collect()
    assert ok[0]["error"] is None
    with pytest.raises(Exception, match="Expected 3 parts"):
        ST.parse_keys(keys_df(spark, ["a:nodes_ingest:P", "bad"]), strict=True).collect()


def test_require_uids_and_strict_registry(spark):
    from graphmill.operators import progress as P
    from graphmill.operators import validate as V

    df = spark.createDataFrame([(1,), (None,)], "_uid long")
    with pytest.raises(V.MissingUidError):
        V.require_uids(df)
    good, bad = V.require_uids(df, "quarantine")
    assert good.count() == 1 and bad.count() == 1
    reg = spark.createDataFrame([("j1", "Job one")], "job_id string, job_name string")
    entries = spark.createDataFrame([("j1", 1), ("j2", 2)], "job_id string, int_value long")
    assert P.name_entries(entries, reg).where("job_name is null").count() == 1
    with pytest.raises(P.UnknownJobError):
        P.name_entries(entries, reg, strict=True)


def test_adds_with_stored_fingerprints(spark, tmp):
    """As plain adds, key by key; only the batch is shuffled; dropped keys, odd key parts and lost catalog tables included."""
    from graphmill.operators import staging as ST

    plain, own = os.path.join(tmp, "plain"), os.path.join(tmp, "own")

    def batch(lo, hi, job="j", arg="L"):
        return ST.stage(spark.range(lo, hi).select(F.col("id").alias("_uid"), (F.col("id") % 3).alias("v")), job, "nodes_ingest", arg)

    def state(path):
        return sorted(tuple(r) for r in ST.read_staging(spark, path).collect())

    added = []
    for b in (batch(0, 100), batch(50, 150).unionByName(batch(50, 150)), batch(0, 150), batch(0, 40, arg=""), batch(0, 40, arg="\\e"), batch(0, 10, job="k")):
        ST.write_set_add(spark, b, plain)
        added.append(ST.write_indexed_add(spark, b, own, 8))
        assert state(own) == state(plain)
    assert added == [100, 50, 0, 40, 40, 10]
    for path in (plain, own):
        assert ST.drop_keys(spark, path, [("j", "nodes_ingest", "L"), ("k", "nodes_ingest", "L")]) == 2
    assert ST.write_indexed_add(spark, batch(0, 60), own, 8) == 60
    ST.write_set_add(spark, batch(0, 60), plain)
    assert state(own) == state(plain)
    name = ST._set_table(spark, own, 8)
    spark.sql(f"DROP TABLE {name}")  # another session's catalog
    assert ST.write_indexed_add(spark, batch(30, 70), own, 8) == 10
    plan = ST.fresh_members(batch(0, 99), spark.table(ST._set_table(spark, own, 8)).hint("merge"))._jdf.queryExecution().executedPlan().toString()
    stored = plan[plan.index("\n   +- ") :]  # the join's right side
    assert "Exchange" not in stored and "Bucketed: true" in stored and "Exchange hashpartitioning" in plan, plan
    assert "payload" not in stored.split("ReadSchema: ")[-1]


def test_a_failed_indexed_add_leaves_the_sets(spark, tmp):
    from graphmill.operators import staging as ST

    path = os.path.join(tmp, "own")
    good = ST.stage(spark.range(20).select(F.col("id").alias("_uid")), "j", "nodes_ingest", "L")
    assert ST.write_indexed_add(spark, good, path, 4) == 20
    bad = good.unionByName(ST.stage(spark.range(1).select(F.raise_error(F.lit("torn")).cast("long").alias("_uid")), "j", "nodes_ingest", "L"))
    with pytest.raises(Exception, match="torn"):
        ST.write_indexed_add(spark, bad, path, 4)
    assert ST.read_staging(spark, path).count() == 20 and ST.write_indexed_add(spark, good, path, 4) == 0
