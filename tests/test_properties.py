"""Property tests: the Spark operators against small pure-Python models of the same semantics."""

import datetime as dt

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from graphmill.operators import merge as M
from graphmill.operators import skew as S

T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
# Every example runs Spark jobs, so no shrinking: a failure reports its example and seed as generated.
SETTINGS = settings(
    max_examples=12,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
    phases=(Phase.explicit, Phase.reuse, Phase.generate),
)

uids = st.integers(min_value=0, max_value=8)
names = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))


def model_merge(existing: dict, incoming: list[tuple]) -> dict:
    """Apply incoming (uid, seq, name) rows one after another in seq order, like the graph store does."""
    out = {u: dict(v) for u, v in existing.items()}
    for uid, _seq, name in sorted(incoming, key=lambda r: (r[0], r[1])):
        if uid in out:
            out[uid]["name"] = name
            out[uid]["_last_updated"] = T2
        else:
            out[uid] = {"name": name, "age": None, "_created": T2, "_last_updated": None}
    return out


@SETTINGS
@given(
    existing=st.dictionaries(uids, st.tuples(names, st.integers(0, 99)), max_size=6),
    incoming=st.lists(st.tuples(uids, st.integers(0, 1000), names), max_size=10, unique_by=lambda r: (r[0], r[1])),
)
def test_node_upsert_matches_sequential_model(spark, existing, incoming):
    ex_rows = [(u, n, a) for u, (n, a) in existing.items()]
    ex = M.merge_nodes(None, spark.createDataFrame(ex_rows, "_uid long, name string, age long"), T1) if ex_rows else None
    inc = spark.createDataFrame(incoming, "_uid long, seq long, name string")
    got = {}
    if ex is None and not incoming:
        return
    out = M.merge_nodes(ex, inc, T2, order_by=["seq"]) if incoming else ex
    for r in out.collect():
        got[r["_uid"]] = {"name": r["name"], "age": r["age"] if "age" in r else None, "_created": r["_created"], "_last_updated": r["_last_updated"]}
    base = {u: {"name": n, "age": a, "_created": T1, "_last_updated": None} for u, (n, a) in existing.items()}
    want = model_merge(base, incoming)
    # a repeated uid in one batch on a new node: created by the first row, matched by the later ones
    for uid in {r[0] for r in incoming} - set(existing):
        if sum(1 for r in incoming if r[0] == uid) > 1:
            want[uid]["_last_updated"] = T2
    assert got == want


@SETTINGS
@given(
    nodes=st.sets(uids, max_size=8),
    edges=st.lists(st.tuples(st.one_of(st.none(), uids), st.one_of(st.none(), uids)), max_size=25),
    hot=st.sampled_from([None, 2]),
)
def test_edge_upsert_matches_set_model(spark, nodes, edges, hot):
    n = spark.createDataFrame([(u,) for u in nodes], "_uid long")
    e = spark.createDataFrame(edges, "_fromUid long, _toUid long")
    got = {tuple(r) for r in M.merge_edges(None, e, n, n, hot_min_rows=hot).collect()}
    assert got == {(a, b) for a, b in edges if a in nodes and b in nodes}
    dangling = {tuple(r) for r in M.dangling_edges(e, n, n, hot_min_rows=hot).collect()}
    want = {(a, b, a not in nodes, b not in nodes) for a, b in edges if a not in nodes or b not in nodes}
    assert dangling == want


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from([0, 0, 0, 1, 2]), st.integers(0, 10_000)), min_size=1, max_size=40, unique_by=lambda r: r[1]))
def test_numbering_matches_sorted_model(spark, rows):
    df = spark.createDataFrame(rows, "k long, v long")
    got = {(r["k"], r["v"]): r["rn"] for r in S.number_within(df, ["k"], ["v"], partitions=4).collect()}
    want = {}
    for k in {r[0] for r in rows}:
        for i, v in enumerate(sorted(v for kk, v in rows if kk == k), 1):
            want[(k, v)] = i
    assert got == want


batch_rows = st.lists(st.tuples(uids, st.integers(0, 1000), names), min_size=1, max_size=8, unique_by=lambda r: (r[0], r[1]))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture], phases=(Phase.explicit, Phase.reuse, Phase.generate))
@given(batches=st.lists(st.tuples(batch_rows, st.booleans()), min_size=1, max_size=3))
def test_stored_merges_equal_in_memory_merges(spark, tmp_path_factory, batches):
    from pyspark.sql import functions as F

    from graphmill.plans.store import GraphStore

    store = GraphStore(spark, str(tmp_path_factory.mktemp("gs")))
    mem = None
    for i, (rows, extra) in enumerate(batches):
        df = spark.createDataFrame(rows, "_uid long, seq long, name string")
        if extra:  # some batches carry a column the others lack: absent there, so kept
            df = df.withColumn("flag", F.col("seq") % 2 == 0)
        at = dt.datetime(2024, 1, 1 + i)
        store.merge_nodes("N", df, at, order_by=["seq"])
        mem = M.merge_nodes(mem, df, at, order_by=["seq"])
    cols = sorted(mem.columns)
    got = sorted((tuple(r) for r in store.nodes("N").select(*cols).collect()), key=repr)
    assert got == sorted((tuple(r) for r in mem.select(*cols).collect()), key=repr)


@SETTINGS
@given(
    rows=st.lists(st.tuples(st.sampled_from([0, 0, 0, 0, 1, 2, 3, None]), st.integers(0, 50)), max_size=60),
    small_keys=st.sets(st.integers(0, 4), max_size=5),
    threshold=st.integers(1, 6),
    how=st.sampled_from(["inner", "left", "left_semi", "left_anti"]),
)
def test_salted_join_equals_plain(spark, rows, small_keys, threshold, how):
    big = spark.createDataFrame(rows, "k long, v long")
    small = spark.createDataFrame([(k, k * 10) for k in small_keys], "sk long, payload long")
    salted = S.split_join(big, small, "k", "sk", how, min_rows=threshold)
    plain = S.split_join(big, small, "k", "sk", how, min_rows=None)
    assert sorted(map(tuple, salted.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
