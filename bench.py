"""Benchmark: the workloads the baseline names (node upsert, edge upsert, detach delete, whole request,
1,000,000-node delete) plus a few registered queries, at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each workload is run to completion with the ``noop`` sink (every row computed, nothing collected) or, for
the whole request, written to a fresh graph store.  Prints one JSON line.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from graphmill.operators import merge as M  # noqa: E402
from graphmill.plans import catalog as C  # noqa: E402
from graphmill.plans.ingest import ingest  # noqa: E402
from graphmill.plans.store import GraphStore  # noqa: E402
from graphmill.session import checkpoint_root, local_session, scratch_path, table  # noqa: E402
from graphmill.sources.providers import Source  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def node_upsert(spark, d):
    o = table(spark, d, "orders")
    existing = M.merge_nodes(None, C.ORDER.apply(o.where("o_orderstatus <> 'O'")), C.AS_OF_1)
    incoming = o.where("o_orderstatus <> 'F'").select(
        F.col("o_orderkey").alias("_uid"), F.concat("o_orderpriority", F.lit("!")).alias("priority"), F.col("o_totalprice").alias("totalprice")
    )
    run(M.merge_nodes(existing, incoming, C.AS_OF_2))


def edge_upsert(spark, d):
    li = table(spark, d, "lineitem")
    parts = C.PART.apply(table(spark, d, "part"))
    sups = C.SUPPLIER.apply(table(spark, d, "supplier").where("s_acctbal >= 0"))
    first = M.merge_edges(None, C.SUPPLIED_BY.apply(li.where("l_returnflag = 'R'")), parts, sups)
    run(M.merge_edges(first, C.SUPPLIED_BY.apply(li), parts, sups))


def _store(spark):
    return GraphStore(spark, scratch_path(spark, "bench-graph"), buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))


def detach_delete(spark, d):
    """Delete one market segment's customers with their PLACED and IN_NATION edges from a stored graph."""
    store = _store(spark)
    g = C._customer_graph(spark, d)
    for label, df in g.nodes.items():
        store.write_nodes(label, df)
    for key, df in g.edges.items():
        store.write_edges(key, df)
    t0 = time.time()
    s = store.delete_nodes("Customer", [("segment", "MACHINERY")], indexed={"Customer": ["segment"]})
    assert s["total"] > 0 and s["edges_deleted"] > s["total"]
    return time.time() - t0


def whole_request(spark, d):
    store = _store(spark)
    sources = [
        Source("nations", table(spark, d, "nation"), [C.NATION]),
        Source("customers", table(spark, d, "customer"), [C.CUSTOMER, C.CUSTOMER_IN]),
        Source("orders", table(spark, d, "orders"), [C.ORDER, C.PLACED]),
        Source("lineitems", table(spark, d, "lineitem"), [C.SUPPLIED_BY]),
        Source("parts", table(spark, d, "part"), [C.PART]),
        Source("suppliers", table(spark, d, "supplier"), [C.SUPPLIER, C.SUPPLIER_IN]),
    ]
    ingest(spark, sources, store, "bench", dt.datetime(2024, 2, 1))


def delete_1m(spark, d):
    nodes = spark.range(1_000_000).select(
        F.col("id").alias("_uid"), F.lit("Same Name").alias("name"), F.col("id").alias("age"), F.format_string("Person%d@gmail.com", "id").alias("email")
    )
    store = _store(spark)
    store.write_nodes("Person", nodes)
    t0 = time.time()
    s = store.delete_nodes("Person", [("name", "Same Name")], indexed={"Person": ["name"]})
    assert s["total"] == 1_000_000 and s["batches"] == 1000
    return time.time() - t0


def _small_batch(spark, d, store):
    o = table(spark, d, "orders")
    store.merge_nodes("Order", C.ORDER.apply(o), C.AS_OF_1)  # the stored graph (not timed)
    day = o.agg(F.min("o_orderdate")).first()[0]
    batch = o.where(F.col("o_orderdate") == F.lit(day)).select(F.col("o_orderkey").alias("_uid"), F.lit("revised").alias("status"))
    t0 = time.time()
    counts = store.merge_nodes("Order", batch, C.AS_OF_2)
    assert counts.get("updated", 0) > 0
    return time.time() - t0


def small_batch_versioned(spark, d):
    """One day's orders updated in a stored label: the versioned store rewrites the whole label."""
    return _small_batch(spark, d, _store(spark))


def skewed_edge_upsert(spark, d):
    """Edges of which a third end at one supernode, salted by a low hot-key threshold."""
    o = table(spark, d, "orders")
    nodes = o.select(F.col("o_orderkey").alias("_uid"))
    hub = o.agg(F.min("o_orderkey")).first()[0]
    edges = o.select(F.col("o_orderkey").alias("_fromUid"), F.when(F.col("o_orderkey") % 3 == 0, F.lit(hub)).otherwise(F.col("o_orderkey")).alias("_toUid"))
    store = _store(spark)
    t0 = time.time()
    store.merge_edges(("TO", "Order", "Order"), edges, nodes, nodes, 5000)
    return time.time() - t0


def stream_merge(spark, d):
    """The events table as a stream of four micro-batches, upserted by user."""
    t0 = time.time()
    C.QUERIES["stream_merge"](spark, d).write.mode("overwrite").format("noop").save()
    return time.time() - t0


WORKLOADS = {
    "node_upsert": node_upsert,
    "edge_upsert": edge_upsert,
    "detach_delete": detach_delete,
    "whole_request": whole_request,
    "delete_1m_nodes": delete_1m,
    "small_batch_versioned": small_batch_versioned,
    "skewed_edge_upsert": skewed_edge_upsert,
    "stream_merge": stream_merge,
}
QUERIES = [
    "graph_sql",
    "request_state",
    "merge_edges_dedup",
    "undirected_graph",
    "merge_nodes_duplicate_uid",
    "dangling_edges",
    "batch_numbers",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(cpus) * 2, app="graphmill-bench")
    checkpoint_root(spark)  # the session's spark.checkpoint.dir; a temp folder only in local mode
    run(table(spark, sf_dir, "orders").groupBy("o_custkey").count())  # warm-up, not timed
    times = {}
    for name, fn in WORKLOADS.items():
        t0 = time.time()
        inner = fn(spark, sf_dir)
        times[name] = round(inner if isinstance(inner, float) else time.time() - t0, 3)
    for name in QUERIES:
        t0 = time.time()
        run(C.QUERIES[name](spark, sf_dir))
        times[f"q_{name}"] = round(time.time() - t0, 3)
    sf_text = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        sf: float | str = float(sf_text)
    except ValueError:
        sf = sf_text
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
