"""The library's operators applied to the driver tables, one named query per operator group.

Every query reads whole tables (customer, orders, lineitem, part, supplier, nation, region, events,
conversations) and returns a DataFrame; ``oracle.py`` holds the DuckDB SQL that must give the same rows.
Queries that exercise a sink (streams, JSON exports, staged sets, the graph store) write under a fresh
folder of the shared checkpoint root and read their result back.
"""

from __future__ import annotations

import datetime as _dt
import json
from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphmill.functions import keys as K
from graphmill.functions import rows as R
from graphmill.model import EDGES_INGEST, FROM_UID, NODES_INGEST, TO_UID, UID, EdgeMapping, Graph, NodeMapping
from graphmill.operators import delete as D
from graphmill.operators import merge as M
from graphmill.operators import progress as P
from graphmill.operators import skew as S
from graphmill.operators import staging as ST
from graphmill.operators import validate as V
from graphmill.operators import views as VW
from graphmill.plans.ingest import ingest, load_staged
from graphmill.plans.store import GraphStore
from graphmill.plans.translate import IdentityTranslator, MappingTranslator
from graphmill.session import scratch_path, table
from graphmill.sources import index as IX
from graphmill.sources import kv as KV
from graphmill.sources import providers as PR
from graphmill.sources import whitelist as WL
from graphmill.streaming import rows as SR
from graphmill.streaming import state as SG
from graphmill.streaming import stream as SS

# Store layout for the queries' scratch graphs (sized for the driver tables, not the session's defaults).
STORE_BUCKETS = 16
# The event stream: the events table split into this many files (one user per file), read this many
# files per micro-batch.
STREAM_FILES = 8
STREAM_FILES_PER_TRIGGER = 2

AS_OF_1 = "2024-01-01 00:00:00"
AS_OF_2 = "2024-02-01 00:00:00"

# Graph model of the driver tables.
CUSTOMER = NodeMapping("Customer", "c_custkey", {"name": "c_name", "nation": "c_nationkey", "acctbal": "c_acctbal", "segment": "c_mktsegment"})
ORDER = NodeMapping("Order", "o_orderkey", {"status": "o_orderstatus", "totalprice": "o_totalprice", "orderdate": "o_orderdate", "priority": "o_orderpriority"})
NATION = NodeMapping("Nation", "n_nationkey", {"name": "n_name", "region": "n_regionkey"})
SUPPLIER = NodeMapping("Supplier", "s_suppkey", {"name": "s_name", "nation": "s_nationkey", "acctbal": "s_acctbal"})
PART = NodeMapping("Part", "p_partkey", {"name": "p_name", "brand": "p_brand", "type": "p_type", "size": "p_size"})
PLACED = EdgeMapping("PLACED", "Customer", "o_custkey", "Order", "o_orderkey")
CUSTOMER_IN = EdgeMapping("IN_NATION", "Customer", "c_custkey", "Nation", "c_nationkey")
SUPPLIER_IN = EdgeMapping("IN_NATION", "Supplier", "s_suppkey", "Nation", "s_nationkey")
SUPPLIED_BY = EdgeMapping("SUPPLIED_BY", "Part", "l_partkey", "Supplier", "l_suppkey")

# Event table of the driver data read as request progress: user = request, event type = step.
STEP_OF_EVENT = {
    "signup": "STARTED_PROCESSING_REQUEST",
    "view": "FETCHING_DATA_AND_MODELS",
    "click": "PUSHED_GRAPH_ELEMENTS_INTO_NEO",
    "purchase": "DONE_PROCESSING_REQUEST",
    "error": "ERROR",
}


def progress_events(events: DataFrame) -> DataFrame:
    step = F.try_element_at(F.create_map(*[F.lit(x) for kv in STEP_OF_EVENT.items() for x in kv]), F.col("event_type"))
    return events.select(
        F.col("ts").alias("timestamp"),
        F.col("event_id").alias("seq"),
        F.concat(F.lit("req-"), F.col("user_id").cast("string")).alias("request_id"),
        step.alias("event_type"),
        F.col("props").alias("message"),
    )


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return table(spark, d, name)


def _nodes(spark, d, mapping: NodeMapping, tbl: str, where=None) -> DataFrame:
    df = _t(spark, d, tbl)
    if where is not None:
        df = df.where(where)
    return mapping.apply(df)


# ----------------------------------------------------------------------------- translation, J1


def q_translate_nodes(spark, d):
    tr = MappingTranslator().translate(_t(spark, d, "customer"), [CUSTOMER], "req_customers")
    (key, frames), = tr.items()
    return frames[0].select(F.lit(":".join(key)).alias("key"), F.lit(CUSTOMER.label).alias("element_properties"), "*")


def q_translate_edges(spark, d):
    tr = MappingTranslator().translate(_t(spark, d, "orders"), [PLACED], "req_orders")
    (key, frames), = tr.items()
    props = M.element_properties(*PLACED.key)
    return frames[0].select(F.lit(":".join(key)).alias("key"), F.lit(props).alias("element_properties"), "*")


def q_merge_nodes_create(spark, d):
    return M.merge_nodes(None, _nodes(spark, d, CUSTOMER, "customer"), AS_OF_1)


def q_merge_nodes_update(spark, d):
    c = _t(spark, d, "customer")
    existing = M.merge_nodes(None, CUSTOMER.apply(c.where("c_acctbal < 6000")), AS_OF_1)
    incoming = c.where("c_acctbal > 3000").select(
        F.col("c_custkey").alias(UID),
        F.when(F.col("c_nationkey") == 0, F.lit(None).cast("string")).otherwise(F.concat("c_name", F.lit("*"))).alias("name"),
        (F.col("c_acctbal") + 1).alias("acctbal"),
        F.lower("c_mktsegment").alias("tier"),
    )
    return M.merge_nodes(existing, incoming, AS_OF_2)


def q_partitioned_upsert(spark, d):
    """J1 through the partitioned store: the same two merges as ``merge_nodes_update``, each rewriting only
    the partitions its batch touches; the result must equal the in-memory merge."""

    c = _t(spark, d, "customer")
    store = GraphStore(spark, scratch_path(spark, "pgraph"), buckets=STORE_BUCKETS)
    store.merge_nodes("Customer", CUSTOMER.apply(c.where("c_acctbal < 6000")), AS_OF_1)
    incoming = c.where("c_acctbal > 3000").select(
        F.col("c_custkey").alias(UID),
        F.when(F.col("c_nationkey") == 0, F.lit(None).cast("string")).otherwise(F.concat("c_name", F.lit("*"))).alias("name"),
        (F.col("c_acctbal") + 1).alias("acctbal"),
        F.lower("c_mktsegment").alias("tier"),
    )
    store.merge_nodes("Customer", incoming, AS_OF_2)
    return store.nodes("Customer").select(UID, "name", "nation", "acctbal", "segment", "tier", "_created", "_last_updated")


def _event_nodes(spark, d) -> DataFrame:
    return _t(spark, d, "events").select(F.col("user_id").alias(UID), "event_id", "ts", "event_type", "value")


def q_merge_nodes_duplicate_uid(spark, d):
    return M.merge_nodes(None, _event_nodes(spark, d), AS_OF_2, order_by=["ts", "event_id"])


# ----------------------------------------------------------------------------- J2, J3, J4


def q_merge_edges(spark, d):
    cust = _nodes(spark, d, CUSTOMER, "customer", "c_mktsegment <> 'AUTOMOBILE'")
    orders = _t(spark, d, "orders")
    ords = ORDER.apply(orders)
    first = M.merge_edges(None, PLACED.apply(orders.where("o_orderpriority = '1-URGENT'")), cust, ords)
    final = M.merge_edges_flagged(first, PLACED.apply(orders), cust, ords)
    return final.select(FROM_UID, TO_UID, F.lit("PLACED").alias("_edgeType"), F.col(M.ACTION).alias("action"))


def q_merge_edges_dedup(spark, d):
    parts = _nodes(spark, d, PART, "part")
    sups = _nodes(spark, d, SUPPLIER, "supplier", "s_acctbal >= 0")
    e = M.merge_edges(None, SUPPLIED_BY.apply(_t(spark, d, "lineitem")), parts, sups)
    return e.select(FROM_UID, TO_UID, F.lit("SUPPLIED_BY").alias("_edgeType"))


def q_dangling_edges(spark, d):
    cust = _nodes(spark, d, CUSTOMER, "customer", "c_mktsegment <> 'AUTOMOBILE'")
    ords = _nodes(spark, d, ORDER, "orders", "o_orderstatus <> 'P'")
    return M.dangling_edges(PLACED.apply(_t(spark, d, "orders")), cust, ords)


def _customer_graph(spark, d) -> Graph:
    cust = _nodes(spark, d, CUSTOMER, "customer")
    ords = _nodes(spark, d, ORDER, "orders")
    nats = _nodes(spark, d, NATION, "nation")
    placed = M.merge_edges(None, PLACED.apply(_t(spark, d, "orders")), cust, ords)
    cin = M.merge_edges(None, CUSTOMER_IN.apply(_t(spark, d, "customer")), cust, nats)
    return Graph({"Customer": cust, "Order": ords, "Nation": nats}, {PLACED.key: placed, CUSTOMER_IN.key: cin})


def _delete(spark, d) -> D.DeleteResult:
    g = _customer_graph(spark, d)
    return D.detach_delete(g, "Customer", [("segment", "MACHINERY")], indexed={"*": ["_uid"], "Customer": ["segment"]})


def q_detach_delete_nodes(spark, d):
    return _delete(spark, d).graph.nodes["Customer"].select(UID, "name", "segment")


def q_detach_delete_edges(spark, d):
    g = _delete(spark, d).graph
    parts = [
        e.select(F.lit(k[0]).alias("_edgeType"), F.col(FROM_UID).cast("long").alias(FROM_UID), F.col(TO_UID).cast("long").alias(TO_UID))
        for k, e in sorted(g.edges.items())
    ]
    return parts[0].unionByName(parts[1])


def q_delete_summary(spark, d):
    return _delete(spark, d).summary


# ----------------------------------------------------------------------------- A2-A5


def _counter_batches(spark, d) -> DataFrame:
    c = _t(spark, d, "customer")
    nat = _nodes(spark, d, NATION, "nation")
    low = CUSTOMER.apply(c.where("c_acctbal < 5000"))
    high = CUSTOMER.apply(c.where("c_acctbal >= 2000"))
    f1 = M.merge_nodes_flagged(None, low, AS_OF_1)
    n1 = M.node_counters(f1, low, "Customer").withColumn("batch", F.lit(1))
    c1 = M.merge_nodes(None, low, AS_OF_1)
    f2 = M.merge_nodes_flagged(c1, high, AS_OF_2)
    n2 = M.node_counters(f2, high, "Customer").withColumn("batch", F.lit(2))
    fn = M.merge_nodes_flagged(None, nat, AS_OF_1)
    n3 = M.node_counters(fn, nat, "Nation").withColumn("batch", F.lit(3))
    c2 = M.merge_nodes(c1, high, AS_OF_2)
    e1 = M.merge_edges_flagged(None, CUSTOMER_IN.apply(c.where("c_acctbal < 5000")), c1, nat)
    n4 = M.edge_counters(e1, *CUSTOMER_IN.key).withColumn("batch", F.lit(4))
    e2 = M.merge_edges_flagged(e1.drop(M.ACTION), CUSTOMER_IN.apply(c), c2, nat)
    n5 = M.edge_counters(e2, *CUSTOMER_IN.key).withColumn("batch", F.lit(5))
    return n1.unionByName(n2).unionByName(n3).unionByName(n4).unionByName(n5)


def q_merge_counters(spark, d):
    return _counter_batches(spark, d).select("batch", "element_type", "element_properties", "counter", "value")


def q_counter_rollup(spark, d):
    return P.counter_rollup(_counter_batches(spark, d).withColumn("request_id", F.lit("req-counters")))


def _model_graph(spark, d) -> Graph:
    cust = _nodes(spark, d, CUSTOMER, "customer")
    sups = _nodes(spark, d, SUPPLIER, "supplier")
    nats = _nodes(spark, d, NATION, "nation", "n_regionkey <> 4")
    ords = _nodes(spark, d, ORDER, "orders")
    return Graph(
        {"Customer": cust, "Supplier": sups, "Nation": nats, "Order": ords},
        {
            PLACED.key: M.merge_edges(None, PLACED.apply(_t(spark, d, "orders")), cust, ords),
            CUSTOMER_IN.key: M.merge_edges(None, CUSTOMER_IN.apply(_t(spark, d, "customer")), cust, nats),
            SUPPLIER_IN.key: M.merge_edges(None, SUPPLIER_IN.apply(_t(spark, d, "supplier")), sups, nats),
        },
    )


def q_count_nodes_by_label(spark, d):
    return VW.count_nodes_by_label(_model_graph(spark, d))


def q_count_edges_by_type(spark, d):
    return VW.count_edges_by_type(_model_graph(spark, d))


# ----------------------------------------------------------------------------- staging


def _staged_events(events: DataFrame) -> DataFrame:
    return ST.stage_columns(events, "evjob", NODES_INGEST, F.col("event_type"), ["event_id", "user_id"])


def _decode_event(staged: DataFrame) -> DataFrame:
    return staged.select(
        *ST.KEY_COLS,
        F.get_json_object(ST.PAYLOAD, "$.user_id").cast("long").alias(UID),
        F.get_json_object(ST.PAYLOAD, "$.event_id").cast("long").alias("event_id"),
    )


def q_stage_set_add(spark, d):
    ev = _t(spark, d, "events")
    first = _staged_events(ev.where("value < 50"))
    both = ST.set_add(first, _staged_events(ev))
    return _decode_event(both)


SET_BUCKETS = 8


def q_indexed_set_add(spark, d):
    """K1 / U1 on storage with fingerprints: the events in two overlapping batches, then all again."""
    ev = _t(spark, d, "events")
    path = scratch_path(spark, "indexed-sets")
    batches = [ev.where("event_type <> 'click'"), ev.where("event_type <> 'view'"), ev]
    added = [ST.write_indexed_add(spark, _staged_events(b), path, SET_BUCKETS) for b in batches]
    per_key = ST.cardinality(ST.read_staging(spark, path))
    return per_key.select("arguments", "cardinality", *[F.lit(n).cast("long").alias(f"added_{i}") for i, n in enumerate(added)])


def _staged_parts(parts: DataFrame) -> DataFrame:
    return ST.stage_columns(parts, "pjob", NODES_INGEST, F.col("p_brand"), ["p_partkey", "p_name", "p_size"])


def q_publish_check(spark, d):
    p = _t(spark, d, "part")
    existing = _staged_parts(p.where("p_size <= 25"))
    items = _staged_parts(p).unionAll(_staged_parts(p.where("p_size = 1")))
    return ST.publish_check(existing, items)


def q_stage_cardinality(spark, d):
    ev = _t(spark, d, "events")
    staged = _staged_events(ev).unionAll(_staged_events(ev.where("value > 90")))
    return ST.cardinality(staged)


def _customer_keys(spark, d) -> DataFrame:
    c = _t(spark, d, "customer")
    op = F.when(F.col("c_mktsegment") == "BUILDING", EDGES_INGEST).when(F.col("c_mktsegment") == "AUTOMOBILE", "drop_ingest").otherwise(NODES_INGEST)
    args = F.when(F.col("c_mktsegment") == "BUILDING", "IN_NATION,Customer,Nation").otherwise("Customer")
    job = F.when(F.col("c_nationkey") == 1, F.lit("")).otherwise(F.col("c_name"))
    key = F.concat(K.build_key(job, op, args), F.when(F.col("c_nationkey") == 0, F.lit(":extra")).otherwise(F.lit("")))
    return c.select(key.alias("key"))


def q_parse_keys(spark, d):
    p = ST.parse_keys(_customer_keys(spark, d))
    return p.select(
        "key",
        "job_name",
        "operation",
        F.array_join("arguments", "|").alias("arguments"),
        F.size("arguments").cast("long").alias("n_arguments"),
        "error",
    ).withColumn("n_arguments", F.when(F.col("arguments").isNotNull(), F.col("n_arguments")))


def _valid_keys(spark, d) -> DataFrame:
    p = ST.parse_keys(_customer_keys(spark, d)).where(F.col("error").isNull())
    return p.select("job_name", "operation", F.array_join("arguments", ",").alias("arguments"))


def q_order_jobs(spark, d):
    return ST.order_jobs(_valid_keys(spark, d)).select("key", "job_order")


def q_keys_by_pattern(spark, d):
    hit = ST.keys_by_pattern(_valid_keys(spark, d), "Customer#0000001[0-4]?:*_ingest:*")
    return hit.select(ST.key_column())


def q_batch_numbers(spark, d):
    o = _t(spark, d, "orders").select("o_custkey", "o_orderkey")
    return ST.batch_numbers(o, ["o_custkey"], ["o_orderkey"], 3)


def q_key_sample(spark, d):
    s = ST.key_sample(_staged_events(_t(spark, d, "events")), 3)
    return s.withColumn("event_id", F.get_json_object(ST.PAYLOAD, "$.event_id").cast("long"))


def q_row_to_json_roundtrip(spark, d):
    p = _t(spark, d, "part").withColumn("p_type", F.when(F.col("p_size") > 45, F.lit(None)).otherwise(F.col("p_type")))
    js = R.row_to_json(p, "graph_node")
    back = js.select(R.json_to_row("graph_node", p.schema).alias("r"), "graph_node").select("r.*", "graph_node")
    joined = back.alias("b").join(p.alias("o"), F.col("b.p_partkey") == F.col("o.p_partkey"))
    same = F.lit(True)
    for c in p.columns:
        same = same & F.col(f"b.{c}").eqNullSafe(F.col(f"o.{c}"))
    return joined.select(
        *[F.col(f"b.{c}").alias(c) for c in p.columns],
        same.alias("roundtrip_ok"),
        F.col("b.graph_node").contains('"p_type":null').alias("has_null_field"),
    )


def q_multi_get(spark, d):
    store = _t(spark, d, "customer").where("c_acctbal > 0").select(
        F.format_string("Customer-%d", F.col("c_custkey")).alias("key"), F.col("c_name").alias("value")
    )
    req = _t(spark, d, "orders").select(F.col("o_orderkey").alias("pos"), F.format_string("Customer-%d", F.col("o_custkey")).alias("key"))
    return KV.multi_get(req, store)


def q_multi_get_hash(spark, d):
    parts = _t(spark, d, "part").where("p_size <= 40").select(
        F.format_string("Part-%d", F.col("p_partkey")).alias("key"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("type"),
    )
    store = R.to_entries(parts, ["name", "brand", "type"], "field", "value")
    req = _t(spark, d, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("pos"), F.format_string("Part-%d", F.col("l_partkey")).alias("key")
    )
    return KV.multi_get_hash(req, store)


LOOKUP_BUCKETS = 16


def q_get_stored(spark, d):
    """S7 from a stored index: the customers of partly shipped orders; only the folders that hold one are read."""
    path = scratch_path(spark, "kv")
    KV.write_store(_t(spark, d, "customer").select(F.format_string("Customer-%d", F.col("c_custkey")).alias("key"), F.col("c_name").alias("value")), path, LOOKUP_BUCKETS)
    req = _t(spark, d, "orders").where("o_orderstatus = 'P'")
    return KV.get_stored(req.select(F.col("o_orderkey").alias("pos"), F.format_string("Customer-%d", F.col("o_custkey")).alias("key")), path)


def q_get_stored_hash(spark, d):
    """S8 from a stored index: suppliers asked for by nation, more keys than the index has."""
    path = scratch_path(spark, "kv")
    supplier = _t(spark, d, "supplier").select(F.format_string("Nation-%d", F.col("s_nationkey")).alias("key"), F.col("s_name").alias("field"), F.col("s_acctbal").cast("string").alias("value"))
    KV.write_store(supplier.where("key <> 'Nation-7'"), path, LOOKUP_BUCKETS)
    req = _t(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("pos"), F.format_string("Nation-%d", F.col("n_nationkey")).alias("key"))
    return KV.get_stored(req, path).select("pos", "key", "field", F.col("value").cast("double").alias("value"))


def q_keyed_overwrite(spark, d):
    return KV.keyed_rows(_event_nodes(spark, d), ["ts", "event_id"])


def q_keyed_sink(spark, d):
    """K3 on storage: all events, overwritten by one row per user, read back."""
    path = scratch_path(spark, "keyed")
    _event_nodes(spark, d).write.parquet(path)
    KV.write_keyed(_event_nodes(spark, d), path, ["ts", "event_id"])
    return spark.read.parquet(path)


def _published_events(spark, d, path: str) -> DataFrame:
    """The events staged under jobs whose names look like numbers, a key per type (empty for views)."""
    ev = _t(spark, d, "events")
    args = F.when(F.col("event_type") == "view", F.lit("")).otherwise(F.col("event_type"))
    for i, job in enumerate(("01", "1", "20240201")):
        own = ev.where(F.pmod("user_id", F.lit(3)) == i)
        ST.publish(spark, ST.stage_columns(own, job, NODES_INGEST, args, ["event_id", "ts"]), path)
    return ST.read_staging(spark, path)


def q_staged_keys(spark, d):
    """K1, K2, K4 on storage: publish, publish again (nothing new), drop one key, read back with types."""
    path = scratch_path(spark, "staging")
    _published_events(spark, d, path)
    staged = _published_events(spark, d, path)
    ST.drop_keys(spark, path, [("1", NODES_INGEST, ""), ("01", NODES_INGEST, "click")])
    left = ST.read_staging(spark, path)
    shape = T.StructType.fromJson(json.loads(staged.select(ST.SCHEMA).first()[0]))  # one shape under every key
    return left.select("job_name", "arguments", R.json_to_row(ST.PAYLOAD, shape).alias("r")).select("job_name", "arguments", "r.event_id", "r.ts")


def q_fan_out(spark, d):
    """The orders to two folders and a writer that fails; outcomes, and the rows that arrived."""
    paths = [scratch_path(spark, f"fan-{i}") for i in range(2)]

    def failing(df: DataFrame) -> None:
        raise RuntimeError("unavailable")

    writers = [("a", lambda df: df.write.parquet(paths[0])), ("broken", failing), ("b", lambda df: df.write.parquet(paths[1]))]
    outcomes = P.fan_out(_t(spark, d, "orders"), writers)
    summary = P.outcome_summary(spark.createDataFrame([("orders", ok) for _, ok, _ in outcomes], "request_id string, ok boolean"))
    arrived = reduce(DataFrame.unionByName, [spark.read.parquet(p) for p in paths]).agg(F.count(F.lit(1)).alias("rows_written"))
    return summary.crossJoin(arrived).select("total", "succeeded", "failed", "all_ok", "verdict", "rows_written")  # one row each


def q_fan_out_outcomes(spark, d):
    """Results and exceptions of the writers, a row each."""

    def counted(df: DataFrame) -> int:
        path = scratch_path(spark, "fan-counted")
        df.write.parquet(path)
        return spark.read.parquet(path).count()

    def failing(df: DataFrame) -> None:
        raise LookupError("unavailable")

    outcomes = P.fan_out_outcomes(_t(spark, d, "orders"), [("counted", counted), ("broken", failing), ("silent", lambda df: None)])
    return P.outcomes_frame(spark, outcomes, "orders")


def q_translate_identity(spark, d):
    """Every row of a source is a node of one label."""
    (key, frames), = IdentityTranslator("Supplier").translate(_t(spark, d, "supplier"), None, "job").items()
    return frames[0].select(F.lit(":".join(key)).alias("key"), "s_suppkey", "s_name")


# ----------------------------------------------------------------------------- progress


def _pev(spark, d) -> DataFrame:
    return progress_events(_t(spark, d, "events"))


def q_request_state(spark, d):
    return P.request_state(_pev(spark, d))


def q_status_times(spark, d):
    return P.status_times(_pev(spark, d))


def q_request_errors(spark, d):
    return P.request_errors(_pev(spark, d))


def _progress_inputs(spark, d):
    ev = _t(spark, d, "events").select(F.concat(F.lit("req-"), F.col("user_id").cast("string")).alias("request_id"), F.col("event_type").alias("key"), "value")
    card = ev.groupBy("request_id", "key").agg(F.count(F.lit(1)).alias("cardinality"))
    processed = ev.where("value >= 30").select("request_id", "key", F.lit(1).cast("long").alias("how_many"))
    return ev, card, processed


def q_progress_percent(spark, d):
    _, card, processed = _progress_inputs(spark, d)
    return P.progress(card, processed)


def q_missing_keys(spark, d):
    ev, card, _ = _progress_inputs(spark, d)
    finished = ev.groupBy("request_id", "key").agg(F.min("value").alias("m")).where("m >= 10")
    return P.missing_keys(card, finished)


def q_outcome_summary(spark, d):
    ev = _t(spark, d, "events").select(
        F.concat(F.lit("req-"), F.col("user_id").cast("string")).alias("request_id"), (F.col("event_type") != "error").alias("ok")
    )
    return P.outcome_summary(ev)


def _undirected(spark, d):
    li = _t(spark, d, "lineitem")
    parts = _t(spark, d, "part").where("p_size <= 40").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias(UID))
    e1 = li.select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias(FROM_UID), F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias(TO_UID)
    )
    e2 = li.where("l_returnflag = 'R'").select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias(FROM_UID), F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias(TO_UID)
    )
    return VW.undirected_graph([parts], [("SUPPLIED_BY,Part,Supplier", e1), ("SUPPLIES,Supplier,Part", e2)])


def q_undirected_graph(spark, d):
    return _undirected(spark, d)[1]


def q_undirected_vertices(spark, d):
    return _undirected(spark, d)[0]


def q_undirected_attributes(spark, d):
    parts = _t(spark, d, "part").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias(UID), F.col("p_brand").alias("brand"), F.col("p_type").alias("type"))
    suppliers = _t(spark, d, "supplier").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias(UID), F.col("s_name").alias("name"))
    return VW.undirected_attributes([parts, suppliers, parts.where("brand < 'Brand#3'")])


def _requests(spark, d) -> DataFrame:
    ev = _t(spark, d, "events")
    k = F.get_json_object("props", "$.k")
    rid = F.concat(F.lit('"request_id":"e'), F.col("event_id").cast("string"), F.lit('"'))
    body = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("{"), rid, F.lit("}")))
        .when(F.col("event_type") == "view", F.concat(F.lit('{"request_type":"nothing",'), rid, F.lit("}")))
        .when(F.col("event_type") == "click", F.concat(F.lit('{"request_type":"white_list",'), rid, F.lit("}")))
        .when(F.col("event_type") == "purchase", F.concat(F.lit('{"request_type":"white_list",'), rid, F.lit(',"file_path":'), k, F.lit("}")))
        .otherwise(F.concat(F.lit('{"request_type":"white_list",'), rid, F.lit(',"file_path":"/lists/'), k, F.lit('.txt"}')))
    )
    return ev.select("event_id", body.alias("request"))


def q_validate_requests(spark, d):
    v = V.validate_requests(_requests(spark, d))
    return v.select("event_id", "valid", F.array_join("problems", "; ").alias("problems"))


def q_uid_duplicates(spark, d):
    return V.uid_duplicates(_event_nodes(spark, d))


def q_uid_nulls(spark, d):
    c = _t(spark, d, "conversations").select(
        F.when(F.col("role") == "system", F.lit(None).cast("long")).otherwise(F.col("conv_id") * 1000 + F.col("turn")).alias(UID), "text"
    )
    return V.uid_nulls(c, "Message")


def q_events_of_request(spark, d):
    return V.events_of_request(_pev(spark, d), "req-12").select("request_id", "seq", "event_type")


# ----------------------------------------------------------------------------- streams


STREAM_STATE_PARTITIONS = 8


def _stream_session(spark: SparkSession) -> SparkSession:
    """A session sharing the SparkContext, with the state partitions sized for the driver tables (a
    streaming query fixes its state partitions at its first start)."""
    s = spark.newSession()
    s.conf.set("spark.sql.shuffle.partitions", str(STREAM_STATE_PARTITIONS))
    s.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return s


def _stream_copy(spark, d, name: str) -> tuple[str, T.StructType]:
    """The events table split into files by user (one user per file), in a fresh scratch folder."""
    ev = _t(spark, d, "events")
    path = scratch_path(spark, name)
    ev.repartition(STREAM_FILES, "user_id").write.parquet(path)
    return path, ev.schema


def q_stream_read(spark, d):
    src, schema = _stream_copy(spark, d, "stream-src")
    out = scratch_path(spark, "stream-out")
    SS.run_to_end(SS.read_stream(_stream_session(spark), src, schema, max_files_per_trigger=STREAM_FILES_PER_TRIGGER), SS.copy_to_sink(out), scratch_path(spark, "stream-ckpt"))
    return spark.read.schema(schema).parquet(out).select("event_id", "ts", "user_id", "event_type", "value")


def q_stream_merge(spark, d):
    src, schema = _stream_copy(spark, d, "stream-src")
    store = GraphStore(spark, scratch_path(spark, "stream-graph"), buckets=STORE_BUCKETS)
    stream = SS.read_stream(_stream_session(spark), src, schema, max_files_per_trigger=STREAM_FILES_PER_TRIGGER).select(
        F.col("user_id").alias(UID), "event_id", "ts", "event_type", "value"
    )
    SS.merge_stream_into_store(stream, store, "User", AS_OF_2, scratch_path(spark, "stream-ckpt"), order_by=["ts", "event_id"])
    return store.nodes("User")


def q_live_state(spark, d):
    """The streaming request state in update mode, upserted per micro-batch into a graph store."""
    src, schema = _stream_copy(spark, d, "stream-src")
    store = GraphStore(spark, scratch_path(spark, "live-state"), buckets=STORE_BUCKETS)
    stream = progress_events(SS.read_stream(_stream_session(spark), src, schema, max_files_per_trigger=STREAM_FILES_PER_TRIGGER))
    SS.run_to_end(SS.live_state(stream), SS.upsert_sink(store, "RequestState", "request_id", AS_OF_2), scratch_path(spark, "stream-ckpt"), mode="update")
    return store.nodes("RequestState").select(
        F.col(UID).alias("request_id"), "status", "first_at", "end_at", "n_events", "n_errors"
    )


STREAM_BATCHES = 5
RUN_IDLE_DAYS = 3


def _row_stream(spark, session, d, name: str) -> tuple[DataFrame, str]:
    """(a stream of the events, its checkpoint folder): few files in the order of time, so that a user is spread over all of
    them, read in micro-batches of fewer rows than a file has."""
    ev = _t(spark, d, "events")
    src, ckpt = scratch_path(spark, name), scratch_path(spark, "stream-ckpt")
    ev.repartitionByRange(3, "ts", "event_id").sortWithinPartitions("ts", "event_id").write.parquet(src)
    rows = max(1, ev.count() // STREAM_BATCHES)
    return SR.read_rows(session, src, ev.schema, ckpt, rows), ckpt


def q_stream_rows(spark, d):
    """Every event once, in micro-batches that begin and end inside files, until the stream is idle."""
    stream, ckpt = _row_stream(spark, _stream_session(spark), d, "stream-src")
    out = scratch_path(spark, "stream-out")
    SR.run_until_idle(stream, SS.copy_to_sink(out), ckpt, 1.0)
    return spark.read.schema(stream.schema).parquet(out).select("event_id", "ts", "user_id", "event_type", "value")


def q_listeners(spark, d):
    """Two listeners of the event stream, each a query of its own; one fails on its first batch and catches up alone."""
    src, schema = _stream_copy(spark, d, "stream-src")
    outs = {name: scratch_path(spark, f"listener-{name}") for name in ("steady", "flaky")}
    failed = []

    def flaky(batch: DataFrame, batch_id: int) -> None:
        if not failed:
            failed.append(batch_id)
            raise RuntimeError("unavailable")
        SS.copy_to_sink(outs["flaky"])(batch, batch_id)

    stream = SS.read_stream(_stream_session(spark), src, schema, max_files_per_trigger=STREAM_FILES_PER_TRIGGER)
    got = SS.run_listeners(stream, [("steady", SS.copy_to_sink(outs["steady"])), ("flaky", flaky)], scratch_path(spark, "stream-ckpt"))
    rows = [spark.read.schema(schema).parquet(outs[n]).agg(F.count(F.lit(1)).alias("n_events"), F.count_distinct("event_id").alias("n_distinct")).select(
        F.lit(n).alias("listener"), F.lit(ok).alias("ok"), F.lit(tries).cast("long").alias("attempts"), "n_events", "n_distinct") for n, ok, tries, _ in got]
    return reduce(DataFrame.unionByName, rows)


def q_stream_merge_rows(spark, d):
    """The merge of users whose rows come in many micro-batches."""
    stream, ckpt = _row_stream(spark, _stream_session(spark), d, "stream-src")
    store = GraphStore(spark, scratch_path(spark, "stream-graph"), buckets=STORE_BUCKETS)
    stream = stream.select(F.col("user_id").alias(UID), "event_id", "ts", "event_type", "value")
    SR.run_until_idle(stream, SS.merge_sink(store, "User", AS_OF_2, ["ts", "event_id"]), ckpt, 1.0)
    return store.nodes("User")


def q_live_runs(spark, d):
    """Request state in runs, replaced by STARTED and dropped by a timer, upserted per micro-batch."""
    session = SG.rocksdb_session(_stream_session(spark))
    # a state partition starts a Python worker per micro-batch, so as many as tasks run at once
    session.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    stream, ckpt = _row_stream(spark, session, d, "stream-src")
    store = GraphStore(spark, scratch_path(spark, "live-runs"), buckets=STORE_BUCKETS)
    runs = SG.live_runs(progress_events(stream), "1 hour", RUN_IDLE_DAYS * 86_400)
    SR.run_until_idle(runs, SS.merge_sink(store, "RequestRun", AS_OF_2, key="request_id"), ckpt, 1.0, mode="update")
    return store.nodes("RequestRun").select(F.col(UID).alias("request_id"), "status", "start_at", "end_at", "n_events", "n_errors")


def q_closed_sessions(spark, d):
    src, schema = _stream_copy(spark, d, "stream-src")
    out = scratch_path(spark, "sessions")
    stream = progress_events(SS.read_stream(_stream_session(spark), src, schema))
    SS.run_to_end(SS.closed_sessions(stream, "1 hour", "1 hour"), SS.copy_to_sink(out), scratch_path(spark, "stream-ckpt"))
    got = spark.read.parquet(out)
    return got.select(
        "request_id",
        F.col("session_start").cast("timestamp_ntz").alias("session_start"),
        F.col("session_end").cast("timestamp_ntz").alias("session_end"),
        "n_events",
    )


def q_event_sequence(spark, d):
    ev = _t(spark, d, "events").select("user_id", "ts", "event_id", "event_type")
    n = S.number_within(ev, ["user_id"], ["ts", "event_id"], out="rn")
    prev = n.select("user_id", (F.col("rn") + 1).alias("rn"), F.col("event_type").alias("from_type"))
    pairs = n.join(prev, ["user_id", "rn"], "inner")
    return pairs.groupBy("from_type", F.col("event_type").alias("to_type")).agg(F.count(F.lit(1)).alias("n"))


# ----------------------------------------------------------------------------- whole requests


def _store_counts(store: GraphStore) -> DataFrame:
    g = store.graph()
    n = VW.count_nodes_by_label(g).select(F.lit("NODES").alias("element_type"), F.col("label").alias("name"), "n")
    e = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit("EDGES").alias("element_type"), F.lit(M.element_properties(*k)).alias("name"), "n")
        for k, df in sorted(g.edges.items())
    ]
    out = n
    for x in e:
        out = out.unionByName(x)
    return out


def q_ingest_two_sources(spark, d):
    store = GraphStore(spark, scratch_path(spark, "graph"), buckets=STORE_BUCKETS)
    sources = [
        PR.Source("customers", _t(spark, d, "customer"), [CUSTOMER, CUSTOMER_IN]),
        PR.Source("suppliers", _t(spark, d, "supplier"), [SUPPLIER, SUPPLIER_IN]),
        PR.Source("nations", _t(spark, d, "nation").where("n_regionkey <> 4"), [NATION]),
    ]
    ingest(spark, sources, store, "req", _dt.datetime(2024, 2, 1))
    return _store_counts(store)


def q_ingest_progress(spark, d):
    """A6, J5 over the events of an ingest: per key its size, what was processed, percent and whether the request is complete."""
    store = GraphStore(spark, scratch_path(spark, "graph"))
    sources = [PR.Source("customers", _t(spark, d, "customer"), [CUSTOMER, CUSTOMER_IN]), PR.Source("nations", _t(spark, d, "nation"), [NATION])]
    res = ingest(spark, sources, store, "req", _dt.datetime(2024, 2, 1))
    expected, done = P.of_ingest(res.events)
    whole = P.completeness(expected, done).select("request_id", "complete")
    out = P.progress(expected, done).join(whole, "request_id")
    return out.select(F.substring_index("key", ":", -2).alias("key"), "cardinality", "processed", "percent", "complete")


def q_load_staged(spark, d):
    store = GraphStore(spark, scratch_path(spark, "graph"))
    path = scratch_path(spark, "staging")
    c = _t(spark, d, "customer")
    o = _t(spark, d, "orders")
    tid = "load1"
    ST.write_set_add(spark, ST.stage(CUSTOMER.apply(c), tid, NODES_INGEST, "Customer"), path)
    vip = CUSTOMER.apply(c.where("c_acctbal > 9000")).withColumn("vip", F.lit(True))
    ST.write_set_add(spark, ST.stage(vip, tid, NODES_INGEST, "Customer"), path)
    ST.write_set_add(spark, ST.stage(ORDER.apply(o), tid, NODES_INGEST, "Order"), path)
    ST.write_set_add(spark, ST.stage(PLACED.apply(o), tid, EDGES_INGEST, PLACED.arguments), path)
    load_staged(spark, path, store, tid, "req-load", _dt.datetime(2024, 2, 1))
    vips = store.nodes("Customer").agg(F.count("vip").alias("n")).select(F.lit("NODES").alias("element_type"), F.lit("Customer.vip").alias("name"), "n")
    return _store_counts(store).unionByName(vips)


def q_admin_log_named(spark, d):
    ev = _t(spark, d, "events")
    entries = ev.select(
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("job-"), F.pmod("user_id", F.lit(25)).cast("string")).alias("job_id"),
        F.col("event_type").alias("category"),
        F.floor("value").cast("long").alias("int_value"),
        F.col("props").alias("string_value"),
    )
    registry = _t(spark, d, "nation").select(F.concat(F.lit("job-"), F.col("n_nationkey").cast("string")).alias("job_id"), F.col("n_name").alias("job_name"))
    return P.name_entries(entries, registry).select("timestamp", "job_name", "job_id", "category", "int_value", "string_value")


def q_fixture_nodes(spark, d):
    return PR.fixture_nodes(_t(spark, d, "customer").select(F.col("c_custkey").alias("i")))


def q_fixture_edges(spark, d):
    ids = _t(spark, d, "orders").select(F.col("o_orderkey").alias("i"))
    nodes = PR.fixture_nodes(ids)
    return M.merge_edges(None, PR.fixture_edges(ids), nodes, nodes).withColumn("_edgeType", F.lit("EDGE_TYPE"))


def q_two_sources(spark, d):
    srcs = PR.mock_sources(_t(spark, d, "customer").select(F.col("c_custkey").alias("i")))
    out = None
    for s in srcs:
        f = s.data.select(F.lit(s.name).alias("source"), UID, "name", "age", F.array_join("likes", ",").alias("likes"), "email")
        out = f if out is None else out.unionByName(f)
    return out


def q_index_scan(spark, d):
    docs = PR.index_documents(_t(spark, d, "customer").select(F.col("c_custkey").alias("i")))
    path = scratch_path(spark, "index")
    even = docs.where("pid % 2 = 0").withColumn("long_text", F.array(F.format_string("a%d", "pid"), F.format_string("b%d", "pid")))
    odd = docs.where("pid % 2 = 1").withColumn("long_text", F.format_string("t%d", "pid"))
    even.write.json(path + "/part=even")
    odd.write.json(path + "/part=odd")
    df = IX.read_index(spark, path, "json", array_fields=["long_text"])
    return df.select(
        F.col("pid").cast("long").alias("pid"),
        "name",
        F.col("age").cast("long").alias("age"),
        "org_name",
        "org_location",
        F.array_join("long_text", "|").alias("long_text"),
        F.size("long_text").cast("long").alias("n_long_text"),
    )


def q_select_sources(spark, d):
    """The white list (names of suppliers in ASIA, one per line, padded) selects among all suppliers."""
    sup, nation, region = _t(spark, d, "supplier"), _t(spark, d, "nation"), _t(spark, d, "region")
    path = scratch_path(spark, "white-list")
    asia = nation.join(region.where("r_name = 'ASIA'"), nation.n_regionkey == region.r_regionkey, "left_semi")
    wl = sup.join(asia, sup.s_nationkey == asia.n_nationkey, "left_semi")
    wl.select(F.concat(F.lit("  "), "s_name", F.lit(" ")).alias("value")).write.text(path)
    srcs = sup.withColumnRenamed("s_name", "source_name")
    return WL.select_sources(srcs, WL.read_white_list(spark, path)).select("s_suppkey", F.col("source_name").alias("s_name"))


def _staged_customers(spark, d) -> DataFrame:
    c = _t(spark, d, "customer")
    n = _t(spark, d, "nation")
    cn = c.join(n, c.c_nationkey == n.n_nationkey)
    return ST.stage_columns(
        cn.select(F.col("c_custkey").alias(UID), F.col("c_name").alias("name"), "n_name", "n_regionkey"),
        "custjob",
        NODES_INGEST,
        F.concat(F.lit("Customer_"), F.col("n_name")),
        [UID, "name"],
    )


def q_staged_scan(spark, d):
    staged = _staged_customers(spark, d)
    ST.keys_of_translation(staged, "custjob")
    members = ST.scan_key(staged, "custjob:nodes_ingest:Customer_NATION_7")
    return ST.decode(members, members.select(ST.SCHEMA).first()[0])


def q_delete_keys(spark, d):
    staged = _staged_customers(spark, d)
    n, r = _t(spark, d, "nation"), _t(spark, d, "region")
    gone = n.join(r.where("r_regionkey = 0"), n.n_regionkey == r.r_regionkey).select(
        F.lit("custjob").alias("job_name"), F.lit(NODES_INGEST).alias("operation"), F.concat(F.lit("Customer_"), F.col("n_name")).alias("arguments")
    )
    left = ST.delete_keys(staged, gone)
    return left.select(*ST.KEY_COLS, F.get_json_object(ST.PAYLOAD, "$._uid").cast("long").alias(UID))


def q_delete_prefix(spark, d):
    prefix = "custjob:nodes_ingest:Customer_NATION_1"
    _, summary = ST.delete_prefix(_staged_customers(spark, d), prefix)
    return summary.select(F.lit(prefix).alias("prefix"), "keys_deleted", "rows_remaining")


def q_purge(spark, d):
    """K6 on storage: rows and keys staged, keys purged, and rows left."""
    path = scratch_path(spark, "staging")
    ST.write_set_add(spark, _staged_customers(spark, d), path)
    before = ST.read_staging(spark, path).agg(F.count(F.lit(1)).alias("rows_staged"), F.count_distinct(*ST.KEY_COLS).alias("keys_staged")).first()
    purged = ST.purge_storage(spark, path)
    left = ST.read_staging(spark, path).agg(F.count(F.lit(1)).alias("rows_left"))
    return left.select(*[F.lit(x).cast("long").alias(n) for n, x in (("rows_staged", before[0]), ("keys_staged", before[1]), ("keys_purged", purged))], "rows_left")


def q_key_columns(spark, d):
    o = _t(spark, d, "orders")
    job = K.translation_id(F.lit("req"), F.col("o_orderdate"), F.lit("orders"))
    op = F.when(F.col("o_orderstatus") == "F", NODES_INGEST).otherwise(EDGES_INGEST)
    args = F.when(op == NODES_INGEST, F.array(F.lit("Order"))).otherwise(F.array(F.lit("PLACED"), F.lit("Customer"), F.lit("Order")))
    job_name = F.when(F.col("o_orderstatus") == "P", F.concat(job, F.lit(":p"))).otherwise(job)
    return o.select(
        "o_orderkey",
        job_name.alias("job_name"),
        K.build_key(job_name, op, F.array_join(args, ",")).alias("key"),
        K.job_name_ok(job_name).alias("job_ok"),
        K.element_kind(op).alias("kind"),
        K.element_label(op, args).alias("element_properties"),
        K.edge_type_or_default(None, F.col("o_orderpriority")).alias("edge_type"),
        K.edge_type_or_default("PLACED", F.col("o_orderpriority")).alias("edge_type_given"),
    )


def q_scalar_forms(spark, d):
    ev = _t(spark, d, "events")
    attrs = R.to_attribute_map(["event_id", "user_id", "event_type"])
    nested = F.array(F.array(F.array("event_type")), F.array(F.array("props")))
    return ev.select(
        "event_id",
        R.ts_text("ts").alias("ts_text"),
        R.unix_seconds("ts").alias("ts_unix"),
        R.to_json_without(ev.select("event_id", "user_id", "event_type", "props", "value", "ts"), ["props", "value", "ts"], "json"),
        F.array_join(F.transform(F.map_entries(attrs), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";").alias("attributes"),
        F.array_join(R.flatten_all(nested, T.ArrayType(T.ArrayType(T.ArrayType(T.StringType())))), "|").alias("flat"),
    )


def q_progress_lookup(spark, d):
    ev = _pev(spark, d)
    live = P.request_state(ev.where(F.col("timestamp") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")))
    full = P.request_state(ev)
    path = scratch_path(spark, "dump")
    P.dump_states(live, path, AS_OF_1)  # an earlier dump, superseded by the next one
    P.dump_states(full, path, AS_OF_2)
    dumped = P.read_dumped(spark, path, full.schema)
    return P.progress_lookup(live, dumped).select("request_id", "status", "n_events", "source")


def q_source_maps(spark, d):
    s, n = _t(spark, d, "supplier"), _t(spark, d, "nation")
    pairs = s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.concat(F.lit("req-"), F.col("n_regionkey").cast("string")).alias("request_id"),
        F.col("s_name").alias("source_name"),
        F.concat(F.lit("model-"), F.col("n_name")).alias("graph_model"),
    )
    return P.source_models(pairs)


def q_source_keys(spark, d):
    s = _t(spark, d, "supplier")
    written = s.select(F.col("s_name").alias("source_name"), F.explode(F.array(F.lit("job:nodes_ingest:Supplier"), F.lit("job:edges_ingest:IN_NATION,Supplier,Nation"))).alias("key"))
    return P.source_keys(written.unionByName(written))


def q_union_frames(spark, d):
    c = _t(spark, d, "customer").select(F.col("c_custkey").alias(UID), F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"))
    s = _t(spark, d, "supplier").select(F.col("s_suppkey").alias(UID), F.col("s_name").alias("name"), F.col("s_acctbal").alias("acctbal"), F.col("s_nationkey").alias("nation"))
    return ST.union_frames([c, s])


def q_sequence_check(spark, d):
    expected = [STEP_OF_EVENT[t] for t in ("signup", "view", "click")]
    return P.sequence_check(_pev(spark, d), expected)


def q_typed_edges(spark, d):
    li = _t(spark, d, "lineitem").select(
        F.col("l_partkey").alias(FROM_UID),
        F.col("l_suppkey").alias(TO_UID),
        F.when(F.col("l_returnflag") == "R", F.lit("RETURNED")).otherwise(F.lit("SUPPLIED_BY")).alias("_edgeType"),
    )
    g = Graph({"Part": _nodes(spark, d, PART, "part"), "Supplier": _nodes(spark, d, SUPPLIER, "supplier", "s_acctbal >= 0")}, {})
    g = M.merge_typed_edges(g, li, "Part", "Supplier")
    parts = [e.select(F.lit(k[0]).alias("_edgeType"), FROM_UID, TO_UID) for k, e in sorted(g.edges.items())]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def q_store_delete(spark, d):
    store = GraphStore(spark, scratch_path(spark, "graph"), buckets=STORE_BUCKETS)
    g = _customer_graph(spark, d)
    for label, df in g.nodes.items():
        store.write_nodes(label, df)
    for key, df in g.edges.items():
        store.write_edges(key, df)
    s = store.delete_nodes("Customer", [("segment", "MACHINERY")], indexed={"Customer": ["segment"]})
    counts = _store_counts(store)
    return counts.withColumn("deleted_nodes", F.lit(s["total"]).cast("long")).withColumn("deleted_edges", F.lit(s["edges_deleted"]).cast("long"))


GRAPH_SQL = """
SELECT c.segment AS segment, count(*) AS n_orders, round(sum(o.totalprice), 2) AS revenue
FROM edges_PLACED_Customer_Order e
JOIN nodes_Customer c ON e._fromUid = c._uid
JOIN nodes_Order o ON e._toUid = o._uid
GROUP BY c.segment
"""


def q_graph_sql(spark, d):
    cust = M.merge_nodes(None, _nodes(spark, d, CUSTOMER, "customer"), AS_OF_1)
    ords = M.merge_nodes(None, _nodes(spark, d, ORDER, "orders"), AS_OF_1)
    placed = M.merge_edges(None, PLACED.apply(_t(spark, d, "orders")), cust, ords)
    g = Graph({"Customer": cust, "Order": ords}, {PLACED.key: placed})
    return VW.graph_sql(spark, g, GRAPH_SQL)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
