"""The physical plans keep their scale properties (see PLANS.md)."""

import os
import re

from pyspark.sql import functions as F

from graphmill.model import NodeMapping
from graphmill.operators import merge as M
from graphmill.plans import catalog as C
from graphmill.plans.store import GraphStore
from conftest import SF


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_merge_shuffles_only_incoming(spark, tmp):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        o = spark.read.parquet(os.path.join(SF, "orders.parquet"))
        store = GraphStore(spark, os.path.join(tmp, "g"), buckets=4)
        store.write_nodes("Order", C.ORDER.apply(o))
        inc = o.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("_uid"), F.col("o_orderpriority").alias("priority"))
        p = plan(M.merge_nodes_flagged(store.nodes("Order"), inc, "2024-01-01"))
        assert "Bucketed: true" in p
        assert p.count("Exchange hashpartitioning") == 1  # the incoming batch only, into the 4 buckets
        assert re.search(r"Exchange hashpartitioning\(_uid#\d+L, 4\)", p)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_edge_checks_read_only_node_keys(spark):
    li = spark.read.parquet(os.path.join(SF, "lineitem.parquet"))
    parts = C.PART.apply(spark.read.parquet(os.path.join(SF, "part.parquet")))
    sups = C.SUPPLIER.apply(spark.read.parquet(os.path.join(SF, "supplier.parquet")))
    p = plan(M.merge_edges(None, C.SUPPLIED_BY.apply(li), parts, sups))
    assert "ReadSchema: struct<p_partkey:bigint>" in p
    assert "ReadSchema: struct<s_suppkey:bigint>" in p
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in p


def test_mapping_filter_and_columns_reach_the_scan(spark):
    m = NodeMapping("Customer", "c_custkey", {"segment": "c_mktsegment"}, where="c_acctbal > 100")
    p = plan(m.apply(spark.read.parquet(os.path.join(SF, "customer.parquet"))))
    assert "GreaterThan(c_acctbal,100.0)" in p
    assert "ReadSchema: struct<c_custkey:bigint,c_acctbal:double,c_mktsegment:string>" in p


def test_no_python_or_nested_loops_in_queries(spark):
    for name in ("merge_nodes_update", "merge_edges", "request_state", "undirected_graph", "validate_requests", "multi_get"):
        p = plan(C.QUERIES[name](spark, SF))
        for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in p, (name, bad)
