"""Write PLANS.md: the physical plans of the headline operators at sf0.1, with what to look for.

Usage: python tools/show_plans.py [sf_dir]
"""

from __future__ import annotations

import datetime as dt
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from graphmill.operators import merge as M  # noqa: E402
from graphmill.operators import skew as S  # noqa: E402
from graphmill.operators import staging as ST  # noqa: E402
from graphmill.plans import catalog as C  # noqa: E402
from graphmill.plans.store import GraphStore  # noqa: E402
from graphmill.sources import kv as KV  # noqa: E402
from graphmill.session import checkpoint_root, local_session, scratch_path, table  # noqa: E402


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def main():
    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 16, app="plans")
    checkpoint_root(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # show the shuffle plans a large graph gets
    out = ["# Physical plans of the headline operators", "",
           f"Generated by `tools/show_plans.py` on {d} with broadcast joins switched off, to show the plans a",
           "graph too large to broadcast gets. AQE is on; the plans are the initial ones (`isFinalPlan=false`).", ""]

    o = table(spark, d, "orders")
    store = GraphStore(spark, scratch_path(spark, "plans-graph"), buckets=16)
    store.write_nodes("Order", M.merge_nodes(None, C.ORDER.apply(o.where("o_orderstatus <> 'O'")), C.AS_OF_1))
    inc = o.where("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("_uid"), F.concat("o_orderpriority", F.lit("!")).alias("priority"))
    merged = M.merge_nodes_flagged(store.nodes("Order"), inc, C.AS_OF_2)
    sets, kv = scratch_path(spark, "plans-sets"), scratch_path(spark, "plans-kv")
    ST.write_indexed_add(spark, C._staged_events(table(spark, d, "events")), sets, 16)
    set_table = ST._set_table(spark, sets, 16)
    KV.write_store(table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("key"), F.col("c_name").alias("value")), kv, 16)
    wanted = o.where("o_orderkey < 40").select(F.col("o_orderkey").alias("pos"), F.col("o_custkey").cast("string").alias("key"))
    sections = [
        ("Node upsert into a bucketed store (J1)",
         "The existing version is a bucketed scan (`Bucketed: true`, 16 of 16) with no Exchange above it. Only the "
         "incoming batch is shuffled, into 16 partitions (the buckets), after a partial `max(struct)` dedupe. The "
         "filter `o_orderstatus <> 'F'` and the three read columns reach the parquet scan.", merged),
        ("Edge upsert (J2)",
         "Repeated pairs collapse in a partial hash aggregate; each end is joined with the node keys only "
         "(`ReadSchema` of part / supplier is just the key), which flags dangling pairs, so that the writing job can count them.",
         M.merge_edges(None, C.SUPPLIED_BY.apply(table(spark, d, "lineitem")), C.PART.apply(table(spark, d, "part")), C.SUPPLIER.apply(table(spark, d, "supplier")))),
        ("Salted join for a hot key (split_join)",
         "Key 7 holds a third of the rows: it is cut into slices; the join key is `(key, _slice)`; the node side "
         "repeats key 7 once per slice (`Generate explode(sequence(...))`).",
         S.split_join(
             spark.range(0, 600000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("k"), F.col("id")),
             spark.range(0, 1000).select(F.col("id").alias("uid")), "k", "uid", "left_semi", min_rows=50000)),
        ("Request state from events (A10)",
         "Last start per request is a partial aggregate; the join back runs salted for hot requests; the final "
         "aggregate is `max_by` / `count`, combined map-side.", C.q_request_state(spark, d)),
        ("Per-key numbering (W2 batch numbers)",
         "One range partitioning on (key, order), so a hot key spans several tasks; rows are numbered in their sorted partition "
         "(`ArrowEvalPython` over the key columns). The offsets of keys that cross a border come from the same shuffle: the second "
         "`Exchange rangepartitioning` below is the same one and becomes `ReusedExchange` when the plan runs; their own exchanges carry one row a partition.",
         C.q_batch_numbers(spark, d)),
        ("Set add with stored fingerprints (K1, U1)",
         "Of the stored sets only `member` is read, bucketed and without an Exchange; the batch alone is shuffled.",
         ST.fresh_members(C._staged_events(table(spark, d, "events")), spark.table(set_table))),
        ("Lookup in a stored index (S7)",
         "The bucket folders come from the requested keys (`PartitionFilters`); other folders are not opened.",
         KV.get_stored(wanted, kv)),
        ("Flagship: orders and revenue per segment from the graph views (U5)",
         "Plain Spark SQL over the node and edge views; Catalyst prunes node columns to those the query reads.",
         C.q_graph_sql(spark, d)),
    ]
    for title, note, df in sections:
        out += [f"## {title}", "", note, "", "```", plan(df).rstrip(), "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()
    print("wrote PLANS.md", dt.datetime.now())


if __name__ == "__main__":
    main()
