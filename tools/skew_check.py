"""Synthetic skew check: a third of all edges leave one supernode.

Times the edge upsert and the per-key numbering with the hot-key split on and off, and reports the
largest task input of the final join stage, read from a listener-free proxy (rows per output partition).
Usage: python tools/skew_check.py [n_edges]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from graphmill.operators import merge as M  # noqa: E402
from graphmill.operators import skew as S  # noqa: E402
from graphmill.session import checkpoint_root, local_session  # noqa: E402


def main():
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 6_000_000
    spark = local_session(8, 16, app="skew-check")
    checkpoint_root(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # keep partition sizes visible
    m = n // 3
    nodes = spark.range(0, m).select(F.col("id").alias("_uid"))
    # one third of the edges leave node 7, each to a different partner (so dedupe does not remove the skew)
    e = spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % m).cast("long").alias("_fromUid"),
        F.when(F.col("id") % 3 == 0, F.col("id") / 3).otherwise((F.col("id") * 7919) % m).cast("long").alias("_toUid"),
    )
    for label, hot, aqe_skew in (("plain", None, "false"), ("salted", n // 48, "false"), ("aqe-skew", None, "true"), ("salted+aqe", n // 48, "true")):
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", aqe_skew)
        t0 = time.time()
        out = M.merge_edges(None, e, nodes, nodes, hot_min_rows=hot)
        sizes = out.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count"), F.sum("count")).collect()[0]
        print(f"merge_edges[{label}] {time.time() - t0:.1f}s  rows={sizes[1]}  largest output partition={sizes[0]}")
    ev = e.select(F.col("_fromUid").alias("k"), F.col("_toUid").alias("v"))
    t0 = time.time()
    numbered = S.number_within(ev, ["k"], ["v"], out="rn")
    top = numbered.where("k = 7").agg(F.max("rn"), F.count(F.lit(1))).collect()[0]
    parts = numbered.groupBy(F.spark_partition_id()).count().agg(F.max("count")).collect()[0][0]
    print(f"number_within {time.time() - t0:.1f}s  hot key rows={top[1]} max rn={top[0]}  largest partition={parts}")
    spark.stop()


if __name__ == "__main__":
    main()
