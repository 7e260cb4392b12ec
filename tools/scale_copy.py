"""Make a k-times copy of the driver tables (derived from them, keys offset per copy) for scaling runs.

Usage: python tools/scale_copy.py SRC_DIR DEST_DIR K
Every copy shifts the keys of customer, orders, lineitem, part, supplier and events by the table's key
range, so joins stay valid and every key stays unique; nation and region are shared.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from graphmill.session import local_session  # noqa: E402

SHIFT = {
    "customer": {"c_custkey": "customer"},
    "orders": {"o_orderkey": "orders", "o_custkey": "customer"},
    "lineitem": {"l_orderkey": "orders", "l_partkey": "part", "l_suppkey": "supplier"},
    "part": {"p_partkey": "part"},
    "supplier": {"s_suppkey": "supplier"},
    "events": {"event_id": "events", "user_id": "users"},
}
KEY_OF = {"customer": "c_custkey", "orders": "o_orderkey", "part": "p_partkey", "supplier": "s_suppkey", "events": "event_id"}


def main():
    src, dest, k = sys.argv[1], sys.argv[2], int(sys.argv[3])
    spark = local_session(8, 16, app="scale-copy")
    read = lambda t: spark.read.parquet(os.path.join(src, f"{t}.parquet"))
    span = {t: read(t).agg(F.max(c)).first()[0] + 1 for t, c in KEY_OF.items()}
    span["users"] = read("events").agg(F.max("user_id")).first()[0] + 1
    for t in ("region", "nation", "customer", "orders", "lineitem", "part", "supplier", "events"):
        df = read(t)
        if t in SHIFT:
            df = df.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(k - 1).cast("long"))))
            for c, space in SHIFT[t].items():
                df = df.withColumn(c, F.col(c) + F.col("_copy") * F.lit(span[space]))
            df = df.drop("_copy")
        df.repartition(max(1, k)).write.mode("overwrite").parquet(os.path.join(dest, f"{t}.parquet"))
    spark.stop()
    print("wrote", dest)


if __name__ == "__main__":
    main()
