"""The scaling copy keeps keys unique and references valid."""

import os
import subprocess
import sys

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_scale_copy_doubles_and_keeps_references(tmp_path):
    dest = str(tmp_path / "x2")
    subprocess.run([sys.executable, os.path.join(ROOT, "tools", "scale_copy.py"), "/root/testdata/sf0.001", dest, "2"], check=True, capture_output=True, timeout=600)
    q = lambda sql: duckdb.sql(sql).fetchall()[0]
    src = q("select count(*) from '/root/testdata/sf0.001/orders.parquet'")[0]
    n, distinct = q(f"select count(*), count(distinct o_orderkey) from '{dest}/orders.parquet/*.parquet'")
    assert n == distinct == 2 * src
    orphans = q(f"select count(*) from '{dest}/orders.parquet/*.parquet' where o_custkey not in (select c_custkey from '{dest}/customer.parquet/*.parquet')")[0]
    assert orphans == 0
