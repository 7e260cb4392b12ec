"""Every query of the library's own catalog against its DuckDB oracle on the smallest driver tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from conftest import SF
from graphmill.plans.catalog import QUERIES
from graphmill.plans.oracle import ORACLE

TABLES = "region nation customer supplier part orders lineitem events conversations".split()


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        v = v.item()
    if isinstance(v, float):
        return int(v) if v.is_integer() and abs(v) < 2**53 else float(f"{v:.6g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= E.queries().items() and ORACLE.items() <= E.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF).toPandas()
    want = duck.execute(E.oracle_sql()[name]).df()
    gc, gr = _rows(got)
    wc, wr = _rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["segment", "n_orders", "revenue"] and df.count() == 5


SPARK_TO_DUCK = {"LongType()": "BIGINT", "IntegerType()": "INTEGER", "StringType()": "VARCHAR", "DoubleType()": "DOUBLE", "BooleanType()": "BOOLEAN", "TimestampNTZType()": "TIMESTAMP"}


@pytest.mark.parametrize("name", ["key_sample", "merge_counters", "request_state", "parse_keys", "union_frames", "sequence_check", "store_delete", "closed_sessions"])
def test_column_types_match_oracle(spark, duck, name):
    got = {f.name: SPARK_TO_DUCK.get(repr(f.dataType), repr(f.dataType)) for f in E.queries()[name](spark, SF).schema.fields}
    rel = duck.sql(E.oracle_sql()[name])
    assert got == dict(zip(rel.columns, [str(t) for t in rel.types]))
