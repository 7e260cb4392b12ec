"""Registration of the training-data queries."""

import re

import __spark_entry__ as E
from graphmill.llm.queries import ORACLE, QUERIES


def test_one_query_per_operator_is_registered():
    numbers = [int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert QUERIES.items() <= E.queries().items() and "pipeline" in E.queries()


def test_each_oracle_has_its_query():
    assert set(ORACLE) <= set(QUERIES) and ORACLE.items() <= E.oracle_sql().items()
