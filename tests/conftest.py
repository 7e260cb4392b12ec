import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from graphmill.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, 4, app="graphmill-tests")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="graphmill-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


@pytest.fixture(scope="session")
def person_ids(spark):
    # FIXTURES 1: 1,050 Person nodes; FIXTURES 2: 500 edges i -> 2i.
    return spark.range(1050).withColumnRenamed("id", "i")


@pytest.fixture(scope="session")
def persons(spark, person_ids):
    from graphmill.sources.providers import fixture_nodes

    return fixture_nodes(person_ids)


@pytest.fixture(scope="session")
def person_edges(spark):
    from graphmill.sources.providers import fixture_edges

    return fixture_edges(spark.range(500).withColumnRenamed("id", "i"))
