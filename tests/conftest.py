import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = os.environ.get("SUBLEDGER_TEST_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    from subledger.session import local_session

    s = local_session("8", "subledger-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from subledger.sources.fixtures import tables as stored

    return stored(spark, SF_ORACLE)


@pytest.fixture(scope="session")
def duck():
    from subledger.plans.compare import duckdb_connection

    return duckdb_connection(SF_ORACLE)
