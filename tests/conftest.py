import os

import pytest

from bindings.check import database, local_session
from bindings.tables import Tables

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "tests")


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def tables(spark, folder):
    return Tables(spark, folder)


@pytest.fixture(scope="session")
def duck(folder):
    return database(folder)


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def plan():
    """Text of a physical plan."""
    return lambda df: df._jdf.queryExecution().toString()
