"""Every registered query against its SQL, or for rows where it has none."""

import pytest

from bindings import load
from bindings.check import mismatch

QUERIES, ORACLES = load()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(name, spark, duck, folder):
    problem = mismatch(QUERIES[name](spark, folder), duck, ORACLES[name])
    assert problem is None, problem


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLES.keys()))
def test_gives_rows(name, spark, folder):
    assert QUERIES[name](spark, folder).count() > 0
