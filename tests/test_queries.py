"""Every registered query of the engine against its SQL."""

from __future__ import annotations

import pytest

from relweave.plans.queries import ORACLES, QUERIES
from tests.compare import connect, same


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_each_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir, con):
    same(QUERIES[name](spark, sf_dir), con, ORACLES[name])
