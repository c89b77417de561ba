from __future__ import annotations

import pytest

from tests.compare import connect, differences
from tidemark.checks.oracle import ORACLE
from tidemark.checks.queries import QUERIES


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, con, name):
    assert differences(QUERIES[name](spark, data), con, ORACLE[name]) == []
