"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_point
from check_queries import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    frame = QUERIES[name](spark, SF_DIR)
    if name in ORACLES:
        assert compare(frame, con, ORACLES[name]) == ""
    else:
        assert frame.count() >= 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
