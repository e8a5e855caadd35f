"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest

from compare import compare, duck

from basketry.catalog import REGISTRY

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    pytest.importorskip("duckdb")
    return duck(SF)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, name, REGISTRY[name], SF) is None


def test_every_query_has_sql():
    assert [n for n, e in REGISTRY.items() if e.sql is None] == []
