"""Each registered query against its SQL, and its plan against what would not scale."""

from __future__ import annotations

import os

import pytest
from compare import compare, duck
from filing_helpers import SF_DIR

import __spark_entry__ as entry
from kessan.queries import all_queries, all_sql

QUERIES, SQL = all_queries(), all_sql()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    ok, note = compare(spark, con, SF_DIR, name, QUERIES[name], SQL.get(name))
    assert ok, note


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["doc_id", "period"] and df.count() > 0


def test_every_inventory_id_is_covered():
    from kessan.queries.registry import COVERS

    covered = {i for ids in COVERS.values() for i in ids}
    wanted = {f"{family}{n}" for family, last in {
        "S": 13, "K": 8, "P": 30, "J": 17, "A": 24, "W": 18, "O": 4, "U": 6, "N": 29, "Q": 5, "E": 12,
    }.items() for n in range(1, last + 1)}
    assert wanted - covered == set()
