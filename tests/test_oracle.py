"""Every registered survey query against its DuckDB oracle (sf0.001 for speed).

The driver runs the same comparison at sf0.01; set ``FIELDBOOK_ORACLE_SF`` to
another folder (or run ``python tests/oracle_check.py <folder>``) for any
other scale.
"""

from __future__ import annotations

import os

import pytest

from __spark_entry__ import entry
from fieldbook.plans.catalog import QUERIES
from fieldbook.plans.oracle_sql import oracle_sql
from tests.oracle_check import compare, duck

from .conftest import SF0001

SF_DIR = os.environ.get("FIELDBOOK_ORACLE_SF", SF0001)
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) == set(QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    result = compare(spark, SF_DIR, name, QUERIES[name], oracle_sql()[name], con)
    assert result["ok"], result


def test_entry_smoke(spark):
    df = entry(spark)
    rows = df.collect()
    assert df.columns == ["final_status", "count", "status_rank"]
    assert len(rows) == 6
