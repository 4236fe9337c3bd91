"""Every registered query against its SQL restatement at the smallest scale."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as entry  # noqa: E402
from compare import compare, duck  # noqa: E402

from star_queries.registry import QUERIES as REGISTERED  # noqa: E402

# the corpus operators have their own tests
QUERIES = {k: f for k, f in entry.queries().items() if k in REGISTERED}
ORACLES = {k: f for k, f in entry.oracle_sql().items() if k in REGISTERED}


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    n, ok, note = compare(spark, con, name, QUERIES[name], ORACLES.get(name), sf_dir)
    assert ok is not False, note
    assert "types" not in note, note
