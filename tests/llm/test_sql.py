"""Queries whose SQL restatement is brute force over whole tables."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from compare import compare, duck  # noqa: E402

from zoneday.llm import queries  # noqa: E402


@pytest.mark.parametrize("name", ["op3_run_index", "op7_ownership", "op9_trie_join", "op10_nn_descent"])
def test_query_against_sql(spark, sf_dir, name):
    _, ok, note = compare(spark, duck(sf_dir), name, queries.QUERIES[name], queries.ORACLES[name], sf_dir)
    assert ok, note
    assert "types" not in note, note
