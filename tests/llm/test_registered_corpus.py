"""Corpus queries against their SQL twins, and their shape."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import compare  # noqa: E402

from quotaflow.llm.queries import ORACLES, QUERIES  # noqa: E402


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_oracle(spark, sf_dir, key):
    assert compare.differences(QUERIES[key](spark, sf_dir), compare.connect(sf_dir), ORACLES[key]) == []


def test_one_query_per_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
