"""Every registered query against its SQL twin, exactly."""

import compare
import pytest

import __spark_entry__ as entry_points

QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()
# The corpus queries have tests of their own.
CHECKED = sorted(k for k in QUERIES if not k.startswith("op") and k != "pipeline")


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("key", CHECKED)
def test_query_equals_oracle(spark, sf_dir, con, key):
    result = QUERIES[key](spark, sf_dir)
    if key not in ORACLES:
        assert result.count() > 0
        return
    assert compare.differences(result, con, ORACLES[key]) == []


def test_only_corpus_queries_have_no_oracle():
    """Models, keyed merges and mined rules are no SQL; ``tests/llm`` holds them against plain definitions."""
    without = set(QUERIES) - set(ORACLES)
    assert not {k for k in without if not k.startswith("op") and k != "pipeline"}


def test_entry_has_rows_and_stable_columns(spark):
    result = entry_points.entry(spark)
    assert result.columns == [
        "client_id", "last_purchase", "avg_volume_3m", "avg_volume_6m", "b2b_share_3m", "b2b_share_6m",
    ]
    assert result.count() > 0


def test_foreign_keys_resolve(con):
    """What lets the fixture leave out lookups nobody reads."""
    for child, key, parent, target in [
        ("lineitem", "l_orderkey", "orders", "o_orderkey"),
        ("lineitem", "l_partkey", "part", "p_partkey"),
        ("orders", "o_custkey", "customer", "c_custkey"),
    ]:
        orphans = con.execute(
            f"SELECT count(*) FROM {child} WHERE {key} IS NULL OR {key} NOT IN (SELECT {target} FROM {parent})"
        ).fetchone()[0]
        repeats = con.execute(f"SELECT count(*) - count(DISTINCT {target}) FROM {parent}").fetchone()[0]
        assert (orphans, repeats) == (0, 0)
