from decimal import Decimal

import frames
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quotaflow.operators import targets as G


def split(spark, volumes, target=1000, **options):
    df = frames.sales(spark, *[(i + 1, "X", "2024-01-01", v) for i, v in enumerate(volumes)])
    return G.allocate_targets(df, frames.targets(spark, ("X", target, 2025)), 2025, **options)


def test_worked_example(spark):
    assert frames.rows(split(spark, [600, 300, 100]), "client_id", "share_pct", "client_target") == [
        (1, 60.0, 600.0), (2, 30.0, 300.0), (3, 10.0, 100.0),
    ]


def test_rounding_leaves_a_cent_and_exact_does_not(spark):
    plain = split(spark, [1, 1, 1], 100)
    assert frames.rows(plain, "client_target") == [(33.33,)] * 3
    assert frames.rows(G.reconcile_targets(plain), "client_target_sum", "difference") == [(99.99, 0.01)]
    assert G.reconciliation_check(plain).first()[1:] == (False, "1 brands differ")
    exact = split(spark, [1, 1, 1], 100, exact=True)
    assert frames.rows(exact, "client_id", "client_target") == [(1, 33.34), (2, 33.33), (3, 33.33)]
    assert G.reconciliation_check(exact).first().passed


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.integers(0, 5000), min_size=1, max_size=40).filter(any),
    st.integers(0, 100_000),
)
def test_allocation_invariants(spark, volumes, target):
    plain = split(spark, volumes, target).collect()
    whole = sum(volumes)
    assert len(plain) == len(volumes)
    for row in plain:
        assert row.client_target == pytest.approx(target * volumes[row.client_id - 1] / whole, abs=0.005001)
    assert sum(r.client_target for r in plain) == pytest.approx(target, abs=0.005 * len(plain) + 1e-6)
    exact = split(spark, volumes, target, exact=True).collect()
    assert sum(Decimal(str(r.client_target)) for r in exact) == target
    for row in exact:
        assert row.client_target == pytest.approx(target * volumes[row.client_id - 1] / whole, abs=0.010001)


def test_share_scale_rounds_before_multiplying(spark):
    row = split(spark, [1, 2], 1_000_000, share_scale=4).collect()[0]
    assert (row.share_pct, row.client_target) == (33.3333, 333333.0)


def test_gaps_between_sales_and_targets(spark):
    df = frames.sales(spark, (1, "X", "2024-01-01", 1), (1, "Y", "2024-01-01", 1), (1, None, "2024-01-01", 9))
    goals = frames.targets(spark, ("X", 10, 2024), ("X", 20, 2025), ("Z", 30, 2025))
    assert frames.rows(G.allocate_targets(df, goals, 2025), "brand", "client_target") == [("X", 20.0)]
    assert frames.rows(G.allocate_targets(df, goals, None), "brand", "target_year", "client_target") == [("X", 2024, 10.0), ("X", 2025, 20.0)]
    assert G.allocate_targets(df, goals, 1999).count() == 0
    brands = df.select("brand").distinct()
    assert frames.rows(G.brands_with_target(brands, goals)) == [("X",)]
    assert frames.rows(G.brands_with_target(brands, goals, present=False)) == [(None,), ("Y",)]


def test_brand_without_volume_has_no_share(spark):
    for exact in (False, True):
        assert frames.rows(split(spark, [0, 0], exact=exact), "share_pct", "client_target") == [(None, None)] * 2


def test_history_limits_the_sales(spark):
    df = frames.sales(spark, (1, "X", "2023-06-01", 1), (2, "X", "2024-06-01", 3))
    goals = frames.targets(spark, ("X", 10, 2025))
    past = G.allocate_targets(df, goals, 2025, history=("2024-01-01", "2024-12-31"))
    assert frames.rows(past, "client_id", "client_target") == [(2, 10.0)]


def test_shares_of_a_brand_add_up(spark):
    df = frames.sales(spark, *[(i, "XY"[i % 2], "2024-01-01", i + 1) for i in range(40)])
    sums = G.participation(df).groupBy("brand").sum("share_pct").collect()
    assert [r[1] for r in sums] == [pytest.approx(100.0)] * 2


def test_reconcile_modes(spark):
    ct = split(spark, [1, 1, 1], 100)
    row = G.reconcile_targets(ct, "notebook", with_pct=True).first()
    assert (row.target_volume, row.difference, row.difference_pct) == (100, 0.01, 0.01)
    with pytest.raises(ValueError):
        G.reconcile_targets(ct, "other")


def test_attainment_without_sales_in_the_year(spark):
    df = frames.sales(spark, (1, "X", "2024-05-01", 90), (2, "X", "2025-05-01", 10))
    ct = G.allocate_targets(df, frames.targets(spark, ("X", 100, 2025)), 2025)
    assert frames.rows(G.target_attainment(df, ct, 2025), "client_id", "actual_volume", "attainment_pct", "attainment_band") == [
        (1, 0.0, 0.0, "critical"), (2, 10.0, 100.0, "on_track"),
    ]


def test_large_targets_table_is_not_broadcast(spark, monkeypatch, shuffle_joins):
    monkeypatch.setattr(G, "is_small", lambda df: False)
    plan = frames.plan(split(spark, [600, 300, 100]))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert frames.rows(split(spark, [600, 300, 100]), "client_target") == [(100.0,), (300.0,), (600.0,)]
    assert frames.rows(split(spark, [1, 1, 1], 100, exact=True), "client_target") == [(33.33,), (33.33,), (33.34,)]


def test_wanted_brands_are_pushed_below_the_sums(spark, tmp_path):
    """With targets from a file only sales of their brands are summed and shuffled, once."""
    from quotaflow.sources import files

    (tmp_path / "targets.csv").write_text("Marca;Meta;Ano\nA;100;2025\n", encoding="utf-8")
    goals = files.read_targets(spark, str(tmp_path / "targets.csv"))
    sales = frames.sales(spark, (1, "A", "2024-01-01", 3), (2, "B", "2024-01-01", 5))
    text = frames.plan(G.allocate_targets(sales, goals, 2025))
    before_sum = text[text.index("partial_sum(volume_hl") :]
    assert "LeftSemi" in before_sum
    assert [r.client_id for r in G.allocate_targets(sales, goals, 2025).collect()] == [1]


def test_years_are_kept_apart(spark):
    sales = spark.createDataFrame(
        [(1, "A", "2023-05-01", 10), (1, "A", "2024-05-01", 90)], "client_id long, brand string, sale_date string, volume_hl int"
    ).selectExpr("client_id", "brand", "to_date(sale_date) as sale_date", "cast(volume_hl as decimal(12,2)) as volume_hl")
    goals = spark.createDataFrame([("A", 100, 2023), ("A", 900, 2024)], "brand string, target_volume long, target_year int")
    every = G.allocate_targets(sales, goals, None)
    got = {r.target_year: (r.actual_volume, r.attainment_pct) for r in G.target_attainment(sales, every).collect()}
    assert got == {2023: (10.0, 10.0), 2024: (90.0, 10.0)}
    assert [r.target_year for r in G.target_attainment(sales, every, 2024).collect()] == [2024]
    assert {r.target_year: r.difference for r in G.reconcile_targets(every, mode="notebook").collect()} == {2023: 0.0, 2024: 0.0}
