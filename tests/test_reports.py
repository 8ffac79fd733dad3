import frames
import pytest

from quotaflow.operators import reports as R
from quotaflow.operators import targets as G


@pytest.fixture()
def sold(spark):
    return frames.sales(
        spark,
        (1, "A", "2024-01-01", 5, 50, True), (1, "B", "2024-01-01", 5, 10, False), (2, "A", "2024-01-02", 1, 30, None),
        (3, "C", "2024-01-02", 2, 0, False), (3, None, "2024-01-02", 90, 900, True),
    )


@pytest.fixture()
def ct(spark, sold):
    return G.allocate_targets(sold, frames.targets(spark, ("A", 60, 2025), ("B", 40, 2025)), 2025)


def test_filters(sold):
    assert R.filter_brands(sold).count() == R.filter_brands(sold, []).count() == 5
    assert R.filter_brands(sold, ["A", "C"]).count() == 3
    assert R.filter_brand(sold, "B").count() == 1 and R.filter_brand(sold).count() == 5
    assert [R.filter_channel(sold, w).count() for w in ("B2B", "B2C", None)] == [2, 2, 5]


def test_lower_bounds_are_inclusive(spark, ct):
    view = spark.createDataFrame([(1, "2.5"), (2, "x"), (3, None), (4, "2.4"), (5, "NaN")], "client_id long, avg_volume_3m string")
    assert frames.rows(R.min_volume(view, 2.5), "client_id") == [(1,)]
    assert frames.rows(R.top_clients(view, "avg_volume_3m", 5, least=0), "client_id") == [(1,), (4,)]
    assert frames.rows(R.min_target(ct, 50.0), "brand", "client_id") == [("A", 1)]


def test_overview_counts_clients_of_the_whole_view(spark, sold):
    view = spark.createDataFrame([(i,) for i in range(7)], "client_id long")
    assert R.overview_kpis(sold, view, ["A"], "B2B").first().asDict() == {"transactions": 1, "volume": 5.0, "revenue": 50.0, "clients": 7}
    assert R.overview_kpis(sold, view, ["Z"]).first().asDict() == {"transactions": 0, "volume": 0.0, "revenue": 0.0, "clients": 7}


def test_top_brands_break_ties_by_name_and_drop_null(sold):
    assert [tuple(r) for r in R.top_brands(sold, n=2).collect()] == [("A", 6.0), ("B", 5.0)]
    shares = R.top_brands(sold, "revenue", 2, share=True).collect()
    assert [(r.brand, r.share_pct) for r in shares] == [("A", 80 / 90 * 100), ("B", 10 / 90 * 100)]


def test_channels(sold):
    assert [tuple(r) for r in R.channel_counts(sold).collect()] == [("B2B", 2), ("B2C", 2)]


def test_scorecard_and_detail(spark, sold, ct):
    assert [tuple(r) for r in R.brand_scorecard(sold).collect()] == [
        ("A", 6.0, 80.0, 2, 80 / 6), ("B", 5.0, 10.0, 1, 2.0), ("C", 2.0, 0.0, 1, 0.0),
    ]
    row = R.brand_detail(sold, ct, "A").first()
    assert (row.target_volume, row.target_clients, row.gap, row.gap_pct) == (60, 2, 54.0, 900.0)
    row = R.brand_detail(sold, ct, "C").first()
    assert (row.target_volume, row.gap) == (None, None)
    empty = frames.sales(spark, (1, "Z", "2024-01-01", 0, 5))
    assert R.brand_scorecard(empty).first().avg_price is None


def test_top_clients_of_brands(sold):
    assert frames.rows(R.top_clients_of_brand(sold, "A", 1), "client_id", "volume") == [(1, 5.0)]
    every = frames.rows(R.top_clients_of_brand(sold, n=1), "brand", "client_id", "place")
    assert every == [("A", 1, 1), ("B", 1, 1), ("C", 3, 1)]


def test_top_of_every_brand_is_cut_before_the_shuffle(sold, capsys):
    R.top_clients_of_brand(sold, n=1).explain()
    assert "WindowGroupLimit" in capsys.readouterr().out


def test_target_reports(ct):
    assert R.target_kpis(ct).first().asDict() == {"total_target": 100.0, "clients": 2, "brands": 2}
    assert R.target_kpis(ct, "A", 20.0).first().asDict() == {"total_target": 50.0, "clients": 1, "brands": 2}
    assert R.target_kpis(ct, "Z").first().asDict() == {"total_target": 0.0, "clients": 0, "brands": 2}
    assert [tuple(r) for r in R.top_clients_by_target(ct, 1).collect()] == [(1, 90.0, "Cliente 1")]
    assert frames.rows(R.top_participation(ct, 1), "brand", "share_pct") == [("B", 100.0)]
    tree = frames.rows(R.target_hierarchy(ct), "level", "brand", "client_id", "total_target")
    assert tree == [("brand", "A", None, 60.0), ("brand", "B", None, 40.0), ("client", "A", 1, 50.0), ("client", "A", 2, 10.0), ("client", "B", 1, 40.0)]
    mean = R.target_hierarchy(ct).where("level = 'brand' and brand = 'A'").first().mean_share
    assert mean == pytest.approx((50 * 83.33 + 10 * 16.67) / 60)


def test_choices_browse_and_detail(spark, sold):
    assert [r[0] for r in R.choices(sold, "brand").collect()] == ["A", "B", "C"]
    seen = R.browse(sold, 1, "A").collect()
    assert [(r.client_id, r.table_rows) for r in seen] == [(1, 5)]
    assert R.first_rows(sold, 2, ["client_id", "brand"]).count() == 2
    view = spark.createDataFrame([(1, 2.0, 3.0), (2, 4.0, 1.0)], "client_id long, avg_volume_3m double, avg_volume_6m double")
    detail = R.client_detail(view, 1)
    assert detail.columns == ["client_id", "avg_volume_3m", "avg_volume_6m"] and detail.first().client_id == 2


def test_no_report_multiplies_its_rows(spark):
    """Neither the target levels nor the geographic counts expand the client rows."""
    from quotaflow.operators import geo

    ct = spark.createDataFrame([("A", 1, 2.0, 50.0)], "brand string, client_id long, client_target double, share_pct double")
    assert "Expand" not in frames.plan(R.target_hierarchy(ct))
    gs = spark.createDataFrame([(1, "c", "s", 1)], "client_id long, city string, state string, volume_hl int")
    gs = gs.withColumn("volume_hl", gs.volume_hl.cast("decimal(12,2)"))
    assert "Expand" not in frames.plan(geo.geo_kpis(gs))
    assert geo.geo_kpis(gs).collect() == [(1, 1, 1, 1.0)]
