from decimal import Decimal

import frames
import pytest

from quotaflow.operators import geo as G

PLACES = "postal_code string, city string, state string"


@pytest.fixture()
def geo(spark):
    return spark.createDataFrame(
        [("01310-100", "São Paulo", "SP"), ("50030230", "Recife", "PE"), ("50030230", "Recife", "PE"), ("70000000", None, "DF")],
        PLACES,
    )


@pytest.fixture()
def dim(spark):
    return spark.createDataFrame(
        [(1, 10, "01310100"), (2, 20, "50030230"), (3, 30, "99999999"), (4, 40, None), (5, 50, "70000000")],
        "client_key long, client_id long, postal_code string",
    )


@pytest.fixture()
def placed(spark):
    rows = [
        (10, "A", Decimal("5.00"), Decimal("50.00"), "São Paulo", "SP"),
        (10, "B", Decimal("1.00"), Decimal("9.00"), "São Paulo", "SP"),
        (20, "A", Decimal("3.00"), Decimal("31.00"), "Recife", "PE"),
        (30, "A", Decimal("2.00"), Decimal("20.00"), None, "PE"),
        (40, "A", Decimal("9.00"), Decimal("90.00"), None, None),
        (50, None, Decimal("1.00"), Decimal("10.00"), "Natal", "RN"),
    ]
    return spark.createDataFrame(rows, "client_id long, brand string, volume_hl decimal(12,2), revenue decimal(12,2), city string, state string")


def test_join_and_apply(dim, geo):
    assert frames.rows(G.join_geography(dim, geo), "client_id", "city", "state") == [
        (10, "São Paulo", "SP"), (20, "Recife", "PE"), (30, None, None), (40, None, None), (50, None, "DF"),
    ]
    lost = ("Não encontrado", "Não encontrado")
    applied = G.apply_geography(dim, geo)
    assert frames.rows(applied, "client_id", "city", "state") == [
        (10, "São Paulo", "SP"), (20, "Recife", "PE"), (30, *lost), (40, None, None), (50, *lost),
    ]
    assert G.enriched_count(applied).first()[0] == 2


def test_enrich_markers(spark, geo, dim):
    forms = spark.createDataFrame([(1, "01310-100"), (2, "123"), (3, None), (4, "Não informado"), (5, "70000000")], "client_id long, postal_code string")
    told = G.enrich_geography(forms, geo)
    assert frames.rows(told, "client_id", "postal_code", "city", "state") == [
        (1, "01310-100", "São Paulo", "SP"),
        (2, "123", "Não encontrado", "Não encontrado"),
        (3, None, "Não informado", "Não informado"),
        (4, "Não informado", "Não informado", "Não informado"),
        (5, "70000000", "Não encontrado", "DF"),
    ]
    assert G.enrich_geography(dim.drop("postal_code"), geo).first().state == "Não consultado"


def test_propagate_replaces_placeholders(spark, dim, geo):
    view = spark.createDataFrame([(10, None), (99, "x")], "client_id long, city string")
    assert frames.rows(G.propagate_geo(view, G.join_geography(dim, geo)), "client_id", "city", "state") == [
        (10, "São Paulo", "SP"), (99, None, None),
    ]


def test_totals_equal_row_level_sales(spark, dim, geo):
    sold = frames.sales(spark, (10, "A", "2024-01-01", 5), (10, "A", "2024-01-02", 2), (20, "A", "2024-01-01", 1), (77, "A", "2024-01-01", 4))
    places = G.join_geography(dim, geo)
    by_rows = G.geo_sales(sold.join(dim.select("client_id", "client_key"), "client_id", "left").drop("client_id", "postal_code"), places)
    for report in (G.by_state, G.by_city, G.brand_state_volume, G.geo_concentration):
        assert frames.rows(report(G.geo_totals(sold, places))) == frames.rows(report(by_rows))


def test_state_table(spark):
    states = G.states_table(spark)
    assert states.count() == 27
    df = spark.createDataFrame([("PE",), ("??",)], "state string")
    assert frames.rows(G.with_state_info(df, states), "state", "state_name", "lat") == [("??", "??", None), ("PE", "Pernambuco", -8.0476)]


def test_kpis_ignore_unknown_places(placed):
    assert tuple(G.geo_kpis(placed).first()) == (3, 3, 5, 21.0)
    assert tuple(G.geo_kpis(placed.where("client_id = 0")).first()) == (0, 0, 0, 0.0)


def test_state_rollups(spark, placed):
    assert [tuple(r) for r in G.by_state(placed).collect()] == [("SP", 6.0, 59.0, 1), ("PE", 5.0, 51.0, 2), ("RN", 1.0, 10.0, 1)]
    assert frames.rows(G.by_state(placed, brand="B")) == [("SP", 1.0, 9.0, 1)]
    located = G.by_state(placed, G.states_table(spark).where("state = 'PE'"), located=True)
    assert frames.rows(located, "state", "state_name") == [("PE", "Pernambuco")]
    assert frames.rows(G.filter_states(placed, ["RN"]), "client_id") == [(50,)]
    assert G.filter_states(placed, []).count() == 6
    shares = frames.rows(G.top_states(placed, 2, share=True), "state", "share_pct")
    assert shares == [("PE", 5 / 11 * 100), ("SP", 6 / 11 * 100)]


def test_city_rollups(placed):
    assert [r.city_state for r in G.by_city(placed, 2).collect()] == ["São Paulo - SP", "Recife - PE"]
    assert G.by_city(placed).count() == 3


def test_matrix_and_top_clients(placed):
    matrix = G.brand_state_matrix(placed, ["PE", "SP", "AC"])
    assert frames.rows(matrix, "brand", "PE", "SP", "AC") == [("A", 5.0, 5.0, 0.0), ("B", 0.0, 1.0, 0.0)]
    assert frames.rows(G.top_clients_in_state(placed, "SP"), "client_label", "brand", "volume") == [
        ("Cliente 10", "A", 5.0), ("Cliente 10", "B", 1.0),
    ]


def test_concentration(placed):
    got = frames.rows(G.geo_concentration(placed), "cumulative_pct", "state", "share_pct")
    assert got == [(50.0, "SP", 50.0), (11 / 12 * 100, "PE", 5 / 12 * 100), (100.0, "RN", 1 / 12 * 100)]
