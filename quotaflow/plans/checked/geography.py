"""Geography."""

from pyspark.sql import functions as F

from ...functions import text
from ...operators import geo as G
from ...operators import star as S
from ...operators.columns import as_doubles
from ..oracle import BRAND, STATE, ratio, total
from .registry import client_targets, clients, geography, placed_sales, query, sales, states, view

BY_STATE = (
    f"SELECT state, {total('volume_hl')} AS volume, {total('revenue')} AS revenue, count(DISTINCT client_id) AS clients"
    f" FROM gs WHERE state IS NOT NULL AND brand = '{BRAND}' GROUP BY state"
)
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@query("j7_clients_geography", "SELECT * FROM dim_geo", "dim_geo")
def _(spark, d):
    return G.join_geography(clients(spark, d), geography(spark, d))


@query(
    "j11_geo_sales",
    "SELECT d.client_id, d.postal_code, d.city, d.state, s.brand, CAST(s.volume_hl AS DOUBLE) AS volume_hl,"
    " CAST(s.revenue AS DOUBLE) AS revenue FROM sales s LEFT JOIN dim_geo d USING (client_id)",
    "dim_geo",
)
def _(spark, d):
    star = S.build_star(sales(spark, d, *S.NEEDED))
    rows = G.geo_sales(
        S.fact_with_brand(star.fact, star.dim_product), G.join_geography(star.dim_client, geography(spark, d))
    )
    return as_doubles(rows.select("client_id", "postal_code", "city", "state", "brand", "volume_hl", "revenue"))


@query(
    "j12_propagate_to_view",
    "SELECT v.*, m.city, m.state FROM view v LEFT JOIN dim_marked m USING (client_id)",
    "view",
    "dim_marked",
)
def _(spark, d):
    return G.propagate_geo(view(spark, d), G.apply_geography(clients(spark, d), geography(spark, d)))


@query(
    "j12_propagate_to_targets",
    "SELECT c.client_id, c.brand, c.client_target, m.city, m.state FROM ct c LEFT JOIN dim_marked m USING (client_id)",
    "ct",
    "dim_marked",
)
def _(spark, d):
    rows = client_targets(spark, d).select("client_id", "brand", "client_target")
    return G.propagate_geo(rows, G.apply_geography(clients(spark, d), geography(spark, d)))


@query("j13_apply_geography", "SELECT * FROM dim_marked", "dim_marked")
def _(spark, d):
    return G.apply_geography(clients(spark, d), geography(spark, d))


@query(
    "j15_state_info",
    "SELECT b.*, coalesce(s.state_name, b.state) AS state_name, s.lat, s.lon FROM by_state b LEFT JOIN states s USING (state)",
    "by_state",
    "states",
)
def _(spark, d):
    return G.with_state_info(G.by_state(placed_sales(spark, d)), states(spark, d))


@query(
    "a21_geo_kpis",
    "SELECT count(DISTINCT state) AS states, count(DISTINCT city) AS cities, count(DISTINCT client_id) AS clients,"
    f" {total('volume_hl')} AS volume FROM gs",
    "gs",
)
def _(spark, d):
    return G.geo_kpis(placed_sales(spark, d))


@query(
    "a22_by_state",
    "SELECT b.*, coalesce(s.state_name, b.state) AS state_name, s.lat, s.lon FROM by_state b LEFT JOIN states s USING (state)",
    "by_state",
    "states",
)
def _(spark, d):
    return G.by_state(placed_sales(spark, d), states(spark, d))


@query(
    "a22_by_located_state",
    "SELECT b.*, s.state_name, s.lat, s.lon FROM by_state b JOIN states s USING (state)",
    "by_state",
    "states",
)
def _(spark, d):
    return G.by_state(placed_sales(spark, d), states(spark, d), located=True)


@query("a23_top_states", "SELECT * FROM by_state ORDER BY volume DESC, state LIMIT 3", "by_state")
def _(spark, d):
    return G.top_states(placed_sales(spark, d), 3)


@query(
    "a23_top_states_share",
    f"SELECT *, {ratio('volume', 'sum(CAST(volume AS DECIMAL(28,8))) OVER ()')} * 100 AS share_pct"
    " FROM (SELECT * FROM by_state ORDER BY volume DESC, state LIMIT 4)",
    "by_state",
)
def _(spark, d):
    return G.top_states(placed_sales(spark, d), 4, share=True)


@query(
    "a24_by_city",
    f"SELECT state, city, {total('volume_hl')} AS volume, {total('revenue')} AS revenue, count(DISTINCT client_id) AS clients,"
    " city || ' - ' || state AS city_state FROM gs WHERE state IS NOT NULL AND city IS NOT NULL GROUP BY state, city"
    " ORDER BY volume DESC, state, city LIMIT 20",
    "gs",
)
def _(spark, d):
    return G.by_city(placed_sales(spark, d), 20)


@query("a25_by_state_of_brand", BY_STATE, "gs")
def _(spark, d):
    return G.by_state(placed_sales(spark, d), brand=BRAND)


@query(
    "a25_top_states_of_brand",
    f"SELECT *, {ratio('volume', 'sum(CAST(volume AS DECIMAL(28,8))) OVER ()')} * 100 AS share_pct"
    f" FROM ({BY_STATE} ORDER BY volume DESC, state LIMIT 3)",
    "gs",
)
def _(spark, d):
    return G.top_states(placed_sales(spark, d), 3, share=True, brand=BRAND)


@query(
    "a26_brand_state_volume",
    f"SELECT brand, state, {total('volume_hl')} AS volume FROM gs WHERE brand IS NOT NULL AND state IS NOT NULL GROUP BY 1, 2",
    "gs",
)
def _(spark, d):
    return G.brand_state_volume(placed_sales(spark, d))


@query(
    "a26_brand_state_matrix",
    "SELECT brand, "
    + ", ".join(f"""coalesce(CAST(sum(CASE WHEN state = '{r}' THEN volume_hl END) AS DOUBLE), 0.0) AS "{r}" """ for r in REGIONS)
    + " FROM gs WHERE brand IS NOT NULL AND state IS NOT NULL GROUP BY brand",
    "gs",
)
def _(spark, d):
    return G.brand_state_matrix(placed_sales(spark, d), REGIONS)


@query(
    "a27_top_clients_in_state",
    f"SELECT client_id, city, brand, {total('volume_hl')} AS volume, {total('revenue')} AS revenue,"
    f" 'Cliente ' || client_id AS client_label FROM gs WHERE state = '{STATE}' AND brand IS NOT NULL GROUP BY client_id, city, brand"
    " ORDER BY volume DESC, client_id, city, brand LIMIT 20",
    "gs",
)
def _(spark, d):
    return G.top_clients_in_state(placed_sales(spark, d), STATE)


@query(
    "t9_enrich_geography",
    "SELECT client_key, client_id, code AS postal_code, CASE WHEN code IS NULL THEN 'Não informado'"
    " ELSE coalesce(g.city, 'Não encontrado') END AS city, CASE WHEN code IS NULL THEN 'Não informado'"
    " ELSE coalesce(g.state, 'Não encontrado') END AS state FROM (SELECT client_key, client_id,"
    " CASE WHEN client_key % 5 <> 0 THEN postal_code END AS code FROM dim) LEFT JOIN geo g ON g.postal_code = code",
    "dim",
    "geo",
)
def _(spark, d):
    known = F.when(F.col("client_key") % 5 != 0, F.col("postal_code"))
    return G.enrich_geography(clients(spark, d).withColumn("postal_code", known), geography(spark, d))


def _concentration(*keys):
    names = ", ".join(keys)
    return (
        f"SELECT {names}, CAST(v AS DOUBLE) AS volume, {ratio('v', 'sum(v) OVER ()')} * 100 AS share_pct,"
        f" {ratio(f'sum(v) OVER (ORDER BY v DESC, {names} ROWS UNBOUNDED PRECEDING)', 'sum(v) OVER ()')} * 100 AS cumulative_pct"
        f" FROM (SELECT {names}, sum(volume_hl) AS v FROM gs WHERE {' AND '.join(f'{k} IS NOT NULL' for k in keys)} GROUP BY {names})"
    )


@query("k17_concentration_by_state", _concentration("state"), "gs")
def _(spark, d):
    return G.geo_concentration(placed_sales(spark, d))


@query("k17_concentration_by_city", _concentration("state", "city"), "gs")
def _(spark, d):
    return G.geo_concentration(placed_sales(spark, d), "city")


@query(
    "k18_format_postal",
    "SELECT client_id, substr(postal_code, 1, 5) || '-' || substr(postal_code, 6, 3) AS postal_display FROM dim",
    "dim",
)
def _(spark, d):
    return clients(spark, d).select("client_id", text.format_postal(F.col("postal_code")).alias("postal_display"))
