"""Reporting questions."""

from ...operators import reports as R
from ...operators.columns import as_doubles
from ..oracle import BRAND, ratio, total
from .registry import client_targets, clients, in_order, query, sales, view

SUM = "sum(CAST(client_target AS DECIMAL(20,2)))"
WINDOWS = "avg_volume_3m, avg_volume_6m, b2b_share_3m, b2b_share_6m"
SOLD = ("client_id", "brand", "volume_hl", "revenue", "is_b2b")


@query("p30_compare_windows", f"SELECT client_id, {WINDOWS} FROM view WHERE avg_volume_3m >= 20", "view")
def _(spark, d):
    return R.compare_windows(view(spark, d), 20)


@query(
    "p31_client_detail",
    f"SELECT client_id, postal_code, last_purchase, {WINDOWS} FROM view JOIN dim USING (client_id)"
    " ORDER BY avg_volume_3m DESC, client_id LIMIT 20",
    "view",
    "dim",
)
def _(spark, d):
    return R.client_detail(R.with_postal(view(spark, d), clients(spark, d)), 20)


@query(
    "p32_browse",
    "SELECT client_id, brand, sale_date, material_id, CAST(volume_hl AS DOUBLE) AS volume_hl, (SELECT count(*) FROM sales) AS table_rows"
    f" FROM sales WHERE brand = '{BRAND}' ORDER BY client_id, brand, sale_date, material_id, volume_hl LIMIT 1000",
    "sales",
)
def _(spark, d):
    rows = sales(spark, d, "client_id", "brand", "sale_date", "material_id", "volume_hl")
    return as_doubles(R.browse(rows, 1000, BRAND))


@query(
    "a11_overview_kpis",
    f"SELECT count(*) AS transactions, {total('volume_hl')} AS volume, {total('revenue')} AS revenue,"
    " (SELECT count(DISTINCT client_id) FROM sales) AS clients FROM sales WHERE brand IN ('Brand#1', 'Brand#12') AND is_b2b",
    "sales",
)
def _(spark, d):
    return R.overview_kpis(sales(spark, d, *SOLD), view(spark, d), ["Brand#1", "Brand#12"], "B2B")


@query(
    "a12_top_brands_by_volume",
    "SELECT brand, CAST(sum(volume_hl) AS DOUBLE) AS volume FROM sales WHERE brand IS NOT NULL GROUP BY 1"
    " ORDER BY sum(volume_hl) DESC, brand LIMIT 10",
    "sales",
)
def _(spark, d):
    return R.top_brands(sales(spark, d, "brand", "volume_hl"))


@query(
    "a13_top_brands_by_revenue",
    f"SELECT brand, CAST(r AS DOUBLE) AS revenue, {ratio('r', 'sum(r) OVER ()')} * 100 AS share_pct FROM"
    " (SELECT brand, sum(revenue) AS r FROM sales WHERE brand IS NOT NULL GROUP BY 1 ORDER BY r DESC, brand LIMIT 10)",
    "sales",
)
def _(spark, d):
    return R.top_brands(sales(spark, d, "brand", "revenue"), by="revenue", share=True)


@query(
    "a14_channel_counts",
    "SELECT CASE WHEN is_b2b THEN 'B2B' ELSE 'B2C' END AS channel, count(*) AS transactions FROM sales WHERE is_b2b IS NOT NULL GROUP BY 1",
    "sales",
)
def _(spark, d):
    return R.channel_counts(sales(spark, d, "is_b2b"))


@query(
    "a15_target_kpis",
    f"SELECT coalesce(CAST({SUM} AS DOUBLE), 0.0) AS total_target, count(DISTINCT client_id) AS clients,"
    f" (SELECT count(DISTINCT brand) FROM ct) AS brands FROM ct WHERE brand = '{BRAND}' AND client_target >= 0.5",
    "ct",
)
def _(spark, d):
    return R.target_kpis(client_targets(spark, d), BRAND, 0.5)


@query(
    "a16_top_clients_by_target",
    f"SELECT client_id, CAST({SUM} AS DOUBLE) AS total_target, 'Cliente ' || client_id AS client_label FROM ct"
    " GROUP BY client_id ORDER BY total_target DESC, client_id LIMIT 20",
    "ct",
)
def _(spark, d):
    return R.top_clients_by_target(client_targets(spark, d))


WEIGHTED = "sum(CAST(client_target AS DECIMAL(18,2)) * CAST(share_pct AS DECIMAL(9,4)))"


@query(
    "a17_target_hierarchy",
    f"SELECT brand, client_id, coalesce(CAST({SUM} AS DOUBLE), 0.0) AS total_target, {ratio(WEIGHTED, SUM)} AS mean_share,"
    " CASE WHEN grouping(client_id) = 1 THEN 'brand' ELSE 'client' END AS level FROM ct"
    " GROUP BY ROLLUP (brand, client_id) HAVING grouping(brand) = 0",
    "ct",
)
def _(spark, d):
    return R.target_hierarchy(client_targets(spark, d))


@query("a18_brand_scorecard", "SELECT * FROM scorecard", "scorecard")
def _(spark, d):
    return R.brand_scorecard(sales(spark, d, *SOLD))


@query(
    "a19_brand_detail",
    "SELECT s.*, t.target_year, t.target_volume, t.target_clients, t.target_volume - s.volume AS gap,"
    f" {ratio('(t.target_volume - s.volume)', 's.volume')} * 100 AS gap_pct FROM scorecard s LEFT JOIN (SELECT brand,"
    " target_year, max(target_volume) AS target_volume, count(DISTINCT client_id) AS target_clients FROM ct GROUP BY 1, 2) t USING (brand)"
    f" WHERE brand = '{BRAND}'",
    "scorecard",
    "ct",
)
def _(spark, d):
    return R.brand_detail(sales(spark, d, *SOLD), client_targets(spark, d), BRAND)


TOP_OF_BRAND = (
    "SELECT brand, client_id, CAST(sum(volume_hl) AS DOUBLE) AS volume, CAST(sum(revenue) AS DOUBLE) AS revenue{place}"
    " FROM sales WHERE {where} GROUP BY 1, 2"
)


@query(
    "a20_top_clients_of_brand",
    TOP_OF_BRAND.format(place="", where=f"brand = '{BRAND}'") + " ORDER BY volume DESC, client_id LIMIT 10",
    "sales",
)
def _(spark, d):
    return R.top_clients_of_brand(sales(spark, d, *SOLD), BRAND)


@query(
    "a20_top_clients_of_every_brand",
    TOP_OF_BRAND.format(
        place=", CAST(row_number() OVER (PARTITION BY brand ORDER BY sum(volume_hl) DESC, client_id) AS INT) AS place",
        where="brand IS NOT NULL",
    )
    + " QUALIFY place <= 10",
    "sales",
)
def _(spark, d):
    return R.top_clients_of_brand(sales(spark, d, *SOLD))


@query("a28_choices", "SELECT DISTINCT brand FROM sales WHERE brand IS NOT NULL", "sales")
def _(spark, d):
    return R.choices(sales(spark, d, "brand"), "brand")


@query("o2_top_clients_6m", "SELECT * FROM view ORDER BY avg_volume_6m DESC, client_id LIMIT 10", "view")
def _(spark, d):
    return R.top_clients(view(spark, d))


@query(
    "o3_top_clients_3m",
    "SELECT * FROM view WHERE avg_volume_3m >= 10 ORDER BY avg_volume_3m DESC, client_id LIMIT 20",
    "view",
)
def _(spark, d):
    return R.top_clients(view(spark, d), "avg_volume_3m", 20, least=10)


@query(
    "o4_top_participation",
    "SELECT client_id, brand, share_pct, client_target FROM ct ORDER BY share_pct DESC, brand, client_id LIMIT 15",
    "ct",
)
def _(spark, d):
    return R.top_participation(client_targets(spark, d)).select("client_id", "brand", "share_pct", "client_target")


@query(
    "o5_sorted_brands",
    "SELECT brand, volume, row_number() OVER (ORDER BY volume DESC, brand) AS place FROM scorecard",
    "scorecard",
)
def _(spark, d):
    return in_order(R.brand_scorecard(sales(spark, d, *SOLD)).select("brand", "volume"))


@query(
    "o6_first_rows",
    "SELECT client_id, brand, client_target FROM ct ORDER BY client_id, brand LIMIT 100",
    "ct",
)
def _(spark, d):
    rows = client_targets(spark, d).select("client_id", "brand", "client_target")
    return R.first_rows(rows, 100, ["client_id", "brand"])


@query(
    "j9_view_with_postal",
    "SELECT view.*, postal_code, 'Cliente ' || client_id AS client_label FROM view LEFT JOIN dim USING (client_id)",
    "view",
    "dim",
)
def _(spark, d):
    return R.with_postal(view(spark, d), clients(spark, d))


@query(
    "j10_targets_with_postal",
    "SELECT client_id, brand, client_target, postal_code, 'Cliente ' || client_id AS client_label FROM ct LEFT JOIN dim USING (client_id)",
    "ct",
    "dim",
)
def _(spark, d):
    return R.with_postal(client_targets(spark, d).select("client_id", "brand", "client_target"), clients(spark, d))
