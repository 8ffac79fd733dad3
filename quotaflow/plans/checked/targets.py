"""Target allocation."""

from ...operators import targets as G
from ...operators.columns import as_doubles
from ..oracle import YEAR, ratio, rounded
from .registry import client_targets, in_order, query, sales, targets

SUM = "sum(CAST(client_target AS DECIMAL(20,2)))"
ALL = "client_id, brand, target_year, CAST(client_volume AS DOUBLE) AS client_volume, CAST(brand_volume AS DOUBLE) AS brand_volume, share_pct, target_volume, client_target"


@query(
    "a3_volume_by_client_brand",
    "SELECT client_id, brand, CAST(sum(volume_hl) AS DOUBLE) AS client_volume FROM sales GROUP BY 1, 2",
    "sales",
)
def _(spark, d):
    return as_doubles(G.volume_by_client_brand(sales(spark, d, "client_id", "brand", "volume_hl")))


@query("a4_volume_by_brand", "SELECT brand, CAST(sum(volume_hl) AS DOUBLE) AS brand_volume FROM sales GROUP BY 1", "sales")
def _(spark, d):
    return as_doubles(G.volume_by_brand(sales(spark, d, "brand", "volume_hl")))


@query(
    "a5_reconcile_local",
    f"SELECT brand, target_year, target_volume, CAST({SUM} AS DOUBLE) AS client_target_sum,"
    f" CAST(target_volume - {SUM} AS DOUBLE) AS difference FROM ct GROUP BY 1, 2, 3",
    "ct",
)
def _(spark, d):
    return G.reconcile_targets(client_targets(spark, d))


@query(
    "a6_reconcile_notebook",
    f"SELECT brand, target_year, max(target_volume) AS target_volume, CAST({SUM} AS DOUBLE) AS client_target_sum,"
    f" CAST(max(target_volume) - {SUM} AS DOUBLE) AS difference FROM ct4 GROUP BY 1, 2",
    "ct4",
)
def _(spark, d):
    return G.reconcile_targets(client_targets(spark, d, share_scale=4), mode="notebook")


def _with_pct(table: str) -> str:
    gap = f"(target_volume - {SUM})"
    return (
        f"SELECT brand, target_year, target_volume, CAST({SUM} AS DOUBLE) AS client_target_sum, CAST({gap} AS DOUBLE) AS difference,"
        f" {rounded(ratio(gap, 'target_volume') + ' * 100')} AS difference_pct FROM {table} GROUP BY 1, 2, 3"
    )


@query("a7_reconcile_all_years", _with_pct("ct_all"), "ct_all")
def _(spark, d):
    every = G.allocate_targets(sales(spark, d, "client_id", "brand", "volume_hl"), targets(spark, d), None)
    return G.reconcile_targets(every, mode="notebook", with_pct=True)


@query("a7_reconcile_with_pct", _with_pct("ct"), "ct")
def _(spark, d):
    return G.reconcile_targets(client_targets(spark, d), mode="notebook", with_pct=True)


@query(
    "a10_target_by_brand",
    f"SELECT brand, CAST({SUM} AS DOUBLE) AS total_target, count(client_id) AS clients FROM ct GROUP BY 1",
    "ct",
)
def _(spark, d):
    return G.target_by_brand(client_targets(spark, d))


@query(
    "j5_participation",
    "SELECT v.client_id, v.brand, CAST(v.client_volume AS DOUBLE) AS client_volume, CAST(b.brand_volume AS DOUBLE)"
    f" AS brand_volume, {ratio('v.client_volume', 'b.brand_volume')} * 100 AS share_pct"
    " FROM client_brand v JOIN brand_total b ON v.brand = b.brand",
    "client_brand",
    "brand_total",
)
def _(spark, d):
    return as_doubles(G.participation(sales(spark, d, "client_id", "brand", "volume_hl")))


@query(
    "j6_targets_join",
    "SELECT DISTINCT brand, target_year, target_volume, CAST(brand_volume AS DOUBLE) AS brand_volume FROM brand_total JOIN targets USING (brand)",
    "brand_total",
    "targets",
)
def _(spark, d):
    rows = sales(spark, d, "client_id", "brand", "volume_hl")
    both = G.allocate_targets(rows, targets(spark, d), year=None)
    return as_doubles(both.select("brand", "target_year", "target_volume", "brand_volume").distinct())


@query("j14_brands_with_target", "SELECT DISTINCT brand FROM sales WHERE brand IN (SELECT brand FROM targets)", "sales", "targets")
def _(spark, d):
    return G.brands_with_target(sales(spark, d, "brand").distinct(), targets(spark, d))


@query(
    "j14_brands_without_target",
    "SELECT DISTINCT brand FROM sales WHERE brand IS NULL OR brand NOT IN (SELECT brand FROM targets)",
    "sales",
    "targets",
)
def _(spark, d):
    return G.brands_with_target(sales(spark, d, "brand").distinct(), targets(spark, d), present=False)


@query(
    "o1_ordered_targets",
    "SELECT client_id, brand, client_target, row_number() OVER (ORDER BY brand, client_target DESC, client_id) AS place FROM ct",
    "ct",
)
def _(spark, d):
    return in_order(G.ordered_targets(client_targets(spark, d)).select("client_id", "brand", "client_target"))


@query("t7_allocate_local", f"SELECT {ALL} FROM ct", "ct")
def _(spark, d):
    return as_doubles(client_targets(spark, d))


# Cents by the largest remainders: what rounding down leaves goes to the first places.
EXACT = f"""
  SELECT client_id, brand, (base + every + CASE WHEN place <= left_over - every * clients THEN 1 ELSE 0 END) / 100.0 AS client_target
  FROM (SELECT *, floor(left_over / clients) AS every FROM (
    SELECT *, target_volume * 100 - sum(base) OVER b AS left_over, count(*) OVER b AS clients,
           row_number() OVER (PARTITION BY brand ORDER BY cents - base DESC, client_id) AS place
    FROM (SELECT *, floor(cents) AS base FROM (
      SELECT v.client_id, v.brand, t.target_volume,
             {ratio('v.client_volume', 'b.brand_volume')} * 100 / 100 * t.target_volume * 100 AS cents
      FROM client_brand v JOIN brand_total b ON v.brand = b.brand JOIN targets t ON t.brand = v.brand AND t.target_year = {YEAR}))
    WINDOW b AS (PARTITION BY brand)))"""


@query("t7_allocate_exact", EXACT, "client_brand", "brand_total", "targets")
def _(spark, d):
    return client_targets(spark, d, exact=True).select("client_id", "brand", "client_target")


@query(
    "t7_allocate_history",
    f"SELECT client_id, brand, client_volume, brand_volume, {rounded('pct / 100 * target_volume')} AS client_target FROM (SELECT"
    f" h.client_id, h.brand, CAST(v AS DOUBLE) AS client_volume, CAST(w AS DOUBLE) AS brand_volume, {ratio('v', 'w')} * 100 AS pct,"
    " t.target_volume FROM (SELECT client_id, brand, sum(volume_hl) AS v, sum(sum(volume_hl)) OVER (PARTITION BY brand) AS w FROM sales"
    " WHERE sale_date BETWEEN DATE '2000-01-01' AND DATE '2000-12-31' GROUP BY 1, 2) h"
    f" JOIN targets t ON t.brand = h.brand AND t.target_year = {YEAR})",
    "sales",
    "targets",
)
def _(spark, d):
    rows = sales(spark, d, "client_id", "brand", "volume_hl", "sale_date")
    past = G.allocate_targets(rows, targets(spark, d), YEAR, history=("2000-01-01", "2000-12-31"))
    return as_doubles(past.select("client_id", "brand", "client_volume", "brand_volume", "client_target"))


@query("t8_allocate_notebook", f"SELECT {ALL} FROM ct4", "ct4")
def _(spark, d):
    return as_doubles(client_targets(spark, d, share_scale=4))


@query(
    "k10_abc_class",
    "SELECT client_id, brand, share_pct, CASE WHEN share_pct > 50 THEN 'A' WHEN share_pct >= 20 THEN 'B' ELSE 'C' END AS abc_class FROM ct",
    "ct",
)
def _(spark, d):
    return G.with_abc_class(client_targets(spark, d)).select("client_id", "brand", "share_pct", "abc_class")


def _attainment(table: str, years: str) -> str:
    pct = ratio("coalesce(a.v, 0.0)", "c.client_target")
    return (
        "SELECT *, CASE WHEN attainment_pct < 50 THEN 'critical' WHEN attainment_pct < 80 THEN 'below' WHEN attainment_pct > 100"
        " THEN 'excellent' WHEN attainment_pct <= 100 THEN 'on_track' END AS attainment_band FROM (SELECT c.client_id, c.brand,"
        f" CAST(c.target_year AS INT) AS target_year, c.client_target, coalesce(a.v, 0.0) AS actual_volume, {pct} * 100 AS attainment_pct"
        f" FROM {table} c LEFT JOIN (SELECT client_id, brand, year(sale_date) AS y, CAST(sum(volume_hl) AS DOUBLE) AS v FROM sales"
        f" WHERE {years} GROUP BY 1, 2, 3) a ON a.client_id = c.client_id AND a.brand = c.brand AND a.y = c.target_year)"
    )


@query("k15_target_attainment", _attainment("ct", f"year(sale_date) = {YEAR}"), "ct")
def _(spark, d):
    rows = sales(spark, d, "client_id", "brand", "volume_hl", "sale_date")
    return G.target_attainment(rows, client_targets(spark, d), YEAR)


@query("k15_attainment_all_years", _attainment("ct_all", "TRUE"), "ct_all")
def _(spark, d):
    rows = sales(spark, d, "client_id", "brand", "volume_hl", "sale_date")
    return G.target_attainment(rows, G.allocate_targets(rows, targets(spark, d), None))
