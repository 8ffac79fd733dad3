"""Star schema."""

from ...operators import star as S
from ...operators.columns import as_doubles
from .registry import clients, query, sales

MEASURES = "CAST(s.volume_hl AS DOUBLE) AS volume_hl, CAST(s.revenue AS DOUBLE) AS revenue, s.is_b2b"


@query("w1_client_key", "SELECT * FROM dim", "dim")
def _(spark, d):
    return clients(spark, d)


@query("w2_product_key", "SELECT * FROM prod", "prod")
def _(spark, d):
    return S.dim_product(sales(spark, d, "brand"))


@query("w3_time_key", "SELECT * FROM times", "times")
def _(spark, d):
    return S.dim_time(sales(spark, d, "sale_date"))


@query(
    "j2_client_key_join",
    "SELECT d.client_key, s.client_id, CAST(s.volume_hl AS DOUBLE) AS volume_hl FROM sales s LEFT JOIN dim d USING (client_id)",
    "dim",
)
def _(spark, d):
    return as_doubles(S.with_client_key(sales(spark, d, "client_id", "volume_hl"), clients(spark, d)))


@query(
    "j3_product_key_join",
    "SELECT p.product_key, s.brand, CAST(s.volume_hl AS DOUBLE) AS volume_hl FROM sales s LEFT JOIN prod p USING (brand)",
    "prod",
)
def _(spark, d):
    rows = sales(spark, d, "brand", "volume_hl")
    return as_doubles(S.with_product_key(rows, S.dim_product(rows)))


@query(
    "j4_time_key_join",
    "SELECT t.time_key, s.sale_date, CAST(s.volume_hl AS DOUBLE) AS volume_hl FROM sales s LEFT JOIN times t USING (sale_date)",
    "times",
)
def _(spark, d):
    rows = sales(spark, d, "sale_date", "volume_hl")
    return as_doubles(S.with_time_key(rows, S.dim_time(rows)))


@query(
    "j8_fact_with_brand",
    f"SELECT p.product_key, p.brand, {MEASURES} FROM sales s LEFT JOIN prod p USING (brand)",
    "prod",
)
def _(spark, d):
    star = S.build_star(sales(spark, d, *S.NEEDED))
    joined = S.fact_with_brand(star.fact, star.dim_product)
    return as_doubles(joined.select("product_key", "brand", "volume_hl", "revenue", "is_b2b"))


@query(
    "t3_star_local",
    f"SELECT d.client_key, t.time_key, p.product_key, {MEASURES} FROM sales s LEFT JOIN dim d USING (client_id)"
    " LEFT JOIN prod p USING (brand) LEFT JOIN times t USING (sale_date)",
    "dim",
    "prod",
    "times",
)
def _(spark, d):
    return as_doubles(S.build_star(sales(spark, d, *S.NEEDED)).fact)


@query(
    "t4_star_notebook",
    f"SELECT d.client_key, t.time_key, p.product_key, s.sale_date, {MEASURES} FROM sales s"
    " LEFT JOIN dim d USING (client_id) LEFT JOIN prod_nn p USING (brand) LEFT JOIN times t USING (sale_date)",
    "dim",
    "prod_nn",
    "times",
)
def _(spark, d):
    return as_doubles(S.build_star(sales(spark, d, *S.NEEDED), "notebook").fact)
