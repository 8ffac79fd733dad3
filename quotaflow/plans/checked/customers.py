"""Customer view."""

from ...operators import customer as V
from ...operators.columns import as_doubles
from ..oracle import PAST
from .registry import query, sales, view

NEEDED = ("client_id", "sale_date", "volume_hl", "revenue", "is_b2b")


@query("a1_last_purchase", "SELECT client_id, max(sale_date) AS last_purchase FROM sales GROUP BY 1", "sales")
def _(spark, d):
    return V.last_purchase(sales(spark, d, "client_id", "sale_date"))


@query(
    "a2_monthly_grain",
    "SELECT client_id, year_month, last_purchase, months_from_last, CAST(volume_hl AS DOUBLE) AS volume_hl,"
    " CAST(revenue AS DOUBLE) AS revenue, CAST(b2b_revenue AS DOUBLE) AS b2b_revenue,"
    " CAST(b2b_volume AS DOUBLE) AS b2b_volume FROM grain",
    "grain",
)
def _(spark, d):
    return as_doubles(V.monthly_grain(sales(spark, d, *NEEDED)))


@query(
    "j1_last_purchase_join",
    "SELECT DISTINCT client_id, last_purchase, months_from_last FROM grain",
    "grain",
)
def _(spark, d):
    grain = V.monthly_grain(sales(spark, d, *NEEDED))
    return grain.select("client_id", "last_purchase", "months_from_last").distinct()


@query("a8_reference_date", "SELECT max(sale_date) AS reference_date FROM sales", "sales")
def _(spark, d):
    return V.reference_date(sales(spark, d, "sale_date"))


@query("a9_one_pass_aggregates", "SELECT client_id, avg_volume_3m, b2b_share_3m FROM view_abs", "view_abs")
def _(spark, d):
    return view(spark, d, mode="absolute", months=(3,)).select("client_id", "avg_volume_3m", "b2b_share_3m")


@query("w4_average_volume", "SELECT client_id, avg_volume_3m, avg_volume_6m FROM view", "view")
def _(spark, d):
    return view(spark, d).select("client_id", "avg_volume_3m", "avg_volume_6m")


def _window_sums(spark, d, column, name):
    from pyspark.sql import functions as F

    from ...operators.columns import total

    grain = V.monthly_grain(sales(spark, d, *NEEDED))
    inside = [F.when(F.col("months_from_last") <= n, F.col(column)) for n in (3, 6)]
    return grain.groupBy("client_id").agg(total(inside[0]).alias(f"{name}_3m"), total(inside[1]).alias(f"{name}_6m"))


def _window_sums_sql(column, name):
    return "SELECT client_id, " + ", ".join(
        f"coalesce(CAST(sum(CASE WHEN months_from_last <= {n} THEN {column} END) AS DOUBLE), 0.0) AS {name}_{n}m"
        for n in (3, 6)
    ) + " FROM grain GROUP BY client_id"


@query("w5_window_revenue", _window_sums_sql("revenue", "revenue"), "grain")
def _(spark, d):
    return _window_sums(spark, d, "revenue", "revenue")


@query("w6_window_b2b_revenue", _window_sums_sql("b2b_revenue", "b2b_revenue"), "grain")
def _(spark, d):
    return _window_sums(spark, d, "b2b_revenue", "b2b_revenue")


@query("w7_b2b_share", "SELECT client_id, b2b_share_3m, b2b_share_6m FROM view", "view")
def _(spark, d):
    return view(spark, d).select("client_id", "b2b_share_3m", "b2b_share_6m")


@query("t5_customer_view_relative", "SELECT * FROM view", "view")
def _(spark, d):
    return view(spark, d)


@query(
    "t5_customer_view_by_month",
    "SELECT client_id, last_purchase, coalesce(CAST(sum(CASE WHEN n3 > 0 THEN v3 END) AS DOUBLE)"
    " / nullif(count(CASE WHEN n3 > 0 THEN 1 END), 0), 0.0) AS avg_volume_3m, coalesce(CAST(sum(CASE WHEN n6 > 0 THEN v6 END)"
    " AS DOUBLE) / nullif(count(CASE WHEN n6 > 0 THEN 1 END), 0), 0.0) AS avg_volume_6m FROM (SELECT client_id, last_purchase,"
    " year_month, sum(CASE WHEN months_from_last <= 3 THEN volume_hl END) AS v3, sum(CASE WHEN months_from_last <= 6"
    " THEN volume_hl END) AS v6, count(*) FILTER (WHERE months_from_last <= 3) AS n3, count(*) FILTER"
    " (WHERE months_from_last <= 6) AS n6 FROM grain GROUP BY 1, 2, 3) GROUP BY 1, 2",
    "grain",
)
def _(spark, d):
    return view(spark, d, grain="month").select("client_id", "last_purchase", "avg_volume_3m", "avg_volume_6m")


@query("t6_customer_view_absolute", "SELECT * FROM view_abs", "view_abs")
def _(spark, d):
    return view(spark, d, mode="absolute")


@query("k1_mean_volume", "SELECT client_id, avg_volume_3m, avg_volume_6m FROM view_cal", "view_cal")
def _(spark, d):
    return view(spark, d, mode="calendar").select("client_id", "avg_volume_3m", "avg_volume_6m")


@query("k7_b2b_volume_share", "SELECT client_id, b2b_share_3m, b2b_share_6m FROM view_cal", "view_cal")
def _(spark, d):
    return view(spark, d, mode="calendar").select("client_id", "b2b_share_3m", "b2b_share_6m")


@query("k1_mean_volume_as_of", "SELECT client_id, last_purchase, avg_volume_3m, avg_volume_6m FROM view_as_of", "view_as_of")
def _(spark, d):
    past = view(spark, d, mode="calendar", as_of=PAST)
    return past.select("client_id", "last_purchase", "avg_volume_3m", "avg_volume_6m")
