"""Projections, filters and cleaning (P, T1, T2)."""

from pyspark.sql import functions as F

from ...functions import text
from ...operators import cleaning as C
from ...operators import reports as R
from ...operators.columns import as_doubles, known
from ...operators.geo import filter_states
from ...operators.targets import targets_for_year
from ...schemas import SALES_DIALECTS
from ..oracle import BRAND, STATE, YEAR
from .registry import client_targets, geography, placed_sales, query, sales, targets, view

FILLED = "client_id, material_id, is_b2b, volume_hl, revenue, sale_date, packaging_code, brand, material, postal_code"


def _doubles(columns: str) -> str:
    for c in ("volume_hl", "revenue", "client_volume", "brand_volume"):
        columns = columns.replace(c, f"CAST({c} AS DOUBLE) AS {c}")
    return columns


@query(
    "p1_parse_date",
    "SELECT client_id, CASE WHEN brand IS NOT NULL THEN sale_date END AS sale_date FROM sales",
    "sales",
)
def _(spark, d):
    written = F.when(F.col("brand").isNull(), "31/12/1999").otherwise(F.date_format("sale_date", "yyyy-MM-dd"))
    texts = sales(spark, d, "client_id", "brand", "sale_date").withColumn("sale_date", written)
    return C.parse_dates(texts).select("client_id", "sale_date")


@query(
    "p2_fill_numeric",
    "SELECT client_id, material_id, CAST(volume_hl AS DOUBLE) AS volume_hl,"
    " CASE WHEN brand IS NULL THEN 0 ELSE packaging_code END AS packaging_code FROM sales",
    "sales",
)
def _(spark, d):
    coded = F.when(F.col("brand").isNotNull(), F.col("packaging_code"))
    rows = sales(spark, d, "client_id", "material_id", "volume_hl", "packaging_code", "brand")
    return as_doubles(C.fill_numeric(rows.withColumn("packaging_code", coded)).drop("brand"))


@query("p3_fill_flag", "SELECT client_id, material_id, coalesce(is_b2b, FALSE) AS is_b2b FROM sales", "sales")
def _(spark, d):
    return C.fill_flag(sales(spark, d, "client_id", "material_id", "is_b2b"))


@query(
    "p4_fill_text",
    "SELECT client_id, coalesce(brand, 'Não informado') AS brand, material FROM sales",
    "sales",
)
def _(spark, d):
    return C.fill_text(sales(spark, d, "client_id", "brand", "material"))


@query(
    "p5_add_calendar",
    "SELECT client_id, sale_date, CAST(year(sale_date) AS INT) AS year, CAST(month(sale_date) AS INT) AS month,"
    " strftime(sale_date, '%Y-%m') AS year_month FROM sales",
    "sales",
)
def _(spark, d):
    return C.add_calendar(sales(spark, d, "client_id", "sale_date"))


@query("p6_add_quarter", "SELECT client_id, sale_date, CAST(quarter(sale_date) AS INT) AS quarter FROM sales", "sales")
def _(spark, d):
    return C.add_quarter(sales(spark, d, "client_id", "sale_date"))


@query("p7_dedupe", f"SELECT DISTINCT {_doubles(FILLED)} FROM sales", "sales")
def _(spark, d):
    rows = sales(spark, d)
    return as_doubles(C.dedupe(rows.unionAll(rows)))


@query(
    "p7_dropped_rows",
    "SELECT CAST(sum(n) AS BIGINT) AS rows_before, count(*) AS rows_after, CAST(sum(n) - count(*) AS BIGINT) AS dropped_rows FROM"
    " (SELECT count(*) AS n FROM (SELECT * FROM sales UNION ALL SELECT * FROM sales WHERE client_id % 3 = 0)"
    f" GROUP BY {FILLED})",
    "sales",
)
def _(spark, d):
    rows = sales(spark, d)
    return C.dedupe_counted(rows.unionAll(rows.where("client_id % 3 = 0")))[1]


@query(
    "p8_require_not_null",
    "SELECT client_id, brand, sale_date FROM sales WHERE brand IS NOT NULL AND is_b2b IS NOT NULL",
    "sales",
)
def _(spark, d):
    rows = sales(spark, d, "client_id", "brand", "sale_date", "is_b2b")
    return C.require_not_null(rows, ["client_id", "brand", "sale_date", "is_b2b"]).drop("is_b2b")


@query(
    "p9_cast_types",
    "SELECT client_id, CAST(volume_hl AS DOUBLE) AS volume_hl, CAST(is_b2b AS INT) AS is_b2b FROM sales",
    "sales",
)
def _(spark, d):
    return C.cast_types(sales(spark, d, "client_id", "volume_hl", "is_b2b"))


@query(
    "p10_ensure_revenue",
    "SELECT client_id, CAST(volume_hl AS DOUBLE) AS volume_hl, CAST(volume_hl * 100 AS DOUBLE) AS revenue FROM sales",
    "sales",
)
def _(spark, d):
    return as_doubles(C.ensure_revenue(sales(spark, d, "client_id", "volume_hl")))


@query(
    "p11_rename",
    'SELECT client_id, sale_date AS "date", brand, CAST(volume_hl AS DOUBLE) AS volume_hl, is_b2b AS b2b_status,'
    " postal_code AS cep, CAST(revenue AS DOUBLE) AS valor FROM sales",
    "sales",
)
def _(spark, d):
    return as_doubles(C.to_dialect(sales(spark, d), SALES_DIALECTS["notebook"]))


@query(
    "p12_geo_placeholders",
    "SELECT client_id, last_purchase, CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS state FROM view",
    "view",
)
def _(spark, d):
    return C.add_geo_placeholders(view(spark, d).select("client_id", "last_purchase"))


@query("p13_distinct_values", "SELECT DISTINCT client_id, postal_code FROM sales", "sales")
def _(spark, d):
    return C.distinct_values(sales(spark, d, "client_id", "postal_code"), ["client_id", "postal_code"])


@query("p14_drop_null_brand", "SELECT DISTINCT brand FROM sales WHERE brand IS NOT NULL", "sales")
def _(spark, d):
    return known(C.distinct_values(sales(spark, d, "brand"), ["brand"]), "brand")


@query("p15_targets_for_year", f"SELECT brand, target_year, target_volume FROM targets WHERE target_year = {YEAR}", "targets")
def _(spark, d):
    return targets_for_year(targets(spark, d), YEAR)


@query(
    "p16_filter_brands",
    "SELECT client_id, brand, CAST(volume_hl AS DOUBLE) AS volume_hl FROM sales WHERE brand IN ('Brand#1', 'Brand#12')",
    "sales",
)
def _(spark, d):
    return as_doubles(R.filter_brands(sales(spark, d, "client_id", "brand", "volume_hl"), ["Brand#1", "Brand#12"]))


@query(
    "p17_filter_channel",
    "SELECT client_id, is_b2b, CAST(volume_hl AS DOUBLE) AS volume_hl FROM sales WHERE is_b2b = FALSE",
    "sales",
)
def _(spark, d):
    return as_doubles(R.filter_channel(sales(spark, d, "client_id", "is_b2b", "volume_hl"), "B2C"))


@query("p18_filter_brand", f"SELECT client_id, brand, client_target FROM ct WHERE brand = '{BRAND}'", "ct")
def _(spark, d):
    return R.filter_brand(client_targets(spark, d), BRAND).select("client_id", "brand", "client_target")


@query(
    "p19_filter_states",
    "SELECT client_id, brand, state, CAST(sum(volume_hl) AS DOUBLE) AS volume_hl FROM gs"
    " WHERE state IN ('ASIA', 'EUROPE') GROUP BY 1, 2, 3",
    "gs",
)
def _(spark, d):
    chosen = filter_states(placed_sales(spark, d), ["ASIA", "EUROPE"])
    return as_doubles(chosen.select("client_id", "brand", "state", "volume_hl"))


@query(
    "p20_filter_state",
    f"SELECT client_id, brand, city, CAST(sum(volume_hl) AS DOUBLE) AS volume_hl FROM gs WHERE state = '{STATE}' GROUP BY 1, 2, 3",
    "gs",
)
def _(spark, d):
    chosen = filter_states(placed_sales(spark, d), [STATE])
    return as_doubles(chosen.select("client_id", "brand", "city", "volume_hl"))


@query("p21_min_volume", "SELECT client_id, avg_volume_3m FROM view WHERE avg_volume_3m >= 60", "view")
def _(spark, d):
    return R.min_volume(view(spark, d), 60).select("client_id", "avg_volume_3m")


@query("p22_min_target", "SELECT client_id, brand, client_target FROM ct WHERE client_target >= 10", "ct")
def _(spark, d):
    return R.min_target(client_targets(spark, d), 10).select("client_id", "brand", "client_target")


@query("p23_drop_unknown", "SELECT client_id, is_b2b, brand FROM sales WHERE is_b2b IS NOT NULL AND brand IS NOT NULL", "sales")
def _(spark, d):
    return known(sales(spark, d, "client_id", "is_b2b", "brand"), "is_b2b", "brand")


@query(
    "p24_to_number",
    "SELECT client_id, CASE WHEN brand IS NOT NULL THEN CAST(volume_hl AS DOUBLE) END AS volume FROM sales",
    "sales",
)
def _(spark, d):
    written = F.coalesce(F.when(F.col("brand").isNotNull(), F.col("volume_hl").cast("string")), F.lit("n/a"))
    return sales(spark, d, "client_id", "brand", "volume_hl").select("client_id", text.to_number(written).alias("volume"))


@query("p25_client_label", "SELECT client_id, 'Cliente ' || client_id AS client_label FROM view", "view")
def _(spark, d):
    return view(spark, d).select("client_id", text.client_label(F.col("client_id")).alias("client_label"))


@query(
    "p26_city_label",
    "SELECT DISTINCT d.postal_code, g.city || ' - ' || g.state AS city_state FROM dim d LEFT JOIN geo g USING (postal_code)",
    "dim",
    "geo",
)
def _(spark, d):
    codes = sales(spark, d, "postal_code").distinct()
    placed = codes.join(geography(spark, d), "postal_code", "left")
    return placed.select("postal_code", text.city_label(F.col("city"), F.col("state")).alias("city_state"))


@query(
    "p27_channel_name",
    "SELECT client_id, CASE WHEN is_b2b THEN 'B2B' WHEN NOT is_b2b THEN 'B2C' END AS channel FROM sales",
    "sales",
)
def _(spark, d):
    return sales(spark, d, "client_id", "is_b2b").select("client_id", text.channel_name(F.col("is_b2b")).alias("channel"))


@query(
    "p28_normalize_postal",
    "SELECT client_id, CASE WHEN is_b2b THEN postal_code END AS postal_code FROM sales",
    "sales",
)
def _(spark, d):
    dashed = F.concat(F.substring("postal_code", 1, 5), F.lit("-"), F.substring("postal_code", 6, 3))
    written = F.when(F.col("is_b2b"), dashed).when(~F.col("is_b2b"), F.substring("postal_code", 2, 7))
    rows = sales(spark, d, "client_id", "is_b2b", "postal_code")
    return rows.select("client_id", text.normalize_postal(written).alias("postal_code"))


@query(
    "p29_detect_date_column",
    "SELECT 'data_doc' AS date_column, sale_date, count(*) AS sales FROM sales GROUP BY sale_date",
    "sales",
)
def _(spark, d):
    rows = C.to_dialect(sales(spark, d, "client_id", "sale_date", "volume_hl"), SALES_DIALECTS["local"])
    found = C.detect_date_column(rows.columns)
    return rows.groupBy(F.lit(found).alias("date_column"), F.col(found).alias("sale_date")).agg(
        F.count(F.lit(1)).alias("sales")
    )


@query(
    "t1_clean_fill",
    f"SELECT {_doubles(FILLED)}, CAST(year(sale_date) AS INT) AS year, CAST(month(sale_date) AS INT) AS month,"
    " strftime(sale_date, '%Y-%m') AS year_month FROM filled",
    "filled",
)
def _(spark, d):
    return as_doubles(C.clean(sales(spark, d), "fill"))


@query(
    "t2_clean_drop",
    f"SELECT DISTINCT {_doubles(FILLED).replace('is_b2b', 'CAST(is_b2b AS INT) AS is_b2b', 1)} FROM sales"
    " WHERE client_id IS NOT NULL AND sale_date IS NOT NULL AND volume_hl IS NOT NULL",
    "sales",
)
def _(spark, d):
    return as_doubles(C.cast_types(C.clean(sales(spark, d), "drop")))
