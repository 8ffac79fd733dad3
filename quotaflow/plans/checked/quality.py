"""Profiles and checks (Q)."""

from ...operators import quality as Q
from ...operators.cleaning import clean
from ...operators.columns import as_doubles
from ...operators.geo import apply_geography, enriched_count
from ...operators.reports import first_rows
from ...operators.star import NEEDED, build_star
from ...operators.targets import reconciliation_check, targets_for_year
from ...sources.scratch import staged
from .registry import client_targets, clients, geography, query, sales, targets, view

COLUMNS = {
    "client_id": "bigint",
    "material_id": "bigint",
    "is_b2b": "boolean",
    "volume_hl": "decimal(12,2)",
    "revenue": "decimal(18,4)",
    "sale_date": "date",
    "packaging_code": "int",
    "brand": "string",
    "material": "string",
    "postal_code": "string",
}


def _each(template: str, columns=COLUMNS) -> str:
    return " UNION ALL ".join(template.format(c=c, t=t, i=i) for i, (c, t) in enumerate(columns.items(), 1))


NUMBERS = {c: t for c, t in COLUMNS.items() if t.startswith(("bigint", "int", "decimal"))}
TEXTS = {c: t for c, t in COLUMNS.items() if t == "string"}


@query(
    "q1_schema_report",
    _each("SELECT '{c}' AS column_name, {i} AS position, '{t}' AS data_type, count({c}) AS filled FROM sales"),
    "sales",
)
def _(spark, d):
    return Q.schema_report(sales(spark, d))


@query(
    "q2_describe",
    _each(
        "SELECT '{c}' AS column_name, count({c}) AS count, CAST(sum({c}) AS DOUBLE) / count({c}) AS mean,"
        " round(stddev_samp({c}), 4) AS stddev, CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max FROM sales",
        NUMBERS,
    )
    + " UNION ALL "
    + _each(
        "SELECT '{c}', count({c}), NULL, NULL, min({c}), max({c}) FROM sales",
        TEXTS,
    ),
    "sales",
)
def _(spark, d):
    from pyspark.sql import functions as F

    return Q.describe(sales(spark, d)).withColumn("stddev", F.round("stddev", 4))


@query(
    "q3_sample_rows",
    "SELECT client_id, sale_date, material_id, CAST(volume_hl AS DOUBLE) AS volume_hl FROM sales"
    " ORDER BY client_id, sale_date, material_id, volume_hl LIMIT 20",
    "sales",
)
def _(spark, d):
    return as_doubles(first_rows(sales(spark, d, "client_id", "sale_date", "material_id", "volume_hl"), 20))


@query(
    "q4_row_counts",
    "SELECT 'sales' AS stage, count(*) AS rows FROM sales UNION ALL SELECT 'clean', count(*) FROM (SELECT DISTINCT * FROM sales)"
    " UNION ALL SELECT 'customer_view', count(*) FROM view UNION ALL SELECT 'client_targets', count(*) FROM ct",
    "view",
    "ct",
)
def _(spark, d):
    return Q.row_counts(
        {
            "sales": sales(spark, d, "client_id"),
            "clean": clean(sales(spark, d), "drop"),
            "customer_view": view(spark, d),
            "client_targets": client_targets(spark, d),
        }
    )


@query("q5_table_size", "SELECT 10 AS columns, count(*) AS rows FROM sales", "sales")
def _(spark, d):
    return Q.table_size(sales(spark, d))


@query(
    "q6_null_profile",
    _each(
        "SELECT '{c}' AS column_name, count({c}) AS filled, count(*) - count({c}) AS nulls,"
        " CAST(count(*) - count({c}) AS DOUBLE) / count(*) * 100 AS null_pct FROM sales"
    ),
    "sales",
)
def _(spark, d):
    return Q.null_profile(sales(spark, d))


@query(
    "q7_check_not_empty",
    "SELECT 'targets of 1999 is not empty' AS check, count(*) > 0 AS passed,"
    " CASE WHEN count(*) > 0 THEN 'has rows' ELSE 'no rows' END AS detail FROM targets WHERE target_year = 1999",
    "targets",
)
def _(spark, d):
    return Q.check_not_empty(targets_for_year(targets(spark, d), 1999), "targets of 1999")


@query(
    "q8_reconciliation_check",
    "SELECT 'client targets add up to the brand target' AS check, count(*) FILTER (WHERE gap <> 0) = 0 AS passed,"
    " count(*) FILTER (WHERE gap <> 0) || ' brands differ' AS detail FROM (SELECT max(target_volume)"
    " - sum(CAST(client_target AS DECIMAL(20,2))) AS gap FROM ct GROUP BY brand)",
    "ct",
)
def _(spark, d):
    return reconciliation_check(client_targets(spark, d))


@query(
    "q9_column_guard",
    "SELECT 'brand' AS column_name, TRUE AS present, count(brand) AS filled FROM sales"
    " UNION ALL SELECT 'city', FALSE, 0 FROM (SELECT count(*) FROM sales)"
    " UNION ALL SELECT 'is_b2b', TRUE, count(is_b2b) FROM sales",
    "sales",
)
def _(spark, d):
    return Q.column_guard(sales(spark, d), ["brand", "city", "is_b2b"])


@query(
    "q10_clean_report",
    "SELECT 'is_b2b' AS column_name, count(*) - count(is_b2b) AS filled_nulls, 'False' AS filled_with FROM sales"
    " UNION ALL SELECT 'brand', count(*) - count(brand), 'Não informado' FROM sales",
    "sales",
)
def _(spark, d):
    return Q.clean_report(sales(spark, d))


@query("q12_enriched_clients", "SELECT count(*) AS enriched_clients FROM dim_geo WHERE city IS NOT NULL", "dim_geo")
def _(spark, d):
    return enriched_count(apply_geography(clients(spark, d), geography(spark, d)))


@query(
    "q13_star_integrity",
    "SELECT 'fact client_key is in its dimension' AS check, TRUE AS passed, '0' AS detail UNION ALL"
    " SELECT 'fact product_key is in its dimension', TRUE, '0' UNION ALL"
    " SELECT 'fact time_key is in its dimension', TRUE, '0' UNION ALL"
    " SELECT 'fact has one row per sale', TRUE, CAST(count(*) AS VARCHAR) FROM sales",
    "sales",
)
def _(spark, d):
    rows = staged(sales(spark, d, *NEEDED))
    return Q.star_integrity(build_star(rows, stage=False), rows)


@query(
    "q13_no_nulls",
    "SELECT 'sales: no nulls in client_id, sale_date, brand' AS check, count(*) FILTER (WHERE brand IS NULL) = 0 AS passed,"
    " CAST(count(*) FILTER (WHERE brand IS NULL) AS VARCHAR) AS detail FROM sales",
    "sales",
)
def _(spark, d):
    return Q.no_nulls_check(sales(spark, d, "client_id", "sale_date", "brand"), ["client_id", "sale_date", "brand"], "sales")


@query(
    "q13_metrics_alive",
    "SELECT 'customer view: metrics are not all zero' AS check, TRUE AS passed,"
    " CAST(count(*) FILTER (WHERE b2b_share_3m <> 0 OR b2b_share_6m <> 0) AS VARCHAR) AS detail FROM view",
    "view",
)
def _(spark, d):
    return Q.metrics_check(view(spark, d), ["b2b_share_3m", "b2b_share_6m"], "customer view")
