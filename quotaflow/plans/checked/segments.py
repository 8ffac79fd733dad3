"""Segments of the KPI glossary."""

from pyspark.sql import functions as F

from ...functions.text import volume_units
from ...operators import segments as S
from ...operators.columns import as_doubles
from ..oracle import AS_OF, CTES, months_between
from .registry import query, sales, view

DAYS = f"(DATE '{AS_OF}' - last_purchase)"
MONTHS = months_between(f"DATE '{AS_OF}'", "last_purchase")
SCORE = (
    f"CASE WHEN floor({MONTHS}) <= 1 THEN 5 WHEN floor({MONTHS}) <= 3 THEN 4 WHEN floor({MONTHS}) <= 6 THEN 3"
    f" WHEN floor({MONTHS}) <= 12 THEN 2 ELSE 1 END"
)
BANDS = {
    "k2_volume_band": (
        "volume_band",
        "CASE WHEN avg_volume_3m > 50 THEN 'high' WHEN avg_volume_3m >= 10 THEN 'medium' ELSE 'low' END",
    ),
    "k3_volume_trend": (
        "volume_trend",
        "CASE WHEN avg_volume_3m - avg_volume_6m > CAST(avg_volume_6m AS DOUBLE) * CAST(0.05 AS DOUBLE) THEN 'growing'"
        " WHEN avg_volume_3m - avg_volume_6m < -(avg_volume_6m * CAST(0.05 AS DOUBLE)) THEN 'declining' ELSE 'stable' END",
    ),
    "k4_activity_status": (
        "activity_status",
        f"CASE WHEN {DAYS} < 30 THEN 'active' WHEN {DAYS} <= 90 THEN 'at_risk' ELSE 'inactive' END",
    ),
    "k5_months_since_last": ("months_since_last", MONTHS),
    "k6_recency_score": ("recency_score", f"CAST({SCORE} AS INT)"),
    "k8_channel_band": (
        "channel_band",
        "CASE WHEN b2b_share_3m >= 100 THEN 'exclusive_b2b' WHEN b2b_share_3m >= 50 THEN 'mostly_b2b'"
        " WHEN b2b_share_3m > 0 THEN 'mostly_b2c' ELSE 'exclusive_b2c' END",
    ),
    "k9_channel_shift": (
        "channel_shift",
        "CASE WHEN b2b_share_3m - b2b_share_6m > 1 THEN 'to_wholesale' WHEN b2b_share_3m - b2b_share_6m < -1"
        " THEN 'to_retail' ELSE 'stable' END",
    ),
    "k13_volume_alert": (
        "volume_alert",
        "CASE WHEN avg_volume_3m < avg_volume_6m * CAST(0.5 AS DOUBLE) THEN 'sharp_decline'"
        " WHEN avg_volume_3m > avg_volume_6m * CAST(1.2 AS DOUBLE) THEN 'fast_growth' ELSE 'none' END",
    ),
    "k14_recency_alert": (
        "recency_alert",
        f"CASE WHEN {DAYS} > 90 THEN 'urgent' WHEN {DAYS} >= 60 THEN 'at_risk' WHEN {DAYS} >= 30 THEN 'watch' ELSE 'active' END",
    ),
}


def _band_query(key: str, column: str, sql: str) -> None:
    @query(key, f"SELECT client_id, {sql} AS {column} FROM view", "view")
    def _(spark, d):
        return S.segment_view(view(spark, d), AS_OF).select("client_id", column)


for _key, (_column, _sql) in BANDS.items():
    _band_query(_key, _column, _sql)


CTES["rfm"] = (
    ("sales",),
    f"""
      SELECT *, {MONTHS} AS months_since_last, CAST({SCORE} AS INT) AS recency FROM (
        SELECT client_id, max(sale_date) AS last_purchase, count(*) FILTER (WHERE recent) AS frequency,
               coalesce(CAST(sum(volume_hl) FILTER (WHERE recent) AS DOUBLE), 0.0) / 12.0 AS monetary
        FROM (SELECT *, sale_date >= CAST(DATE '{AS_OF}' - INTERVAL 12 MONTH AS DATE) AS recent FROM sales) GROUP BY 1)""",
)


@query("k11_rfm", "SELECT * FROM rfm", "rfm")
def _(spark, d):
    return S.rfm(sales(spark, d, "client_id", "sale_date", "volume_hl"), AS_OF)


@query(
    "k12_rfm_segment",
    "SELECT client_id, recency, frequency, monetary, CASE WHEN recency = 1 THEN 'lost'"
    " WHEN recency >= 4 AND f >= CAST(2 AS DOUBLE)/3 AND m >= CAST(2 AS DOUBLE)/3 THEN 'champions'"
    " WHEN recency >= 4 AND f >= CAST(2 AS DOUBLE)/3 AND m >= CAST(1 AS DOUBLE)/3 THEN 'loyal'"
    " WHEN recency = 2 AND f >= CAST(2 AS DOUBLE)/3 AND m >= CAST(2 AS DOUBLE)/3 THEN 'at_risk' ELSE 'other' END AS segment"
    " FROM (SELECT *, percent_rank() OVER (ORDER BY frequency) AS f, percent_rank() OVER (ORDER BY monetary) AS m FROM rfm)",
    "rfm",
)
def _(spark, d):
    scores = S.rfm(sales(spark, d, "client_id", "sale_date", "volume_hl"), AS_OF)
    return S.rfm_segment(scores).select("client_id", "recency", "frequency", "monetary", "segment")


@query(
    "k16_volume_units",
    "SELECT client_id, CAST(volume_hl AS DOUBLE) AS volume_hl, CAST(volume_hl AS DOUBLE) * CAST(100 AS DOUBLE) AS volume_l,"
    " CAST(volume_hl AS DOUBLE) / CAST(10 AS DOUBLE) AS volume_m3 FROM sales",
    "sales",
)
def _(spark, d):
    rows = sales(spark, d, "client_id", "volume_hl")
    return as_doubles(rows.select("client_id", "volume_hl", *volume_units(F.col("volume_hl"))))
