"""Customer segments over the view and the sales."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bands
from ..sources.scratch import cut_lineage
from .columns import known
from .numbering import rank_cuts


def segment_view(view: DataFrame, as_of: str, tol: float = 0.05, share_tol: float = 1.0) -> DataFrame:
    """The customer view with every band, score and alert of the glossary.

    Column expressions only: as many segments as wanted cost one pass.
    """
    date = F.lit(as_of).cast("date")
    v3, v6 = F.col("avg_volume_3m"), F.col("avg_volume_6m")
    s3, s6 = F.col("b2b_share_3m"), F.col("b2b_share_6m")
    last = F.col("last_purchase")
    return view.withColumns(
        {
            "volume_band": bands.volume_band(v3),
            "volume_trend": bands.volume_trend(v3, v6, tol),
            "volume_alert": bands.volume_alert(v3, v6),
            "activity_status": bands.activity_status(last, date),
            "months_since_last": bands.months_since_last(last, date),
            "recency_score": bands.recency_score(last, date),
            "recency_alert": bands.recency_alert(last, date),
            "channel_band": bands.channel_band(s3),
            "channel_shift": bands.channel_shift(s3, s6, share_tol),
        }
    )


def rfm(sales: DataFrame, as_of: str, months: int = 12) -> DataFrame:
    """Recency, number of transactions and mean monthly volume of the last months."""
    end = F.lit(as_of).cast("date")
    inside = (F.col("sale_date") >= F.add_months(end, -months)) & (F.col("sale_date") <= end)
    return (
        known(sales, "client_id")
        .groupBy("client_id")
        .agg(
            F.max(F.when(F.col("sale_date") <= end, F.col("sale_date"))).alias("last_purchase"),
            F.count_if(inside).alias("frequency"),
            (
                F.coalesce(F.sum(F.when(inside, F.col("volume_hl"))).cast("double"), F.lit(0.0))
                / F.lit(float(months))
            ).alias("monetary"),
        )
        .withColumn("months_since_last", bands.months_since_last(F.col("last_purchase"), end))
        .withColumn("recency", bands.recency_score(F.col("last_purchase"), end))
    )


def rfm_segment(scores: DataFrame) -> DataFrame:
    """champions, loyal, at_risk, lost or other.

    High and medium frequency and volume are the upper and middle third by
    percent rank; recency is high from score 4, low at 2, very low at 1.
    """
    thirds = (1.0 / 3.0, 2.0 / 3.0)
    scores = cut_lineage(scores)  # read three times below
    f_cuts = rank_cuts(scores, "frequency", thirds)
    m_cuts = rank_cuts(scores, "monetary", thirds)
    f_high = F.col("frequency") >= f_cuts.select("cut_1").scalar()
    m_high = F.col("monetary") >= m_cuts.select("cut_1").scalar()
    m_medium = (F.col("monetary") >= m_cuts.select("cut_0").scalar()) & ~m_high
    recent = F.col("recency") >= 4
    segment = (
        F.when(F.col("recency") == 1, "lost")
        .when(recent & f_high & m_high, "champions")
        .when(recent & f_high & m_medium, "loyal")
        .when((F.col("recency") == 2) & f_high & m_high, "at_risk")
        .otherwise("other")
    )
    return scores.withColumn("segment", segment)
