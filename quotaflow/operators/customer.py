"""Customer view: last purchase, trailing average volume and B2B share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import known, ratio

_MEASURE = {"volume": "volume_hl", "revenue": "revenue"}


def last_purchase(sales: DataFrame) -> DataFrame:
    return sales.groupBy("client_id").agg(F.max("sale_date").alias("last_purchase"))


def reference_date(sales: DataFrame) -> DataFrame:
    return sales.agg(F.max("sale_date").alias("reference_date"))


def _with_last(sales: DataFrame) -> DataFrame:
    """Daily sums per client, each with the client's last purchase.

    A client's rows are summed by day before the client is brought together,
    so a window partition has at most one row per calendar day, whatever share
    of the sales one client has.
    """
    b2b = F.coalesce(F.col("is_b2b"), F.lit(False))
    daily = (
        known(sales, "client_id")
        .groupBy("client_id", "sale_date")
        .agg(
            F.sum("volume_hl").alias("volume_hl"),
            F.sum("revenue").alias("revenue"),
            F.sum(F.when(b2b, F.col("revenue")).otherwise(0)).alias("b2b_revenue"),
            F.sum(F.when(b2b, F.col("volume_hl")).otherwise(0)).alias("b2b_volume"),
        )
    )
    last = F.max("sale_date").over(Window.partitionBy("client_id"))
    return daily.withColumn("last_purchase", last).withColumn(
        "months_from_last", F.months_between("last_purchase", "sale_date")
    )


def monthly_grain(sales: DataFrame) -> DataFrame:
    """Sums per client, year-month and exact distance to the last purchase.

    The distance is part of the grain, so this is one row per purchase day
    (days of one month only meet when their distance is the same, as at month
    ends).  The month is written out after the sums, so only where it is read.
    """
    sums = ("volume_hl", "revenue", "b2b_revenue", "b2b_volume")
    return (
        _with_last(sales)
        .groupBy("client_id", F.trunc("sale_date", "month").alias("_month"), "last_purchase", "months_from_last")
        .agg(*[F.sum(c).alias(c) for c in sums])
        .select("client_id", F.date_format("_month", "yyyy-MM").alias("year_month"), "last_purchase", "months_from_last", *sums)
    )


def _share(part: Column, whole: Column, scale: int | None) -> Column:
    pct = ratio(part, whole) * 100
    return pct if scale is None else F.round(pct, scale)


def _relative(sales, months, share, grain, scale):
    part, whole = f"b2b_{share}", _MEASURE[share]
    wanted = {"volume_hl", whole, part}
    if grain == "month":
        # Calendar months instead of days; each counts what falls in the window.
        base = _with_last(sales).withColumn("year_month", F.date_format("sale_date", "yyyy-MM"))
        sums = {
            f"{c}_{n}": F.sum(F.when(F.col("months_from_last") <= n, F.col(c))).alias(f"{c}_{n}")
            for n in months
            for c in wanted
        }
        base = base.groupBy("client_id", "last_purchase", "year_month").agg(*sums.values())
        window = {n: {c: F.col(f"{c}_{n}") for c in wanted} for n in months}
    else:
        base = monthly_grain(sales)
        window = {
            n: {c: F.when(F.col("months_from_last") <= n, F.col(c)) for c in wanted} for n in months
        }
    metrics = []
    for n in months:
        cols = window[n]
        average = ratio(F.sum(cols["volume_hl"]), F.count(cols["volume_hl"]))
        metrics.append(F.coalesce(average, F.lit(0.0)).alias(f"avg_volume_{n}m"))
    for n in months:
        cols = window[n]
        pct = F.when(F.sum(cols[whole]) > 0, _share(F.sum(cols[part]), F.sum(cols[whole]), scale))
        metrics.append(pct.otherwise(F.lit(0.0)).alias(f"b2b_share_{n}m"))
    return base.groupBy("client_id", "last_purchase").agg(*metrics)


def _fixed_end(sales, months, share, as_of: str | None, calendar: bool, scale):
    """Windows that end on one date for all clients: a single aggregate per client."""
    if as_of is None:
        # A scalar subquery: computed once, then a constant in the aggregate.
        end = reference_date(sales).scalar()
    else:
        end = F.lit(as_of).cast("date")
        sales = sales.where(F.col("sale_date") <= end)
    measure = F.col(_MEASURE[share])
    metrics = [F.max("sale_date").alias("last_purchase")]
    shares = []
    for n in months:
        inside = F.col("sale_date") >= F.add_months(end, -n)
        volume = F.when(inside, F.col("volume_hl"))
        whole = F.sum(F.when(inside, measure))
        part = F.sum(F.when(inside & F.col("is_b2b"), measure))
        if calendar:
            average = F.coalesce(F.sum(volume).cast("double"), F.lit(0.0)) / F.lit(float(n))
            part = F.coalesce(part, F.when(whole.isNotNull(), F.lit(0)))
        else:
            average = ratio(F.sum(volume), F.count(volume))
        metrics.append(average.alias(f"avg_volume_{n}m"))
        shares.append(_share(part, whole, scale).alias(f"b2b_share_{n}m"))
    return sales.groupBy("client_id").agg(*metrics, *shares)


def customer_view(
    sales: DataFrame,
    months: Sequence[int] = (3, 6),
    mode: str = "relative",
    share: str | None = None,
    grain: str = "day",
    as_of: str | None = None,
    share_scale: int | None | str = "default",
) -> DataFrame:
    """One row per client: last purchase, average volume and B2B share per window.

    ``relative``  windows end at the client's own last purchase; average per
                  purchase day (or per month with ``grain="month"``); share of
                  revenue rounded to 2; 0 where a window or its B2B part is empty.
    ``absolute``  windows end at the last date of all sales; average per sale;
                  share of volume, not rounded; null where nothing was sold, or
                  nothing B2B.
    ``calendar``  windows end at ``as_of`` (default: the last date of all
                  sales); average is window total / months; share of volume.

    Sales after ``as_of`` count for nothing, the last purchase included.
    """
    if mode == "relative":
        scale = 2 if share_scale == "default" else share_scale
        return _relative(sales, months, share or "revenue", grain, scale)
    if mode not in ("absolute", "calendar"):
        raise ValueError(f"unknown mode {mode!r}")
    scale = None if share_scale == "default" else share_scale
    return _fixed_end(sales, months, share or "volume", as_of, mode == "calendar", scale)
