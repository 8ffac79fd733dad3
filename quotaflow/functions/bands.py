"""Bands, scores and alerts of the KPI glossary.

Thresholds are fixed values of the glossary.  Where its bounds leave a gap the
chosen rule is said in the docstring.  An unknown input gives a null band.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def volume_band(avg_volume: Column) -> Column:
    return F.when(avg_volume > 50, "high").when(avg_volume >= 10, "medium").when(avg_volume < 10, "low")


def _shift(recent: Column, earlier: Column, slack: Column, up: str, down: str, same: str) -> Column:
    gap = recent - earlier
    return F.when(gap > slack, up).when(gap < -slack, down).when(gap.isNotNull(), same)


def volume_trend(recent: Column, longer: Column, tol: float = 0.05) -> Column:
    """Short against long average; within ``tol`` of the long one is stable."""
    return _shift(recent, longer, F.abs(longer) * tol, "growing", "declining", "stable")


def channel_shift(recent: Column, longer: Column, tol: float = 1.0) -> Column:
    """B2B share moving to wholesale or retail; within ``tol`` points is stable."""
    return _shift(recent, longer, F.lit(float(tol)), "to_wholesale", "to_retail", "stable")


def channel_band(share: Column) -> Column:
    """100 exclusive B2B, from 50 mostly B2B, above 0 mostly B2C, 0 exclusive B2C."""
    return (
        F.when(share >= 100, "exclusive_b2b")
        .when(share >= 50, "mostly_b2b")
        .when(share > 0, "mostly_b2c")
        .when(share <= 0, "exclusive_b2c")
    )


def days_since(last: Column, as_of: Column) -> Column:
    return F.datediff(as_of, last)


def months_since_last(last: Column, as_of: Column) -> Column:
    return F.months_between(as_of, last)


def activity_status(last: Column, as_of: Column) -> Column:
    days = days_since(last, as_of)
    return F.when(days < 30, "active").when(days <= 90, "at_risk").when(days > 90, "inactive")


def recency_score(last: Column, as_of: Column) -> Column:
    """5 (latest) to 1, on completed months, so that no month count falls in a gap."""
    months = F.floor(months_since_last(last, as_of))
    return (
        F.when(months <= 1, 5)
        .when(months <= 3, 4)
        .when(months <= 6, 3)
        .when(months <= 12, 2)
        .when(months > 12, 1)
    )


def recency_alert(last: Column, as_of: Column) -> Column:
    """30 to 60 days is ``watch``."""
    days = days_since(last, as_of)
    return (
        F.when(days > 90, "urgent")
        .when(days >= 60, "at_risk")
        .when(days >= 30, "watch")
        .when(days < 30, "active")
    )


def volume_alert(recent: Column, longer: Column) -> Column:
    return (
        F.when(recent < longer * 0.5, "sharp_decline")
        .when(recent > longer * 1.2, "fast_growth")
        .when((recent - longer).isNotNull(), "none")
    )


def abc_class(share: Column) -> Column:
    return F.when(share > 50, "A").when(share >= 20, "B").when(share < 20, "C")


def attainment_band(attainment: Column) -> Column:
    """80 to 100 % is ``on_track``."""
    return (
        F.when(attainment < 50, "critical")
        .when(attainment < 80, "below")
        .when(attainment > 100, "excellent")
        .when(attainment <= 100, "on_track")
    )
