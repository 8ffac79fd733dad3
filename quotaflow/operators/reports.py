"""The reporting questions: filters, KPI totals, top lists and scorecards.

Sales here are any table with client, brand, volume, revenue and flag; a
report groups by them and leaves out rows whose group is unknown.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from .columns import distinct_counts, cents, known, ratio, top, total


def filter_brands(df: DataFrame, brands: Sequence[str] | None = None) -> DataFrame:
    """No selection means no filter."""
    return df.where(F.col("brand").isin(list(brands))) if brands else df


def filter_brand(df: DataFrame, brand: str | None = None) -> DataFrame:
    return df.where(F.col("brand") == brand) if brand else df


def filter_channel(df: DataFrame, which: str | None = None) -> DataFrame:
    """``"B2B"``, ``"B2C"`` or no filter."""
    if which is None:
        return df
    return df.where(F.col("is_b2b") == {"B2B": True, "B2C": False}[which])


def min_volume(df: DataFrame, least: float, column: str = "avg_volume_3m") -> DataFrame:
    """Rows whose value is a number of at least ``least``."""
    # A NaN would compare as the greatest number.
    return known(df.withColumn(column, text.to_number(F.col(column))), column).where(F.col(column) >= least)


def min_target(df: DataFrame, least: float) -> DataFrame:
    return df.where(F.col("client_target") >= least)


def choices(df: DataFrame, column: str) -> DataFrame:
    return known(df.select(column).distinct(), column).orderBy(column)


def with_postal(df: DataFrame, dim: DataFrame) -> DataFrame:
    """A per-client table with the client's postal code and label."""
    return df.join(dim.select("client_id", "postal_code"), "client_id", "left").withColumn(
        "client_label", text.client_label(F.col("client_id"))
    )


def overview_kpis(
    sales: DataFrame, view: DataFrame, brands: Sequence[str] | None = None, channel: str | None = None
) -> DataFrame:
    """Transactions, volume and revenue of the selection; clients of the whole view."""
    chosen = filter_channel(filter_brands(sales, brands), channel)
    clients = view.agg(F.countDistinct("client_id")).scalar()
    return chosen.agg(
        F.count(F.lit(1)).alias("transactions"),
        total("volume_hl").alias("volume"),
        total("revenue").alias("revenue"),
    ).withColumn("clients", clients)


def top_brands(sales: DataFrame, by: str = "volume", n: int = 10, share: bool = False) -> DataFrame:
    """``share`` adds each brand's percentage of the ``n`` brands."""
    column = {"volume": "volume_hl", "revenue": "revenue"}[by]
    sums = known(sales, "brand").groupBy("brand").agg(F.sum(column).alias("_sum"))
    best = top(sums, n, "_sum", "brand")
    columns = ["brand", F.col("_sum").cast("double").alias(by)]
    if share:
        # The window holds the n rows of the list.
        whole = F.sum("_sum").over(Window.partitionBy())
        columns.append((ratio(F.col("_sum"), whole) * 100).alias("share_pct"))
    return best.select(*columns)


def channel_counts(sales: DataFrame) -> DataFrame:
    return (
        known(sales, "is_b2b")
        .groupBy(text.channel_name(F.col("is_b2b")).alias("channel"))
        .agg(F.count(F.lit(1)).alias("transactions"))
        .orderBy(F.desc("transactions"), "channel")
    )


def brand_scorecard(sales: DataFrame) -> DataFrame:
    """Volume, revenue, clients and average price per brand, largest volume first.

    Summed per brand and client first: counting clients then needs no second
    look at the sales, and a large brand is spread over its clients.
    """
    per_client = (
        known(sales, "brand")
        .groupBy("brand", "client_id")
        .agg(F.sum("volume_hl").alias("volume_hl"), F.sum("revenue").alias("revenue"))
    )
    return (
        per_client.groupBy("brand")
        .agg(
            total("volume_hl").alias("volume"),
            total("revenue").alias("revenue"),
            F.count("client_id").alias("clients"),
        )
        .withColumn("avg_price", ratio(F.col("revenue"), F.col("volume")))
        .orderBy(F.desc("volume"), "brand")
    )


def brand_detail(sales: DataFrame, client_targets: DataFrame, brand: str) -> DataFrame:
    """One brand: scorecard, and for each target year target, clients with target and the gap to the target."""
    target = (
        client_targets.where(F.col("brand") == brand)
        .groupBy("brand", "target_year")
        .agg(F.max("target_volume").alias("target_volume"), F.countDistinct("client_id").alias("target_clients"))
    )
    gap = F.col("target_volume") - F.col("volume")
    return (
        brand_scorecard(filter_brand(sales, brand))
        .join(target, "brand", "left")
        .withColumns({"gap": gap, "gap_pct": ratio(gap, F.col("volume")) * 100})
    )


def top_clients_of_brand(sales: DataFrame, brand: str | None = None, n: int = 10) -> DataFrame:
    """Largest clients of one brand, or of every brand when none is named."""
    sums = (
        known(filter_brand(sales, brand), "brand", "client_id")
        .groupBy("brand", "client_id")
        .agg(total("volume_hl").alias("volume"), total("revenue").alias("revenue"))
    )
    if brand:
        return top(sums, n, "volume", "client_id")
    # Spark keeps n rows per brand and task before the shuffle.
    place = F.row_number().over(Window.partitionBy("brand").orderBy(F.desc("volume"), "client_id"))
    return sums.withColumn("place", place).where(F.col("place") <= n)


def target_kpis(client_targets: DataFrame, brand: str | None = None, least: float = 0.0) -> DataFrame:
    """Total and clients of the selection; brands of the whole table."""
    chosen = F.col("client_target") >= least
    if brand:
        chosen &= F.col("brand") == brand
    kinds = {"clients": F.when(chosen, F.col("client_id")), "brands": F.col("brand")}
    counted = distinct_counts(client_targets, kinds, F.when(chosen, cents("client_target")), "total_target")
    return counted.select("total_target", "clients", "brands")


def top_clients_by_target(client_targets: DataFrame, n: int = 20) -> DataFrame:
    sums = known(client_targets, "client_id").groupBy("client_id").agg(
        total(cents("client_target")).alias("total_target")
    )
    return top(sums, n, "total_target", "client_id").withColumn(
        "client_label", text.client_label(F.col("client_id"))
    )


def target_hierarchy(client_targets: DataFrame) -> DataFrame:
    """Targets by brand and by client within brand, with the target-weighted mean share.

    The brand level sums the client level, which has a row per client and brand.
    """
    weight = cents("client_target")
    by_client = client_targets.groupBy("brand", "client_id").agg(
        F.sum(weight).alias("_weight"), F.sum(weight * F.col("share_pct").cast("decimal(9,4)")).alias("_weighted")
    )
    by_brand = by_client.groupBy("brand").agg(F.sum("_weight").alias("_weight"), F.sum("_weighted").alias("_weighted"))
    levels = by_client.withColumn("level", F.lit("client")).unionByName(
        by_brand.withColumns({"client_id": F.lit(None).cast("long"), "level": F.lit("brand")})
    )
    return levels.select(
        "brand",
        "client_id",
        F.coalesce(F.col("_weight").cast("double"), F.lit(0.0)).alias("total_target"),
        ratio(F.col("_weighted"), F.col("_weight")).alias("mean_share"),
        "level",
    )


def top_clients(view: DataFrame, by: str = "avg_volume_6m", n: int = 10, least: float | None = None) -> DataFrame:
    """Largest clients by a view column; ``least`` also drops what is not a number."""
    chosen = view if least is None else min_volume(known(view, by), least, by)
    return top(chosen, n, by, "client_id")


def top_participation(client_targets: DataFrame, n: int = 15) -> DataFrame:
    return top(client_targets, n, "share_pct", "brand", "client_id")


def compare_windows(view: DataFrame, least: float = 0.0) -> DataFrame:
    """3- against 6-month volume and share of the clients above a volume."""
    return min_volume(view, least).select(
        "client_id", "avg_volume_3m", "avg_volume_6m", "b2b_share_3m", "b2b_share_6m"
    )


def client_detail(view: DataFrame, n: int = 20, least: float = 0.0) -> DataFrame:
    """The display columns that exist, for the top clients."""
    wanted = [
        "client_id",
        "postal_code",
        "last_purchase",
        "avg_volume_3m",
        "avg_volume_6m",
        "b2b_share_3m",
        "b2b_share_6m",
    ]
    return top_clients(view, "avg_volume_3m", n, least).select([c for c in wanted if c in view.columns])


def browse(
    df: DataFrame, limit: int, brand: str | None = None, order: Sequence[str] | None = None
) -> DataFrame:
    """First rows in a stated order (all columns if none), each with the row count."""
    chosen = filter_brand(df, brand)
    rows = df.agg(F.count(F.lit(1))).scalar()
    return chosen.orderBy(*(order or df.columns)).limit(limit).withColumn("table_rows", rows)


def first_rows(df: DataFrame, n: int, order: Sequence[str] | None = None) -> DataFrame:
    return df.orderBy(*(order or df.columns)).limit(n)
