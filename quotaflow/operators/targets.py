"""Targets of a brand handed down to its clients, and the checks on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bands
from ..sources.scratch import is_small, small_side
from .columns import cents, known, ratio, total
from .numbering import number_rows

# Share of the rows from which a brand is joined without a shuffle.
HOT = 0.01


def targets_for_year(targets: DataFrame, year: int | None) -> DataFrame:
    return targets if year is None else targets.where(F.col("target_year") == year)


def volume_by_client_brand(sales: DataFrame) -> DataFrame:
    return sales.groupBy("client_id", "brand").agg(F.sum("volume_hl").alias("client_volume"))


def volume_by_brand(sales: DataFrame) -> DataFrame:
    return sales.groupBy("brand").agg(F.sum("volume_hl").alias("brand_volume"))


def _brand_totals(by_client: DataFrame) -> DataFrame:
    """Brand totals out of the client x brand sums, not out of the sales again."""
    return by_client.groupBy("brand").agg(F.sum("client_volume").alias("brand_volume"))


def participation(sales: DataFrame) -> DataFrame:
    """Each client's percentage of its brand; sales without brand are left out.

    A window over the brand would put all clients of a large brand into one
    task; one total per brand joined back does not.  Brands with at least ``HOT`` of the
    rows, which cannot be more than its inverse, are sent to every task; only the others' rows are
    shuffled, and no task gets more than its share of them.
    """
    by_client = volume_by_client_brand(known(sales, "brand"))
    totals = by_client.groupBy("brand").agg(F.sum("client_volume").alias("brand_volume"), F.count(F.lit(1)).alias("_n"))
    rows = totals.agg(F.sum("_n")).scalar()
    is_hot = F.col("_n") >= rows * HOT
    hot, others = (totals.where(c).drop("_n") for c in (is_hot, ~is_hot))
    # At most 1 / HOT rows, whatever the sales.
    of_hot = by_client.join(F.broadcast(hot), "brand")
    rest = by_client.join(F.broadcast(hot.select("brand")), "brand", "left_anti").join(others, "brand")
    return of_hot.unionByName(rest).withColumn("share_pct", ratio(F.col("client_volume"), F.col("brand_volume")) * 100)


def allocate_targets(
    sales: DataFrame,
    targets: DataFrame,
    year: int | None,
    share_scale: int | None = None,
    exact: bool = False,
    history: tuple[str, str] | None = None,
) -> DataFrame:
    """Client targets in proportion to the client's past volume in the brand.

    ``share_scale=None`` multiplies the unrounded share and shows it rounded to
    2; ``share_scale=4`` rounds the share to 4 before multiplying.  ``exact``
    spreads the cents lost by rounding over the largest remainders, so that a
    brand's targets add up.  ``year=None`` takes all years, ``history`` limits
    the sales that count.  Brands without target, or without sales, vanish.
    Looks at the size of the targets first, which starts a job, as ``exact`` does.
    """
    if history is not None:
        sales = sales.where(F.col("sale_date").between(*[F.lit(d).cast("date") for d in history]))
    wanted = targets_for_year(targets, year).select("brand", "target_volume", "target_year")
    small = is_small(wanted)
    sized = F.broadcast if small else lambda df: df
    # Sales of brands without target leave before anything is summed or shuffled.
    sold = known(sales, "brand").join(sized(wanted.select("brand").distinct()), "brand", "left_semi")
    by_client = volume_by_client_brand(sold)
    # Brand-sized tables meet first, so one join touches the client rows.  It
    # has at most one row per wanted target, whose size is checked.
    plan = sized(wanted.join(_brand_totals(by_client), "brand"))
    shared = by_client.join(plan, "brand").withColumn(
        "_pct", ratio(F.col("client_volume"), F.col("brand_volume")) * 100
    )
    if exact:
        shared = _exact_targets(shared, small)
    elif share_scale is None:
        shared = shared.withColumn("client_target", F.round(F.col("_pct") / 100 * F.col("target_volume"), 2))
    else:
        rounded = F.round("_pct", share_scale)
        shared = shared.withColumn("client_target", F.round(F.col("target_volume") * rounded / 100, 2))
    return shared.select(
        "client_id",
        "brand",
        "target_year",
        "client_volume",
        "brand_volume",
        F.round("_pct", 2 if share_scale is None else share_scale).alias("share_pct"),
        "target_volume",
        "client_target",
    )


def _exact_targets(shared: DataFrame, small: bool) -> DataFrame:
    """Largest-remainder rounding to cents within each brand and year.

    Places within a brand come from one numbering of all rows, so that a brand
    with very many clients is still spread over many tasks.
    """
    in_cents = F.col("_pct") / 100 * F.col("target_volume") * 100
    split = shared.withColumn("_base", F.floor(in_cents)).withColumn("_rest", in_cents - F.col("_base"))
    group = ["brand", "target_year"]
    placed = number_rows(split, [*group, F.desc("_rest"), "client_id"], "_n")
    per_brand = placed.groupBy(*group).agg(
        F.min("_n").alias("_first"),
        F.count(F.lit(1)).alias("_rows"),
        (F.max("target_volume") * 100 - F.sum("_base")).alias("_left"),
    )
    if small:
        per_brand = F.broadcast(per_brand)
    everyone = F.floor(F.col("_left") / F.col("_rows"))
    extra = (F.col("_n") - F.col("_first") < F.col("_left") - everyone * F.col("_rows")).cast("long")
    return placed.join(per_brand, group).withColumn(
        "client_target", (F.col("_base") + everyone + extra) / F.lit(100.0)
    )


def reconcile_targets(client_targets: DataFrame, mode: str = "local", with_pct: bool = False) -> DataFrame:
    """Brand target against the sum of its client targets.

    ``local`` groups by brand, year and target; ``notebook`` by brand and year with
    the largest target.  ``with_pct`` adds the difference in percent of the target.
    """
    if mode == "local":
        keys = ["brand", "target_year", "target_volume"]
        sums = client_targets.groupBy(*keys).agg(F.sum(cents("client_target")).alias("_sum"))
    elif mode == "notebook":
        target = F.max("target_volume").alias("target_volume")
        sums = client_targets.groupBy("brand", "target_year").agg(F.sum(cents("client_target")).alias("_sum"), target)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    gap = F.col("target_volume") - F.col("_sum")
    result = sums.withColumns(
        {"client_target_sum": F.col("_sum").cast("double"), "difference": gap.cast("double")}
    )
    if with_pct:
        result = result.withColumn("difference_pct", F.round(ratio(gap, F.col("target_volume")) * 100, 2))
    return result.drop("_sum")


def reconciliation_check(client_targets: DataFrame) -> DataFrame:
    """Check row: how many brands do not add up to their target."""
    off = F.count_if(F.col("difference") != 0)
    return reconcile_targets(client_targets).agg(
        F.lit("client targets add up to the brand target").alias("check"),
        (off == 0).alias("passed"),
        F.concat(off.cast("string"), F.lit(" brands differ")).alias("detail"),
    )


def target_by_brand(client_targets: DataFrame) -> DataFrame:
    return (
        client_targets.groupBy("brand")
        .agg(total(cents("client_target")).alias("total_target"), F.count("client_id").alias("clients"))
        .orderBy(F.desc("total_target"), "brand")
    )


def ordered_targets(client_targets: DataFrame) -> DataFrame:
    return client_targets.orderBy("brand", F.desc("client_target"), "client_id")


def brands_with_target(brands: DataFrame, targets: DataFrame, present: bool = True) -> DataFrame:
    """Rows of ``brands`` whose brand has (or has not) a target."""
    return brands.join(small_side(targets.select("brand")), "brand", "left_semi" if present else "left_anti")


def with_abc_class(client_targets: DataFrame) -> DataFrame:
    return client_targets.withColumn("abc_class", bands.abc_class(F.col("share_pct")))


def target_attainment(sales: DataFrame, client_targets: DataFrame, year: int | None = None) -> DataFrame:
    """Volume sold in the target's year against the client target; no sale counts as 0.

    ``year`` takes the targets of that year only, None each target with its own year.
    """
    if year is not None:
        # A date range, unlike a comparison of the year, reaches the Parquet scan.
        first, last = (F.lit(f"{year:04d}-{day}").cast("date") for day in ("01-01", "12-31"))
        sales = sales.where(F.col("sale_date").between(first, last))
    keys = ["client_id", "brand", "target_year"]
    actual = (
        sales.withColumn("target_year", F.year("sale_date"))
        .groupBy(*keys)
        .agg(F.sum("volume_hl").cast("double").alias("actual_volume"))
    )
    sold = F.coalesce(F.col("actual_volume"), F.lit(0.0))
    return (
        targets_for_year(client_targets, year)
        .select(*keys, "client_target")
        .join(actual, keys, "left")
        .withColumn("actual_volume", sold)
        .withColumn("attainment_pct", ratio(F.col("actual_volume"), F.col("client_target")) * 100)
        .withColumn("attainment_band", bands.attainment_band(F.col("attainment_pct")))
    )
