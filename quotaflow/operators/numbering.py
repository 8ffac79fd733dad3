"""Dense numbers, running totals and ranks over a global order, without one big task.

A window without partitioning would pull all rows into one task.  Here the rows
are range-partitioned, the ranges are written once (so that every later look at
them sees the same boundaries, also after losing executors), and only one row
per range (its size or sum) is accumulated to give each range its offset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import cut_lineage

_RANGE, _PLACE, _OFFSET = "_range", "_place", "_offset"


def _ranges(df: DataFrame, order: Sequence[Column | str], partitions: int | None) -> DataFrame:
    # Without a number adaptive execution merges neighbouring small ranges.
    ranges = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    ordered = ranges.sortWithinPartitions(*order)
    # The low 33 bits of the id count the rows of the partition from 0.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return cut_lineage(ordered.withColumn(_RANGE, F.spark_partition_id()).withColumn(_PLACE, place))


def _with_offsets(ranged: DataFrame, amount: Column) -> DataFrame:
    """Adds what the earlier ranges hold; the broadcast side has one row per range.

    Every row has its offset.  A left join says so to the optimizer, which then
    leaves the join out wherever the number itself is not read.
    """
    before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(_RANGE)
        .agg(amount.alias("_amount"))
        .select(_RANGE, F.coalesce(F.sum("_amount").over(before), F.lit(0)).alias(_OFFSET))
    )
    return ranged.join(F.broadcast(offsets), _RANGE, "left")


def number_rows(
    df: DataFrame, order: Sequence[Column | str], name: str, partitions: int | None = None
) -> DataFrame:
    """Adds 1, 2, 3 ... in the given order, which should be unique."""
    numbered = _with_offsets(_ranges(df, order, partitions), F.count(F.lit(1)))
    number = (F.col(_OFFSET) + F.col(_PLACE) + 1).cast("long").alias(name)
    return numbered.select(number, *df.columns)


def number_as_they_come(df: DataFrame, name: str) -> DataFrame:
    """Adds 1, 2, 3 ... in the order the rows come in, which an ``orderBy`` gave them: no task gets more than its range."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranges = cut_lineage(df.withColumn(_RANGE, F.spark_partition_id()).withColumn(_PLACE, place))
    numbered = _with_offsets(ranges, F.count(F.lit(1)))
    return numbered.select(*df.columns, (F.col(_OFFSET) + F.col(_PLACE) + 1).cast("long").alias(name))


def running_total(
    df: DataFrame, order: Sequence[Column | str], value: str, name: str, partitions: int | None = None
) -> DataFrame:
    """Adds the sum of ``value`` over all rows up to and including this one."""
    ranged = _with_offsets(_ranges(df, order, partitions), F.sum(value))
    so_far = Window.partitionBy(_RANGE).orderBy(_PLACE).rowsBetween(Window.unboundedPreceding, 0)
    return ranged.select(*df.columns, (F.col(_OFFSET) + F.sum(value).over(so_far)).alias(name))


def rank_cuts(df: DataFrame, column: str, fractions: Sequence[float]) -> DataFrame:
    """One row: for each fraction the least value whose percent rank reaches it.

    percent rank = rows below / (rows - 1).  It depends on the value alone and
    never falls, so comparing a value with the cut is comparing its rank with
    the fraction: no row has to be ranked or joined.  Columns ``cut_0`` ...
    """
    values = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_total(values, [column], "_n", "_upto")
    # All counts are summed before the single-row result; nothing is collected.
    rows = ranked.select(F.sum("_n")).scalar()
    percent = F.coalesce(
        F.try_divide((F.col("_upto") - F.col("_n")).cast("double"), (rows - 1).cast("double")), F.lit(0.0)
    )
    return ranked.agg(
        *[F.min(F.when(percent >= f, F.col(column))).alias(f"cut_{i}") for i, f in enumerate(fractions)]
    )
