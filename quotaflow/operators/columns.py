"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def total(column: str | Column) -> Column:
    """Exact decimal sum as a double; 0 over no rows."""
    col = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.sum(col).cast("double"), F.lit(0.0))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole in doubles; null where the whole is zero or unknown."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def cents(column: str) -> Column:
    """A value already rounded to two places, as an exact decimal."""
    return F.col(column).cast(T.DecimalType(20, 2))


def known(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which none of the columns is null or not a number.

    Written as plain predicates, which reach the Parquet scan.
    """
    for name in columns:
        col = df[name]
        df = df.where(col.isNotNull())
        if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            df = df.where(~F.isnan(col))
    return df


def distinct_counts(df: DataFrame, kinds: Mapping[str, Column], amount: Column, name: str) -> DataFrame:
    """One row: how many distinct values, nulls apart, each kind has, and the exact sum of ``amount`` as ``name``.

    Every row gives a (kind, value) pair for each kind, which the tasks already add up, so one pass and
    one aggregate serve all counts.
    """
    first = next(iter(kinds))
    pairs = F.array(*[
        F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("value"), F.when(F.lit(kind == first), amount).alias("amount"))
        for kind, value in kinds.items()
    ])
    sums = df.select(F.inline(pairs)).groupBy("kind", "value").agg(F.sum("amount").alias("amount"))
    counts = [F.count_if((F.col("kind") == kind) & F.col("value").isNotNull()).alias(kind) for kind in kinds]
    return sums.agg(*counts, total("amount").alias(name))


def top(df: DataFrame, n: int, by: str, *ties: str) -> DataFrame:
    """First ``n`` rows by ``by`` descending, ties broken ascending."""
    return df.orderBy(F.desc_nulls_last(by), *[F.asc(t) for t in ties]).limit(n)


def as_doubles(df: DataFrame, except_for: Iterable[str] = ()) -> DataFrame:
    """Decimal columns as doubles, for reports."""
    skip = set(except_for)
    return df.select(
        [
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType) and f.name not in skip
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
