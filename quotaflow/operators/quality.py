"""Profiles and named checks, as tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import NOT_INFORMED
from .star import Star


def _per_column(df: DataFrame, columns: Sequence[str], fields: Mapping[str, callable]) -> DataFrame:
    """One aggregate over the table, then one row per column.

    ``fields`` gives for each output field the aggregate of a column.
    """
    row = df.agg(
        F.array(
            *[F.struct(F.lit(c).alias("column_name"), *[make(c).alias(n) for n, make in fields.items()]) for c in columns]
        ).alias("rows")
    )
    return row.select(F.inline("rows"))


def schema_report(df: DataFrame) -> DataFrame:
    """Position, type and filled rows of every column."""
    place = {f.name: (i + 1, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)}
    return _per_column(
        df,
        df.columns,
        {
            "position": lambda c: F.lit(place[c][0]),
            "data_type": lambda c: F.lit(place[c][1]),
            "filled": lambda c: F.count(c),
        },
    )


def table_size(df: DataFrame) -> DataFrame:
    return df.agg(F.lit(len(df.columns)).alias("columns"), F.count(F.lit(1)).alias("rows"))


def describe(df: DataFrame) -> DataFrame:
    """count, mean, sample deviation, least and greatest of number and text columns."""
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    textual = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    nothing = F.lit(None).cast("double")
    return _per_column(
        df,
        [c for c in df.columns if c in numeric | textual],
        {
            "count": F.count,
            "mean": lambda c: F.try_divide(F.sum(c).cast("double"), F.count(c)) if c in numeric else nothing,
            "stddev": lambda c: F.stddev_samp(c) if c in numeric else nothing,
            "min": lambda c: F.min(c).cast("string"),
            "max": lambda c: F.max(c).cast("string"),
        },
    )


def describe_written(df: DataFrame) -> DataFrame:
    """``describe`` of a written table, numbers and texts apart: one hash aggregate cannot hold the least of a text."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return describe(df.drop(*texts)).unionByName(describe(df.select(*texts)))


def null_profile(df: DataFrame) -> DataFrame:
    """Filled and null rows and null percentage per column, in one pass; NaN is not null."""
    rows = F.count(F.lit(1))
    pct = lambda c: F.coalesce(F.try_divide((rows - F.count(c)).cast("double"), rows.cast("double")) * 100, F.lit(0.0))
    return _per_column(
        df,
        df.columns,
        {"filled": F.count, "nulls": lambda c: rows - F.count(c), "null_pct": pct},
    )


def clean_report(before: DataFrame) -> DataFrame:
    """What the filling policy will put in, per column that has nulls."""
    kinds = {}
    for f in before.schema.fields:
        if isinstance(f.dataType, T.NumericType):
            kinds[f.name] = "0"
        elif isinstance(f.dataType, T.BooleanType):
            kinds[f.name] = "False"
        elif isinstance(f.dataType, T.StringType):
            kinds[f.name] = NOT_INFORMED
    return _per_column(
        before,
        list(kinds),
        {"filled_nulls": lambda c: F.count_if(F.col(c).isNull()), "filled_with": lambda c: F.lit(kinds[c])},
    ).where(F.col("filled_nulls") > 0)


def row_counts(stages: Mapping[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.lit(name).alias("stage"), F.count(F.lit(1)).alias("rows")) for name, df in stages.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def has_columns(df: DataFrame, *columns: str) -> bool:
    return set(columns) <= set(df.columns)


def column_guard(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """For each wanted column whether it is there, and how many rows fill it."""
    return _per_column(
        df,
        list(wanted),
        {
            "present": lambda c: F.lit(c in df.columns),
            "filled": lambda c: F.count(c) if c in df.columns else F.count(F.lit(None).cast("string")),
        },
    )


def check(name: str, passed: Column, detail: Column) -> list[Column]:
    return [F.lit(name).alias("check"), passed.alias("passed"), detail.cast("string").alias("detail")]


def check_not_empty(df: DataFrame, name: str) -> DataFrame:
    """Check row instead of a warning; looks at one row at most."""
    return df.limit(1).agg(
        *check(
            f"{name} is not empty",
            F.count(F.lit(1)) > 0,
            F.when(F.count(F.lit(1)) > 0, "has rows").otherwise("no rows"),
        )
    )


def no_nulls_check(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    bad = F.count_if(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns]))
    return df.agg(*check(f"{name}: no nulls in {', '.join(columns)}", bad == 0, bad))


def metrics_check(view: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Passed unless every metric of every row is zero or unknown."""
    alive = F.count_if(reduce(lambda a, b: a | b, [F.coalesce(F.col(c) != 0, F.lit(False)) for c in columns]))
    return view.agg(*check(f"{name}: metrics are not all zero", alive > 0, alive))


def star_integrity(star: Star, sales: DataFrame) -> DataFrame:
    """Every key of the fact is in its dimension, and the fact has the sales' rows.

    One pass over the fact counts its rows by each of the three keys (grouping sets), so the
    fact is worked out once; the join sees one row per key.
    """
    dims = {"client_key": star.dim_client, "product_key": star.dim_product, "time_key": star.dim_time}
    counted = star.fact.groupingSets([(k,) for k in dims], *dims).agg(
        F.count(F.lit(1)).alias("_n"), *[F.grouping(k).alias(f"_no_{k}") for k in dims]
    )
    of_kind = lambda made: F.coalesce(*[F.when(F.col(f"_no_{k}") == 0, made(k)) for k in dims])
    used = counted.select(of_kind(F.lit).alias("_kind"), of_kind(lambda k: F.col(k).cast("long")).alias("_key"), "_n")
    members = [df.select(F.lit(k).alias("_kind"), F.col(k).cast("long").alias("_key")).distinct() for k, df in dims.items()]
    known = reduce(DataFrame.unionByName, members).withColumn("_known", F.lit(True))
    orphan = F.col("_key").isNotNull() & F.col("_known").isNull()
    rows = F.coalesce(F.sum(F.when(F.col("_kind") == "client_key", F.col("_n"))), F.lit(0))
    found = used.join(known, ["_kind", "_key"], "left").agg(
        rows.alias("_rows"), *[F.count_if(orphan & (F.col("_kind") == k)).alias(k) for k in dims]
    )
    found = found.withColumn("_sold", sales.agg(F.count(F.lit(1))).scalar())
    checks = [check(f"fact {k} is in its dimension", F.col(k) == 0, F.col(k)) for k in dims]
    checks.append(check("fact has one row per sale", F.col("_rows") == F.col("_sold"), F.col("_rows")))
    return found.select(F.inline(F.array(*[F.struct(*c) for c in checks])))


SUMMARY = "step string, rows long, seconds double, output string"


def run_summary(spark: SparkSession, steps: Sequence[tuple]) -> DataFrame:
    """One row per step of a run."""
    return spark.createDataFrame(list(steps), SUMMARY)
