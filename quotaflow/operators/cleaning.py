"""Cleaning: dates, missing values, calendar columns, duplicates, names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text
from ..schemas import ESTIMATED_PRICE, NOT_CONSULTED, NOT_INFORMED
from ..sources.scratch import BROADCAST_BYTES, is_small, staged


def parse_dates(df: DataFrame, column: str = "sale_date", pattern: str = "yyyy-MM-dd") -> DataFrame:
    return df.withColumn(column, text.parse_date(F.col(column).cast("string"), pattern))


def _fill(df: DataFrame, kind: type | tuple[type, ...], value) -> DataFrame:
    filled = {
        f.name: F.coalesce(F.col(f.name), F.lit(value).cast(f.dataType))
        for f in df.schema.fields
        if isinstance(f.dataType, kind)
    }
    return df.withColumns(filled) if filled else df


def fill_numeric(df: DataFrame, value: int = 0) -> DataFrame:
    """Null numbers become ``value``: amounts, codes and ids alike; NaN stays."""
    return _fill(df, T.NumericType, value)


def fill_flag(df: DataFrame) -> DataFrame:
    return _fill(df, T.BooleanType, False)


def fill_text(df: DataFrame, marker: str = NOT_INFORMED) -> DataFrame:
    """Null texts become the marker, which from then on is a value like others."""
    return _fill(df, T.StringType, marker)


def add_calendar(df: DataFrame, column: str = "sale_date") -> DataFrame:
    date = F.col(column)
    return df.withColumns(
        {
            "year": F.year(date),
            "month": F.month(date),
            "year_month": F.date_format(date, "yyyy-MM"),
        }
    )


def add_quarter(df: DataFrame, column: str = "sale_date") -> DataFrame:
    return df.withColumn("quarter", F.quarter(F.col(column)))


def dedupe(df: DataFrame) -> DataFrame:
    """One of each set of fully equal rows.

    Equal rows already meet in the map-side aggregate, so a row repeated any
    number of times is shuffled once per task.
    """
    return df.dropDuplicates()


def dedupe_counted(df: DataFrame, limit: int = BROADCAST_BYTES) -> tuple[DataFrame, DataFrame]:
    """One of each set of fully equal rows, and a row with the number of rows before, after and dropped.

    Rows meet by a digest of 128 bits; only those whose digest occurs twice are compared as a whole, and shuffled.
    Should there be too many such digests to send them to every task, all rows are.  The rows are counted by the
    tasks that take the digests.  Starts a job.
    """
    seen = Observation()
    digest = {"_high": F.xxhash64(*df.columns), "_low": F.xxhash64(F.lit("low"), *reversed(df.columns))}
    keyed = df.withColumns(digest)
    counted = keyed.groupBy("_high", "_low").agg(F.count(F.lit(1)).alias("_n"))
    counted = counted.observe(seen, F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"))
    twice = staged(counted.where("_n > 1").select("_high", "_low"), "twice")
    rows = F.lit(seen.get["rows"]).cast("long")
    if is_small(twice, limit):
        again = keyed.join(F.broadcast(twice), ["_high", "_low"], "left_semi").select(*df.columns)
        once = keyed.join(F.broadcast(twice), ["_high", "_low"], "left_anti").select(*df.columns)
        unique = again.dropDuplicates()
        lost = again.agg(F.count(F.lit(1)).alias("_n")).select("_n", F.lit(0).alias("_m"))
        lost = lost.unionByName(unique.agg(F.count(F.lit(1)).alias("_m")).select(F.lit(0).alias("_n"), "_m"))
        dropped = lost.agg((F.sum("_n") - F.sum("_m")).alias("dropped"))
        kept = once.unionByName(unique)
    else:
        kept = df.dropDuplicates()
        dropped = kept.agg((rows - F.count(F.lit(1))).alias("dropped"))
    report = dropped.select(
        rows.alias("rows_before"), (rows - F.col("dropped")).alias("rows_after"), F.col("dropped").alias("dropped_rows")
    )
    return kept, report


def require_not_null(
    df: DataFrame, columns: Sequence[str] = ("client_id", "sale_date", "volume_hl")
) -> DataFrame:
    """Rows in which none of the columns is null; NaN is not null."""
    for name in columns:
        df = df.where(df[name].isNotNull())
    return df


def cast_types(df: DataFrame) -> DataFrame:
    """Volume as double and the flag as 0 / 1, as the notebook variant types them."""
    return df.withColumns(
        {"volume_hl": F.col("volume_hl").cast("double"), "is_b2b": F.col("is_b2b").cast("int")}
    )


def ensure_revenue(df: DataFrame, price: int = ESTIMATED_PRICE) -> DataFrame:
    """Adds revenue = volume x price only where the source has no revenue column."""
    if "revenue" in df.columns:
        return df
    return df.withColumn("revenue", F.col("volume_hl") * F.lit(price))


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Renames the columns that ``names`` mentions and leaves the rest."""
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def to_dialect(df: DataFrame, dialect: Mapping[str, str]) -> DataFrame:
    """The columns a dialect knows, under its names and in its order."""
    return df.select([F.col(ours).alias(theirs) for theirs, ours in dialect.items() if ours in df.columns])


def add_geo_placeholders(df: DataFrame, consulted: bool = True) -> DataFrame:
    """Empty city and state columns where absent, or the "not consulted" text."""
    value = F.lit(None if consulted else NOT_CONSULTED).cast("string")
    return df.withColumns({c: value for c in ("city", "state") if c not in df.columns})


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def detect_date_column(columns: Sequence[str], fragment: str = "data") -> str | None:
    """First column whose lower-cased name holds ``fragment``."""
    return next((c for c in columns if fragment in c.lower()), None)


def clean(sales: DataFrame, policy: str = "fill") -> DataFrame:
    """Cleaned sales.

    ``fill`` keeps every row and fills what is missing; ``drop`` removes equal
    rows and rows without client, date or volume.
    """
    if policy == "fill":
        return sales.transform(fill_numeric).transform(fill_flag).transform(fill_text).transform(add_calendar)
    if policy == "drop":
        return sales.transform(dedupe).transform(require_not_null).transform(ensure_revenue)
    raise ValueError(f"unknown cleaning policy {policy!r}")
