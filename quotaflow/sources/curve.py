"""Tables laid out along a space-filling curve over several keys, with statistics that tell which files a lookup needs.

Each key's values are put into cells with about as many rows each, in the order of the values; the bits of a
row's cells, taken in turn, are its place on the curve.  Rows near on the curve are near in all keys, so each
file holds a short range of every key, and a lookup on any of them needs few files.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.numbering import running_total
from .scratch import small_side, staged

BITS, FILES = 8, 64


def _cells(df: DataFrame, key: str, bits: int) -> DataFrame:
    """The cell of each value of a key, by the number of rows up to it."""
    values = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    upto = running_total(values, [key], "_n", "_upto")
    rows = upto.agg(F.max("_upto")).scalar()
    cell = F.floor((F.col("_upto") - F.col("_n")) * (1 << bits) / rows).cast("long")
    return upto.select(F.col(key).alias(f"_value_{key}"), cell.alias(f"_cell_{key}"))


def _place(cells: Sequence[Column], bits: int) -> Column:
    """The cells' bits in turn, the highest first."""
    parts = [
        F.shiftleft(F.shiftright(cell, bit).bitwiseAND(F.lit(1)), bit * len(cells) + i)
        for bit in range(bits)
        for i, cell in enumerate(cells)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def write_curve(df: DataFrame, path: str, keys: Sequence[str], files: int = FILES, bits: int = BITS) -> DataFrame:
    """Writes ``df`` in about ``files`` files along the curve over ``keys``, and their statistics.

    The rows are written once before they are laid out, as each key's cells, the range bounds and the files read them.
    Values meet their cells by a join behind a size check.  A row number spreads rows of one place over the
    files, so a value that most rows share does not fall to one task.  A null key is in the first cell.
    Starts jobs: the values are numbered along their order.
    """
    df = staged(df, "curve-rows")
    spark, placed = df.sparkSession, df
    for key in keys:
        cells = small_side(_cells(df, key, bits))
        placed = placed.join(cells, placed[key] == cells[f"_value_{key}"], "left").drop(f"_value_{key}")
    at = _place([F.coalesce(F.col(f"_cell_{k}"), F.lit(0)) for k in keys], bits)
    placed = placed.select(*df.columns, at.alias("_place"), F.monotonically_increasing_id().alias("_row"))
    ordered = placed.repartitionByRange(files, "_place", "_row").sortWithinPartitions("_place", *keys)
    ordered.select(*df.columns).write.mode("overwrite").parquet(f"{path}/rows")
    written = spark.read.schema(df.schema).parquet(f"{path}/rows")
    _statistics(written, keys).coalesce(1).write.mode("overwrite").parquet(f"{path}/files")
    return written


def _statistics(written: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, ends and nulls of each key per file.

    The ends of texts are taken from their distinct values: an aggregate that holds a text sorts its
    input, and would sort all rows of a task.
    """
    of_file = written.select(F.col("_metadata.file_path").alias("file"), *keys)
    texts = [k for k in keys if isinstance(written.schema[k].dataType, (T.StringType, T.BinaryType))]
    ends = lambda k: [F.min(k).alias(f"least_{k}"), F.max(k).alias(f"most_{k}")]
    fixed = [e for k in keys if k not in texts for e in ends(k)]
    nulls = [F.count_if(F.col(k).isNull()).alias(f"nulls_{k}") for k in keys]
    stats = of_file.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), *fixed, *nulls)
    for k in texts:
        stats = stats.join(of_file.select("file", k).distinct().groupBy("file").agg(*ends(k)), "file")
    return stats


def files_for(spark: SparkSession, path: str, **equals) -> list[str]:
    """The files that may hold rows with these values of the keys."""
    stats = spark.read.parquet(f"{path}/files")
    for key, value in equals.items():
        if value is None:
            stats = stats.where(F.col(f"nulls_{key}") > 0)
        else:
            stats = stats.where(F.lit(value).between(F.col(f"least_{key}"), F.col(f"most_{key}")))
    return [r["file"] for r in stats.select("file").orderBy("file").collect()]


def lookup(spark: SparkSession, path: str, **equals) -> DataFrame:
    """The rows with these values of the keys; only files that may hold some are opened."""
    table = spark.read.parquet(f"{path}/rows")
    found = files_for(spark, path, **equals)
    rows = spark.read.schema(table.schema).parquet(*found) if found else table.limit(0)
    return rows.where(reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(v) for k, v in equals.items()]))
