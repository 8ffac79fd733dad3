"""Session settings the library relies on."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

def build_session(app: str = "quotaflow", **conf: str) -> SparkSession:
    """A session in UTC; everything else is left to the cluster's defaults."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def shuffle_partitions(spark: SparkSession, number: int | None) -> Iterator[None]:
    """The number of shuffle partitions for the work inside; the session's own afterwards.

    None leaves it alone.  Adaptive execution merges small partitions, so a number for
    the largest shuffle does for the others.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    try:
        if number is not None:
            spark.conf.set(key, str(number))
        yield
    finally:
        spark.conf.set(key, before)
