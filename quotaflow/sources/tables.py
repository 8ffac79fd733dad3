"""Catalog tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import places


def create_database(spark: SparkSession, db: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{where}")


def register(df: DataFrame, db: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Saves ``df`` as a managed table, replacing it, and returns the table."""
    full = f"{db}.{name}"
    df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true").saveAsTable(full)
    return df.sparkSession.table(full)


def _pointer(spark: SparkSession, db: str) -> str:
    return f"{spark.catalog.getDatabase(db).locationUri.rstrip('/')}/_current"


def _versions(spark: SparkSession, db: str) -> dict[str, str]:
    """Name of each published table and of the table that holds its rows now."""
    return (places.pointed(spark, _pointer(spark, db)) or {}).get("tables", {})


def publish(results: Mapping[str, DataFrame], db: str, keep: int = 2) -> dict[str, DataFrame]:
    """Serving tables of all results, each in a table of a new version.

    When all are written, one pointer makes them current together: ``snapshot`` and ``table`` follow it and never mix
    versions.  Views with the plain names, for SQL, are renewed after it, one after the other.  What is
    published under other names stays.  The last ``keep`` versions stay for those who are reading them; older ones are dropped.
    """
    if not results:
        return {}
    spark = next(iter(results.values())).sparkSession
    before, version = _versions(spark, db), uuid.uuid4().hex[:12]
    names = {name: f"{name}__{version}" for name in results}
    try:
        for name, df in results.items():
            register(df, db, names[name])
    except Exception:
        for name in names.values():
            spark.sql(f"DROP TABLE IF EXISTS {db}.{name}")
        raise
    fallen = places.point(spark, _pointer(spark, db), {"tables": before | names}, keep)
    for name, full in names.items():
        spark.sql(f"CREATE OR REPLACE VIEW {db}.{name} AS SELECT * FROM {db}.{full}")
    held = {t for n in range(keep) for t in _held(spark, db, n).values()}
    for old in {t for content in fallen for t in content.get("tables", {}).values()} - held:
        spark.sql(f"DROP TABLE IF EXISTS {db}.{old}")
    found = snapshot(spark, db)
    return {name: found[name] for name in results}


def _held(spark: SparkSession, db: str, back: int) -> dict[str, str]:
    """What was current ``back`` versions ago, as far as it is kept."""
    return (places.pointed(spark, _pointer(spark, db), back) or {}).get("tables", {})


def snapshot(spark: SparkSession, db: str) -> dict[str, DataFrame]:
    """All published tables, as of one moment."""
    return {name: spark.table(f"{db}.{full}") for name, full in _versions(spark, db).items()}


def table(spark: SparkSession, name: str) -> DataFrame:
    """A table of the catalog; of a published one the current version."""
    db, _, plain = name.rpartition(".")
    full = _versions(spark, db).get(plain) if db and spark.catalog.databaseExists(db) else None
    return spark.table(f"{db}.{full}" if full else name)


def write_clustered(df: DataFrame, name: str, keys: Sequence[str], n: int, files: int = 8) -> DataFrame:
    """Table bucketed and sorted by the lookup keys; joins on them need no shuffle.

    Rows are sent to the task of their bucket beforehand, else every task would
    write a file per bucket.  ``files`` tasks share a bucket, so that a key with
    very many rows does not fall to one task.
    """
    bucket = F.pmod(F.hash(*keys), F.lit(n))
    share = F.pmod(F.xxhash64(*df.columns), F.lit(files))
    (
        df.repartition(n * files, bucket, share)
        .write.bucketBy(n, *keys)
        .sortBy(*keys)
        .mode("overwrite")
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)
