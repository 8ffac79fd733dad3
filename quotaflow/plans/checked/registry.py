"""Registry of queries and the inputs they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ...operators.customer import customer_view
from ...operators.geo import geo_totals, join_geography
from ...operators import star
from ...operators.numbering import number_as_they_come
from ...operators.targets import allocate_targets
from ...sources import fixtures
from ..oracle import YEAR, with_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None, *ctes: str):
    """Registers a query; ``sql`` may use the named CTEs."""

    def add(build: Callable[[SparkSession, str], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = build
        if sql is not None:
            ORACLES[key] = with_ctes(sql, *ctes) if ctes else sql
        return build

    return add


sales = fixtures.sales
targets = fixtures.targets
geography = fixtures.geography
states = fixtures.states


def view(spark: SparkSession, d: str, **options) -> DataFrame:
    needed = ("client_id", "sale_date", "volume_hl", "revenue", "is_b2b")
    return customer_view(sales(spark, d, *needed), **options)


def client_targets(spark: SparkSession, d: str, **options) -> DataFrame:
    return allocate_targets(sales(spark, d, "client_id", "brand", "volume_hl"), targets(spark, d), YEAR, **options)


def in_order(df: DataFrame) -> DataFrame:
    """The rows with their place: shows the order they come in."""
    return number_as_they_come(df, "place")


def clients(spark: SparkSession, d: str) -> DataFrame:
    return star.dim_client(sales(spark, d, "client_id", "sale_date", "postal_code"))


def placed_clients(spark: SparkSession, d: str) -> DataFrame:
    last_codes = star.clients(sales(spark, d, "client_id", "sale_date", "postal_code"))
    return join_geography(last_codes, geography(spark, d))


def placed_sales(spark: SparkSession, d: str) -> DataFrame:
    return geo_totals(sales(spark, d, "client_id", "brand", "volume_hl", "revenue"), placed_clients(spark, d))
