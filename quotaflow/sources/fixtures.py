"""Canonical sales, targets and geography derived from the TPC-H-like test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import small_side

# Declared, so that opening a table starts no job to look into file footers.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_nationkey int",
    "part": "p_partkey long, p_name string, p_brand string, p_size int",
    "orders": "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double, l_discount double",
}


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _postal(nation: str):
    return F.lpad((F.lit(10_000_000) + F.col(nation) * 100_003).cast("string"), 8, "0")


def sales(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """One sale per order line; some flags and brands are null on purpose.

    All columns, or the named ones.  Every foreign key of the tables resolves
    (a test checks it), so a lookup none of whose columns is asked for is left
    out: it could neither drop nor repeat a sale.  Lines and orders are cut to what a
    sale needs before they meet, customers meet the orders and not the lines, and
    a lookup that passes the size check is broadcast.
    """
    line, order = source(spark, sf_dir, "lineitem").select(*_line_columns()), source(spark, sf_dir, "orders").select(*_order_columns())
    part, customer = source(spark, sf_dir, "part"), source(spark, sf_dir, "customer")
    available = _sale_columns()
    asked = {*columns} or {*available}
    if "postal_code" in asked:
        order = order.join(small_side(customer), F.col("client_id") == F.col("c_custkey"))
    joined = line.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
    if told := [c for c in ("brand", "material", "packaging_code") if c in asked]:
        lookup = part.select("p_partkey", *[_PART_COLUMNS[c] for c in told])
        joined = joined.join(small_side(lookup), F.col("material_id") == F.col("p_partkey"))
    return joined.select(*[available[c].alias(c) for c in columns or available])


def _line_columns() -> list[Column]:
    discount = F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)")
    return [
        F.col("l_orderkey"),
        F.col("l_partkey").alias("material_id"),
        ((F.col("l_orderkey") * 7 + F.col("l_partkey")) % 997 == 0).alias("unflagged"),
        ((F.col("l_orderkey") + F.col("l_partkey")) % 101 == 0).alias("unbranded"),
        F.col("l_quantity").cast("decimal(12,2)").alias("volume_hl"),
        (F.col("l_extendedprice").cast("decimal(12,2)") * discount).cast("decimal(18,4)").alias("revenue"),
    ]


def _order_columns() -> list[Column]:
    return [
        F.col("o_orderkey"),
        F.col("o_custkey").alias("client_id"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("urgent"),
        F.col("o_orderdate").cast("date").alias("sale_date"),
    ]


def _sale_columns() -> dict[str, Column]:
    return {
        "client_id": F.col("client_id"),
        "material_id": F.col("material_id"),
        "is_b2b": F.when(~F.col("unflagged"), F.col("urgent")),
        "volume_hl": F.col("volume_hl"),
        "revenue": F.col("revenue"),
        "sale_date": F.col("sale_date"),
        "packaging_code": F.col("p_size"),
        "brand": F.when(~F.col("unbranded"), F.col("p_brand")),
        "material": F.col("p_name"),
        "postal_code": _postal("c_nationkey"),
    }


_PART_COLUMNS = {"brand": "p_brand", "material": "p_name", "packaging_code": "p_size"}


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All brands for the years 2000 and 2001; those above 10 under a name that nobody sells."""
    number = F.substring("p_brand", 7, 10).cast("long")
    name = F.when(number <= 10, F.col("p_brand")).otherwise(F.concat(F.lit("Unsold "), "p_brand"))
    brands = source(spark, sf_dir, "part").select(name.alias("brand"), number.alias("_n")).distinct()
    year = F.explode(F.array(F.lit(2000), F.lit(2001)))
    return brands.select("brand", "_n", year.alias("target_year")).select(
        "brand", "target_year", (F.col("_n") * 1000 + (F.col("target_year") - 2000) * 500).alias("target_volume")
    )


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as cities and regions as states; nation 24 has a code no client has, so theirs is unknown."""
    nation, region = source(spark, sf_dir, "nation"), source(spark, sf_dir, "region")
    return (
        nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.when(F.col("n_nationkey") == 24, "99999999").otherwise(_postal("n_nationkey")).alias("postal_code"), F.col("n_name").alias("city"), F.col("r_name").alias("state"))
    )


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions in the place of the states table; one has another name, so one state is unknown."""
    return source(spark, sf_dir, "region").select(
        F.when(F.col("r_name") == "AFRICA", "ATLANTIS").otherwise(F.col("r_name")).alias("state"),
        F.concat(F.lit("Region "), "r_name").alias("state_name"),
        (F.col("r_regionkey") * 10).cast("double").alias("lat"),
        (F.col("r_regionkey") * -10).cast("double").alias("lon"),
    )
