"""Star schema: client, product and time dimensions and the sales fact."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import small_side, staged
from .cleaning import add_calendar, add_quarter
from .numbering import number_rows


@dataclass(frozen=True)
class Star:
    dim_client: DataFrame
    dim_product: DataFrame
    dim_time: DataFrame
    fact: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {
            "dim_client": self.dim_client,
            "dim_product": self.dim_product,
            "dim_time": self.dim_time,
            "fact_sales": self.fact,
        }


def clients(sales: DataFrame) -> DataFrame:
    """One row per client with the postal code of the latest purchase.

    Codes used on the same last day: the smallest.  The raw rows are reduced to
    client x code by a hash aggregate first; only that is compared as structs.
    """
    per_code = sales.groupBy("client_id", "postal_code").agg(F.max("sale_date").alias("_last"))
    preference = F.struct(
        F.col("postal_code").isNull().alias("unknown"),
        F.coalesce(-F.unix_date("_last"), F.lit(2**31 - 1)).alias("age"),
        F.col("postal_code"),
    )
    best = per_code.groupBy("client_id").agg(F.min(preference).alias("_best"))
    return best.select("client_id", F.col("_best.postal_code").alias("postal_code"))


def dim_client(sales: DataFrame) -> DataFrame:
    return number_rows(clients(sales), ["client_id"], "client_key")


def dim_product(sales: DataFrame, keep_null: bool = True) -> DataFrame:
    brands = sales.select("brand").distinct()
    if not keep_null:
        brands = brands.na.drop()
    return number_rows(brands, ["brand"], "product_key")


def dim_time(sales: DataFrame) -> DataFrame:
    """The calendar bounds the rows, so one window over the distinct dates numbers them."""
    key = F.row_number().over(Window.orderBy(F.asc_nulls_first("sale_date"))).cast("long")
    dates = sales.select("sale_date").distinct().select(key.alias("time_key"), "sale_date")
    return dates.transform(add_calendar).transform(add_quarter)


def with_client_key(sales: DataFrame, dim: DataFrame) -> DataFrame:
    return sales.join(small_side(dim.select("client_id", "client_key")), "client_id", "left")


def with_product_key(sales: DataFrame, dim: DataFrame) -> DataFrame:
    """Null brands find no partner and keep a null key."""
    return sales.join(small_side(dim.select("brand", "product_key")), "brand", "left")


def with_time_key(sales: DataFrame, dim: DataFrame) -> DataFrame:
    return sales.join(small_side(dim.select("sale_date", "time_key")), "sale_date", "left")


def build_dimensions(sales: DataFrame, variant: str = "local") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Client, product and time dimension of a variant (see ``build_star``)."""
    notebook = {"local": False, "notebook": True}[variant]
    # Numbering writes each dimension once; the three do not wait for each other.
    with ThreadPoolExecutor(3) as pool:
        jobs = [
            pool.submit(dim_client, sales),
            pool.submit(dim_product, sales, keep_null=not notebook),
            pool.submit(dim_time, sales),
        ]
    client, product, time = [job.result() for job in jobs]
    return client, product, time.drop("year_month" if notebook else "quarter")


def fact_sales(sales: DataFrame, client: DataFrame, product: DataFrame, time: DataFrame, variant: str = "local") -> DataFrame:
    """A row per sale with the keys of its dimensions."""
    keyed = (
        sales.transform(with_client_key, client)
        .transform(with_product_key, product)
        .transform(with_time_key, time)
    )
    keys = ["client_key", "time_key", "product_key"] + (["sale_date"] if variant == "notebook" else [])
    return keyed.select(*keys, "volume_hl", "revenue", "is_b2b")


# The columns of the sales a star is built from.
NEEDED = ("client_id", "brand", "sale_date", "postal_code", "volume_hl", "revenue", "is_b2b")


def build_star(sales: DataFrame, variant: str = "local", stage: bool = True) -> Star:
    """``local``: year-month in the time dimension, null brand is a member.

    ``notebook``: quarter in the time dimension, null brand left out, date kept
    in the fact.

    The three dimensions and the fact each read the sales, so their columns are written
    once; ``stage=False`` is for sales that are a written table already.
    """
    if stage:
        sales = staged(sales.select(*NEEDED), "star-sales")
    dimensions = build_dimensions(sales, variant)
    return Star(*dimensions, fact_sales(sales, *dimensions, variant))


def fact_with_brand(fact: DataFrame, product: DataFrame) -> DataFrame:
    return fact.join(small_side(product), "product_key", "left")
