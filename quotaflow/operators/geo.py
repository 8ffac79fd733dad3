"""Geography by postal code, and the roll-ups over it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text
from ..schemas import NOT_FOUND, NOT_INFORMED
from ..sources.scratch import small_side
from .cleaning import add_geo_placeholders
from .columns import distinct_counts, known, ratio, top, total
from .numbering import running_total
from .reports import filter_brand

# The 27 states with name, latitude and longitude of the capital.
STATES = [
    ("AC", "Acre", -9.0238, -70.8120),
    ("AL", "Alagoas", -9.5713, -36.7819),
    ("AP", "Amapá", 0.0389, -51.0664),
    ("AM", "Amazonas", -3.1190, -60.0217),
    ("BA", "Bahia", -12.9714, -38.5014),
    ("CE", "Ceará", -3.7172, -38.5433),
    ("DF", "Distrito Federal", -15.7939, -47.8828),
    ("ES", "Espírito Santo", -20.3155, -40.3128),
    ("GO", "Goiás", -16.6864, -49.2643),
    ("MA", "Maranhão", -2.5387, -44.2825),
    ("MT", "Mato Grosso", -15.6014, -56.0979),
    ("MS", "Mato Grosso do Sul", -20.4486, -54.6295),
    ("MG", "Minas Gerais", -19.9167, -43.9345),
    ("PA", "Pará", -1.4554, -48.4898),
    ("PB", "Paraíba", -7.1219, -34.8450),
    ("PR", "Paraná", -25.4195, -49.2646),
    ("PE", "Pernambuco", -8.0476, -34.8770),
    ("PI", "Piauí", -5.0949, -42.8042),
    ("RJ", "Rio de Janeiro", -22.9068, -43.1729),
    ("RN", "Rio Grande do Norte", -5.7945, -35.2110),
    ("RS", "Rio Grande do Sul", -30.0346, -51.2177),
    ("RO", "Rondônia", -8.7612, -63.9004),
    ("RR", "Roraima", 2.8235, -60.6758),
    ("SC", "Santa Catarina", -27.5954, -48.5480),
    ("SP", "São Paulo", -23.5505, -46.6333),
    ("SE", "Sergipe", -10.9472, -37.0731),
    ("TO", "Tocantins", -10.2491, -48.3243),
]


def states_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STATES, "state string, state_name string, lat double, lon double")


def _postal_table(geo: DataFrame) -> DataFrame:
    """One row per valid code, so that a join cannot multiply rows."""
    code = text.normalize_postal(F.col("postal_code"))
    return known(geo.withColumn("postal_code", code), "postal_code").groupBy("postal_code").agg(
        F.min("city").alias("city"), F.min("state").alias("state")
    )


def join_geography(df: DataFrame, geo: DataFrame) -> DataFrame:
    """City and state by postal code; null where the code is unknown."""
    return df.drop("city", "state").join(small_side(_postal_table(geo)), "postal_code", "left")


def _marked(column: str, missing: Column | None = None) -> Column:
    found = F.coalesce(F.col(column), F.lit(NOT_FOUND))
    return found if missing is None else F.when(missing, NOT_INFORMED).otherwise(found)


def apply_geography(dim: DataFrame, geo: DataFrame) -> DataFrame:
    """Sets city and state of the client dimension; "not found" in both if either fails.

    Clients without a postal code are not looked up and stay empty.
    """
    joined = join_geography(dim, geo)
    complete = F.col("city").isNotNull() & F.col("state").isNotNull()
    return joined.withColumns(
        {
            c: F.when(F.col("postal_code").isNotNull(), F.when(complete, F.col(c)).otherwise(NOT_FOUND))
            for c in ("city", "state")
        }
    )


def enrich_geography(df: DataFrame, geo: DataFrame) -> DataFrame:
    """City and state with markers: not informed, not found, not consulted.

    The code is normalised for the lookup only; the column itself is kept.
    """
    if "postal_code" not in df.columns:
        return add_geo_placeholders(df, consulted=False)
    missing = F.col("postal_code").isNull() | F.col("postal_code").isin("", NOT_INFORMED)
    lookup = small_side(_postal_table(geo)).withColumnRenamed("postal_code", "_code")
    return (
        df.drop("city", "state")
        .withColumn("_code", text.normalize_postal(F.col("postal_code")))
        .join(lookup, "_code", "left")
        .withColumns({c: _marked(c, missing) for c in ("city", "state")})
        .drop("_code")
    )


def propagate_geo(df: DataFrame, dim: DataFrame) -> DataFrame:
    """City and state of the client dimension on a table with few rows per client.

    A plain join: both sides are spread by client and no client has many rows.
    """
    return df.drop("city", "state").join(dim.select("client_id", "city", "state"), "client_id", "left")


def geo_sales(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Sales rows with the client's id, postal code, city and state."""
    columns = dim.select("client_key", "client_id", "postal_code", "city", "state")
    return fact.join(small_side(columns), "client_key", "left")


def geo_totals(sales: DataFrame, dim: DataFrame) -> DataFrame:
    """Client x brand sums with geography: what every roll-up below needs.

    Sales are summed per client and brand before the client dimension is
    joined, so the sales rows themselves are never shuffled for the join.
    """
    sums = sales.groupBy("client_id", "brand").agg(
        F.sum("volume_hl").alias("volume_hl"), F.sum("revenue").alias("revenue")
    )
    return propagate_geo(sums, dim)


def with_state_info(df: DataFrame, states: DataFrame) -> DataFrame:
    """State name and coordinates; an unknown state keeps its code as name."""
    return df.join(small_side(states), "state", "left").withColumn(
        "state_name", F.coalesce("state_name", "state")
    )


def filter_states(df: DataFrame, states: Sequence[str] | None = None) -> DataFrame:
    return df.where(F.col("state").isin(list(states))) if states else df


def geo_kpis(gs: DataFrame) -> DataFrame:
    """Distinct states, cities (by name alone) and clients, and the volume."""
    kinds = {"states": F.col("state"), "cities": F.col("city"), "clients": F.col("client_id")}
    return distinct_counts(gs, kinds, F.col("volume_hl"), "volume")


def _rollup(gs: DataFrame, *keys: str) -> DataFrame:
    return (
        known(gs, *keys)
        .groupBy(*keys)
        .agg(
            total("volume_hl").alias("volume"),
            total("revenue").alias("revenue"),
            F.countDistinct("client_id").alias("clients"),
        )
    )


def by_state(
    gs: DataFrame, states: DataFrame | None = None, brand: str | None = None, located: bool = False
) -> DataFrame:
    """Volume, revenue and clients by state, with name and place if ``states`` is given.

    ``located`` keeps the states that have coordinates.
    """
    rolled = _rollup(filter_brand(gs, brand), "state")
    if states is not None:
        rolled = with_state_info(rolled, states)
        if located:
            rolled = known(rolled, "lat", "lon")
    return rolled.orderBy(F.desc("volume"), "state")


def top_states(gs: DataFrame, n: int = 15, share: bool = False, brand: str | None = None) -> DataFrame:
    """``share`` adds each state's percentage of the ``n`` states."""
    best = top(_rollup(filter_brand(gs, brand), "state"), n, "volume", "state")
    if not share:
        return best
    # The window holds the n rows of the list.
    whole = F.sum(F.col("volume").cast("decimal(28,8)")).over(Window.partitionBy())
    return best.withColumn("share_pct", ratio(F.col("volume"), whole) * 100)


def by_city(gs: DataFrame, n: int | None = None) -> DataFrame:
    """Volume, revenue and clients by state and city; the first ``n`` with a label."""
    rolled = _rollup(gs, "state", "city").withColumn("city_state", text.city_label(F.col("city"), F.col("state")))
    if n is None:
        return rolled.orderBy(F.desc("volume"), "state", "city")
    return top(rolled, n, "volume", "state", "city")


def brand_state_volume(gs: DataFrame) -> DataFrame:
    return (
        known(gs, "brand", "state").groupBy("brand", "state").agg(total("volume_hl").alias("volume"))
    )


def brand_state_matrix(gs: DataFrame, states: Sequence[str]) -> DataFrame:
    """One row per brand, one column per state, 0 where nothing was sold."""
    cells = brand_state_volume(gs)
    return cells.groupBy("brand").pivot("state", list(states)).agg(F.max("volume")).na.fill(0.0)


def top_clients_in_state(gs: DataFrame, state: str, n: int = 20) -> DataFrame:
    keys = ("client_id", "city", "brand")
    sums = (
        known(gs.where(F.col("state") == state), *keys)
        .groupBy(*keys)
        .agg(total("volume_hl").alias("volume"), total("revenue").alias("revenue"))
    )
    return top(sums, n, "volume", *keys).withColumn("client_label", text.client_label(F.col("client_id")))


def geo_concentration(gs: DataFrame, level: str = "state") -> DataFrame:
    """Share of the total by state or city, and cumulated from the largest down."""
    keys = ["state"] if level == "state" else ["state", "city"]
    sums = known(gs, *keys).groupBy(*keys).agg(F.sum("volume_hl").alias("_volume"))
    upto = running_total(sums, [F.desc("_volume"), *keys], "_volume", "_upto")
    whole = upto.agg(F.sum("_volume")).scalar()
    return upto.select(
        *keys,
        F.col("_volume").cast("double").alias("volume"),
        (ratio(F.col("_volume"), whole) * 100).alias("share_pct"),
        (ratio(F.col("_upto"), whole) * 100).alias("cumulative_pct"),
    )


def enriched_count(dim: DataFrame) -> DataFrame:
    """How many clients have a city that was found."""
    found = F.col("city").isNotNull() & (F.col("city") != NOT_FOUND)
    return dim.agg(F.count_if(found).alias("enriched_clients"))
