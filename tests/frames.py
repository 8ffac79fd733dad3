"""Tiny hand-made frames."""

from datetime import date
from decimal import Decimal

SALES = (
    "client_id long, brand string, sale_date date, volume_hl decimal(12,2), revenue decimal(18,4), "
    "is_b2b boolean, postal_code string"
)


def day(text):
    return None if text is None else date.fromisoformat(text)


def sale(client, brand, when, volume, revenue=None, b2b=False, postal="01310100"):
    money = volume * 10 if revenue is None else revenue
    return (client, brand, day(when), Decimal(str(volume)), Decimal(str(money)), b2b, postal)


def sales(spark, *rows):
    return spark.createDataFrame([sale(*r) if isinstance(r, tuple) else sale(**r) for r in rows], SALES)


def targets(spark, *rows):
    return spark.createDataFrame(list(rows), "brand string, target_volume long, target_year int")


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is not None, v) for v in r))


def plan(df):
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()
