import frames
import pytest

from quotaflow.operators import quality as Q
from quotaflow.operators import star as S


@pytest.fixture()
def sold(spark):
    return frames.sales(
        spark,
        dict(client=20, brand="B", when="2024-01-01", volume=1, postal="11111111"),
        dict(client=20, brand="A", when="2024-05-01", volume=2, postal="33333333"),
        dict(client=20, brand="A", when="2024-05-01", volume=3, postal="22222222"),
        dict(client=10, brand=None, when="2023-12-31", volume=4, postal=None),
        dict(client=10, brand="A", when="2023-01-01", volume=5, postal="44444444"),
        dict(client=None, brand="A", when="2024-01-01", volume=6, postal="55555555"),
    )


def test_one_row_per_client_with_latest_then_smallest_code(sold):
    assert frames.rows(S.dim_client(sold.na.drop(subset=["client_id"]))) == [(1, 10, "44444444"), (2, 20, "22222222")]


def test_two_codes_do_not_repeat_sales(sold):
    star = S.build_star(sold)
    assert star.fact.count() == sold.count()
    assert all(r.passed for r in Q.star_integrity(star, sold).collect())


def test_dimensions_per_variant(sold):
    local, notebook = S.build_star(sold), S.build_star(sold, "notebook")
    assert frames.rows(local.dim_product) == [(1, None), (2, "A"), (3, "B")]
    assert frames.rows(notebook.dim_product) == [(1, "A"), (2, "B")]
    assert local.dim_time.columns == ["time_key", "sale_date", "year", "month", "year_month"]
    assert notebook.dim_time.columns == ["time_key", "sale_date", "year", "month", "quarter"]
    assert notebook.fact.columns == ["client_key", "time_key", "product_key", "sale_date", "volume_hl", "revenue", "is_b2b"]
    with pytest.raises(KeyError):
        S.build_star(sold, "other")


def test_null_brand_keeps_a_null_key(sold):
    fact = S.build_star(sold).fact
    assert fact.where("product_key is null").count() == 1
    assert fact.where("client_key is null").count() == 1
    joined = S.fact_with_brand(fact, S.build_star(sold).dim_product)
    assert joined.count() == 6 and joined.where("brand is null").count() == 1


def test_large_dimensions_are_not_broadcast(sold, monkeypatch, shuffle_joins):
    monkeypatch.setattr(S, "small_side", lambda df: df)
    assert frames.plan(S.with_time_key(sold, S.dim_time(sold))).count("SortMergeJoin") >= 1
    assert S.build_star(sold).fact.count() == 6


def test_broken_star_fails_its_checks(sold):
    star = S.build_star(sold)
    broken = S.Star(star.dim_client.where("client_id = 10"), star.dim_product, star.dim_time, star.fact.limit(5))
    failed = {r.check for r in Q.star_integrity(broken, sold).where("not passed").collect()}
    assert failed == {"fact client_key is in its dimension", "fact has one row per sale"}


def counting(df, seen):
    """``df``, whose rows are counted each time they are worked out."""

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema)


def test_the_sales_are_worked_out_once(spark, sold):
    seen = spark.sparkContext.accumulator(0)
    assert S.build_star(counting(sold, seen)).fact.count() == 6 and seen.value == 6


def test_integrity_works_the_fact_out_once(spark, sold):
    star, seen = S.build_star(sold), spark.sparkContext.accumulator(0)
    counted = S.Star(star.dim_client, star.dim_product, star.dim_time, counting(star.fact, seen))
    assert all(r.passed for r in Q.star_integrity(counted, sold).collect()) and seen.value == 6
