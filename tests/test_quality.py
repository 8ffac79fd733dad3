import frames
import pytest

from quotaflow.operators import quality as Q


@pytest.fixture()
def df(spark):
    return spark.createDataFrame([(1, "a", 2.0), (2, None, float("nan")), (3, None, None), (4, "b", 4.0)], "i long, s string, d double")


def test_null_profile_counts_null_but_not_nan(df):
    assert [tuple(r) for r in Q.null_profile(df).collect()] == [("i", 4, 0, 0.0), ("s", 2, 2, 50.0), ("d", 3, 1, 25.0)]
    assert {r.null_pct for r in Q.null_profile(df.limit(0)).collect()} == {0.0}


def test_describe(df):
    got = {r.column_name: r for r in Q.describe(df.drop("d")).collect()}
    assert (got["i"]["count"], got["i"].mean, got["i"].min, got["i"].max) == (4, 2.5, "1", "4")
    assert got["i"].stddev == pytest.approx(1.2909944487)
    assert (got["s"]["count"], got["s"].mean, got["s"].min, got["s"].max) == (2, None, "a", "b")


def test_statistics_of_numbers_need_no_sorted_aggregate(df):
    split = Q.describe_written(df)
    assert frames.rows(split.where("column_name <> 'd'")) == frames.rows(Q.describe(df.drop("d")))
    numbers, texts = split._jdf.queryExecution().executedPlan().toString().split("partial_count(s", 1)
    assert "SortAggregate" not in Q.describe(df.drop("s"))._jdf.queryExecution().executedPlan().toString() and "partial_stddev" not in texts
    assert "partial_count(i" in numbers


def test_schema_size_and_guard(df):
    assert [tuple(r) for r in Q.schema_report(df).collect()] == [("i", 1, "bigint", 4), ("s", 2, "string", 2), ("d", 3, "double", 3)]
    assert tuple(Q.table_size(df).first()) == (3, 4)
    assert Q.has_columns(df, "i", "s") and not Q.has_columns(df, "i", "x")
    assert [tuple(r) for r in Q.column_guard(df, ["s", "x"]).collect()] == [("s", True, 2), ("x", False, 0)]


def test_clean_report_names_columns_with_nulls(df):
    assert [tuple(r) for r in Q.clean_report(df).collect()] == [("s", 2, "Não informado"), ("d", 1, "0")]


def test_checks(spark, df):
    assert tuple(Q.check_not_empty(df, "t").first()) == ("t is not empty", True, "has rows")
    assert tuple(Q.check_not_empty(df.limit(0), "t").first()) == ("t is not empty", False, "no rows")
    assert tuple(Q.no_nulls_check(df, ["i", "s"], "t").first())[1:] == (False, "2")
    dead = spark.createDataFrame([(0.0, None)], "a double, b double")
    assert not Q.metrics_check(dead, ["a", "b"], "view").first().passed


def test_counts_and_summary(spark, df):
    assert frames.rows(Q.row_counts({"all": df, "none": df.limit(0)})) == [("all", 4), ("none", 0)]
    assert Q.run_summary(spark, [("clean", 4, 0.5, None)]).first().rows == 4
