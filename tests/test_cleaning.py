from decimal import Decimal

import frames
import pytest
from pyspark.sql import functions as F

from quotaflow.functions import text
from quotaflow.operators import cleaning as C
from quotaflow.operators.columns import known

RAW = "client_id long, code long, volume_hl decimal(12,2), loss double, is_b2b boolean, brand string, sale_date string"


@pytest.fixture()
def raw(spark):
    nan = float("nan")
    return spark.createDataFrame(
        [
            (1, None, Decimal("1.50"), nan, True, "A", "2023-01-31"),
            (None, 7, None, None, None, None, "31/01/2023"),
            (2, 8, Decimal("2.00"), 1.0, False, "B", None),
        ],
        RAW,
    )


def test_bad_date_text_is_null(raw):
    found = [r.sale_date for r in C.parse_dates(raw).collect()]
    assert found == [frames.day("2023-01-31"), None, None]


def test_fill_numeric_covers_ids_and_decimals_but_not_nan(raw):
    first, second, _ = C.fill_numeric(raw).collect()
    assert first.code == 0 and first.loss != first.loss
    assert (second.client_id, second.volume_hl, second.loss) == (0, Decimal("0.00"), 0.0)
    assert second.brand is None and second.is_b2b is None


def test_fill_keeps_types(raw):
    assert C.clean(raw.drop("sale_date").withColumn("sale_date", F.lit(None).cast("date"))).dtypes[:6] == raw.dtypes[:6]


def test_fill_flag_and_text(raw):
    row = C.fill_text(C.fill_flag(raw)).collect()[1]
    assert row.is_b2b is False and row.brand == "Não informado"


def test_calendar_and_quarter(spark):
    df = frames.sales(spark, (1, "A", "2024-02-29", 1))
    row = C.add_quarter(C.add_calendar(df)).first()
    assert (row.year, row.month, row.year_month, row.quarter) == (2024, 2, "2024-02", 1)


def test_dedupe_needs_full_equality(spark):
    df = frames.sales(spark, (1, "A", "2024-01-01", 1), (1, "A", "2024-01-01", 1), (1, "A", "2024-01-01", 2))
    assert C.dedupe(df).count() == 2


def test_drop_policy(spark):
    df = frames.sales(spark, (1, None, "2024-01-01", 1), (1, None, "2024-01-01", 1), (None, "A", "2024-01-01", 1), (2, "A", None, 1))
    kept = C.clean(df, "drop")
    assert frames.rows(kept, "client_id", "brand") == [(1, None)]
    assert dict(C.cast_types(kept).dtypes)["volume_hl"] == "double"
    assert dict(C.cast_types(kept).dtypes)["is_b2b"] == "int"


def test_unknown_policy(spark):
    with pytest.raises(ValueError):
        C.clean(frames.sales(spark, (1, "A", "2024-01-01", 1)), "guess")


def test_estimated_revenue_only_when_absent(spark):
    df = frames.sales(spark, (1, "A", "2024-01-01", 2, 7))
    assert C.ensure_revenue(df).first().revenue == Decimal("7.0000")
    assert C.ensure_revenue(df.drop("revenue")).first().revenue == Decimal("200.00")


def test_placeholders_only_where_absent(spark):
    df = spark.createDataFrame([(1, "X")], "client_id long, city string")
    assert C.add_geo_placeholders(df).first().asDict() == {"client_id": 1, "city": "X", "state": None}
    assert C.add_geo_placeholders(df.drop("city"), consulted=False).first().city == "Não consultado"


def test_detect_date_column():
    assert C.detect_date_column(["Código do Cliente", "data_doc", "data_pedido"]) == "data_doc"
    assert C.detect_date_column(["date"]) is None


def test_postal_forms(spark):
    df = spark.createDataFrame([("01310-100",), ("01310100",), ("1310100",), ("123",), (None,), ("Não informado",)], "c string")
    found = [tuple(r) for r in df.select(text.normalize_postal(F.col("c")), text.format_postal(F.col("c"))).collect()]
    assert found == [("01310100", "01310-100")] * 2 + [(None, None)] * 4
    number = spark.createDataFrame([(1310100,)], "c int")
    assert number.select(text.postal_from_number(F.col("c"))).first()[0] == "01310100"


def test_labels(spark):
    df = spark.createDataFrame([(7, "Recife", "PE", True), (8, None, "PE", None)], "i long, c string, s string, b boolean")
    got = df.select(
        text.client_label(F.col("i")), text.city_label(F.col("c"), F.col("s")), text.channel_name(F.col("b"))
    ).collect()
    assert [tuple(r) for r in got] == [("Cliente 7", "Recife - PE", "B2B"), ("Cliente 8", None, None)]


def test_numbers_and_units(spark):
    df = spark.createDataFrame([("12.5",), ("n/a",), (None,)], "v string")
    assert [r[0] for r in df.select(text.to_number(F.col("v"))).collect()] == [12.5, None, None]
    assert tuple(df.limit(1).select(*text.volume_units(F.lit(Decimal("1.50")))).first()) == (150.0, 0.15)


def test_known_drops_rows_with_any_null_or_nan(raw):
    assert known(raw, "brand", "sale_date").count() == 1
    assert known(raw, "loss").count() == 1
    assert C.require_not_null(raw, ["loss"]).count() == 2


def test_not_null_reaches_the_scan(raw, tmp_path, capsys):
    raw.write.parquet(str(tmp_path / "t"))
    known(raw.sparkSession.read.parquet(str(tmp_path / "t")), "brand").groupBy("brand").count().explain()
    plan = capsys.readouterr().out
    assert "PushedFilters: [IsNotNull(brand)]" in plan and "ReadSchema: struct<brand:string>" in plan


def test_counting_dropped_rows_works_the_rows_out_as_rarely_as_needed(spark):
    """Once for the digests and once for the whole rows; counting them costs no further pass."""
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, None), (3, None), (3, None)], "k long, t string")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    kept, report = C.dedupe_counted(rows.mapInArrow(count, rows.schema), limit=0)
    assert [tuple(r) for r in report.collect()] == [(6, 3, 3)]
    assert seen.value == 12
    assert kept.count() == 3
    assert [tuple(r) for r in C.dedupe_counted(rows.limit(0))[1].collect()] == [(0, 0, 0)]
