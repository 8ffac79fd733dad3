from datetime import date
from decimal import Decimal

import frames
import pytest

from quotaflow import session
from quotaflow.__main__ import main
from quotaflow.operators.customer import customer_view
from quotaflow.plans.full_run import run
from quotaflow.sources import files, scratch, tables

LOCAL = """Código do Cliente,cod material,b2b_status,volume_hl,valor,data_doc,materialPackaging,brand,brand_desc,material,CEP_cliente
10,1,True,1.5,15.25,2024-01-31,12.0,3,A,Cola,1310100
10,2,,2,20,2024-02-29,,,,,50030230
20,3,False,abc,30,31/01/2024,7,4,B,Tea,50030230
"""
NOTEBOOK = """date,client_id,brand,volume_hl,b2b_status,cep
2024-01-31,10,A,1.5,1,1310100
2024-02-29,20,,2,0,50030230
"""


@pytest.fixture()
def inputs(tmp_path):
    (tmp_path / "sales.csv").write_text(LOCAL, encoding="utf-8")
    (tmp_path / "notebook.csv").write_text(NOTEBOOK, encoding="utf-8")
    (tmp_path / "targets.csv").write_text("﻿Marca;Meta;Ano\nA;100;2025\nB;50;2025\nA;90;2024\n", encoding="utf-8")
    (tmp_path / "geo.csv").write_text("postal_code,city,state\n01310100,São Paulo,SP\n", encoding="utf-8")
    return tmp_path


def test_local_dialect(spark, inputs):
    got = files.read_sales(spark, str(inputs / "sales.csv")).collect()
    first, second, third = got
    assert (first.client_id, first.is_b2b, first.packaging_code, first.brand_code, first.brand) == (10, True, 12, 3, "A")
    assert (first.volume_hl, first.sale_date, first.postal_code) == (Decimal("1.500000"), date(2024, 1, 31), "01310100")
    assert (second.is_b2b, second.brand, second.packaging_code) == (None, None, None)
    assert (third.volume_hl, third.sale_date) == (None, None)


def test_notebook_dialect_in_its_own_order(spark, inputs):
    df = files.read_sales(spark, str(inputs / "notebook.csv"), "notebook")
    assert "revenue" not in df.columns
    assert frames.rows(df, "client_id", "is_b2b", "postal_code") == [(10, True, "01310100"), (20, False, "50030230")]


def test_files_of_a_folder_must_share_a_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Marca;Meta;Ano\nA;1;2025\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("Marca;Ano;Meta\nB;2025;2\n", encoding="utf-8")
    with pytest.raises(Exception, match="CSV header"):
        files.read_targets(spark, str(tmp_path)).collect()


def test_shuffle_partitions_are_restored(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(KeyError), session.shuffle_partitions(spark, 18):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "18"
        raise KeyError
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    with session.shuffle_partitions(spark, None):
        assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_nothing_is_lost_and_rounding_is_listed(spark, tmp_path):
    head = LOCAL.split("\n")[0]
    lines = [
        "9007199254740993.0,1,True,2000000000000,0.12345678,2024-01-31,1,1,A,x,1",
        "12.7,1,True,0.123456789012,1e3,2024-02-30,1,1,A,x,1",
        "13,,,,,,,,,,",
    ]
    (tmp_path / "sales.csv").write_text("\n".join([head, *lines]) + "\n", encoding="utf-8")
    first, second, third = files.read_sales(spark, str(tmp_path / "sales.csv")).collect()
    assert (first.client_id, first.volume_hl, first.revenue) == (9007199254740993, Decimal(2000000000000), Decimal("0.12345678"))
    assert (second.client_id, second.volume_hl, second.revenue, second.sale_date) == (None, Decimal("0.123456789"), Decimal(1000), None)
    assert third.client_id == 13 and third.volume_hl is None
    counted = files.count_unread(files.read_sales(spark, str(tmp_path / "sales.csv"), mark=True))
    assert {r.column_name: r.unread for r in counted.collect() if r.unread} == {"client_id": 1, "sale_date": 1}
    found = files.rejects(files.read_sales(spark, str(tmp_path / "sales.csv"), mark=True))
    assert frames.rows(found) == [
        ("sales.csv", "client_id", "12.7", "unread"),
        ("sales.csv", "sale_date", "2024-02-30", "unread"),
        ("sales.csv", "volume_hl", "0.123456789012", "rounded"),
    ]


@pytest.mark.parametrize(
    "raw, value, rounded",
    [("12.340000000000002", "12.34", True), ("0.30000000000000004", "0.3", True), ("1.5", "1.5", False), ("1.50000000000000000000", "1.5", False),
     ("1e-12", "0", True), ("1.00000000001e5", "100000.000001", False), ("0.00000000000000000000001", "0", True), ("-7", "-7", False)],
)
def test_float_artefacts_are_rounded(spark, tmp_path, raw, value, rounded):
    (tmp_path / "sales.csv").write_text(f"{LOCAL.split(chr(10))[0]}\n1,1,True,{raw},1,2024-01-31,1,1,A,x,1\n", encoding="utf-8")
    marked = files.read_sales(spark, str(tmp_path / "sales.csv"), mark=True)
    assert marked.first().volume_hl == Decimal(value)
    assert [(r.raw, r.reason) for r in files.rejects(marked).collect()] == ([(raw, "rounded")] if rounded else [])


def test_marked_texts_are_parsed_by_generated_code(spark, inputs):
    marked = files.read_sales(spark, str(inputs / "sales.csv"), mark=True)
    plan = marked._jdf.queryExecution().executedPlan().toString()
    # No lambda, which is interpreted, keeps the projection out of generated code.
    assert "lambda" not in plan and plan.lstrip().startswith("*(1) Project")
    assert marked.first()[files.REJECTED] == []


@pytest.mark.parametrize("raw", [" 1.12345678901 ", "1.1234567890 ", "1E2", "1.e1", ".5", "-0.00000000009", "+1.00000000000", "1.12345678900001", "12e-11", "1.5f", "1,5", "7.", "1.2.3", ""])
def test_rounding_is_found_as_by_exact_numbers(spark, tmp_path, raw):
    (tmp_path / "sales.csv").write_text(f"{LOCAL.split(chr(10))[0]}\n1,1,True,\"{raw}\",1,2024-01-31,1,1,A,x,1\n", encoding="utf-8")
    try:
        exact = Decimal(raw) if raw.strip() and "f" not in raw else None
    except ArithmeticError:
        exact = None
    wanted = [] if not raw else ["unread"] if exact is None else ["rounded"] if exact != round(exact, 10) else []
    marked = files.read_sales(spark, str(tmp_path / "sales.csv"), mark=True)
    assert [r.reason for r in files.rejects(marked).collect()] == wanted
    assert marked.first().volume_hl == (None if exact is None else round(exact, 10).quantize(Decimal("1e-10")))


def test_wrong_header_is_an_error(spark, inputs):
    with pytest.raises(ValueError, match="data_doc"):
        files.read_sales(spark, str(inputs / "sales.csv"), "notebook")
    with pytest.raises(ValueError, match="client_id, sale_date, volume_hl"):
        files.read_sales(spark, str(inputs / "sales.csv"), sep=";")


def test_listing_is_complete(spark, tmp_path):
    for i in range(1, 30):
        (tmp_path / f"file{i:02d}.csv").write_text("x" * i)
    with pytest.raises(FileNotFoundError, match=r"file01.csv \(1 bytes\).*file29.csv \(29 bytes\)"):
        files.require_input(spark, str(tmp_path / "absent.csv"))


def test_targets_with_byte_order_mark(spark, inputs):
    df = files.read_targets(spark, str(inputs / "targets.csv"))
    assert df.dtypes == [("brand", "string"), ("target_volume", "bigint"), ("target_year", "int")]
    assert frames.rows(df) == [("A", 90, 2024), ("A", 100, 2025), ("B", 50, 2025)]


def test_absent_input_says_what_is_there(spark, inputs):
    with pytest.raises(FileNotFoundError, match="geo.csv"):
        files.require_input(spark, str(inputs / "absent.csv"))
    assert {r.path.rpartition("/")[2] for r in files.list_input(spark, str(inputs)).collect()} >= {"geo.csv", "sales.csv"}


def test_outputs_present(spark, tmp_path):
    files.write_parquet(spark.range(3), str(tmp_path / "there"))
    rows = files.outputs_present(spark, [str(tmp_path / "there"), str(tmp_path / "absent")]).collect()
    assert [(r.passed, r.detail) for r in rows] == [(False, f"absent: {tmp_path / 'absent'}")]
    assert files.outputs_present(spark, [str(tmp_path / "there")]).first().passed


def test_single_file_and_order_are_the_callers_choice(spark, tmp_path):
    df = spark.range(100).repartition(4)
    files.write_csv(df, str(tmp_path / "one"), single=True)
    files.write_csv(df, str(tmp_path / "many"))
    assert [len(list((tmp_path / n).glob("part-*"))) for n in ("one", "many")] == [1, 4]
    files.write_csv(df, str(tmp_path / "sorted"), order=["id"])
    files.write_csv(df, str(tmp_path / "single"), single=True, order=["id"])
    for name in ("sorted", "single"):
        parts = sorted((tmp_path / name).glob("part-*"))
        read = [int(x) for p in parts for x in p.read_text().split()[1:]]
        assert read == list(range(100))


def test_selection_name():
    assert files.selection_name("Visão Consolidada", date(2025, 10, 21)) == "visão_consolidada_20251021.csv"


def test_small_side_checks_bytes(spark):
    narrow, wide = spark.range(1000), spark.range(1000).selectExpr("id", "repeat('x', 500) as t")
    assert scratch.is_small(narrow, 100_000) and not scratch.is_small(wide, 100_000)
    hinted = scratch.small_side(narrow, 100_000)._jdf.queryExecution().logical().toString()
    plain = scratch.small_side(wide, 100_000)._jdf.queryExecution().logical().toString()
    assert "hint" in hinted.lower() and "hint" not in plain.lower()


class _Conf(dict):
    def set(self, key, value):
        self[key] = value


class _Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder


class _Session:
    def __init__(self, master="local[2]", folder=None, **conf):
        self.conf, self.sparkContext = _Conf(conf), _Context(master, folder)


def test_shared_folder_is_the_one_the_cluster_names():
    named = _Session("spark://m:7077", **{"spark.checkpoint.dir": "hdfs://nn/shared/"})
    path = scratch.scratch_path(named, "x")
    assert path.startswith("hdfs://nn/shared/x-") and path != scratch.scratch_path(named, "x")
    assert scratch.shared_root(_Session("yarn", "hdfs://nn/set")) == "hdfs://nn/set"
    unnamed = _Session()
    assert scratch.shared_root(unnamed) == scratch.shared_root(unnamed)
    for master in ("yarn", "spark://m:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            scratch.shared_root(_Session(master))


def test_clustered_table_joins_without_shuffle(spark, tmp_path, capsys):
    tables.create_database(spark, "clustered_test", str(tmp_path / "db"))
    df = spark.range(1000).selectExpr("id % 50 as k", "id as v")
    left = tables.write_clustered(df, "clustered_test.l", ["k"], 4, files=2)
    right = tables.write_clustered(df.select("k").distinct(), "clustered_test.r", ["k"], 4, files=2)
    joined = left.hint("merge").join(right, "k")
    joined.explain()
    assert "Exchange" not in capsys.readouterr().out
    assert joined.count() == 1000
    assert len(list((tmp_path / "db" / "l").glob("part-*"))) <= 8


def test_publish_replaces(spark, tmp_path):
    tables.create_database(spark, "publish_test", str(tmp_path / "db"))
    tables.publish({"t": spark.range(3)}, "publish_test")
    assert tables.publish({"t": spark.range(5)}, "publish_test")["t"].count() == 5
    assert tables.table(spark, "publish_test.t").count() == 5


@pytest.mark.parametrize(
    "policy, mode, geography, unmet",
    [("fill", "relative", None, ["sales: every text could be read", "sales: no nulls in client_id, sale_date, volume_hl"]), ("drop", "absolute", "geo.csv", ["sales: every text could be read"])],
)
def test_full_run(spark, inputs, policy, mode, geography, unmet):
    config = files.RunConfig(
        sales=str(inputs / "sales.csv"), targets=str(inputs / "targets.csv"), output=str(inputs / "out"),
        policy=policy, mode=mode, geography=geography and str(inputs / geography),
    )
    result = run(spark, config)
    assert set(result.paths) == {"visao_consolidada", "metas_por_cliente", "dim_cliente", "dim_produto", "dim_tempo", "fato_vendas"}
    written = {n: spark.read.parquet(p) for n, p in result.paths.items()}
    sold = 3 if policy == "fill" else 2
    assert written["fato_vendas"].count() == sold
    rows = {r.step: r.rows for r in result.summary.collect()}
    assert rows["load"] == 3 and rows["fato_vendas"] == sold
    assert written["visao_consolidada"].columns == [
        "cliente_id", "data_ultima_compra", "volume_medio_3m", "volume_medio_6m", "share_b2b_3m", "share_b2b_6m", "cidade", "estado",
    ]
    if policy == "drop":
        assert written["dim_tempo"].columns == ["sk_tempo", "date", "ano", "mes", "trimestre"]
        assert written["metas_por_cliente"].columns[:6] == [
            "cliente_id", "marca", "volume_total", "percentual_participacao", "meta_marca", "meta_cliente",
        ]
    places = {r.cliente_id: r.cidade for r in written["dim_cliente"].collect()}
    if geography:
        assert places == {10: "Não encontrado"}
    else:
        assert set(places.values()) == {None}
    checks = {r.check: r.passed for r in result.checks.collect()}
    assert [name for name, passed in checks.items() if not passed] == unmet
    assert len(checks) == 11
    assert sorted(result.failed()) == sorted(unmet)
    assert spark.read.parquet(str(inputs / "out/checks")).count() == 11
    assert spark.read.parquet(str(inputs / "out/summary")).count() == result.summary.count()
    kinds = ("sales_schema", "sales_statistics", "sales_sample", "sales_nulls", "sales_filled", "targets_schema", "targets_sample")
    assert all(spark.read.parquet(str(inputs / "out/staging/profile" / k)).columns for k in kinds)
    staged = "sales" if policy == "fill" else "clean"
    view = frames.rows(customer_view(spark.read.parquet(str(inputs / "out/staging" / staged)), mode=mode))
    assert frames.rows(written["visao_consolidada"].drop("cidade", "estado")) == view


def test_command_line(spark, inputs, capsys):
    # The session's warehouse takes the published tables.
    main(
        ["--sales", str(inputs / "notebook.csv"), "--targets", str(inputs / "targets.csv"), "--output", str(inputs / "out"),
         "--dialect", "notebook", "--policy", "drop", "--mode", "calendar", "--database", "command_line_test"]
    )
    printed = capsys.readouterr().out
    assert "every output is written" in printed
    sold = frames.rows(tables.table(spark, "command_line_test.fato_vendas"), "valor", "b2b_status")
    assert sold == [(Decimal("150.000000"), True), (Decimal("200.000000"), False)]
    arguments = ["--sales", str(inputs / "sales.csv"), "--targets", str(inputs / "targets.csv"), "--output", str(inputs / "strict"), "--strict"]
    with pytest.raises(SystemExit, match="every text could be read"):
        main(arguments)
    with pytest.raises(FileNotFoundError):
        main(["--sales", str(inputs / "absent.csv"), "--targets", str(inputs / "targets.csv"), "--output", str(inputs / "o")])
