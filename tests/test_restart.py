"""Runs that are ended and started again, and results that become current together."""

import frames
import pytest
from pyspark.sql import functions as F

from quotaflow.operators.targets import allocate_targets
from quotaflow.plans import full_run
from quotaflow.sources import files, places, tables

SALES = """Código do Cliente,b2b_status,volume_hl,valor,data_doc,brand_desc,CEP_cliente
10,True,12.340000000000002,15.25,2024-01-31,A,1310100
10,,2,n/a,2024-02-29,,50030230
20,False,3,30,31/01/2024,B,50030230
20,False,3,30,31/01/2024,B,50030230
"""
TABLES = {"visao_consolidada", "metas_por_cliente", "dim_cliente", "dim_produto", "dim_tempo", "fato_vendas"}


@pytest.fixture()
def config(tmp_path):
    (tmp_path / "sales.csv").write_text(SALES, encoding="utf-8")
    (tmp_path / "targets.csv").write_text("Marca;Meta;Ano\nA;100;2025\nB;50;2025\n", encoding="utf-8")
    return files.RunConfig(sales=str(tmp_path / "sales.csv"), targets=str(tmp_path / "targets.csv"), output=str(tmp_path / "out"))


class Ended(Exception):
    pass


def _fail(*_, **__):
    raise Ended


def _contents(spark, paths):
    return {n: frames.rows(spark.read.parquet(p)) for n, p in paths.items()}


def _stamps(folder):
    return {p: p.stat().st_mtime_ns for p in folder.rglob("part-*")}


def test_a_run_goes_on_where_it_was_ended(spark, config, tmp_path, monkeypatch):
    with monkeypatch.context() as broken:
        broken.setattr(full_run, "customer_view", _fail)
        with pytest.raises(Ended):
            full_run.run(spark, config)
    staged = _stamps(tmp_path / "out" / "staging")
    assert staged and not (tmp_path / "out" / "current").exists()
    result = full_run.run(spark, config)
    assert {"load", "load_targets", "profile", "dimensions"} <= set(result.skipped)
    assert _stamps(tmp_path / "out" / "staging") == staged
    whole = full_run.run(spark, files.RunConfig(config.sales, config.targets, str(tmp_path / "other")))
    assert whole.skipped == []
    assert _contents(spark, result.paths) == _contents(spark, whole.paths)
    assert set(files.current(spark, config.output)) == TABLES


def test_a_finished_run_is_not_done_again(spark, config, tmp_path):
    first = full_run.run(spark, config)
    stamps = _stamps(tmp_path / "out")
    again = full_run.run(spark, config)
    assert again.paths == first.paths and "checks" in again.skipped and len(again.skipped) == 12
    assert {p: t for p, t in _stamps(tmp_path / "out").items() if "summary" not in p.parts} == {
        p: t for p, t in stamps.items() if "summary" not in p.parts
    }


def test_other_inputs_and_parameters_are_another_run(spark, config, tmp_path):
    first = full_run.run(spark, config)
    before = _contents(spark, first.paths)
    with open(config.sales, "a", encoding="utf-8") as more:
        more.write("30,True,5,50,2024-03-31,A,1310100\n")
    second = full_run.run(spark, config)
    assert second.skipped == []
    assert spark.read.parquet(second.paths["dim_cliente"]).count() == len(before["dim_cliente"]) + 1
    # What was current before can still be read.
    assert _contents(spark, first.paths) == before
    third = full_run.run(spark, files.RunConfig(config.sales, config.targets, config.output, year=2024))
    assert third.skipped == [] and spark.read.parquet(third.paths["metas_por_cliente"]).count() == 0
    assert files.current(spark, config.output)["fato_vendas"].parquet == third.paths["fato_vendas"]
    # Two runs are kept.
    assert not (tmp_path / "out" / "runs" / first.paths["fato_vendas"].split("/")[-3]).exists()
    forced = full_run.run(spark, files.RunConfig(config.sales, config.targets, config.output, year=2024, resume=False))
    assert forced.skipped == [] and _contents(spark, forced.paths) == _contents(spark, third.paths)


def test_every_rejected_text_is_reported(spark, config):
    result = full_run.run(spark, config)
    assert frames.rows(result.rejects, "input", "file", "column_name", "raw", "reason") == [
        ("sales", "sales.csv", "revenue", "n/a", "unread"),
        ("sales", "sales.csv", "sale_date", "31/01/2024", "unread"),
        ("sales", "sales.csv", "sale_date", "31/01/2024", "unread"),
        ("sales", "sales.csv", "volume_hl", "12.340000000000002", "rounded"),
    ]
    steps = {r.step: r.rows for r in result.summary.collect()}
    assert steps["rejects"] == 4
    told = {r.check: (r.passed, r.detail) for r in result.checks.collect()}
    assert told["sales: every text could be read"] == (False, "revenue: 1, sale_date: 2; rounded volume_hl: 1")
    volume = spark.read.parquet(result.paths["fato_vendas"]).agg(F.sum("volume_hl").cast("double")).first()[0]
    assert volume == pytest.approx(12.34 + 2 + 3 + 3, abs=1e-12)


def test_dropped_duplicates_are_in_the_summary(spark, config):
    result = full_run.run(spark, files.RunConfig(config.sales, config.targets, config.output, policy="drop"))
    assert {r.step: r.rows for r in result.summary.collect()}["duplicates dropped"] == 1


def test_a_failed_export_leaves_the_results_before(spark, tmp_path, monkeypatch):
    output = str(tmp_path / "out")
    files.export_all({"a": spark.range(3), "b": spark.range(4)}, output)
    broken = spark.range(5).select(F.raise_error(F.lit("torn")).cast("long").alias("id"))
    with pytest.raises(Exception, match="torn"):
        files.export_all({"a": spark.range(9), "b": broken}, output)
    found = files.current(spark, output)
    assert [(n, e.rows, spark.read.parquet(e.parquet).count()) for n, e in sorted(found.items())] == [("a", 3, 3), ("b", 4, 4)]
    assert len(list((tmp_path / "out" / "runs").iterdir())) == 1
    files.export_all({"a": spark.range(6), "b": spark.range(7)}, output)
    assert [e.rows for _, e in sorted(files.current(spark, output).items())] == [6, 7]
    # Who has the paths of the export before can still read.
    assert spark.read.parquet(found["a"].parquet).count() == 3
    files.export_all({"a": spark.range(8)}, output)
    assert len(list((tmp_path / "out" / "runs").iterdir())) == 2


def test_no_export_yet(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.current(spark, str(tmp_path))
    with pytest.raises(ValueError):
        files.export_all({}, str(tmp_path))


def test_pointers_are_never_written_over(spark, tmp_path):
    folder = str(tmp_path / "p")
    assert places.pointed(spark, folder) is None
    assert places.put_text(spark, f"{folder}/x", "one") and not places.put_text(spark, f"{folder}/x", "two")
    assert places.get_text(spark, f"{folder}/x") == "one"
    assert [places.point(spark, folder, {"n": n}) for n in range(4)] == [[], [], [{"n": 0}], [{"n": 1}]]
    assert places.pointed(spark, folder) == {"n": 3} and places.pointed(spark, folder, 1) == {"n": 2}
    assert places.names(spark, folder) == ["000000000003", "000000000004", "x"]


def test_readers_never_see_two_versions(spark, tmp_path, monkeypatch):
    tables.create_database(spark, "versions_test", str(tmp_path / "db"))
    both = lambda n: {"a": spark.range(n), "b": spark.range(n)}
    counts = lambda: {n: df.count() for n, df in tables.snapshot(spark, "versions_test").items()}
    tables.publish(both(3), "versions_test")
    seen, register = [], tables.register

    def watched(df, db, name):
        seen.append((counts(), tables.table(spark, "versions_test.a").count()))
        return register(df, db, name)

    monkeypatch.setattr(tables, "register", watched)
    held = tables.snapshot(spark, "versions_test")
    tables.publish(both(5), "versions_test")
    assert seen == [({"a": 3, "b": 3}, 3)] * 2
    assert counts() == {"a": 5, "b": 5} and spark.table("versions_test.b").count() == 5
    # A reader that looked before the switch goes on with what it found.
    assert {n: df.count() for n, df in held.items()} == {"a": 3, "b": 3}

    def broken(df, db, name):
        if name.startswith("b"):
            raise Ended
        return register(df, db, name)

    monkeypatch.setattr(tables, "register", broken)
    with pytest.raises(Ended):
        tables.publish(both(9), "versions_test")
    assert counts() == {"a": 5, "b": 5}
    monkeypatch.setattr(tables, "register", register)
    tables.publish({"a": spark.range(6)}, "versions_test")
    assert counts() == {"a": 6, "b": 5}
    tables.publish({"a": spark.range(7)}, "versions_test")
    held = [t.name for t in spark.catalog.listTables("versions_test") if t.tableType == "MANAGED"]
    assert sorted(n.split("__")[0] for n in held) == ["a", "a", "b"]
