"""The whole job: read, profile, clean, star schema, customer view, targets, export."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import quality
from ..operators.cleaning import add_geo_placeholders, clean, dedupe_counted, ensure_revenue, rename, require_not_null
from ..operators.customer import customer_view
from ..operators.geo import enrich_geography, propagate_geo
from ..operators.star import Star, build_dimensions, fact_sales
from ..operators.targets import allocate_targets, reconciliation_check, targets_for_year
from ..schemas import EXPORT_NAMES, GEOGRAPHY, NOTEBOOK_DROPS, TABLE_NAMES, export_names
from ..session import shuffle_partitions
from ..sources import files
from .steps import Steps, fingerprint


SAMPLE_ROWS = 10
AT_ONCE = 4
DIMENSIONS = ("dim_client", "dim_product", "dim_time")


@dataclass
class RunResult:
    paths: dict[str, str]
    profile: DataFrame
    checks: DataFrame
    summary: DataFrame
    rejects: DataFrame
    # Steps an earlier run had done.
    skipped: list[str] = field(default_factory=list)

    def failed(self) -> list[str]:
        """Names of the checks that did not pass."""
        return [r["check"] for r in self.checks.where(~F.col("passed")).select("check").collect()]


def _again(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """The written copy of ``df``."""
    return spark.read.schema(df.schema).parquet(path)


def _load(marked: DataFrame, path: str) -> dict:
    """Writes the typed rows with what was rejected in them, in one pass whose tasks count the rows.

    The rejects get a table of their own out of the written copy, of which only that column is read; they are counted there.
    """
    spark, names = marked.sparkSession, files.typed_columns(marked)
    rows, rejects = files.write_counted(marked, path), files.rejects(_again(spark, marked, path))
    files.write_parquet(rejects, f"{path}_rejects")
    # A text has one reason, so there are at most two rows per column.
    counted = _again(spark, rejects, f"{path}_rejects").groupBy("reason", "column_name").agg(F.count(F.lit(1)).alias("n"))
    found = {(row["reason"], row["column_name"]): row["n"] for row in counted.collect()}
    return {"rows": rows} | {r: {c: found[r, c] for c in names if (r, c) in found} for r in (files.UNREAD, files.ROUNDED)}


def _clean(spark: SparkSession, raw: DataFrame, path: str) -> dict:
    """The notebook's cleaning: one of equal rows, none without its keys.  Dropping compares rows, so it is staged."""
    unique, report = dedupe_counted(raw)
    sales = unique.transform(require_not_null).transform(ensure_revenue)
    return {"rows": files.write_counted(sales, path), "dropped": report.first()["dropped_rows"]}


def _profile(raw: DataFrame, targets: DataFrame) -> dict[str, DataFrame]:
    """The exploration of both inputs, and what the filling policy will put in."""
    return {
        "sales_schema": quality.schema_report(raw),
        "sales_statistics": quality.describe_written(raw),
        "sales_sample": raw.limit(SAMPLE_ROWS),
        "sales_nulls": quality.null_profile(raw),
        "sales_filled": quality.clean_report(raw),
        "targets_schema": quality.schema_report(targets),
        "targets_sample": targets.limit(SAMPLE_ROWS),
    }


def _unread_check(name: str, facts: dict, spark: SparkSession) -> DataFrame:
    told = lambda reason: ", ".join(f"{c}: {n}" for c, n in facts[reason].items())
    rounded = f"; rounded {told(files.ROUNDED)}" if facts[files.ROUNDED] else ""
    row = (f"{name}: every text could be read", not facts[files.UNREAD], (told(files.UNREAD) or "none") + rounded)
    return files.rows_to_df(spark, [row], "check string, passed boolean, detail string")


def run(spark: SparkSession, config: files.RunConfig) -> RunResult:
    """Runs the job and writes every table as Parquet and CSV under the output folder.

    The typed sales are written once and all later steps read that copy: the
    text is parsed once, each step reads only its columns, and a lost executor
    costs no more than its own tasks.  The checks are computed and written with
    the results, and the run's steps are appended to the summary.

    Every finished step is recorded.  A run that was ended goes on, when it is started again over the same
    inputs with the same parameters, with the first step that was not finished.  The tables are
    written to a folder of the run and become current together at the end (``files.current``).
    """
    with shuffle_partitions(spark, config.shuffle_partitions):
        return _run(spark, config)


def _run(spark: SparkSession, config: files.RunConfig) -> RunResult:
    mark = fingerprint(spark, config)
    steps = Steps(spark, f"{config.output}/steps", mark if config.resume else uuid4().hex)
    staging, notebook = f"{config.output}/staging", config.policy == "drop"
    variant = "notebook" if notebook else "local"
    # Results never go to a folder that another run has made current.
    folder = f"{config.output}/runs/" + steps.once("begin", lambda: {"run": uuid4().hex})["run"]

    marked = files.read_sales(spark, config.sales, config.dialect, mark=True)
    marked_targets = files.read_targets(spark, config.targets, mark=True)
    load = steps.once("load", lambda: _load(marked, f"{staging}/sales"))
    load_targets = steps.once("load_targets", lambda: _load(marked_targets, f"{staging}/targets"))
    raw, targets = (
        _again(spark, df.select(*files.typed_columns(df)), f"{staging}/{name}")
        for df, name in ((marked, "sales"), (marked_targets, "targets"))
    )
    rejects = [
        _again(spark, files.rejects(df), f"{staging}/{name}_rejects").withColumn("input", F.lit(name))
        for df, name in ((marked, "sales"), (marked_targets, "targets"))
    ]
    rejected = sum(sum(facts[r].values()) for facts in (load, load_targets) for r in (files.UNREAD, files.ROUNDED))

    profile = _profile(raw, targets)

    def explore() -> dict:
        for name, table in profile.items():
            files.write_parquet(table, f"{staging}/profile/{name}")
        return {"rows": len(raw.columns)}

    explored = steps.once("profile", explore)
    rows = [
        ("load", load["rows"], load["seconds"], f"{staging}/sales"),
        ("rejects", rejected, 0.0, f"{staging}/sales_rejects"),
        ("profile", explored["rows"], explored["seconds"], f"{staging}/profile"),
    ]
    sales = clean(raw, config.policy)
    if notebook:
        cleaned = steps.once("clean", lambda: _clean(spark, raw, f"{staging}/clean"))
        sales = _again(spark, sales, f"{staging}/clean")
        rows += [
            ("clean", cleaned["rows"], cleaned["seconds"], f"{staging}/clean"),
            ("duplicates dropped", cleaned["dropped"], 0.0, None),
        ]

    def dimensions() -> dict:
        built = build_dimensions(sales, variant)
        for name, df in zip(DIMENSIONS, built, strict=True):
            files.write_parquet(df, f"{staging}/star/{name}")
        return {"rows": None, "schemas": [df.schema.jsonValue() for df in built]}

    numbered = steps.once("dimensions", dimensions)
    client, product, time = (
        spark.read.schema(T.StructType.fromJson(shape)).parquet(f"{staging}/star/{name}")
        for shape, name in zip(numbered["schemas"], DIMENSIONS, strict=True)
    )
    rows.append(("dimensions", None, numbered["seconds"], None))
    star = Star(client, product, time, fact_sales(sales, client, product, time, variant))
    view = customer_view(sales, mode=config.mode)
    client_targets = allocate_targets(sales, targets, config.year, share_scale=4 if notebook else None)
    dim_client = star.dim_client
    if config.geography is None:
        dim_client, view, client_targets = map(add_geo_placeholders, (dim_client, view, client_targets))
    else:
        geo = files.require_input(spark, config.geography, schema=GEOGRAPHY, header=True)
        dim_client = enrich_geography(dim_client, geo)
        view, client_targets = propagate_geo(view, dim_client), propagate_geo(client_targets, dim_client)
    tables = star.tables() | {
        "dim_client": dim_client,
        "customer_view": view,
        "client_targets": client_targets,
    }

    drops = NOTEBOOK_DROPS if notebook else {}
    results = {n: rename(df.drop(*drops.get(n, ())), export_names(n, notebook)) for n, df in tables.items()}
    brand, target, customer = (EXPORT_NAMES.get(n, n) for n in ("brand", "client_target", "client_id"))
    # The Parquet files keep no order, so the ordered table is sorted as its CSV is written.
    orders = {"client_targets": [brand, F.desc(target), customer]}

    def write(name: str) -> dict:
        done = files.export(results[name], TABLE_NAMES[name], folder, order=orders.get(name, ()))
        return {"rows": done.rows, "took": done.seconds}

    with ThreadPoolExecutor(AT_ONCE) as pool:
        jobs = {n: pool.submit(steps.once, f"table_{n}", lambda n=n: write(n)) for n in results}
    exported = {}
    for name, job in jobs.items():
        out, facts = TABLE_NAMES[name], job.result()
        exported[out] = files.Exported(f"{folder}/parquet/{out}", f"{folder}/csv/{out}", facts["rows"], facts["took"])
    paths = {out: e.parquet for out, e in exported.items()}
    ours = lambda table: {theirs: name for name, theirs in export_names(table, notebook).items()}
    written = {name: rename(_again(spark, df, paths[TABLE_NAMES[name]]), ours(name)) for name, df in results.items()}
    if notebook:
        # The exported targets are of one year and do not say which.
        written["client_targets"] = written["client_targets"].withColumn("target_year", F.lit(config.year))
    rows += [(name, e.rows, e.seconds, e.parquet) for name, e in exported.items()]

    checks = [
        _unread_check("sales", load, spark),
        _unread_check("targets", load_targets, spark),
        quality.no_nulls_check(sales, ["client_id", "sale_date", "volume_hl"], "sales"),
        quality.check_not_empty(targets_for_year(targets, config.year), f"targets of {config.year}"),
        quality.metrics_check(written["customer_view"], ["avg_volume_3m", "avg_volume_6m"], "customer view"),
        reconciliation_check(written["client_targets"]),
        quality.star_integrity(Star(*[written[name] for name in star.tables()]), sales),
        files.outputs_present(spark, [p for e in exported.values() for p in (e.parquet, e.csv)]),
    ]
    judged = reduce(DataFrame.unionByName, checks)

    def judge() -> dict:
        files.write_parquet(judged, f"{config.output}/checks")
        files.switch(spark, config.output, folder, exported)
        return {}

    steps.once("checks", judge)
    summary = quality.run_summary(spark, rows)
    summary.coalesce(1).write.mode("append").parquet(f"{config.output}/summary")
    return RunResult(
        paths,
        _again(spark, profile["sales_nulls"], f"{staging}/profile/sales_nulls"),
        _again(spark, judged, f"{config.output}/checks"),
        summary,
        reduce(DataFrame.unionByName, rejects),
        steps.skipped,
    )
