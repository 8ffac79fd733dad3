"""Sources, sinks and the full run (S1-S14, Q11, T10): written, read back, compared."""

from dataclasses import replace
from datetime import date
from functools import reduce

from pyspark.sql import functions as F

from ...operators import cleaning as C
from ...operators.columns import as_doubles
from ...operators.quality import row_counts
from ...operators.reports import brand_scorecard
from ...schemas import EXPORT_NAMES, SALES_DIALECTS, TABLE_NAMES, TARGETS_DIALECT
from ...sources import curve, files, tables
from ...sources.scratch import scratch_path
from ..full_run import run
from ..oracle import BRAND, YEAR
from .registry import client_targets, clients, geography, query, sales, targets, view

ALL = (
    "client_id, brand, target_year, CAST(client_volume AS DOUBLE) AS client_volume, CAST(brand_volume AS DOUBLE) AS brand_volume,"
    " share_pct, target_volume, client_target"
)
SOLD = ("client_id", "brand", "volume_hl", "revenue", "is_b2b")
SOURCES = ("customer", "lineitem", "nation", "orders", "part", "region")
CANONICAL = (
    "client_id, material_id, is_b2b, CAST(volume_hl AS DOUBLE) AS volume_hl, CAST(revenue AS DOUBLE) AS revenue,"
    " sale_date, CAST(packaging_code AS BIGINT) AS packaging_code, brand, material, postal_code"
)


def _database(spark) -> str:
    """A database of its own, under the shared folder."""
    path = scratch_path(spark, "database")
    name = "quotaflow_" + path.rpartition("-")[2]
    tables.create_database(spark, name, path)
    return name


def _sales_file(spark, d, path) -> str:
    """The fixture as a source file: source names, codes written as numbers."""
    rows = C.to_dialect(sales(spark, d), SALES_DIALECTS["local"])
    files.write_csv(rows.withColumn("CEP_cliente", F.col("CEP_cliente").cast("int")), path)
    return path


def _targets_file(spark, d, path) -> str:
    rows = C.to_dialect(targets(spark, d), TARGETS_DIALECT)
    rows.repartition(1).write.option("header", True).option("sep", ";").csv(path)
    return path


@query("s1_read_sales", f"SELECT {CANONICAL} FROM sales", "sales")
def _(spark, d):
    return as_doubles(files.read_sales(spark, _sales_file(spark, d, scratch_path(spark, "sales"))))


REJECTS = """
    SELECT column_name, raw, reason, count(*) AS rows FROM (
      SELECT 'volume_hl' AS column_name, volume_hl || '000000000002' AS raw, 'rounded' AS reason, client_id FROM sales WHERE client_id % 7 = 1
      UNION ALL SELECT 'revenue', 'n/a ' || client_id, 'unread', client_id FROM sales WHERE client_id % 11 = 2
      UNION ALL SELECT 'sale_date', '31/12/1999', 'unread', client_id FROM sales WHERE client_id % 13 = 3)
    GROUP BY ALL"""


def _spoilt_file(spark, d, path) -> str:
    """Source file with float artefacts, texts for numbers and another date format."""
    rows = sales(spark, d, "client_id", "sale_date", "volume_hl", "revenue")
    n = F.col("client_id")
    spoilt = rows.select(
        n.alias("client_id"),
        F.when(n % 13 == 3, "31/12/1999").otherwise(F.col("sale_date").cast("string")).alias("sale_date"),
        F.when(n % 7 == 1, F.concat(F.col("volume_hl").cast("string"), F.lit("000000000002"))).otherwise(F.col("volume_hl").cast("string")).alias("volume_hl"),
        F.when(n % 11 == 2, F.concat(F.lit("n/a "), n.cast("string"))).otherwise(F.col("revenue").cast("string")).alias("revenue"),
    )
    files.write_csv(C.to_dialect(spoilt, SALES_DIALECTS["local"]), path)
    return path


@query("s1_rejects", REJECTS, "sales")
def _(spark, d):
    marked = files.read_sales(spark, _spoilt_file(spark, d, scratch_path(spark, "spoilt")), mark=True)
    return files.rejects(marked).groupBy("column_name", "raw", "reason").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "s1_read_rounded",
    "SELECT client_id, CASE WHEN client_id % 13 <> 3 THEN sale_date END AS sale_date, CAST(volume_hl AS DOUBLE) AS volume_hl,"
    " CASE WHEN client_id % 11 <> 2 THEN CAST(revenue AS DOUBLE) END AS revenue FROM sales",
    "sales",
)
def _(spark, d):
    read = files.read_sales(spark, _spoilt_file(spark, d, scratch_path(spark, "spoilt")))
    return as_doubles(read.select("client_id", "sale_date", "volume_hl", "revenue"))


@query("s2_read_targets", "SELECT brand, target_volume, CAST(target_year AS INT) AS target_year FROM targets", "targets")
def _(spark, d):
    return files.read_targets(spark, _targets_file(spark, d, scratch_path(spark, "targets")))


@query(
    "s3_require_input",
    " UNION ALL ".join(f"SELECT '{t}' AS stage, count(*) AS rows FROM {t}" for t in SOURCES),
)
def _(spark, d):
    return row_counts({t: files.require_input(spark, f"{d}/{t}.parquet", "parquet") for t in SOURCES})


@query(
    "s4_rows_to_table",
    "SELECT brand, note, CAST(sum(volume_hl) AS DOUBLE) AS volume FROM sales JOIN (VALUES ('Brand#1', 'first'),"
    " ('Brand#2', 'second')) AS n(brand, note) USING (brand) GROUP BY 1, 2",
    "sales",
)
def _(spark, d):
    notes = files.rows_to_df(spark, [("Brand#1", "first"), ("Brand#2", "second")], "brand string, note string")
    sums = sales(spark, d, "brand", "volume_hl").groupBy("brand").agg(F.sum("volume_hl").cast("double").alias("volume"))
    return sums.join(notes, "brand")


@query("s5_write_csv", "SELECT * FROM scorecard", "scorecard")
def _(spark, d):
    report, path = brand_scorecard(sales(spark, d, *SOLD)), scratch_path(spark, "csv")
    files.write_csv(report, path, single=True)
    return files.read_csv(spark, path, report.schema)


@query("s6_write_parquet", "SELECT * FROM view", "view")
def _(spark, d):
    path = scratch_path(spark, "parquet")
    files.write_parquet(view(spark, d), path)
    return spark.read.parquet(path)


@query("s7_write_table", f"SELECT {ALL} FROM ct", "ct")
def _(spark, d):
    path = scratch_path(spark, "table")
    files.write_table(client_targets(spark, d), path)
    return as_doubles(spark.read.parquet(path))


@query("s8_register_table", "SELECT * FROM dim", "dim")
def _(spark, d):
    return tables.register(clients(spark, d), _database(spark), "dim_client")


@query(
    "s9_export_all",
    "SELECT f AS format, client_id, brand, client_target, last_purchase, avg_volume_3m, b2b_share_6m FROM (SELECT client_id, NULL AS brand,"
    " NULL AS client_target, last_purchase, avg_volume_3m, b2b_share_6m FROM view UNION ALL SELECT client_id, brand, client_target, NULL,"
    " NULL, NULL FROM ct), (VALUES ('csv'), ('parquet')) AS formats(f)",
    "view",
    "ct",
)
def _(spark, d):
    results = {"view": view(spark, d), "targets": client_targets(spark, d)}
    output = scratch_path(spark, "export")
    files.export_all(results, output)
    columns = ("format", "client_id", "brand", "client_target", "last_purchase", "avg_volume_3m", "b2b_share_6m")
    found = []
    exported = files.current(spark, output)
    for n, df in results.items():
        for fmt, rows in (("parquet", spark.read.parquet(exported[n].parquet)), ("csv", files.read_csv(spark, exported[n].csv, df.schema))):
            found.append(rows.withColumn("format", F.lit(fmt)).select(*[c for c in columns if c == "format" or c in rows.columns]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found).select(*columns)


@query("s10_publish", "SELECT * FROM view", "view")
def _(spark, d):
    return tables.publish({"customer_view": view(spark, d)}, _database(spark))["customer_view"]


@query("s11_read_table", "SELECT * FROM view_abs", "view_abs")
def _(spark, d):
    db = _database(spark)
    tables.publish({"customer_view": view(spark, d, mode="absolute")}, db)
    return tables.table(spark, f"{db}.customer_view")


@query("s12_export_selection", f"SELECT client_id, brand, client_target FROM ct WHERE brand = '{BRAND}'", "ct")
def _(spark, d):
    chosen = client_targets(spark, d).where(F.col("brand") == BRAND).select("client_id", "brand", "client_target")
    path = files.export_selection(chosen, scratch_path(spark, "download"), "Client Targets", date(2001, 8, 1))
    return files.read_csv(spark, path, chosen.schema)


@query(
    "s13_write_clustered",
    "SELECT client_id, brand, CAST(volume_hl AS DOUBLE) AS volume_hl, CAST(revenue AS DOUBLE) AS revenue, is_b2b FROM sales",
    "sales",
)
def _(spark, d):
    name = f"{_database(spark)}.sales_by_client"
    return as_doubles(tables.write_clustered(sales(spark, d, *SOLD), name, ["client_id"], 8))


@query(
    "s13_curve_lookup",
    "SELECT 'client' AS looked_up, client_id, brand, CAST(volume_hl AS DOUBLE) AS volume_hl FROM sales WHERE client_id = (SELECT max(client_id) FROM sales)"
    f" UNION ALL SELECT 'brand', client_id, brand, CAST(volume_hl AS DOUBLE) FROM sales WHERE brand = '{BRAND}'"
    " UNION ALL SELECT 'no brand', client_id, brand, CAST(volume_hl AS DOUBLE) FROM sales WHERE brand IS NULL",
    "sales",
)
def _(spark, d):
    rows, path = sales(spark, d, "client_id", "brand", "volume_hl"), scratch_path(spark, "curve")
    last = curve.write_curve(rows, path, ["client_id", "brand"]).agg(F.max("client_id")).first()[0]
    lookups = {"client": {"client_id": last}, "brand": {"brand": BRAND}, "no brand": {"brand": None}}
    found = [curve.lookup(spark, path, **keys).withColumn("looked_up", F.lit(name)) for name, keys in lookups.items()]
    return as_doubles(reduce(lambda a, b: a.unionByName(b), found)).select("looked_up", "client_id", "brand", "volume_hl")


@query(
    "s14_run_parameters",
    f"SELECT brand, target_volume FROM targets WHERE target_year = {YEAR}",
    "targets",
)
def _(spark, d):
    config = files.RunConfig(sales="", targets=_targets_file(spark, d, scratch_path(spark, "targets")), output="", year=YEAR)
    rows = files.read_targets(spark, config.targets)
    return rows.where(F.col("target_year") == config.year).select("brand", "target_volume")


def source_files(spark, d, name) -> files.RunConfig:
    """The fixture as source files, and the parameters of a run over them."""
    root = scratch_path(spark, name)
    return files.RunConfig(
        sales=_sales_file(spark, d, f"{root}/input/sales"),
        targets=_targets_file(spark, d, f"{root}/input/targets"),
        output=f"{root}/output",
        year=YEAR,
    )


def _full_run(spark, d, name):
    return run(spark, source_files(spark, d, name))


@query(
    "q11_run_summary",
    "SELECT 'load' AS step, count(*) AS rows, 'sales' AS output FROM sales UNION ALL SELECT 'profile', 10, 'profile' UNION ALL"
    " SELECT 'rejects', 0, 'sales_rejects' UNION ALL"
    " SELECT 'dimensions', NULL, NULL UNION ALL SELECT 'visao_consolidada', count(*), 'visao_consolidada' FROM view UNION ALL"
    " SELECT 'metas_por_cliente', count(*), 'metas_por_cliente' FROM ct UNION ALL SELECT 'dim_cliente', count(*), 'dim_cliente' FROM dim"
    " UNION ALL SELECT 'dim_produto', count(*), 'dim_produto' FROM prod UNION ALL SELECT 'dim_tempo', count(*), 'dim_tempo' FROM times"
    " UNION ALL SELECT 'fato_vendas', count(*), 'fato_vendas' FROM sales",
    "view",
    "ct",
    "prod",
    "times",
    "dim",
)
def _(spark, d):
    """Without the seconds: they are another every time."""
    steps = _full_run(spark, d, "summary").summary
    return steps.select("step", "rows", F.substring_index("output", "/", -1).alias("output"))


@query(
    "t10_full_run",
    "SELECT client_id AS cliente_id, last_purchase AS data_ultima_compra, avg_volume_3m AS volume_medio_3m,"
    " avg_volume_6m AS volume_medio_6m, b2b_share_3m AS share_b2b_3m, b2b_share_6m AS share_b2b_6m,"
    " CAST(NULL AS VARCHAR) AS cidade, CAST(NULL AS VARCHAR) AS estado FROM view",
    "view",
)
def _(spark, d):
    return spark.read.parquet(_full_run(spark, d, "run").paths["visao_consolidada"])


def _written(spark, d, name) -> dict:
    """The tables of a run as written, under our names."""
    ours = {theirs: column for column, theirs in EXPORT_NAMES.items()}
    paths = _full_run(spark, d, name).paths
    return {table: C.rename(spark.read.parquet(paths[theirs]), ours) for table, theirs in TABLE_NAMES.items()}


@query("t10_full_run_targets", f"SELECT {ALL} FROM ct", "ct")
def _(spark, d):
    found = _written(spark, d, "run-targets")["client_targets"]
    return as_doubles(found.drop("city", "state"))


@query(
    "t10_full_run_fact",
    "SELECT client_id, sale_date, brand, CAST(volume_hl AS DOUBLE) AS volume_hl, CAST(revenue AS DOUBLE) AS revenue, is_b2b FROM filled",
    "filled",
)
def _(spark, d):
    """The fact with its keys looked up in the three dimensions."""
    t = _written(spark, d, "run-fact")
    rows = t["fact_sales"].join(t["dim_client"].select("client_key", "client_id"), "client_key")
    rows = rows.join(t["dim_time"].select("time_key", "sale_date"), "time_key").join(t["dim_product"], "product_key")
    return as_doubles(rows.select("client_id", "sale_date", "brand", "volume_hl", "revenue", "is_b2b"))


@query(
    "t10_full_run_tables",
    "SELECT 'visao_consolidada' AS stage, count(*) AS rows FROM view UNION ALL SELECT 'metas_por_cliente', count(*) FROM ct"
    " UNION ALL SELECT 'dim_cliente', count(*) FROM dim UNION ALL SELECT 'dim_produto', count(*) FROM prod"
    " UNION ALL SELECT 'dim_tempo', count(*) FROM times UNION ALL SELECT 'fato_vendas', count(*) FROM sales",
    "view",
    "ct",
    "prod",
    "times",
    "dim",
)
def _(spark, d):
    paths = _full_run(spark, d, "tables").paths
    return row_counts({name: spark.read.parquet(path) for name, path in paths.items()})


def _notebook_run(spark, d, name):
    """The notebook variant with geography, end to end: drop, absolute windows, postal table."""
    config = source_files(spark, d, name)
    path = f"{config.output}/../input/geography"
    files.write_csv(geography(spark, d), path)
    return run(spark, replace(config, geography=path, policy="drop", mode="absolute"))


@query(
    "t10_notebook_geography_view",
    "SELECT client_id AS cliente_id, last_purchase AS data_ultima_compra, avg_volume_3m AS volume_medio_3m,"
    " avg_volume_6m AS volume_medio_6m, b2b_share_3m AS share_b2b_3m, b2b_share_6m AS share_b2b_6m,"
    " city AS cidade, state AS estado FROM view_abs JOIN dim_marked USING (client_id)",
    "view_abs",
    "dim_marked",
)
def _(spark, d):
    return spark.read.parquet(_notebook_run(spark, d, "notebook").paths["visao_consolidada"])


@query(
    "t10_notebook_geography_targets",
    "SELECT client_id AS cliente_id, brand AS marca, CAST(client_volume AS DOUBLE) AS volume_total, share_pct AS percentual_participacao,"
    " target_volume AS meta_marca, client_target AS meta_cliente, city AS cidade, state AS estado FROM ct4 JOIN dim_marked USING (client_id)",
    "ct4",
    "dim_marked",
)
def _(spark, d):
    return as_doubles(spark.read.parquet(_notebook_run(spark, d, "notebook-targets").paths["metas_por_cliente"]))


CONTENTS = """
    SELECT 'visao_consolidada' AS stage, CAST(client_id AS VARCHAR) AS key, CAST(NULL AS VARCHAR) AS text, avg_volume_3m AS number FROM view
    UNION ALL SELECT 'metas_por_cliente', client_id || ' ' || brand, CAST(target_year AS VARCHAR), client_target FROM ct
    UNION ALL SELECT 'dim_cliente', CAST(client_id AS VARCHAR), postal_code, CAST(client_key AS DOUBLE) FROM dim
    UNION ALL SELECT 'dim_produto', brand, NULL, CAST(product_key AS DOUBLE) FROM prod_filled
    UNION ALL SELECT 'dim_tempo', CAST(sale_date AS VARCHAR), year_month, CAST(time_key AS DOUBLE) FROM times
    UNION ALL SELECT 'fato_vendas', CAST(client_key AS VARCHAR) || ' ' || time_key, CAST(product_key AS VARCHAR), CAST(volume_hl AS DOUBLE)
      FROM filled JOIN dim USING (client_id) JOIN times USING (sale_date) JOIN prod_filled USING (brand)"""
FILLED_BRANDS = "prod_filled AS (SELECT brand, row_number() OVER (ORDER BY brand) AS product_key FROM (SELECT DISTINCT brand FROM filled))"


@query(
    "t10_full_run_contents",
    f"SELECT * FROM (WITH {FILLED_BRANDS} {CONTENTS})",
    "view",
    "ct",
    "dim",
    "times",
    "filled",
)
def _(spark, d):
    """A key, a text and a number of every row of all six tables."""
    t = _written(spark, d, "run-contents")
    text = lambda c: F.col(c).cast("string")
    facts = {
        "customer_view": (text("client_id"), None, "avg_volume_3m"),
        "client_targets": (F.concat_ws(" ", "client_id", "brand"), text("target_year"), "client_target"),
        "dim_client": (text("client_id"), F.col("postal_code"), "client_key"),
        "dim_product": (F.col("brand"), None, "product_key"),
        "dim_time": (text("sale_date"), F.col("year_month"), "time_key"),
        "fact_sales": (F.concat_ws(" ", "client_key", "time_key"), text("product_key"), "volume_hl"),
    }
    found = [
        t[name].select(
            F.lit(TABLE_NAMES[name]).alias("stage"), key.alias("key"),
            (F.lit(None).cast("string") if value is None else value).alias("text"), F.col(number).cast("double").alias("number"),
        )
        for name, (key, value, number) in facts.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), found)
