"""File readers and writers."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text
from ..schemas import DEFAULT_YEAR, SALES, SALES_DIALECTS, TARGETS, TARGETS_DIALECT
from . import places

# What a file must name for its rows to mean anything.
REQUIRED = {"sales": ("client_id", "sale_date", "volume_hl"), "targets": ("brand", "target_volume", "target_year")}
# Column with the texts of a row that are no value of their type or more exact than it.
REJECTED = "__rejected"
UNREAD, ROUNDED = "unread", "rounded"
_REJECTS = "array<struct<file:string,column_name:string,raw:string,reason:string>>"


@dataclass(frozen=True)
class RunConfig:
    """Parameters of a run."""

    sales: str
    targets: str
    output: str
    year: int = DEFAULT_YEAR
    geography: str | None = None
    dialect: str = "local"
    policy: str = "fill"
    mode: str = "relative"
    # For the run only; None leaves the session's number.
    shuffle_partitions: int | None = None
    # Steps that a run over the same inputs and parameters has finished are not done again.
    resume: bool = True


def list_input(spark: SparkSession, folder: str) -> DataFrame:
    """Names and sizes of the files in a folder; contents are not read."""
    return spark.read.format("binaryFile").load(folder).select("path", "length")


def require_input(spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType | None = None, **options) -> DataFrame:
    """The table at ``path``; an absent input fails here and not at the first action."""
    reader = spark.read.options(**options)
    try:
        return (reader.schema(schema) if schema is not None else reader).format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        folder = path.rstrip("/").rpartition("/")[0] or "."
        try:
            # The driver has listed the folder already to plan this.
            found = [f"{r.path.rpartition('/')[2]} ({r.length} bytes)" for r in list_input(spark, folder).orderBy("path").collect()]
        except AnalysisException:
            found = []
        raise FileNotFoundError(f"no input at {path}; the folder holds {found or 'nothing'}") from error


def _header(spark: SparkSession, path: str, sep: str, encoding: str) -> list[str]:
    """Column names of the file, in its own order: reads its first line only."""
    return require_input(spark, path, header=True, sep=sep, encoding=encoding).columns


def _typed(raw: Column, name: str, kind: T.DataType) -> Column:
    """A canonical column out of its text."""
    if isinstance(kind, T.BooleanType):
        value = text.parse_flag(raw)
    elif isinstance(kind, T.DateType):
        value = text.parse_date(F.substring(raw, 1, 10))
    elif isinstance(kind, (T.LongType, T.IntegerType)):
        # Codes may have been written as 12 or 12.0; 12.7 is no code.
        exact = raw.try_cast("decimal(38,10)")
        value = F.coalesce(raw.try_cast(kind), F.when(exact == F.floor(exact), F.floor(exact).try_cast(kind)))
    elif name == "postal_code":
        # Written as a number the leading zeros are lost; other texts stay as they are.
        value = F.when(raw.rlike("^[0-9]{1,7}$"), text.postal_from_number(raw)).otherwise(raw)
    elif isinstance(kind, T.StringType):
        value = raw
    else:
        # More places than the type has are rounded, as floats written out have them.
        value = raw.try_cast(kind)
    return value.alias(name)


def _is_rounded(raw: Column, value: Column, kind: T.DataType) -> Column:
    """True if the text has more places than its type, not counting zeros."""
    if not isinstance(kind, T.DecimalType):
        return F.lit(False)
    exact = raw.try_cast(T.DecimalType(38, 18))
    beyond = raw.rlike(rf"^[^eE]*\.[0-9]{{{kind.scale}}}[0-9]*[1-9][^eE]*$")
    # Without an exponent, and with no more characters after the point than the type has places, nothing can be lost.
    point = F.instr(raw, ".")
    long = ((point > 0) & (F.length(raw) - point > kind.scale)) | raw.contains("e") | raw.contains("E")
    return value.isNotNull() & long & (beyond | F.coalesce(exact != value, F.lit(False)))


def _read(
    spark, path, names: Mapping[str, str], target: T.StructType, sep: str, encoding: str, required: Sequence[str], mark: bool
) -> DataFrame:
    """All columns are declared as text and typed by expressions: text that is no value of its type gives null.

    A header that lacks a required column is an error.  With ``mark`` an array column has, for each text
    of a row that could not be read or was rounded, file, column, the text itself and which of both
    it is, and null for the row's other texts (see ``rejects``); it is empty where all were read as they stand.

    A folder's files must agree on their header; one that differs is an error
    and not a table with its columns mixed up.
    """
    header = _header(spark, path, sep, encoding)
    by_name = {theirs.lower(): ours for theirs, ours in names.items()}
    column = {by_name[h.strip().lower()]: h for h in header if h.strip().lower() in by_name}
    if absent := [c for c in required if c not in column]:
        raise ValueError(f"{path} has no column for {', '.join(absent)}; with separator {sep!r} its header is {header}")
    raw = require_input(
        spark,
        path,
        schema=T.StructType([T.StructField(h, T.StringType()) for h in header]),
        header=True,
        enforceSchema=False,
        sep=sep,
        encoding=encoding,
    )
    fields = [(f.name, raw[f"`{column[f.name]}`"], f.dataType) for f in target.fields if f.name in column]
    typed = [_typed(*[text_, name, kind]) for name, text_, kind in fields]
    if not mark:
        return raw.select(typed)
    # One projection of generated code, which parses a text once; only rows with a reason get an array made.
    bad, found = [], []
    for (name, text_, kind), value in zip(fields, typed, strict=True):
        unread, rounded = value.isNull() & (F.trim(text_) != ""), _is_rounded(text_, value, kind)
        bad.append(unread | rounded)
        entry = [F.col("_metadata.file_name").alias("file"), F.lit(name).alias("column_name"), text_.alias("raw")]
        reason = F.when(unread, UNREAD).when(rounded, ROUNDED).alias("reason")
        found.append(F.when(bad[-1], F.struct(*entry, reason)))
    rejected = F.when(reduce(Column.__or__, bad), F.array(*found)).otherwise(F.array().cast(_REJECTS))
    return raw.select(*typed, rejected.alias(REJECTED))


def read_sales(
    spark: SparkSession, path: str, dialect: str = "local", sep: str = ",", encoding: str = "UTF-8", mark: bool = False
) -> DataFrame:
    return _read(spark, path, SALES_DIALECTS[dialect], SALES, sep, encoding, REQUIRED["sales"], mark)


def read_targets(spark: SparkSession, path: str, sep: str = ";", encoding: str = "UTF-8", mark: bool = False) -> DataFrame:
    return _read(spark, path, TARGETS_DIALECT, TARGETS, sep, encoding, REQUIRED["targets"], mark)


def typed_columns(marked: DataFrame) -> list[str]:
    return [c for c in marked.columns if c != REJECTED]


def count_rejected(column: str, reason: str) -> Column:
    """Aggregate over marked rows: texts of a column that were rejected for a reason."""
    return F.count_if(F.exists(REJECTED, lambda r: (r["column_name"] == column) & (r["reason"] == reason)))


def count_unread(marked: DataFrame) -> DataFrame:
    """Column and number of its texts that were no value of its type; one row per column."""
    counts = [F.struct(F.lit(c).alias("column_name"), count_rejected(c, UNREAD).alias("unread")) for c in typed_columns(marked)]
    return marked.agg(F.array(*counts).alias("rows")).select(F.inline("rows"))


def rejects(marked: DataFrame) -> DataFrame:
    """File, column, raw text and reason of every text that was not read as it stands."""
    return marked.where(F.size(REJECTED) > 0).select(F.inline(REJECTED)).where("reason IS NOT NULL")


def rows_to_df(spark: SparkSession, rows: Sequence, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def write_csv(df: DataFrame, path: str, single: bool = False, order: Sequence[str | Column] = ()) -> None:
    """CSV with header, one file per task, or one file with ``single``.

    ``single`` is the caller's choice for a table that one task can write: its rows are
    brought together after their computation, so the work before stays parallel.
    ``order`` sorts the rows over the files, by their names.
    """
    if single:
        df = df.repartition(1).sortWithinPartitions(*order) if order else df.repartition(1)
    elif order:
        df = df.orderBy(*order)
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV this library wrote."""
    return spark.read.schema(schema).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Lakehouse table at a path; ``fmt="delta"`` where its package is installed."""
    df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true").save(path)


@dataclass(frozen=True)
class Exported:
    parquet: str
    csv: str
    rows: int
    seconds: float


def write_counted(df: DataFrame, path: str) -> int:
    """Writes Parquet and returns the number of rows, counted by the writing tasks."""
    seen = Observation()
    write_parquet(df.observe(seen, F.count(F.lit(1)).alias("rows")), path)
    return seen.get["rows"]


def export(df: DataFrame, name: str, output: str, single: bool = False, order: Sequence[str | Column] = ()) -> Exported:
    """A result as Parquet and as CSV, computed once: the CSV is written from the Parquet, in ``order``."""
    began = time.monotonic()
    parquet, csv = f"{output}/parquet/{name}", f"{output}/csv/{name}"
    rows = write_counted(df, parquet)
    write_csv(df.sparkSession.read.schema(df.schema).parquet(parquet), csv, single, order)
    return Exported(parquet, csv, rows, round(time.monotonic() - began, 3))


def new_run(output: str) -> str:
    """A folder for the results of one run, under ``output``."""
    return f"{output}/runs/{uuid.uuid4().hex}"


def switch(spark: SparkSession, output: str, folder: str, exported: Mapping[str, Exported], keep: int = 2) -> None:
    """Makes the run in ``folder`` the current one, for all its tables at once.

    The last ``keep`` runs stay, so that who has just looked up the one before can go on reading it; older ones are removed.
    """
    tables = {name: [e.rows, e.seconds] for name, e in exported.items()}
    for old in places.point(spark, f"{output}/current", {"run": folder.rpartition("/")[2], "tables": tables}, keep):
        if "run" in old:
            places.delete(spark, f"{output}/runs/{old['run']}")


def current(spark: SparkSession, output: str) -> dict[str, Exported]:
    """The tables of the run that was finished last."""
    found = places.pointed(spark, f"{output}/current")
    if found is None:
        raise FileNotFoundError(f"no finished run under {output}")
    folder = f"{output}/runs/{found['run']}"
    return {name: Exported(f"{folder}/parquet/{name}", f"{folder}/csv/{name}", *facts) for name, facts in found["tables"].items()}


def export_all(
    results: Mapping[str, DataFrame],
    output: str,
    single: bool = False,
    at_once: int = 4,
    orders: Mapping[str, Sequence[str | Column]] | None = None,
    keep: int = 2,
) -> dict[str, Exported]:
    """Every result as Parquet and as CSV; ``orders`` has the row order of those whose CSV has one.

    All are written to a folder of their own, and become current together when the last is done (see
    ``current``); a write that fails leaves what was current before.  A few results are written at a
    time, so that the cluster is not left to the last tasks of one table while others wait.
    """
    if not results:
        raise ValueError("nothing to export")
    orders, folder = orders or {}, new_run(output)
    spark = next(iter(results.values())).sparkSession
    try:
        with ThreadPoolExecutor(at_once) as pool:
            jobs = {name: pool.submit(export, df, name, folder, single, orders.get(name, ())) for name, df in results.items()}
        exported = {name: job.result() for name, job in jobs.items()}
    except Exception:
        places.delete(spark, folder)
        raise
    switch(spark, output, folder, exported, keep)
    return exported


def outputs_present(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Check row: every output has at least one file."""
    absent = []
    for path in paths:
        try:
            empty = list_input(spark, path).isEmpty()
        except AnalysisException:
            empty = True
        if empty:
            absent.append(path)
    detail = f"absent: {', '.join(absent)}" if absent else f"{len(paths)} written"
    return rows_to_df(spark, [("every output is written", not absent, detail)], "check string, passed boolean, detail string")


def selection_name(table: str, day: date) -> str:
    """File name of a downloaded selection: table and date."""
    return f"{table.replace(' ', '_').lower()}_{day:%Y%m%d}.csv"


def write_parts(df: DataFrame, path: str, order: Sequence[str | Column] = ()) -> list[tuple[str, int]]:
    """CSV parts without header, one per task, in ``order``; their manifest: each part's path and length, as they follow."""
    (df.orderBy(*order) if order else df).write.mode("overwrite").option("header", False).csv(path)
    parts = df.sparkSession.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "length")
    # The writing tasks number their files by partition.
    return sorted((r["path"], r["length"]) for r in parts.collect())


def export_selection(df: DataFrame, folder: str, table: str, day: date, order: Sequence[str | Column] = ()) -> str:
    """One CSV file with header.  The tasks write its parts, which are then joined as files: no task gets all rows."""
    spark, path = df.sparkSession, f"{folder}/{selection_name(table, day)}"
    parts = write_parts(df, f"{path}.parts", order)
    head = spark.createDataFrame([tuple(df.columns)], T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(df.columns))]))
    header = write_parts(head.coalesce(1), f"{path}.header")
    listed = [p for p, _ in (*header, *parts)]
    places.join_files(spark, listed, f"{path}.joined")
    wanted, found = sum(n for _, n in (*header, *parts)), places.length(spark, f"{path}.joined")
    if found != wanted:
        raise OSError(f"{path} has {found} bytes, its parts {wanted}")
    places.replace(spark, f"{path}.joined", path)
    for rest in (".parts", ".header"):
        places.delete(spark, path + rest)
    return path
