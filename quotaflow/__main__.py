"""Command line of the full run: ``python -m quotaflow --sales ... --targets ... --output ...``."""

from __future__ import annotations

import argparse

from .plans.full_run import run
from .schemas import DEFAULT_YEAR, SALES_DIALECTS
from .session import build_session
from .sources import tables
from .sources.files import RunConfig


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="quotaflow", description="Sales against targets, end to end.")
    parser.add_argument("--sales", required=True, help="sales CSV, file or folder")
    parser.add_argument("--targets", required=True, help="targets CSV, separated by semicolons")
    parser.add_argument("--output", required=True, help="folder all executors can reach")
    parser.add_argument("--year", type=int, default=DEFAULT_YEAR)
    parser.add_argument("--geography", help="CSV of postal_code, city, state")
    parser.add_argument("--dialect", choices=sorted(SALES_DIALECTS), default="local")
    parser.add_argument("--policy", choices=["fill", "drop"], default="fill")
    parser.add_argument("--mode", choices=["relative", "absolute", "calendar"], default="relative")
    parser.add_argument("--database", help="also publish the tables in this database")
    parser.add_argument("--shuffle-partitions", type=int, help="for this run; the session's own number by default")
    parser.add_argument("--strict", action="store_true", help="end with exit code 1 when a check fails")
    return parser.parse_args(arguments)


def main(arguments: list[str] | None = None) -> None:
    """An error ends the process with a failure; nothing is swallowed."""
    options = vars(parse(arguments))
    database, strict = options.pop("database"), options.pop("strict")
    spark = build_session()
    result = run(spark, RunConfig(**options))
    if database:
        tables.create_database(spark, database)
        tables.publish({name: spark.read.parquet(path) for name, path in result.paths.items()}, database)
    result.summary.show(truncate=False)
    result.checks.show(truncate=False)
    if strict and (failed := result.failed()):
        raise SystemExit(f"failed checks: {', '.join(failed)}")


if __name__ == "__main__":
    main()
