"""Runs registered queries against their SQL twins in DuckDB."""

from __future__ import annotations

import datetime
import math
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, datetime.datetime):
        return v.date() if v.time() == datetime.time() else v
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return float(v)
    return v


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_cell(r[i]) for i in order) for r in rows)


# Spark and DuckDB names of the types the results use.
SAME = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
}


def differences(df, con, sql) -> list[str]:
    """What is different, exactly and with multiplicity; nothing when all is equal."""
    relation = con.execute(sql)
    names = [c[0] for c in relation.description]
    types = {c[0]: str(c[1]) for c in relation.description}
    ours, mine = _bag(df.columns, [tuple(r) for r in df.collect()])
    theirs, other = _bag(names, relation.fetchall())
    if ours != theirs:
        return [f"columns {ours} against {theirs}"]
    found = [
        f"type of {n}: {t} against {types[n]}" for n, t in df.dtypes if SAME.get(t) != types[n]
    ]
    if mine != other:
        found.append(
            f"rows {sum(mine.values())} against {sum(other.values())}; "
            f"only here {list((mine - other).items())[:3]}; only there {list((other - mine).items())[:3]}"
        )
    return found
