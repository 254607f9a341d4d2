"""Run a query on Spark and its SQL on DuckDB, and compare the rows as a multiset."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(_plain(r[n]) for n in names) for r in df.collect())


def duck_rows(con, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    names = sorted(columns)
    order = [columns.index(n) for n in names]
    return names, Counter(tuple(_plain(r[i]) for i in order) for r in cursor.fetchall())


def difference(df, con, sql: str) -> str | None:
    """None when equal, else a short account of the difference."""
    names, got = spark_rows(df)
    wanted_names, wanted = duck_rows(con, sql)
    if names != wanted_names:
        return f"columns {names} != {wanted_names}"
    if got == wanted:
        return None
    extra, missing = got - wanted, wanted - got
    return (
        f"{sum(got.values())} rows, wanted {sum(wanted.values())}; "
        f"extra {list(extra)[:2]}; missing {list(missing)[:2]}"
    )
