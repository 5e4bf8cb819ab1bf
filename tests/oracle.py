"""Compare registered queries with their SQL in DuckDB."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    return con


def family(name: str) -> str:
    name = name.lower()
    if name.startswith(("bigint", "int", "smallint", "tinyint", "hugeint", "ubigint", "uinteger")):
        return "integer"
    if name.startswith(("double", "float", "real")):
        return "double"
    return {"varchar": "string"}.get(name, name)


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def compare(spark_df, con, sql: str) -> list[str]:
    """Differences in column names, types, row count and rows; empty when the results agree."""
    relation = con.sql(sql)
    problems = []
    ours = dict(spark_df.dtypes)
    theirs = dict(zip(relation.columns, (str(t) for t in relation.types)))
    if set(ours) != set(theirs):
        return [f"columns {sorted(ours)} != {sorted(theirs)}"]
    for column in ours:
        if family(ours[column]) != family(theirs[column]):
            problems.append(f"type of {column}: {ours[column]} != {theirs[column]}")
    order = sorted(ours)
    a = Counter(tuple(plain(row[c]) for c in order) for row in spark_df.collect())
    picked = relation.select(*[duckdb.ColumnExpression(c) for c in order]).fetchall()
    b = Counter(tuple(plain(v) for v in row) for row in picked)
    if a.total() != b.total():
        problems.append(f"rows {a.total()} != {b.total()}")
    if a != b:
        problems.append(f"only ours: {str(list((a - b).items())[:2])[:600]}  only theirs: {str(list((b - a).items())[:2])[:600]}")
    return problems
