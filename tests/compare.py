"""Comparison of a Spark result with DuckDB's."""

from __future__ import annotations

import math
import re
from datetime import date, datetime
from decimal import Decimal

import duckdb

from casebook.fixtures import TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, Decimal):
        return str(value)
    if isinstance(value, datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, date):
        return value.isoformat()
    return repr(value)


def kinds_of_spark(df) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def kinds_of_duck(con, sql: str) -> dict[str, str]:
    names = {
        "BIGINT": "bigint", "INTEGER": "int", "SMALLINT": "smallint", "VARCHAR": "string", "DOUBLE": "double",
        "TIMESTAMP": "timestamp_ntz", "DATE": "date", "BOOLEAN": "boolean",
    }
    rows = con.execute(f"describe {sql}").fetchall()
    return {r[0]: names.get(r[1], r[1].lower()) for r in rows}


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, query, sql: str, folder: str) -> list[str]:
    df = query(spark, folder)
    ours = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    theirs = rows_of([d[0] for d in result.description], result.fetchall())
    problems = []
    a, b = kinds_of_spark(df), kinds_of_duck(con, sql)
    if a != b:
        problems.append(f"schema {sorted(set(a.items()) ^ set(b.items()))}")
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} / {len(theirs)}")
    if ours != theirs:
        ours_only, theirs_only = list(set(ours) - set(theirs))[:2], list(set(theirs) - set(ours))[:2]
        problems.append(f"values {ours_only} / {theirs_only}")
    if not ours:
        problems.append("no rows")
    plan = df._jdf.queryExecution().executedPlan().toString()
    if re.search(r"Python|ArrowEval|CartesianProduct|NestedLoopJoin", plan):
        problems.append("plan leaves the built-in operators or joins without a key")
    return problems
