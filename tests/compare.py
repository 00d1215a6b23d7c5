"""Compare a query's rows with its SQL run by DuckDB."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return int(value) if value.is_integer() else round(value, 9)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df):
    return sorted(df.columns), _rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return sorted(names), _rows(names, result.fetchall())


def differences(df, con, sql) -> str | None:
    """What differs, or None."""
    names, got = spark_rows(df)
    expected_names, expected = sql_rows(con, sql)
    if names != expected_names:
        return f"columns {names} != {expected_names}"
    if got != expected:
        extra = [r for r in got if r not in set(expected)][:3]
        missing = [r for r in expected if r not in set(got)][:3]
        return f"{len(got)} rows, expected {len(expected)}; extra {extra}; missing {missing}"
    return None
