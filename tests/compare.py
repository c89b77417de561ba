"""Order-free comparison of a Spark result with the same result from DuckDB."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat(timespec="microseconds")
    return repr(value)


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark_df, con, sql: str) -> list[str]:
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    expected = rows_of(names, result.fetchall())
    actual = rows_of(spark_df.columns, spark_df.collect())
    found = []
    if sorted(names) != sorted(spark_df.columns):
        found.append(f"columns {sorted(spark_df.columns)} vs {sorted(names)}")
    if not expected:
        found.append("the SQL side is empty")
    if actual != expected:
        found.append(
            f"{sum(actual.values())} vs {sum(expected.values())} rows; "
            f"only here {list((actual - expected).items())[:3]}; "
            f"only in SQL {list((expected - actual).items())[:3]}"
        )
    return found
