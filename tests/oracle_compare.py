"""Compare a Spark result with the SQL oracle's result, without regard to row or column order."""

from __future__ import annotations

import datetime
import glob
import math
import os
from collections import Counter

import duckdb


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _value(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, (int, float)) or hasattr(value, "as_tuple"):
        number = float(value)
        return "nan" if math.isnan(number) else number
    return value


def _bag(names, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(_value(row[i]) for i in order) for row in rows)


def differences(frame, connection, sql: str) -> str:
    """Empty when both results are equal, otherwise a short description."""
    names, got = _bag(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = connection.execute(sql)
    wanted_names, wanted = _bag([c[0] for c in cursor.description], cursor.fetchall())
    if names != wanted_names:
        return f"columns {names} != {wanted_names}"
    if got != wanted:
        extra, missing = list((got - wanted).items()), list((wanted - got).items())
        return (
            f"{sum(got.values())} rows against {sum(wanted.values())}; "
            f"{len(extra)} unexpected, e.g. {extra[:2]}; {len(missing)} missing, e.g. {missing[:2]}"
        )
    return ""
