"""Side-by-side run of a query and its SQL on the given tables."""

import glob
import math
import os
from decimal import Decimal

import duckdb


def connect(sf_dir):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def rows_of_spark(df):
    names = sorted(df.columns)
    return names, [tuple(_plain(row[n]) for n in names) for row in df.collect()]


def rows_of_duckdb(connection, sql):
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_plain(row[i]) for i in order) for row in result.fetchall()]
    return [columns[i] for i in order], rows


def _key(row):
    return tuple((value is None, str(type(value)), str(value)) for value in row)


def difference(spark_rows, sql_rows):
    """None when equal, else a short description of the first difference."""
    left, right = sorted(spark_rows, key=_key), sorted(sql_rows, key=_key)
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}"
    for a, b in zip(left, right):
        if a != b or [type(x) for x in a] != [type(y) for y in b]:
            return f"{a!r}\n against\n{b!r}"
    return None
