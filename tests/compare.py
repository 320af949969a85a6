"""Order-insensitive comparison of a Spark query with its expected SQL result."""

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool) or value is None:
        return repr(value)
    return f"{type(value).__name__}:{value}"


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    cells = sorted(tuple(_cell(row[i]) for i in order) for row in rows)
    return [names[i] for i in order], cells


def differences(df, connection, sql):
    """Empty text if equal, else a short description."""
    mine = _sorted(df.columns, [tuple(r) for r in df.collect()])
    result = connection.execute(sql)
    theirs = _sorted([d[0] for d in result.description], result.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} expected {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"{len(mine[1])} rows, expected {len(theirs[1])}"
    for a, b in zip(mine[1], theirs[1]):
        if a != b:
            return f"row {dict(zip(mine[0], a))} expected {dict(zip(mine[0], b))}"
    return ""
