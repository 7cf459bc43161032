"""Runs a registered query and its SQL and compares types and rows."""

import os

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(row[i] for i in order) for row in rows),
        key=lambda row: tuple((v is None, str(v)) for v in row),
    )


def compare(spark, connection, query, sql, sf_dir):
    """None if equal, else a description of the first difference."""
    df = query(spark, sf_dir)
    left = normal([tuple(r) for r in df.collect()], df.columns)
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    right = normal(cursor.fetchall(), names)
    types = {n: str(d[1]) for n, d in zip(names, cursor.description)}
    expected = {n: TYPES.get(t, t) for n, t in df.dtypes}
    if types != expected:
        return f"types: spark {expected} sql {types}"
    if len(left) != len(right):
        return f"rows: spark {len(left)} sql {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"row: spark {a} sql {b}"
    return None
