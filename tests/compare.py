"""Order-insensitive comparison of a Spark answer and a DuckDB answer."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _key(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, f"{value:.9g}")
    return (1, str(value))


def _same(left, right) -> bool:
    if isinstance(left, float) and isinstance(right, float):
        return math.isclose(left, right, rel_tol=1e-9, abs_tol=1e-9)
    return type(left) is type(right) and left == right


def differences(spark_df, connection, sql: str) -> list[str]:
    relation = connection.sql(sql)
    columns = sorted(spark_df.columns)
    if columns != sorted(relation.columns):
        return [f"columns {columns} != {sorted(relation.columns)}"]
    position = {c: i for i, c in enumerate(relation.columns)}
    ours = sorted(([row[c] for c in columns] for row in spark_df.collect()), key=lambda r: [_key(v) for v in r])
    theirs = sorted(
        ([row[position[c]] for c in columns] for row in relation.fetchall()), key=lambda r: [_key(v) for v in r]
    )
    if len(ours) != len(theirs):
        return [f"{len(ours)} rows != {len(theirs)} rows"]
    return [
        f"{columns}: {a} != {b}" for a, b in zip(ours, theirs) if not all(_same(x, y) for x, y in zip(a, b))
    ]
