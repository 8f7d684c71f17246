"""Row-for-row comparison of a Spark result with DuckDB."""

from __future__ import annotations

from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
                 "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def sort_key(row: tuple) -> tuple:
    return tuple((value is not None, str(value)) for value in row)


def differences(df, connection, sql: str) -> list[str]:
    """What differs, as readable lines; empty when schema and rows agree."""
    described = connection.execute(f"DESCRIBE {sql}").fetchall()
    expected_types = {name: kind for name, kind, *_ in described}
    problems = []
    if set(df.columns) != set(expected_types):
        return [f"columns {sorted(df.columns)} != {sorted(expected_types)}"]
    for field in df.schema:
        kind = field.dataType.simpleString()
        expected = SPARK_TO_DUCK.get(kind, kind.upper())
        if expected != expected_types[field.name]:
            problems.append(f"type of {field.name}: {kind} != {expected_types[field.name]}")
    names = sorted(df.columns)
    actual = sorted((tuple(row[n] for n in names) for row in df.collect()), key=sort_key)
    selected = ", ".join(f'"{n}"' for n in names)
    wanted = sorted(connection.execute(f"SELECT {selected} FROM ({sql}) q").fetchall(), key=sort_key)
    if len(actual) != len(wanted):
        problems.append(f"{len(actual)} rows != {len(wanted)} rows")
    wrong = [(a, w) for a, w in zip(actual, wanted) if a != w or any(
        isinstance(x, Decimal) and x.as_tuple().exponent != y.as_tuple().exponent for x, y in zip(a, w))]
    problems += [f"row {names}: {a} != {w}" for a, w in wrong[:3]]
    if not wanted:
        problems.append("no rows on either side")
    return problems
