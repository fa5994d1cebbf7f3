"""Row-by-row comparison of registered queries with their SQL."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def differences(con, sql: str, df) -> list[str]:
    """What differs between a Spark result and the SQL's; empty when nothing does."""
    expected = con.sql(sql)
    columns = list(expected.columns)
    if sorted(columns) != sorted(df.columns):
        return [f"columns: {sorted(df.columns)} instead of {sorted(columns)}"]
    want = rows_of(columns, expected.fetchall())
    got = rows_of(df.columns, [tuple(row) for row in df.collect()])
    found = [] if len(want) == len(got) else [f"{len(got)} rows instead of {len(want)}"]
    found += [f"{a} instead of {b}"[:600] for a, b in zip(got, want) if a != b][:3]
    types_want = {c: str(t) for c, t in zip(columns, expected.types)}
    if not found:
        found_types = dict(df.dtypes)
        same = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
                "DATE": "date", "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean"}
        for name, kind in types_want.items():
            if same.get(kind) != found_types[name]:
                found.append(f"type of {name}: {found_types[name]} instead of {kind}")
    return found
