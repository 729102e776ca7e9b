"""Holds a query's rows against DuckDB's rows for its SQL."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _order(row):
    return tuple((v is None, "n" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(type(v)), 0 if v is None else v) for v in row)


def compare(con, df, sql: str) -> None:
    columns = sorted(df.columns)
    relation = con.sql(f"SELECT {', '.join(f'\"{c}\"' for c in columns)} FROM ({sql})")
    assert {c: TYPES[t] for c, t in df.dtypes} == {c: str(t) for c, t in zip(relation.columns, relation.types, strict=True)}
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=_order)
    assert got == sorted((tuple(r) for r in relation.fetchall()), key=_order)
