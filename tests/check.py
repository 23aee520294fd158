"""Compare a Spark result with DuckDB as multisets."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    return value


def _rows(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i].lower())
    return sorted(names, key=str.lower), sorted(
        (tuple(_cell(r[i]) for i in order) for r in records), key=lambda t: tuple((v is not None, str(v)) for v in t)
    )


def spark_rows(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    result = con.execute(sql)
    return _rows([d[0] for d in result.description], result.fetchall())
