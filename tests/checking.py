"""Compare a registered query with its SQL twin in DuckDB."""

import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, folder, query, sql):
    """(names, rows) of both sides."""
    got = query(spark, folder)
    con = duck(folder)
    expected = con.execute(sql)
    names = [c[0] for c in expected.description]
    return (
        (sorted(got.columns), rows_of(got.columns, got.collect())),
        (sorted(names), rows_of(names, expected.fetchall())),
    )
