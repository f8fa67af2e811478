"""Compares a query's rows with its SQL, columns by name and rows in any order."""

import math
from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 9)
    if isinstance(x, Decimal):
        return float(x)
    if isinstance(x, (list, tuple)):
        return tuple(map(_plain, x))
    return x


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in data), key=repr)


def compare(spark, name, query, sql, d):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    want = con.execute(sql)
    names = [c[0] for c in want.description]
    expected = rows(names, want.fetchall())
    df = query(spark, d)
    assert sorted(df.columns) == sorted(names), f"{name}: {sorted(df.columns)} and {sorted(names)}"
    got = rows(df.columns, df.collect())
    assert len(got) == len(expected), f"{name}: {len(got)} rows, SQL {len(expected)}"
    bad = [(a, b) for a, b in zip(got, expected) if a != b]
    assert not bad, f"{name}: {len(bad)} differ, first {bad[0]}"
