"""Runs a query in both engines and compares whole results."""

import math

import duckdb

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(path=DATA):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}/{name}.parquet'")
    return connection


def _value(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else repr(v)


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(columns), sorted(tuple(_value(r[k]) for k in order) for r in found)


def same(spark, query, sql, path=DATA):
    df = query(spark, path)
    stated = connect(path).sql(sql)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(stated.columns, stated.fetchall())
