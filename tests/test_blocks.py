"""Blocks above the rules' cap of 250 offers, in the queries that have none."""

import datetime as dt

import duckdb
import pytest
from tests.oracle import rows
from tests.test_whole import LINE, PART

from offerloom.operators import matching as X
from offerloom.plans import queries as engine


@pytest.fixture(scope="module")
def large(spark, tmp_path_factory):
    """A block of 260 offers of two merchants and one of six offers of two others."""
    path = str(tmp_path_factory.mktemp("large"))
    parts = [(1000 * size + k, "same name", "Brand", "KIND", size, 10.0) for size, n in ((1, 130), (2, 3)) for k in range(n)]
    lines = [(p[0], s + 1, p[0], s, 100.0 + s, dt.datetime(1997, 1, 1), 1.0) for p in parts for s in ((0, 1) if p[4] == 1 else (2, 3))]
    spark.createDataFrame(parts, PART).write.parquet(f"{path}/part.parquet")
    spark.createDataFrame(lines, LINE).write.parquet(f"{path}/lineitem.parquet")
    return path


def both(spark, path, name):
    """The query's rows, the same as those of its SQL."""
    connection = duckdb.connect()
    for table in ("part", "lineitem"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{path}/{table}.parquet/*.parquet'")
    stated = connection.sql(engine.ORACLES[name])
    df = engine.QUERIES[name](spark, path)
    found = df.collect()
    assert rows(df.columns, [tuple(r) for r in found]) == rows(stated.columns, stated.fetchall())
    return found


def test_root_merchant_counts_offers_of_large_blocks(spark, large):
    """with the cap it was the merchant of the small block."""
    assert [tuple(r) for r in both(spark, large, "root_merchant")] == [("s0", 130)]


def test_masters_join_offers_of_large_blocks(spark, large):
    """with the cap each offer of the large block was a master by itself."""
    assert sorted((r["anchor"], r["n_members"]) for r in both(spark, large, "master_skus")) == [("s0:1000", 260), ("s2:2000", 6)]


def test_explanations_cover_large_blocks(spark):
    """F16: with the cap the block of 260 offers gave no pairs."""
    offers = [(f"{s}{k}", s, "B", "x one", "205", "55", "16", "winter") for s in ("a", "b") for k in range(130)]
    columns = ("sku_id", "source", "brand", "normalized_name", "tire_width", "tire_profile", "tire_diameter", "season")
    df = X.features(spark.createDataFrame(offers, ", ".join(f"{c} string" for c in columns)), "tires", None)
    assert X.match_category(df, "tires").select("sku_1", "sku_2").distinct().count() == 130 * 130
