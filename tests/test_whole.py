"""Queries do the whole job: nothing is left out that the operators and their rules keep."""

import datetime as dt
from collections import defaultdict

import pytest
from tests.oracle import DATA, same

from offerloom.operators import matching as X
from offerloom.plans import queries as engine

PART = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
LINE = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_shipdate timestamp_ntz, l_quantity double"


@pytest.fixture(scope="module")
def blocks(spark, tmp_path_factory):
    """Four offers of each part: blocks of 12, 16, 40, 248 and 252 offers; the last is above the rules' cap."""
    path = str(tmp_path_factory.mktemp("blocks"))
    parts = [(1000 * size + k, "same name", "Brand", "KIND", size, 10.0) for size in (3, 4, 10, 62, 63) for k in range(size)]
    lines = [(p[0], s + 1, p[0], s, 100.0 + s, dt.datetime(1997, 1, 1), 1.0) for p in parts for s in range(4)]
    spark.createDataFrame(parts, PART).write.parquet(f"{path}/part.parquet")
    spark.createDataFrame(lines, LINE).write.parquet(f"{path}/lineitem.parquet")
    return path


def test_blocks_up_to_the_cap_keep_all_pairs(spark, blocks):
    members = defaultdict(list)
    for row in engine.keyed(spark, blocks).collect():
        members[row["block_key"]].append((row["sku_id"], row["source"]))
    assert sorted(map(len, members.values())) == [12, 16, 40, 248, 252] and X.MAX_BLOCK == 250
    expected = {(a, b) for m in members.values() if len(m) <= 250 for a, s in m for b, t in m if a < b and s != t}
    found = [(r["sku_1"], r["sku_2"]) for r in engine.QUERIES["candidate_pairs"](spark, blocks).collect()]
    assert len(found) == len(set(found)) and set(found) == expected


def test_offers_of_large_blocks_are_mapped(spark, blocks):
    found = engine.QUERIES["sku_source_mapping"](spark, blocks).collect()
    assert len(found) == 4 * (3 + 4 + 10 + 62 + 63)
    single = {r["source_product_id"] for r in found if r["match_method"] == "single_source"}
    assert single == {str(63000 + k) for k in range(63)}


def test_upsert_takes_the_history_of_all_offers(spark):
    """Old: the history before 1996; new: that of all offers, a unit dearer. No date cuts the new side."""
    old, new = (engine._history(where) for where in ("loaded_at < TIMESTAMP '1996-01-01'", "true"))
    stated = f"""WITH o AS ({old}), n AS (SELECT * REPLACE (price + 1 AS price) FROM ({new}) x)
      SELECT n.captured_at, COALESCE(o.price_date, n.price_date) AS price_date, n.sku_id, n.source, n.source_product_id, COALESCE(o.seller_name, n.seller_name) AS seller_name,
      n.price, n.old_price, n.discount_price FROM n LEFT JOIN o USING (source, source_product_id, captured_at)"""
    same(spark, engine.QUERIES["price_history_upsert"], stated)
    assert engine.QUERIES["price_history_upsert"](spark, DATA).filter("captured_at >= TIMESTAMP '1996-01-01'").count() > 4000


@pytest.mark.parametrize("name", ["sku_map_best", "attribute_mode_eav"])
def test_all_offers_are_mapped(spark, name):
    same(spark, engine.QUERIES[name], engine.ORACLES[name].replace(" WHERE part % 5 <> 0", ""))
    if name == "sku_map_best":
        assert engine.QUERIES[name](spark, DATA).count() == engine.latest(spark, DATA).count()


def test_cleaning_keeps_every_product(spark):
    """One row for each of the 2000 parts of sf0.01, those that come twice in the load too."""
    path = DATA.replace("sf0.001", "sf0.01")
    same(spark, engine.QUERIES["clean_table"], engine.ORACLES["clean_table"].replace("p_partkey % 500", "p_partkey"), path)
    assert engine.QUERIES["clean_table"](spark, path).count() == spark.read.parquet(f"{path}/part.parquet").count()
