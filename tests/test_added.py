"""Operators on listings, sitemaps and mappings that no query covers."""

import json

import pytest
from pyspark.sql import functions as F

from offerloom.functions import parsing as P
from offerloom.operators import matching as X
from offerloom.operators import relational as R
from offerloom.sources import scans as S


def test_compatible_vehicles(spark):
    names = ["Фильтр масляный КАМАЗ Volvo", "Фильтр газель, ГАЗ-3302", "Фильтр ДВС ЯМЗ-236.1 BMW x5", "showcase", None]
    df = spark.createDataFrame([(k, name) for k, name in enumerate(names)], "k int, name string")
    rows = df.orderBy("k").select(P.compatible_brands(F.col("name")), P.compatible_models(F.col("name"))).collect()
    assert [r[0] for r in rows] == ["КАМАЗ; Volvo", "ГАЗ; Газель", "Bmw", None, None]
    assert [r[1] for r in rows] == [None, "ГАЗ-3302", "ДВС ЯМЗ-236.1", None, None]


def test_product_urls_and_images(spark):
    df = spark.createDataFrame([(1, "5", "oil-x"), (2, "5", ""), (3, "6", None), (4, None, "x"), (5, "", "x")], "k int, id string, slug string")
    found = [r[0] for r in df.orderBy("k").select(P.product_url("https://h", F.col("id"), F.col("slug"))).collect()]
    assert found == ["https://h/p5-oil-x.html", "https://h/p5.html", "https://h/p6.html", "", ""]
    product = {"name": "http://no", "image": "http://a", "image200": "ftp://b", "images": ["http://c", {"url": "http://d"}, {"url": "", "src": "http://e"}, {"src": 1}, None, "http://a"], "imageList": ["http://z"], "images2": {"url": "http://y"}}
    df = spark.createDataFrame([(1, json.dumps(product)), (2, "not json"), (3, None), (4, "{}")], "k int, product string")
    assert [r[0] for r in df.orderBy("k").select(P.image_urls(F.col("product"))).collect()] == [["http://a", "http://c", "http://d", "http://e"], [], [], []]


def test_category_key(spark):
    df = spark.createDataFrame([(1, 10, [1]), (2, 99, [1, 20, 10, 7]), (3, None, [1, 2]), (4, 99, None)], "k int, category int, path array<int>")
    keys = {10: "oils", 20: "tires"}
    find = lambda *other: [r[0] for r in df.orderBy("k").select(P.category_key(F.col("category"), F.col("path"), keys, *other)).collect()]
    assert find() == ["oils", "oils", None, None]
    assert find(F.lit("rest")) == ["oils", "oils", "rest", "rest"]


def test_sitemap_index_gives_no_sitemaps(spark, tmp_path):
    (tmp_path / "index.xml").write_text("<sitemapindex><sitemap><loc>https://a/1.xml</loc></sitemap><sitemap><loc>https://a/2.xml</loc></sitemap></sitemapindex>")
    (tmp_path / "1.xml").write_text("<urlset><url><loc> https://a/x </loc></url><!-- <url><loc>https://a/gone</loc></url> --></urlset>")
    (tmp_path / "2.xml").write_text("<urlset><url><lastmod>1</lastmod><loc>https://a/y</loc></url><url><loc>https://a/x</loc></url></urlset>")
    assert sorted(r["url"] for r in S.sitemap_urls(spark, str(tmp_path)).collect()) == ["https://a/x", "https://a/y"]


def test_source_urls_and_complete_columns(spark):
    rows = spark.createDataFrame([("s", "1", "old"), ("s", "2", "old"), ("s", "3", "old")], "source string, source_product_id string, source_url string")
    offers = spark.createDataFrame([("s", "1", "u2"), ("s", "1", "u1"), ("s", "2", " "), ("t", "3", "u3")], rows.schema)
    found = X.with_source_urls(rows, offers)
    assert {r["source_product_id"]: r["source_url"] for r in found.collect()} == {"1": "u1", "2": None, "3": None}
    assert R.assert_complete(found, ["source"]).count() == 3
    with pytest.raises(ValueError, match="source_url in 2 rows"):
        R.assert_complete(found, ["source", "source_url"])
    assert R.assert_complete(found.limit(0), ["source"]).count() == 0


def test_append_rows(spark):
    old = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    new = spark.createDataFrame([("a", 9, "x"), (None, 9, "x"), ("b", 3, "y")], "k string, v int, w string")
    assert sorted((r["k"] or "", r["v"], r["w"]) for r in R.append_rows(old, new, ["k"]).collect()) == [("", 2, None), ("a", 1, None), ("b", 3, "y")]
