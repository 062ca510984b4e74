"""Nested products, linked data, and the small operators beside them."""

import json

import pytest
from pyspark.sql import functions as F

from offerloom.operators import relational as R
from offerloom.plans import clean
from offerloom.sources import products as PR
from offerloom.sources import sinks


def test_flat_product(spark):
    full = {
        "productId": 7, "id": 8, "info": {"title": " A ", "brand_name": ""}, "analytics": {"brand": "B"}, "finalPrice": 10, "price": 11, "slug": "s", "maxAvailableCount": 3,
        "categories": [{"name": "x"}, 5, {"name": None}, {"name": "y"}], "media": [], "images": [{"src": "u1"}, {"url": "", "image_path": "u2"}, {}],
        "attributes": [{"name": "k", "value": 1}, {"code": "c", "value_name": "v"}, {"name": "k", "value": 2}, {"name": "empty", "value": ""}, {"value": 1}],
    }
    df = spark.createDataFrame([(1, json.dumps(full)), (2, "{}"), (3, None), (4, "broken"), (5, "[]")], "k int, p string")
    rows = [r[0] for r in df.orderBy("k").select(PR.flat_product(F.col("p"), "other", "https://h")).collect()]
    assert rows[0].asDict() == {
        "product_id": "7", "name": "A", "price": "10", "price_old": "", "slug": "s", "brand": "B", "quantity_available": "3", "url": "https://h/p/s", "category": "x | y",
        "images": "u1 | u2", "attributes": {"k": "2", "c": "v"},
    }
    for row in rows[1:]:
        assert row.asDict() == dict.fromkeys(("product_id", "name", "price", "price_old", "slug", "brand", "quantity_available", "url", "images"), "") | {"category": "other", "attributes": {}}


def test_size_text(spark):
    df = spark.createDataFrame([("205", "55", "16"), ("205", "", "16"), (None, "55", "16")], "w string, p string, d string")
    assert [r[0] for r in df.select(PR.size_text(F.col("w"), F.col("p"), F.col("d"))).collect()] == ["205/55 R16", "", ""]


def test_page_product(spark):
    script = lambda x: f'<script type="application/ld+json"> {x} </script>'
    product = {"@type": ["Thing", "Product"], "name": "N &amp; M", "brand": "Z", "image": ["i", "j", "i"], "offers": [{"price": "1 200,0", "priceCurrency": "USD", "availability": "https://schema.org/InStock"}, {"price": 1}]}
    crumbs = {"@type": "BreadcrumbList", "itemListElement": [{"item": {"name": "a"}}, {"item": {}}, {"item": {"name": "b"}}]}
    pages = [
        script(json.dumps({"@type": "Product", "name": "first", "offers": {"price": 5}})) + script(json.dumps(product)),
        script("{no json") + script(json.dumps({"@graph": [crumbs, product, 3]})) + "<title>T</title><tr><td>k</td><td>v</td></tr>",
        script(json.dumps([crumbs, {"@type": "Product"}])) + "<h1><b>H</b></h1>",
        "", None,
    ]
    df = spark.createDataFrame([(k, p) for k, p in enumerate(pages)], "k int, html string")
    rows = [r[0] for r in df.orderBy("k").select(PR.page_product(F.col("html"), F.lit("https://h/p12-a"))).collect()]
    assert [(r["product_id"], r["name"], r["price"], r["currency"]) for r in rows] == [("12", "first", 5.0, "KZT"), ("12", "N & M", 1200.0, "USD"), ("12", "H", None, ""), ("12", "", None, ""), ("12", "", None, "")]
    assert (rows[1]["availability"], rows[1]["brand"], rows[1]["category"], rows[1]["images"], rows[1]["title"], rows[1]["attributes"]) == ("InStock", "Z", "a | b", "i | j", "T", {"k": "v"})
    assert rows[2]["category"] == "a | b" and rows[3]["category"] == rows[3]["images"] == ""


def test_small_operators(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b"), (2, "c")], "k int, `x.y` string")
    assert R.sample_rows(df, 1).count() == 1 and R.sample_rows(df, 5, 1).columns == ["k"] and R.sample_rows(df, -1).count() == 0
    made = []
    build = lambda: made.append(1) or df
    for _ in range(2):
        assert sinks.stored_or(spark, str(tmp_path / "t"), build).count() == 2
    assert made == [1]
    sinks.ensure_database(spark, "some_offers")
    sinks.ensure_database(spark, "some_offers")
    assert spark.catalog.databaseExists("some_offers")
    spark.sql("DROP DATABASE some_offers")


def test_cleaners_by_name(spark):
    brands = spark.createDataFrame([], "spelling string, brand string, ord int")
    df = spark.createDataFrame([("1", "Масло 4 л канистра")], "source_product_id string, product_name string")
    for name, groups in (("shop_oils", None), ("dump", {"dump": "oils"})):
        assert clean.clean_named(name, df.withColumn("package_type", F.lit(None).cast("string")), brands, F.lit(None), groups).first()["package_type"] == "canister"
    with pytest.raises(ValueError, match="no cleaner for dump"):
        clean.clean_named("dump", df, brands, F.lit(None))
