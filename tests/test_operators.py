"""Operators on small tables: choices among ties, idempotence, and the paths that no SQL states."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from offerloom.functions import cleaning as C
from offerloom.functions import matching as M
from offerloom.functions import parsing as P
from offerloom.functions.embedded import object_after, page_offers, page_state, resolve_refs
from offerloom.operators import catalog as K
from offerloom.operators import matching as X
from offerloom.operators import relational as R
from offerloom.operators.components import connected_components
from offerloom.plans.run import Config, run_catalog
from offerloom.sources import scans as S
from offerloom.sources import sinks
from offerloom.sources.paged import PagedListing
from offerloom.streaming import ingest as I


def one(spark, function, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(function(F.col("x")).alias("v")).first()["v"]


@pytest.mark.parametrize(("text", "expected"), [
    ("Фильтр 04152-YZZA1 / OC-123", "04152-YZZA1; OC-123"), ("OEM: AB90915YZZ, 123456", "AB90915YZZ"), ("x", None), (None, None),
])
def test_oem_numbers(spark, text, expected):
    assert one(spark, C.oem_numbers, text) == expected


def test_names(spark):
    assert one(spark, C.normalized_name, "Акция! Масло Castrol  5W-30, ") == "масло castrol 5w-30"
    assert one(spark, P.tire_size, "Шина 205/55 R16 91V").asDict() == {"tire_width": 205, "tire_profile": 55, "tire_diameter": 16.0, "load_index": "91", "speed_index": "V"}
    assert one(spark, P.derived_attributes, "АКБ 60 Ah 12V обратная") == {"capacity_ah": "60", "voltage_v": "12", "polarity": "Обратная"}
    assert one(spark, lambda c: P.infer_brand(c, ["mobil", "mobil 1"]), "масло Mobil 1 5w30") == "Mobil 1"
    assert one(spark, lambda c: P.infer_brand(c, []), "Моторное масло foo") == "Foo"


def test_page_extraction(spark):
    html = '<script id="__NEXT_DATA__" type="x">{"a": 1}</script><script type="application/ld+json">{"@type": "Product"}</script><table><tr><td>A&amp;B</td><td>1</td></tr><tr><td>A&amp;B</td><td>2</td></tr></table>'
    assert one(spark, P.embedded_json, html) == '{"a": 1}'
    assert one(spark, P.json_ld, html) == ['{"@type": "Product"}']
    assert one(spark, P.spec_table, html) == {"A&B": "1"}


def test_clean_brand_without_case_and_junk(spark):
    brands = spark.createDataFrame([("Acdelco", "ACDelco", 0), ("ACDELCO", "Other", 1), ("Россия", None, 2)], "spelling string, brand string, ord int")
    df = spark.createDataFrame([("Acdelco",), ("acdelco",), ("россия",), ("205/55R16",), ("Zzz/Yyy",), (" ",), (None,)], "b string")
    found = {r["b"]: r["brand_clean"] for r in C.clean_brand(df, "b", brands).collect()}
    assert found == {"Acdelco": "ACDelco", "acdelco": "ACDelco", "россия": None, "205/55R16": None, "Zzz/Yyy": "Zzz", " ": None, None: None}


def test_golden_counts(spark):
    assert K.categories(spark).count() == 59
    assert K.attributes(spark).count() == 36
    counts = {r["ancestor"]: r["n"] for r in K.category_attributes(spark).join(R.tree_closure(K.categories(spark), "category_id", "parent_category_id", "level", K.LEVELS).filter("ancestor_level = 2"), "category_id").groupBy("ancestor").agg(F.count("*").alias("n")).collect()}
    assert counts == {2: 275, 30: 187, 50: 112, 60: 49}


def test_latest_takes_the_newest_and_nulls_last(spark):
    rows = [("s", 1, dt.datetime(2024, 1, 1), "a"), ("s", 1, None, "b"), ("s", 1, dt.datetime(2024, 2, 1), "c"), ("s", 1, dt.datetime(2024, 2, 1), "b")]
    df = spark.createDataFrame(rows, "source string, id int, loaded_at timestamp, v string")
    assert [r["v"] for r in R.latest_per_key(df, ["source", "id"]).collect()] == ["b"]


def test_blocking(spark):
    rows = [("a1", "A", "k"), ("a2", "A", "k"), ("b1", "B", "k"), ("c1", "A", "j"), ("c2", "A", "j"), ("d1", "A", None), ("d2", "B", None)]
    rows += [(f"x{k}", "AB"[k % 2], "big") for k in range(251)]
    df = spark.createDataFrame(rows, "sku_id string, source string, block_key string")
    assert sorted((r["sku_1"], r["sku_2"]) for r in X.candidate_pairs(df).collect()) == [("a1", "b1"), ("a2", "b1")]


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 501), (501, 500), (7, 7)], "a long, b long")
    found = {r["node"]: r["component"] for r in connected_components(edges, "a", "b").collect()}
    assert found == {**{k: 0 for k in range(201)}, 500: 500, 501: 500}
    assert connected_components(edges.limit(0), "a", "b").isEmpty()


def test_best_pairs_ignore_orientation(spark):
    rows = [("b", "a", "s1", "s2", 0.8, "x", "k"), ("a", "b", "s2", "s1", 0.9, "x", "k")]
    df = spark.createDataFrame(rows, "sku_1 string, sku_2 string, source_1 string, source_2 string, score double, match_type string, candidate_block_key string")
    assert [(r["sku_1"], r["source_1"], r["score"]) for r in X.best_pairs(df).collect()] == [("a", "s2", 0.9)]


def test_rule_score_and_penalty(spark):
    names = ["brand_clean", "width_clean", "profile_clean", "diameter_clean", "season_clean", "speed_index_clean"]
    left, right = ["b", "205", "55", "16", "winter", "unknown"], ["b", "205.0", "55", "16", "summer", "v"]
    df = spark.createDataFrame([tuple(left + right)], ", ".join(f"{n}_{k} string" for k in (1, 2) for n in names))
    sides = [{n: F.col(f"{n}_{k}") for n in names} for k in (1, 2)]
    row = df.select(M.rule_score(*sides).alias("r"), M.hard_mismatch(*sides).alias("m"), M.explanation(*sides).alias("e")).first()
    assert row["r"] == pytest.approx(6 / 7) and not row["m"]
    assert row["e"]["missing_fields"] == ["speed_index_clean"] and list(row["e"]["mismatched_fields"]) == ["season_clean"]


def history(spark, rows):
    df = spark.createDataFrame(rows, "source string, source_product_id string, price double, old_price double, loaded_at timestamp, parsed_at string")
    return K.price_history(df, spark.createDataFrame([("s", "1", "m")], "source string, source_product_id string, sku_id string"), F.lit("2024-05-05").cast("timestamp"))


def test_price_history_and_replay(spark):
    at = dt.datetime(2024, 1, 1, 12)
    new = history(spark, [("s", "1", 10.0, 12.0, at, ""), ("s", "2", 10.0, 10.0, None, "2024-01-02"), ("s", "3", None, 1.0, at, ""), ("s", " ", 1.0, None, at, "")])
    found = {r["source_product_id"]: r for r in new.collect()}
    assert set(found) == {"1", "2"}
    assert (found["1"]["discount_price"], found["1"]["sku_id"], found["1"]["parsed_at"]) == (10.0, "m", at)
    assert (found["2"]["discount_price"], found["2"]["sku_id"], found["2"]["captured_at"]) == (None, None, dt.datetime(2024, 5, 5))
    once = K.upsert_history(new.limit(0), new)
    assert sorted(map(tuple, K.upsert_history(once, new).collect())) == sorted(map(tuple, once.collect()))


def test_quality_gate_is_strict(spark):
    df = spark.range(100).select(F.when(F.col("id") < 95, "x").alias("name"))
    R.assert_quality(R.quality_report(df, {"name": 0.95}))
    with pytest.raises(ValueError, match="name"):
        R.assert_quality(R.quality_report(df.filter("name IS NULL").union(df), {"name": 0.95}))


def test_loads_replace_themselves(spark, tmp_path):
    path = str(tmp_path / "raw")
    df = spark.createDataFrame([("l1", 1), ("l2", 2)], "load_id string, v int")
    sinks.write_load(df, path)
    sinks.write_load(df.filter("load_id = 'l1'").withColumn("extra", F.lit("e")), path)
    assert sorted((r["load_id"], r["v"], r["extra"]) for r in sinks.read_load(spark, path).collect()) == [("l1", 1, "e"), ("l2", 2, None)]
    sinks.replace_table(df, str(tmp_path / "t"))
    sinks.replace_table(df.limit(1), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1


def test_files(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('﻿id,name\n1,"a ""b"", c"\n', encoding="utf-8")
    assert [tuple(r) for r in S.read_csv(spark, str(path)).select("id", "name").collect()] == [("1", 'a "b", c')]
    (tmp_path / "m.xml").write_text("<urlset><url><loc>https://a/1</loc></url><url><loc> https://a/1 </loc></url></urlset>")
    assert [r["url"] for r in S.sitemap_urls(spark, str(tmp_path / "m.xml")).collect()] == ["https://a/1"]
    raw = sinks.as_text(spark.createDataFrame([(1, None, [1, 2])], "a int, b string, c array<int>"))
    assert tuple(raw.first()) == ("1", "", "[1,2]")


def test_safe_names():
    assert S.safe_names(["Цена, тг", "Цена тг", "x" * 80])[:2] == ["c001_tsena_tg", "c002_tsena_tg"]
    assert len(S.safe_names(["x" * 80])[0]) == 55


def test_change_stream(spark, tmp_path):
    source = tmp_path / "in"
    schema = "id string, price int, at long"
    spark.createDataFrame([("a", 1, 1), ("a", 1, 2), ("b", 5, 1)], schema).write.json(str(source / "1"))
    stream = spark.readStream.schema(schema).json(str(source / "*"))
    out = I.change_stream(stream, "id", ["price"], "at")
    for _ in range(2):
        out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
        spark.createDataFrame([("a", 2, 3), ("b", 5, 2)], schema).write.mode("overwrite").json(str(source / "2"))
    found = sorted((r["key"], r["seq"], r["status"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert found == [("a", 1, "new"), ("a", 2, "unchanged"), ("a", 3, "changed"), ("b", 1, "new"), ("b", 2, "unchanged")]


def test_paged_listing(spark, tmp_path):
    for page, ids in ((1, [1, 2]), (2, [2, 3]), (3, [3])):
        (tmp_path / f"oils-{page}.json").write_text(json.dumps({"items": [{"id": i, "name": f"n{i}"} for i in ids]}))
    spark.dataSource.register(PagedListing)
    found = spark.read.format("paged_listing").options(url=f"file://{tmp_path}/{{category}}-{{page}}.json", categories="oils, tires").load()
    assert sorted((r["category"], r["page"], r["id"], json.loads(r["item"])["name"]) for r in found.collect()) == [("oils", 1, "1", "n1"), ("oils", 1, "2", "n2"), ("oils", 2, "3", "n3")]


def test_embedded_state(spark):
    html = 'x window.State = {"a": "}", "b": {"__ref": "k"}, "k": {"v": 1}}; y'
    assert json.loads(one(spark, page_state("window.State"), html))["a"] == "}"
    assert one(spark, page_state("none"), html) is None
    cache = json.loads(object_after(html, "window.State"))
    assert resolve_refs(cache["b"], cache) == {"v": 1}
    flat = json.dumps([{"company": 1, "price": 2, "quantity_in_stock": 3}, {"name": 4}, {"per_unit": 5}, 7, "S", 12.5, {"company": 1, "price": 2, "quantity_in_stock": 3}])
    assert [tuple(r) for r in one(spark, page_offers(), flat)] == [("S", 12.5, 7)]


def test_category_tree_and_price_changes(spark):
    nodes = spark.createDataFrame([("r", "Root", None), ("b", "B", "r"), ("a", " A ", "r"), ("c", "C", "a"), ("c", "C", "a")], "uid string, title string, parent_uid string")
    found = {r["source_uid"]: (r["category_id"], r["level"], r["parent_category_id"], r["is_leaf"]) for r in K.category_tree(nodes).collect()}
    assert found == {"r": (1, 1, None, False), "a": (2, 2, 1, False), "b": (3, 2, 1, True), "c": (4, 3, 2, True)}
    products = spark.createDataFrame([("p", [(5.0, 2), (4.0, None)], "2024-01-02T03"), ("q", [(1.0, 1)], "2024-01-02")], "id string, offers array<struct<price:double,quantity:long>>, parsed_at string")
    status = spark.createDataFrame([("p", "changed"), ("q", "unchanged")], "id string, status string")
    assert [tuple(r) for r in K.price_changes(products, status, ["id"]).collect()] == [("p", 4.0, 2, "2024-01-02")]


def test_whole_run(spark, tmp_path):
    rows = [(k, f"Шина Bosch M{k} 205/55 R16 91V зимняя", "Bosch", str(100 + k), "120") for k in range(6)]
    raw = spark.createDataFrame(rows, "id int, name string, brand string, price string, old_price string")
    brands = spark.createDataFrame([("Bosch", "Bosch", 0)], "spelling string, brand string, ord int")
    oils = spark.createDataFrame([(99, "Масло Castrol EDGE 5W-30 4 л", "Castrol", "5")], "id int, name string, brand string, price string")
    config = Config("l1", str(tmp_path), {("s1", "tires"): raw, ("s2", "tires"): raw.limit(4), ("s1", "oils"): oils}, brands, F.lit("2024-01-01").cast("timestamp"))
    for _ in range(2):  # a second run of the same load changes nothing
        out = run_catalog(spark, config)
        assert out["sku_source_mapping"].count() == 11 and out["sku_price_history"].count() == 11
        sizes = [len(r["source_id"]) for r in out["skus"].collect()]
        assert sum(sizes) == 11 and max(sizes) > 1
        seasons = out["sku_attribute_values"].filter("attribute = 'season'").select("value").distinct().collect()
        assert [r["value"] for r in seasons] == ["winter"]
