"""Cases that once gave wrong answers."""

import pytest
from pyspark.sql import functions as F

from offerloom.functions import cleaning as C
from offerloom.functions import parsing as P
from offerloom.functions import text as X
from offerloom.operators import catalog as K
from offerloom.operators import relational as R
from offerloom.plans import scratch
from offerloom.sources import scans as S
from offerloom.sources import sinks


def values(spark, rows, function):
    df = spark.createDataFrame([(k, x) for k, x in enumerate(rows)], "k int, x string")
    return [r[0] for r in df.orderBy("k").select(function(F.col("x"))).collect()]


def test_upsert_with_null_keys(spark):
    schema = "a string, b string, price int, first int"
    old = spark.createDataFrame([(None, "1", 1, 1), ("x", None, 2, 1), (None, None, 3, 1)], schema)
    new = spark.createDataFrame([(None, "1", 5, 2), (None, "2", 7, 2), (None, None, 9, 2), ("y", "y", 8, 2)], schema)
    found = {(r["a"], r["b"]): (r["price"], r["first"]) for r in R.upsert(old, new, ["a", "b"], ["price"]).collect()}
    assert found == {(None, "1"): (5, 1), ("x", None): (2, 1), (None, "2"): (7, 2), (None, None): (9, 1), ("y", "y"): (8, 2)}


def test_gate_fails_for_a_missing_column(spark):
    report = R.quality_report(spark.createDataFrame([("a",)], "name string"), {"name": 0.5, "gone": 0.5})
    assert {r["column_name"]: (r["coverage"], r["passed"]) for r in report.collect()} == {"name": (1.0, True), "gone": (0.0, False)}
    with pytest.raises(ValueError, match="gone"):
        R.assert_quality(report)


def test_closure_has_no_depth_limit(spark):
    chain = spark.createDataFrame([(k, k - 1 if k > 1 else None, 0) for k in range(1, 9)], "key int, parent int, level int")
    assert sorted(r["count"] for r in R.tree_closure(chain, "key", "parent", "level").groupBy("key").count().collect()) == list(range(1, 9))
    with pytest.raises(ValueError, match="cycle"):
        R.tree_closure(spark.createDataFrame([(1, 2, 0), (2, 1, 0)], "key int, parent int, level int"), "key", "parent", "level")
    nodes = spark.createDataFrame([(f"u{k}", f"t{k}", f"u{k - 1}" if k > 1 else None) for k in range(1, 8)], "uid string, title string, parent_uid string")
    assert {r["source_uid"]: r["level"] for r in K.category_tree(nodes).collect()} == {f"u{k}": k for k in range(1, 8)}


def test_malformed_urls(spark):
    urls = ["http://a b/c", "https://shop.kz/x", None, "shop.kz", "https://shop.kz/%zz"]
    assert values(spark, urls, lambda c: S.allowed_url(c, ["shop.kz"])) == [False, True, False, False, True]
    rows = spark.createDataFrame([(u,) for u in ("https://a/%zz", "https://a/x+y", "https://a/x%20y", "https://a/x y")], "url string")
    found = {r["url"]: r["allowed"] for r in S.robots_allowed(rows, [("disallow", "/x+y"), ("disallow", "/x y")]).collect()}
    assert found == {"https://a/%zz": True, "https://a/x+y": False, "https://a/x%20y": False, "https://a/x y": False}


def test_title_case_and_entities(spark):
    assert values(spark, ["S-oil seven", "mobil 1", "ac/delco", None], P.title_case) == ["S-Oil Seven", "Mobil 1", "Ac/Delco", None]
    assert values(spark, ["масло s-oil 5w30"], lambda c: P.infer_brand(c, ["s-oil"])) == ["S-Oil"]
    texts = ["&laquo;a&raquo; &#8212; &#x2014; &amp;lt; &nbsp;&nosuch; &#150; & b", "plain", None, "", "&#0;&#99999999;"]
    assert values(spark, texts, X.unescape_html) == ["«a» — — &lt;  &nosuch; – & b", "plain", None, "", "&#0;&#99999999;"]


def test_brand_with_nothing_before_a_mark(spark):
    brands = spark.createDataFrame([("Bosch", "Bosch", 0)], "spelling string, brand string, ord int")
    df = spark.createDataFrame([(";a/b",), ("/Bosch;x",), ("Bosch, x",), (";;",)], "brand string")
    assert {r["brand"]: r["brand_clean"] for r in C.clean_brand(df, "brand", brands).collect()} == {";a/b": ";a", "/Bosch;x": "/Bosch", "Bosch, x": "Bosch", ";;": ";;"}


def test_replaced_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (3, 2):
        sinks.replace_table(spark.range(n), path)
        assert spark.read.parquet(path).count() == n
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Master:
        def __init__(self, name):
            self.conf = type("C", (), {"get": staticmethod(lambda *_: None)})
            empty = type("D", (), {"isEmpty": staticmethod(lambda: True)})
            java = type("J", (), {"sc": staticmethod(lambda: type("S", (), {"getCheckpointDir": staticmethod(lambda: empty)}))})
            self.sparkContext = type("X", (), {"master": name, "_jsc": java})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.shared_dir(Master("local-cluster[3,2,1000]"))


def test_page_text_decodes_every_entity(spark):
    """Against a plain version over all pages; the query's SQL knows six entities only."""
    import html
    import re

    from offerloom.plans import queries as engine
    from tests.oracle import DATA

    def plain(page):
        text = html.unescape(re.sub(r"(?s)<[^>]+>", " ", re.sub(r"(?is)<(script|style)[^>]*>.*?</\1>", " ", page)))
        return len(" ".join(text.split()))

    pages = {r["page_id"]: plain(r["html"]) for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    assert {r["page_id"]: r["n_chars"] for r in engine.QUERIES["page_text"](spark, DATA).collect()} == pages
