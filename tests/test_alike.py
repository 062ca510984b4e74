"""Offers alike are matched once: results as for all pairs, from fewer of them."""

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F
from tests.oracle import DATA, rows
from tests.test_whole import LINE, PART

from offerloom.functions import matching as M
from offerloom.operators import matching as X
from offerloom.plans import queries as engine


@pytest.fixture(scope="module")
def copies(spark, tmp_path_factory):
    """Blocks of 8 to 160 offers with many copies, two names, seasons that differ or are unknown, and merchants that lack some parts."""
    path = str(tmp_path_factory.mktemp("copies"))
    parts = [(100 * size + k, f"same {'ring' if k % 4 else 'bolt'}", "Brand", "KIND", size, 10.0) for size in (2, 5, 9, 40, 63) for k in range(size)]
    lines = [(p[0], s + 1, p[0], s, 100.0 + s, dt.datetime(1997, 1, 1), 1.0) for p in parts for s in range(4) if (p[0] + s) % 5 or p[4] == 63]
    spark.createDataFrame(parts, PART).write.parquet(f"{path}/part.parquet")
    spark.createDataFrame(lines, LINE).write.parquet(f"{path}/lineitem.parquet")
    return path


@pytest.mark.parametrize("name", ["rule_scores", "root_merchant", "components", "match_groups", "master_skus", "sku_source_mapping", "json_unnest", "multi_source_share"])
def test_results_are_those_of_all_pairs(spark, copies, name):
    """Against the SQL with the rules' cap of 250 in place of 12."""
    connection = duckdb.connect()
    for table in ("part", "lineitem"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{copies}/{table}.parquet/*.parquet'")
    stated = connection.sql(engine.ORACLES[name].replace("BETWEEN 2 AND 12", f"BETWEEN 2 AND {X.MAX_BLOCK}"))
    df = engine.QUERIES[name](spark, copies)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(stated.columns, stated.fetchall())


def test_links_are_those_of_offers_that_stand_for_others(spark, copies):
    found, members = engine.links(spark, copies)
    kept = members.count()
    assert kept > 150 and members.select("alike").distinct().count() < kept / 2  # 252 offers of the largest block give no pairs
    assert 0 < found.count() < engine.QUERIES["rule_scores"](spark, copies).filter("rule_score >= 0.9").count() / 4


def test_given_texts_score_as_worked_out_ones(spark):
    df = spark.createDataFrame([("A", " a", "unknown", "1.0", "1"), (None, "x", "1.0", "2", "y")], "a string, b string, c string, d string, e string")
    raw = ({"brand_clean": F.col("a"), "article": F.col("c"), "x": F.col("d")}, {"brand_clean": F.col("b"), "article": F.col("d"), "x": F.col("e")})
    made = tuple({n: M.hard_value(c) for n, c in side.items()} for side in raw)
    for function in (M.rule_score, M.hard_mismatch, M.explanation):
        assert df.select(F.to_json(F.struct(function(*raw).alias("v")))).collect() == df.select(F.to_json(F.struct(function(*made, M.given).alias("v")))).collect()


def test_vectors_meet_once_for_all_pairs_that_share_them(spark, copies):
    path = copies
    spark.read.parquet(f"{DATA}/embeddings.parquet").write.mode("overwrite").parquet(f"{path}/embeddings.parquet")
    connection = duckdb.connect()
    for table in ("part", "lineitem", "embeddings"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{path}/{table}.parquet/*.parquet'")
    stated = connection.sql(engine.ORACLES["scored_matches"].replace("BETWEEN 2 AND 12", f"BETWEEN 2 AND {X.MAX_BLOCK}"))
    df = engine.QUERIES["scored_matches"](spark, path)
    assert "zip_with" not in df._jdf.queryExecution().toString()  # no inner product for each pair
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(stated.columns, stated.fetchall())


def all_pairs(df, category="tires"):
    """Every pair scored and explained by itself, then the best of each."""
    rules = X.RULES[category]
    df = df.withColumn("vector", M.unit(M.name_vector(F.col("name_clean"))))
    found = X.score_pairs(X.candidate_pairs(df, [*rules.score, "vector"]), rules)
    return X.best_pairs(X.exact_pairs(df).unionByName(found) if category == "filters" else found)


def texts_of(df):
    return rows(df.columns, [tuple(r) for r in df.withColumn("match_explanation", F.to_json("match_explanation")).collect()])


def test_explanations_are_those_of_all_pairs(spark, copies):
    """F1: kinds of offers are scored and explained, and pairs of offers only listed."""
    texts = {"normalized_name": F.lower("product_name"), "tire_width": F.col("size").cast("string"), "tire_profile": F.col("kind"), "tire_diameter": (F.col("part") % 4 + 14).cast("string"), "season": F.lit("winter")}
    stated = all_pairs(X.features(engine.latest(spark, copies).withColumns(texts), "tires", None))
    df = engine.QUERIES["match_explanations"](spark, copies)
    plan = df._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "window" not in plan and plan.index("generate inline") < plan.index("tojson")  # nothing is ranked; texts are made below the listing
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == texts_of(stated) and stated.count() > 1000


@pytest.mark.parametrize("category", ["tires", "filters"])
@pytest.mark.parametrize("vectors", [True, False])
def test_offers_that_come_twice_give_their_best_pair(spark, category, vectors):
    raw = ["brand", "normalized_name", "product_name", "tire_width", "tire_profile", "tire_diameter", "season", "filter_type", "oem_number"]
    made = [("a", "s1", "x one", "AB12"), ("a", "s1", "x other", "AB12"), ("b", "s2", "x one", "ab-12"), ("c", "s2", "x one", None), ("d", None, "x one", "AB12"), ("e", "s3", "x two 91T", "Q1"), ("a", "s1", "x one", "AB12")]
    offers = spark.createDataFrame([(k, s, "B", n, n, "205.0", "55", "16", None if k == "c" else "зима", "масляный", o) for k, s, n, o in made], ", ".join(f"{c} string" for c in ("sku_id", "source", *raw)))
    df = X.features(offers, category, None)
    found = X.match_category(df.withColumn("vector", M.name_vector(F.col("name_clean"))) if vectors else df, category)
    assert texts_of(found) == texts_of(all_pairs(df, category)) and found.count() >= 2
    again = X.features_of_texts(offers, raw, category)
    assert texts_of(X.match_category(again, category)) == texts_of(found)


def test_a_key_that_comes_twice_among_the_parts_gives_one_offer(spark, tmp_path):
    spark.createDataFrame([(1, "two", "B", "K", 1, 9.0), (1, "one", "B", "K", 1, 8.0)], PART).write.parquet(f"{tmp_path}/part.parquet")
    at = [dt.datetime(1997, 1, 1), dt.datetime(1998, 1, 1), None]
    spark.createDataFrame([(k, 1, 1, s, 5.0, at[k], 1.0) for k in range(3) for s in (3, 7, 8)], LINE).write.parquet(f"{tmp_path}/lineitem.parquet")
    found = engine.latest(spark, str(tmp_path)).collect()
    assert sorted((r["sku_id"], r["product_name"], r["old_price"], r["loaded_at"]) for r in found) == [("s0:1", "B one K 1 л", 160.0, at[1]), ("s3:1", "B one K 1 л", 160.0, at[1])]


def test_scores_are_worked_out_for_kinds_of_offers(spark, copies):
    """as many scores as kinds of offers have pairs, not as offers have."""
    spark.read.parquet(f"{DATA}/embeddings.parquet").write.mode("overwrite").parquet(f"{copies}/embeddings.parquet")
    plan = engine.QUERIES["scored_matches"](spark, copies)._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.index("generate inline") < plan.index("join")


def test_offers_by_part_are_those_of_the_latest_lines(spark, tmp_path):
    """merchants below 0 and none, a part twice, lines without a part; block sizes count offers, with and without a merchant."""
    path = str(tmp_path)
    parts = [(k, f"name {'ring' if k % 2 else 'bolt'}", None if k == 9 else "Brand", "A  KIND", k % 3, 10.0) for k in (*range(1, 12), 4)] + [(4, "another bolt", "Brand", "A  KIND", 1, 5.0)]
    lines = [(k, n, k % 14, s, float(n), dt.datetime(1997, 1, 1 + n), 1.0) for k in range(60) for n, s in enumerate((-3, -1, 0, 2, 7, None)) if (k + n) % 3]
    spark.createDataFrame(parts, PART).write.parquet(f"{path}/part.parquet")
    spark.createDataFrame(lines, LINE).write.parquet(f"{path}/lineitem.parquet")
    columns = ["sku_id", "source", "part", "block_key", *engine.COMPARED]
    offers = engine.comparable(spark, path).select(columns)
    parts = engine.comparable_parts(spark, path)
    found = parts.select("*", F.inline("members")).select(columns)
    assert rows(columns, [tuple(r) for r in found.collect()]) == rows(columns, [tuple(r) for r in offers.collect()]) and found.count() > parts.count() == 11
    for most in (5, 12, 250):
        kinds = [X.offer_kinds(df, engine.COMPARED, max_block=most, members=m) for df, m in ((offers, None), (parts, "members"))]
        assert len({repr(rows(k.columns, [tuple(r) for r in k.withColumn("members", F.array_sort("members")).collect()])) for k in kinds}) == 1
    assert kinds[0].count() > 3


def test_scores_ask_lines_for_part_and_merchant_only(spark, copies, tmp_path):
    """no line is ranked, so tables that have no dates and prices give the same scores."""
    for name, columns in (("lineitem", ["l_partkey", "l_suppkey"]), ("part", ["*"])):
        spark.read.parquet(f"{copies}/{name}.parquet").select(*columns).write.parquet(f"{tmp_path}/{name}.parquet")
    spark.read.parquet(f"{DATA}/embeddings.parquet").write.parquet(f"{tmp_path}/embeddings.parquet")
    spark.read.parquet(f"{DATA}/embeddings.parquet").write.mode("overwrite").parquet(f"{copies}/embeddings.parquet")
    few, all_ = (engine.QUERIES["scored_matches"](spark, path) for path in (str(tmp_path), copies))
    assert rows(few.columns, [tuple(r) for r in few.collect()]) == rows(all_.columns, [tuple(r) for r in all_.collect()]) and few.count() > 1000
