"""Cross-merchant matching: blocking, scoring, components, master records."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import matching as M
from ..plans.scratch import materialize
from .components import connected_components
from .relational import sequential_ids, top_per_key


@dataclass(frozen=True)
class Rules:
    """How a category's offers are blocked and scored."""

    block: tuple[str, ...]
    score: tuple[str, ...]
    threshold: float = 0.78
    rule_weight: float = 0.55
    embedding_weight: float = 0.45
    method: str = "rules+embeddings"


#: The categories' rules.
RULES = {
    "tires": Rules(("width_clean", "profile_clean", "diameter_clean"), ("brand_clean", "width_clean", "profile_clean", "diameter_clean", "season_clean", "speed_index_clean")),
    "oils": Rules(("viscosity_clean", "volume_clean"), ("brand_clean", "viscosity_clean", "volume_clean", "oil_type_clean", "product_line_clean")),
    "filters": Rules(("filter_type_clean",), ("brand_clean", "filter_type_clean", "oem_clean", "article"), 0.76, 0.60, 0.40),
    "batteries": Rules(("capacity_clean", "voltage_clean"), ("brand_clean", "capacity_clean", "voltage_clean", "battery_type_clean", "model_clean")),
}
MAX_BLOCK = 250


def block_sizes(df: DataFrame, key: str = "block_key", source: str = "source") -> DataFrame:
    """Per block: rows and sources, pre-aggregated by source."""
    per = df.filter(F.col(key).isNotNull()).groupBy(key, source).agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy(key).agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_sources"))


def pairing_blocks(sizes: DataFrame, key: str = "block_key", max_block: int | None = MAX_BLOCK) -> DataFrame:
    """The keys of blocks that give pairs: not those of one row, of one source, or above ``max_block`` rows."""
    return sizes.filter((F.col("n_rows") >= 2) & (F.col("n_sources") >= 2) & (F.lit(True) if max_block is None else F.col("n_rows") <= max_block)).select(key)


def paired_offers(df: DataFrame, key: str = "block_key", max_block: int | None = MAX_BLOCK) -> DataFrame:
    """The offers of blocks that give pairs."""
    return df.join(pairing_blocks(block_sizes(df, key), key, max_block), key)


def _pairs(kept: DataFrame, carry: Sequence[str], key: str) -> DataFrame:
    side = lambda k: kept.select(F.col(key), F.col("sku_id").alias(f"sku_{k}"), F.col("source").alias(f"source_{k}"), *[F.col(c).alias(f"{c}_{k}") for c in carry])
    return side(1).join(side(2), key).filter(F.col("source_1") != F.col("source_2"))


def candidate_pairs(df: DataFrame, carry: Sequence[str] = (), key: str = "block_key", max_block: int | None = MAX_BLOCK) -> DataFrame:
    """Pairs of offers from different sources within a block, sku_1 < sku_2, with ``carry`` columns of both sides.

    Blocks of one row, of one source, or above ``max_block`` rows are left out, so a block yields a bounded number of pairs
    and the self-join on the key stays linear in the input."""
    return _pairs(paired_offers(df, key, max_block), carry, key).filter("sku_1 < sku_2")


def alike_offers(df: DataFrame, attributes: Sequence[str], key: str = "block_key", max_block: int | None = MAX_BLOCK) -> DataFrame:
    """The offers of blocks that give pairs, with ``alike``: the least sku_id among those of one source and block whose attributes are
    equal. What depends on the attributes alone is the same for all of them, so the pairs of the least ones stand for all pairs.
    ``df`` has one row per sku_id."""
    same = Window.partitionBy(key, "source", *attributes)
    return paired_offers(df, key, max_block).withColumn("alike", F.min("sku_id").over(same))


def alike_pairs(kept: DataFrame, carry: Sequence[str] = (), key: str = "block_key") -> DataFrame:
    """Candidate pairs of those that stand for the offers alike; ``kept`` comes from ``alike_offers``."""
    return _pairs(kept.filter("sku_id = alike"), carry, key).filter("sku_1 < sku_2")


def offer_kinds(df: DataFrame, attributes: Sequence[str], key: str = "block_key", max_block: int | None = MAX_BLOCK, members: str | None = None) -> DataFrame:
    """One row for the offers of a block whose attributes are equal, in blocks that give pairs: key, attributes and ``members`` (sku_id,
    source; no more than the block has), with the least and greatest sku_id and source. Unlike ``alike_offers`` it keeps pairs and not
    just links: ``member_pairs`` gives them back. ``df`` may have several rows of a sku_id. With ``members``, a row of ``df`` stands for
    all the offers (sku_id, source) in that array, and only sizes are counted offer by offer."""
    ends = [F.min("first").alias("first"), F.max("last").alias("last"), F.min("low").alias("low"), F.max("high").alias("high")]
    if members is None:
        known = F.col("sku_id").isNotNull() & F.col("source").isNotNull()
        kept = paired_offers(df, key, max_block).filter(known).withColumns({"first": F.col("sku_id"), "last": F.col("sku_id"), "low": F.col("source"), "high": F.col("source")})
        return kept.groupBy(key, *attributes).agg(F.collect_list(F.struct("sku_id", "source")).alias("members"), *ends)
    fine = pairing_blocks(block_sizes(df.select(key, F.inline(members)), key), key, max_block)
    known = F.filter(members, lambda m: m["sku_id"].isNotNull() & m["source"].isNotNull())
    kept = df.join(fine, key).withColumn("members", known).filter(F.size("members") > 0)
    sides = {"first": F.array_min("members.sku_id"), "last": F.array_max("members.sku_id"), "low": F.array_min("members.source"), "high": F.array_max("members.source")}
    return kept.withColumns(sides).groupBy(key, *attributes).agg(F.flatten(F.collect_list("members")).alias("members"), *ends)


def kind_pairs(kinds: DataFrame, carry: Sequence[str] = (), key: str = "block_key") -> DataFrame:
    """Ordered pairs of kinds of a block, a kind with itself too, that have a pair of offers: key, members_1, members_2, ``carry`` of both."""
    names = ("members", "first", "last", "low", "high", *carry)
    side = lambda k: kinds.select(F.col(key), *[F.col(c).alias(f"{c}_{k}") for c in names])
    some = (F.col("first_1") < F.col("last_2")) & (F.least("low_1", "low_2") < F.greatest("high_1", "high_2"))
    return side(1).join(side(2), key).filter(some).drop(*[f"{c}_{k}" for c in ("first", "last", "low", "high") for k in (1, 2)])


def member_pairs(pairs: DataFrame) -> DataFrame:
    """For each pair of kinds its pairs of offers from different sources, sku_1 < sku_2 (sku_1, sku_2, source_1, source_2 and the other
    columns): what was worked out for the kinds goes to all of them, without a shuffle."""
    rest = [c for c in pairs.columns if c not in ("members_1", "members_2")]
    lefts = pairs.select(*rest, "members_2", F.inline("members_1").alias("sku_1", "source_1"))
    both = lefts.select(*rest, "sku_1", "source_1", F.inline("members_2").alias("sku_2", "source_2"))
    return both.filter((F.col("sku_1") < F.col("sku_2")) & (F.col("source_1") != F.col("source_2")))


def for_members(rows: DataFrame, members: DataFrame | None) -> DataFrame:
    """``rows`` (sku_id and more) of those that stand for others, for each of ``members`` (sku_id, alike); as they are without members."""
    return rows if members is None else members.select("sku_id", "alike").join(rows.withColumnRenamed("sku_id", "alike"), "alike").drop("alike")


def score_pairs(
    pairs: DataFrame, rules: Rules, vector: str = "vector", value: Callable[[Column], Column] = M.hard_value, ids: Sequence[str] = ("sku_1", "sku_2", "source_1", "source_2"),
    explain: Callable[[Column], Column] = M.given,
) -> DataFrame:
    """Rule, embedding and total score of pairs that carry the score attributes and unit vectors, and those that reach the threshold.
    ``value`` as in ``M.rule_score``; ``ids`` are kept; ``explain`` gives the explanation its form."""
    left, right = ({n: F.col(f"{n}_{k}") for n in rules.score} for k in (1, 2))
    scored = pairs.withColumns({"rule": M.rule_score(left, right, value), "emb": M.dot(F.col(f"{vector}_1"), F.col(f"{vector}_2"))})
    total = F.col("rule") * rules.rule_weight + F.col("emb") * rules.embedding_weight
    scored = scored.withColumn("total", F.when(M.hard_mismatch(left, right, value), total * M.MISMATCH_FACTOR).otherwise(total))
    kept = scored.filter(F.col("total") >= rules.threshold)
    return kept.select(
        *ids, F.round("total", 3).alias("score"), F.round("rule", 3).alias("rule_score"),
        F.round("emb", 3).alias("embedding_score"), F.lit(rules.method).alias("match_type"), F.lit("category+brand+" + "+".join(rules.block)).alias("candidate_rule"),
        F.col("block_key").alias("candidate_block_key"), explain(M.explanation(left, right, value)).alias("match_explanation"),
    )


def exact_pairs(df: DataFrame, col: str = "oem_clean", category: str = "filters") -> DataFrame:
    """Pairs from different sources that share a known exact code; score 1."""
    known = df.filter(M.is_known(F.col(col))).withColumn("code", F.col(col))
    pairs = candidate_pairs(known, key="code", max_block=None)
    same = F.map_from_entries(F.array(F.struct(F.lit(col), F.struct(F.col("code").alias("left"), F.col("code").alias("right")))))
    nothing = F.map_filter(same, lambda k, v: F.lit(False))
    return pairs.select(
        "sku_1", "sku_2", "source_1", "source_2", F.lit(1.0).alias("score"), F.lit(1.0).alias("rule_score"), F.lit(None).cast("double").alias("embedding_score"),
        F.lit("OEM").alias("match_type"), F.lit("category+oem_number").alias("candidate_rule"), F.concat(F.lit(f"{category}|"), "code").alias("candidate_block_key"),
        F.struct(same.alias("matched_fields"), nothing.alias("mismatched_fields"), F.array().cast("array<string>").alias("missing_fields")).alias("match_explanation"),
    )


def best_pairs(matches: DataFrame) -> DataFrame:
    """One row per unordered pair: the best score, then the least method."""
    a, b = F.least("sku_1", "sku_2"), F.greatest("sku_1", "sku_2")
    flip = F.col("sku_1") > F.col("sku_2")
    turned = matches.withColumns({
        "source_1": F.when(flip, F.col("source_2")).otherwise(F.col("source_1")), "source_2": F.when(flip, F.col("source_1")).otherwise(F.col("source_2")), "sku_1": a, "sku_2": b,
    })
    rank = F.row_number().over(Window.partitionBy("sku_1", "sku_2").orderBy(F.col("score").desc(), "match_type", "candidate_block_key"))
    return turned.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def root_merchant(matches: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """The source with most distinct matched offers (one row; the least name among equals). With ``members``, matches are those of ``alike_pairs``."""
    sides = [matches.select(F.col(f"sku_{k}").alias("sku_id"), F.col(f"source_{k}").alias("source")) for k in (1, 2)]
    counts = for_members(sides[0].unionByName(sides[1]).distinct(), members).groupBy("source").agg(F.count(F.lit(1)).alias("n_skus"))
    return counts.orderBy(F.col("n_skus").desc(), "source").limit(1)


def components(matches: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """Per matched offer (sku_id): component, the least offer it can reach. With ``members``, matches are those of ``alike_pairs``:
    offers alike have the same partners, so they lie in one component, and its least offer stands for others."""
    return for_members(connected_components(matches, "sku_1", "sku_2").select(F.col("node").alias("sku_id"), "component"), members)


def match_groups(offers: DataFrame, matches: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """Per offer (sku_id, source): component (its least offer), n_members, anchor: the least offer of the root merchant, else the
    component. Offers without a match stand alone. With ``members``, matches are those of ``alike_pairs``."""
    labels = components(matches, members)
    placed = offers.select("sku_id", "source").join(labels, "sku_id", "left").withColumn("component", F.coalesce("component", "sku_id"))
    root = root_merchant(matches, members).select(F.col("source").alias("root_source"))
    placed = placed.join(F.broadcast(root), F.col("source") == F.col("root_source"), "left")
    heads = placed.groupBy("component").agg(F.count(F.lit(1)).alias("n_members"), F.min(F.when(F.col("root_source").isNotNull(), F.col("sku_id"))).alias("root_sku"))
    heads = heads.withColumn("anchor", F.when(F.col("n_members") > 1, F.coalesce("root_sku", "component")).otherwise(F.col("component"))).drop("root_sku")
    return placed.select("sku_id", "source", "component").join(heads, "component")


def master_skus(offers: DataFrame, groups: DataFrame) -> DataFrame:
    """One record per component: the anchor's name and brand, the members' most frequent category (the least among equals), all
    members, and an id by the order of anchors. ``offers``: sku_id, source, source_product_id, name, brand, category_id, description."""
    full = groups.join(offers.drop("source"), "sku_id")
    votes = full.groupBy("anchor", "category_id").agg(F.count(F.lit(1)).alias("n"))
    category = top_per_key(votes, ["anchor"], [F.col("n").desc(), F.col("category_id").asc()]).select("anchor", "category_id")
    members = full.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct(F.col("source_product_id").alias("id"), "source"))).alias("source_id"))
    heads = full.filter(F.col("sku_id") == F.col("anchor")).select("anchor", "name", "brand", F.col("description").alias("normalized_description"))
    made = heads.join(category, "anchor").join(members, "anchor")
    numbered = sequential_ids(made, "anchor", "sku_", 11)
    return numbered.select("id", "name", "brand", "category_id", "normalized_description", F.lit("active").alias("status"), "source_id", F.lit(False).alias("is_szpt"), "anchor")


def source_mapping(offers: DataFrame, groups: DataFrame, masters: DataFrame, matches: DataFrame, members: DataFrame | None = None) -> DataFrame:
    """Per offer: its master and how it got there: the anchor with 1, the others with their best direct pair. With ``members``, matches
    are those of ``alike_pairs``."""
    ends = [matches.select(F.col(f"sku_{k}").alias("sku"), "score", "match_type") for k in (1, 2)]
    best = ends[0].unionByName(ends[1]).groupBy("sku").agg(F.max(F.struct("score", "match_type")).alias("best")).withColumnRenamed("sku", "sku_id")
    best = for_members(best, members)
    rows = groups.join(offers.drop("source"), "sku_id").join(masters.select("anchor", F.col("id").alias("master")), "anchor").join(best, "sku_id", "left")
    anchor = F.col("sku_id") == F.col("anchor")
    method = F.when(anchor, F.when(F.col("n_members") > 1, "root").otherwise("single_source")).otherwise(F.coalesce("best.match_type", F.lit("rules+embeddings")))
    score = F.when(anchor, 1.0).otherwise(F.coalesce("best.score", F.lit(0.0)))
    rows = rows.withColumns({"match_method": method, "match_score": F.round(score, 3)})
    return rows.select(
        F.col("master").alias("sku_id"), "source", "source_product_id", F.col("name").alias("source_product_name"), "match_method", "match_score",
        M.confidence_bucket(F.col("match_score"), F.col("match_method")).alias("match_confidence"),
    )


def with_source_urls(rows: DataFrame, offers: DataFrame, keys: Sequence[str] = ("source", "source_product_id")) -> DataFrame:
    """``rows`` with the offers' source_url in place of their own: one for each key, the least that isn't blank, else null."""
    found = offers.filter(F.trim("source_url") != "").groupBy(*keys).agg(F.min("source_url").alias("source_url"))
    return rows.drop("source_url").join(found, list(keys), "left")


def features(df: DataFrame, category: str, encode: Callable[[Column], Column] | None = M.name_vector) -> DataFrame:
    """An offer table's cleaned attributes, block key and name vector for its category; no vector without ``encode``."""
    name, raw = F.col("normalized_name"), F.col
    out: dict[str, Column] = {"name_clean": M.clean_text(name), "brand_clean": M.or_unknown(F.lower(F.trim(raw("brand"))))}
    if category == "tires":
        out |= {
            "width_clean": M.clean_width(raw("tire_width")), "profile_clean": M.clean_profile(raw("tire_profile")), "diameter_clean": M.clean_diameter(raw("tire_diameter")),
            "season_clean": M.clean_season(raw("season")), "model_clean": M.tyre_model(out["name_clean"]), "speed_index_clean": M.speed_index(out["name_clean"]),
            "vehicle_type": M.vehicle_type(out["name_clean"]), "studded_clean": M.studded(out["name_clean"]),
        }
    elif category == "oils":
        out["name_clean"] = M.clean_text_oils(name)
        or_else = lambda c, other: F.when(c == "unknown", other).otherwise(c)
        out |= {
            "viscosity_clean": or_else(M.or_unknown(F.lower(F.trim(raw("viscosity")))), M.viscosity_from_name(name)),
            "volume_clean": or_else(M.clean_volume(raw("volume_liters")), M.volume_from_name(name)),
            "oil_type_clean": or_else(M.clean_oil_type(raw("oil_type")), M.clean_oil_type(out["name_clean"])), "product_line_clean": M.oil_product_line(name),
        }
    elif category == "filters":
        out |= {"filter_type_clean": M.clean_filter_type(raw("filter_type")), "oem_clean": M.clean_oem(raw("oem_number")), "article": M.article(raw("product_name"))}
    elif category == "batteries":
        out |= {
            "capacity_clean": M.clean_capacity(raw("capacity_ah")), "voltage_clean": M.clean_capacity(raw("voltage_v")), "model_clean": M.battery_model(out["name_clean"]),
            "battery_type": M.battery_type(raw("product_name")), "battery_type_clean": M.or_unknown(F.lower(M.battery_type(raw("product_name")))),
        }
    df = df.withColumns(out)
    get = lambda c: F.col(c) if c in df.columns else F.lit(None).cast("boolean" if c == "studded_clean" else "string")
    category_id = M.category_id(F.lit(category), get("oil_type_clean"), get("season_clean"), get("vehicle_type"), get("studded_clean"), get("filter_type_clean"), get("battery_type"))
    key = M.block_key(F.lit(category), F.col("brand_clean"), [F.col(c) for c in RULES[category].block])
    return df.withColumns({"category_id": category_id, "block_key": key} | ({"vector": encode(F.col("name_clean"))} if encode else {}))


def features_of_texts(offers: DataFrame, texts: Sequence[str], category: str) -> DataFrame:
    """``offers`` with their features (without vector), worked out once for all whose ``texts``, the raw columns that ``features``
    reads, are equal; nulls count as equal."""
    found = features(offers.select(*texts).distinct(), category, None)
    found = found.select(*[F.col(c).alias(f"_{c}") for c in texts], *[c for c in found.columns if c not in texts])
    found = materialize(found, f"texts_{category}")  # what reads it is planned without its patterns
    return offers.join(found, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in texts]).drop(*[f"_{c}" for c in texts])


def match_category(df: DataFrame, category: str, encode: Callable[[Column], Column] = M.name_vector, explain: Callable[[Column], Column] = M.given) -> DataFrame:
    """The category's accepted pairs, best per pair, from blocks of any size; ``df`` comes from ``features``. Offers of a block with equal
    attributes and names are scored, and explained in the form that ``explain`` gives, once; names are encoded here unless ``df`` has vectors."""
    rules = RULES[category]
    name = "vector" if "vector" in df.columns else "name_clean"
    vector = F.col(name) if name == "vector" else encode(F.col(name))
    kinds = offer_kinds(df, [*rules.score, name], max_block=None).withColumns({"vector": M.unit(vector)} | {c: M.hard_value(F.col(c)) for c in rules.score})
    kinds = materialize(kinds.drop("name_clean"), f"kinds_{category}")  # read three times
    scored = score_pairs(kind_pairs(kinds, [*rules.score, "vector"]), rules, value=M.given, ids=("members_1", "members_2"), explain=explain)
    found = member_pairs(scored)
    found = found.select("sku_1", "sku_2", "source_1", "source_2", *[c for c in found.columns if c not in ("sku_1", "sku_2", "source_1", "source_2")])
    if category == "filters":
        exact = exact_pairs(df)
        return best_pairs(exact.withColumn("match_explanation", explain(F.col("match_explanation"))).unionByName(found))
    repeated = kinds.select(F.inline("members")).groupBy("sku_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return found if repeated.isEmpty() else best_pairs(found)  # where each offer is in one block, once, so is each pair
