"""The whole catalogue run: raw loads to cleaned tables, matches, master records, attributes and price history, with its gates."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import catalog as K
from ..operators import matching as X
from ..operators import relational as R
from ..sources import scans as S
from ..sources import sinks
from .clean import clean_table
from .scratch import materialize


@dataclass
class Config:
    """``tables``: (source, group) to the scan of its raw rows; ``out``: the folder of the results."""

    load_id: str
    out: str
    tables: dict[tuple[str, str], DataFrame]
    brands: DataFrame
    loaded_at: Column = field(default_factory=F.current_timestamp)
    least_names: float = 0.95
    least_ids: float = 0.99
    least_multi_source: float = 0.005


def _history(spark: SparkSession, path: str, new: DataFrame) -> DataFrame:
    """The stored price history with the new one merged in; the new one alone where none is stored."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    stored = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
    return K.upsert_history(spark.read.parquet(path), new) if stored else new


def run_catalog(spark: SparkSession, config: Config) -> dict[str, DataFrame]:
    """Runs all steps and writes every result below ``out``; gives the results by name. Loading the same load again replaces it.
    Masters, mapping and price history are those of all loads; the stored history is kept and updated."""
    cleaned: dict[str, list[DataFrame]] = {}
    for (source, group), raw in config.tables.items():
        path = f"{config.out}/raw/{source}_{group}"
        rows = S.with_audit(S.canonical(raw, source, group), f"{source}_{group}", config.load_id, config.loaded_at)
        sinks.write_load(sinks.as_text(rows.drop("loaded_at")).withColumn("loaded_at", config.loaded_at), path)
        loaded = sinks.read_load(spark, path, config.load_id)
        table = clean_table(loaded, group, config.brands, config.loaded_at)
        sinks.write_load(table, f"{config.out}/cleaned/{source}_{group}")
        table = sinks.read_load(spark, f"{config.out}/cleaned/{source}_{group}", config.load_id)
        R.assert_quality(R.quality_report(table, {"normalized_name": config.least_names, "source_product_id": config.least_ids}))
        table = sinks.read_load(spark, f"{config.out}/cleaned/{source}_{group}")  # the gate is for this load; what follows is for all
        cleaned.setdefault(group, []).append(table.withColumn("sku_id", F.concat_ws(":", F.lit(f"{source}_{group}"), "source_product_id")))

    featured, matches = [], []
    for group, tables in cleaned.items():
        if group in X.RULES:
            rows = R.latest_per_key(S.widening_union(*tables), ["sku_id"])
            rows = materialize(X.features(rows, group, None), f"features_{group}")
            featured.append(rows.select("sku_id", "source", "source_product_id", F.col("normalized_name").alias("name"), "brand", "category_id", F.col("name_clean").alias("description")))
            matches.append(X.match_category(rows, group))
    union = lambda frames: reduce(DataFrame.unionByName, frames)
    offers, found = union(featured), materialize(union(matches), "matches")
    groups = materialize(X.match_groups(offers, found), "groups")
    masters = materialize(X.master_skus(offers, groups), "masters")
    mapping = materialize(X.source_mapping(offers, groups, masters, found), "mapping")

    sku_map = K.best_sku(mapping)
    everything = S.widening_union(*[t.drop("sku_id") for tables in cleaned.values() for t in tables])
    names = sorted({n for names in K.DOMAIN_ATTRIBUTES.values() for n in names if n in everything.columns})
    out = {
        "categories": K.categories(spark), "attributes": K.attributes(spark), "category_attributes": K.category_attributes(spark), "skus": masters.drop("anchor"),
        "sku_source_mapping": mapping, "match_explanations": found, "sku_attribute_values": K.sku_attribute_values(everything, sku_map, K.attributes(spark), names),
        "sku_price_history": _history(spark, f"{config.out}/matching/sku_price_history", K.price_history(everything, sku_map, config.loaded_at)),
    }
    for name, df in out.items():
        sinks.replace_table(df, f"{config.out}/matching/{name}")
    written = {name: spark.read.parquet(f"{config.out}/matching/{name}") for name in out}
    empty = [n for n, df in written.items() if n != "match_explanations" and df.isEmpty()]
    share = written["skus"].agg(F.avg((F.size("source_id") > 1).cast("double"))).first()[0] or 0.0
    if empty or share < config.least_multi_source:
        raise ValueError(f"matching gate failed: empty {empty}, multi-source share {share:.2%}")
    return written
