"""The category tree, the attribute dictionary, attribute values of master records, and price history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cleaning import text_value
from .relational import mode_per_group, sequential_ids, top_per_key, tree_closure, upsert

#: The category tree, indented by level, each line an id and a name.
CATEGORY_TREE = """
1 Автотовары
 2 Масла и жидкости
  3 Моторные масла
   4 Синтетические моторные масла
   5 Полусинтетические моторные масла
   6 Минеральные моторные масла
   7 Промывочные масла
  8 Трансмиссионные масла
   9 ATF масла
   10 CVT масла
   11 Масла для МКПП
   12 Масла для дифференциала
  13 Гидравлические масла
  14 Жидкости ГУР
  15 Тормозные жидкости
   16 DOT 3
   17 DOT 4
   18 DOT 5
  19 Антифризы и охлаждающие жидкости
   20 Концентрат антифриза
   21 Готовый антифриз
  22 Присадки и очистители
   23 Топливные присадки
   24 Присадки в масло
   25 Очистители форсунок
   26 Очистители двигателя
 30 Шины
  31 Легковые шины
   32 Летние легковые шины
   33 Зимние легковые шины
    34 Зимние шипованные легковые шины
    35 Зимние нешипованные легковые шины
   36 Всесезонные легковые шины
  37 Шины для внедорожников и кроссоверов
   38 Летние шины SUV
   39 Зимние шины SUV
   40 Всесезонные шины SUV
  41 Грузовые шины
   42 Шины для лёгких грузовиков
   43 Шины для тяжёлых грузовиков
  44 Мотошины
  45 Сельскохозяйственные шины
  46 Шины для спецтехники
 50 Аккумуляторы
  51 Аккумуляторы для легковых авто
   52 Стандартные аккумуляторы
   53 AGM аккумуляторы
   54 EFB аккумуляторы
   55 GEL аккумуляторы
  56 Аккумуляторы для грузовиков
  57 Аккумуляторы для мотоциклов
 60 Фильтры
  61 Воздушный фильтр
  62 Масляный фильтр
  63 Салонный фильтр
  64 Топливный фильтр
  65 Трансмиссионный фильтр
  66 Гидравлический фильтр
 999 Неклассифицировано
"""
#: Roots of the domains, and levels of the tree.
DOMAIN_ROOTS = {2: "oils", 30: "tires", 50: "batteries", 60: "filters"}
LEVELS = 5
#: Attribute groups and the attributes of each with their units, in the order of their ids.
ATTRIBUTES = {
    "Основные": [
        ("brand", "text"), ("product_line", "text"), ("oil_type", "text"), ("engine_type", "text"), ("battery_type", "text"), ("filter_type", "text"),
        ("season", "text"), ("studded", "boolean"), ("runflat", "boolean"), ("package_type", "text"), ("polarity", "text"), ("terminal_type", "text"),
    ],
    "Технические характеристики": [
        ("viscosity", "text"), ("volume_liters", "liters"), ("capacity_ah", "Ah"), ("voltage_v", "V"), ("start_current_a", "A"), ("load_index", "text"),
        ("speed_index", "text"), ("tire_width", "mm"), ("tire_profile", "percent"), ("tire_diameter", "inch"), ("acea_class", "text"),
        ("specification", "text"), ("approvals", "text"),
    ],
    "Размеры": [
        ("width", "mm"), ("height", "mm"), ("length", "mm"), ("dimensions", "text"), ("weight", "text"),
    ],
    "Совместимость": [
        ("compatible_brand", "text"), ("compatible_model", "text"), ("oem_number", "text"),
    ],
    "Дополнительно": [
        ("features", "text"), ("additional_information", "text"), ("image_url", "text"),
    ],
}
#: The attributes of each domain.
DOMAIN_ATTRIBUTES = {
    "oils": [
        "brand", "product_line", "viscosity", "volume_liters", "oil_type", "engine_type", "specification", "package_type", "acea_class", "approvals",
        "image_url",
    ],
    "tires": [
        "brand", "tire_width", "tire_profile", "tire_diameter", "season", "load_index", "speed_index", "runflat", "studded", "weight", "image_url",
    ],
    "batteries": [
        "brand", "capacity_ah", "voltage_v", "start_current_a", "polarity", "battery_type", "dimensions", "terminal_type", "weight", "features", "length",
        "width", "height", "image_url",
    ],
    "filters": [
        "brand", "filter_type", "compatible_brand", "compatible_model", "oem_number", "additional_information", "image_url",
    ],
}


def category_rows() -> list[tuple[int, str, int, int | None, str | None, bool]]:
    rows, path = [], []
    for line in CATEGORY_TREE.strip("\n").splitlines():
        number, name = line.split(maxsplit=1)
        path = [*path[: len(line) - len(line.lstrip())], (int(number), name)]
        above = path[-2] if len(path) > 1 else (None, None)
        rows.append((int(number), name, len(path), *above))
    inner = {row[3] for row in rows}
    return [(*row, row[0] not in inner) for row in rows]


def upsert_dictionary(stored: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """A static table with the given rows merged in by their id: known ids take all new values, unknown ones are added, others stay."""
    return upsert(stored, rows, [key], [c for c in rows.columns if c != key])


def categories(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(category_rows(), "category_id long, name string, level long, parent_category_id long, parent_category string, is_leaf boolean")


def category_tree(nodes: DataFrame, levels: int | None = None) -> DataFrame:
    """A marketplace's categories (uid, title, parent_uid) as a tree: numbers by level and uid, levels, parents and leaves."""
    rows = nodes.select("uid", F.trim("title").alias("name"), "parent_uid").dropDuplicates(["uid"])
    depth = tree_closure(rows.withColumn("none", F.lit(0)), "uid", "parent_uid", "none", levels).groupBy("uid").agg(F.count(F.lit(1)).alias("level"))
    placed = sequential_ids(rows.join(depth, "uid").withColumn("place", F.concat_ws(" ", F.lpad(F.col("level").cast("string"), 3, "0"), "uid")), "place", "", 9)
    placed = placed.select("uid", "name", "parent_uid", "level", F.col("id").cast("long").alias("category_id"))
    above = placed.select(F.col("uid").alias("parent_uid"), F.col("category_id").alias("parent_category_id"), F.col("name").alias("parent_category"))
    inner = placed.select(F.col("parent_uid").alias("uid")).dropna().distinct().withColumn("is_inner", F.lit(True))
    out = placed.join(above, "parent_uid", "left").join(inner, "uid", "left")
    return out.select("category_id", "name", "level", "parent_category_id", "parent_category", F.col("is_inner").isNull().alias("is_leaf"), F.lit("active").alias("status"), F.col("uid").alias("source_uid"))


def attributes(spark: SparkSession) -> DataFrame:
    """id, name, unit, group id and group of every attribute."""
    rows = [(name, unit, k, group) for k, (group, entries) in enumerate(ATTRIBUTES.items(), 1) for name, unit in entries]
    schema = "id short, name string, unit string, attribute_group_id short, attribute_group string"
    return spark.createDataFrame([(k, *row) for k, row in enumerate(rows, 1)], schema)


def category_attributes(spark: SparkSession) -> DataFrame:
    """Every category below a domain's root with the attributes of that domain."""
    closure = tree_closure(categories(spark), "category_id", "parent_category_id", "level", LEVELS)
    domains = [(root, name) for root, domain in DOMAIN_ROOTS.items() for name in DOMAIN_ATTRIBUTES[domain]]
    wanted = spark.createDataFrame(domains, "ancestor long, attribute string")
    names = categories(spark).select("category_id", F.col("name").alias("category"))
    found = closure.filter("ancestor_level = 2").join(F.broadcast(wanted), "ancestor").join(names, "category_id")
    known = attributes(spark).select("attribute_group_id", "attribute_group", F.col("id").alias("attribute_id"), F.col("name").alias("attribute"))
    return found.join(F.broadcast(known), "attribute").select("category_id", "category", "attribute_group_id", "attribute_group", "attribute_id", "attribute").distinct()


def best_sku(mapping: DataFrame) -> DataFrame:
    """Per offer (source, source_product_id) the master with the best score."""
    known = mapping.dropna(subset=["source", "source_product_id", "sku_id"])
    return top_per_key(known, ["source", "source_product_id"], [F.col("match_score").desc_nulls_last(), F.col("sku_id").asc()]).select("source", "source_product_id", "sku_id")


def sku_attribute_values(offers: DataFrame, sku_map: DataFrame, dictionary: DataFrame, names: Sequence[str]) -> DataFrame:
    """Per master and attribute the most frequent value among its offers; one pass over all attributes."""
    mapped = offers.join(sku_map, ["source", "source_product_id"])
    pairs = ", ".join(f"'{n}', cast(`{n}` AS string)" for n in names)
    long = mapped.selectExpr("sku_id", f"stack({len(names)}, {pairs}) AS (attribute, value)").withColumn("value", text_value(F.col("value")))
    values = mode_per_group(long, ["sku_id", "attribute"], "value", "value")
    return values.join(F.broadcast(dictionary.select(F.col("id").alias("attribute_id"), F.col("name").alias("attribute"))), "attribute").select("sku_id", "attribute_id", "attribute", "value")


HISTORY_KEY = ("source", "source_product_id", "captured_at")
#: Columns that a later load of the same key replaces; the others keep their first value.
HISTORY_UPDATE = ("price", "old_price", "discount_price", "currency", "availability", "sku_id", "parsed_at")


def price_history(offers: DataFrame, sku_map: DataFrame, as_of: Column) -> DataFrame:
    """Priced offers as a time series, one row per source, product and time; unmapped offers keep a null master.

    ``as_of`` stands in for a missing load time. A discount price is the price where the old one was higher."""
    get = lambda c, t="string": F.col(c).cast(t) if c in offers.columns else F.lit(None).cast(t)
    rows = offers.filter(F.col("price").isNotNull()).select(
        F.coalesce(F.col("loaded_at"), as_of).alias("captured_at"), text_value(F.col("source")).alias("source"), text_value(F.col("source_product_id")).alias("source_product_id"),
        get("city").alias("city"), F.col("price").cast("double").alias("price"), get("old_price", "double").alias("old_price"), get("currency").alias("currency"),
        get("availability").alias("availability"), F.nullif(get("parsed_at"), F.lit("")).try_cast("timestamp").alias("parsed"),
    ).dropna(subset=["source", "source_product_id"])
    rows = top_per_key(rows, HISTORY_KEY, [F.col("price").asc()])
    rows = rows.join(sku_map, ["source", "source_product_id"], "left")
    return rows.select(
        "captured_at", F.to_date("captured_at").alias("price_date"), "sku_id", "source", "source_product_id", F.col("source").alias("seller_name"), "city", "price",
        "old_price", F.when(F.col("old_price") > F.col("price"), F.col("price")).alias("discount_price"), "currency", "availability", F.coalesce("parsed", "captured_at").alias("parsed_at"),
    )


def price_changes(products: DataFrame, status: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of new and changed products, the least price and the total quantity over their offers, and the day."""
    total = F.aggregate("offers", F.lit(0).cast("long"), lambda s, o: s + F.coalesce(o["quantity"], F.lit(0)))
    changed = products.join(status.filter("status <> 'unchanged'").select(*keys), list(keys))
    return changed.select(*keys, F.array_min(F.col("offers.price")).alias("price"), total.alias("quantity"), F.substring("parsed_at", 1, 10).alias("date"))


def upsert_history(old: DataFrame, new: DataFrame) -> DataFrame:
    return upsert(old, new, HISTORY_KEY, HISTORY_UPDATE)


