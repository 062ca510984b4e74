"""Scans: listings, pages, files of offers, and the rules that say what may be fetched."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import values as V
from ..functions.text import strip

#: The canonical columns of every group, and those of each.
BASE_COLUMNS = [
    "source", "source_product_id", "source_url", "category_group", "product_name", "brand", "price", "old_price", "currency", "availability", "city",
    "image_url", "parsed_at", "article_sku", "rating", "reviews_count", "seller_count",
]
GROUP_COLUMNS = {
    "tires": [
        "tire_width", "tire_profile", "tire_diameter", "season", "load_index", "speed_index", "studded", "runflat", "model_name", "weight",
    ],
    "oils": [
        "viscosity", "volume_liters", "oil_type", "engine_type", "specification", "product_line", "package_type", "acea_class", "approvals",
    ],
    "batteries": [
        "capacity_ah", "voltage_v", "start_current_a", "polarity", "battery_type", "dimensions", "terminal_type", "weight", "features", "length", "width",
        "height",
    ],
    "filters": [
        "filter_type", "compatible_brand", "compatible_model", "oem_number", "additional_information",
    ],
    "wheels": [
        "wheel_width", "wheel_diameter", "bolt_pattern", "et", "model_name",
    ],
}
#: Other names under which the marketplaces give a column, in order of preference.
ALIASES = {
    "source_product_id": ("product_id", "id", "sku_id", "sku", "code"), "source_url": ("url",), "product_name": ("name", "title", "full_title", "normalized_name"),
    "brand": ("Производитель", "Марка", "brand_name", "brand_code"), "old_price": ("price_old", "price_without_discount"),
    "availability": ("quantity_available_text", "quantity_in_stock", "stocks"), "image_url": ("image", "images", "image_urls"),
    "parsed_at": ("updated_at", "created_at"), "article_sku": ("sku", "code"), "reviews_count": ("review_count",),
    "tire_width": ("width", "Ширина", "Ширина шины", "Ширина профиля", "Ширина профиля шины"), "tire_profile": ("profile", "height", "Высота", "Высота профиля", "Высота профиля шины"),
    "tire_diameter": ("diameter", "Диаметр диска", "Диаметр шины", "Посадочный диаметр", "Посадочный диаметр шины", "Диаметр колеса/диска"),
    "season": ("Сезонность", "Сезонность шин"), "load_index": ("weight_single_index", "Индекс нагрузки", "Индекс нагрузки шины"), "speed_index": ("velocity_index", "Индекс скорости"),
    "studded": ("tyre_stud_type_name", "Шипы"), "runflat": ("Безопасная шина",), "model_name": ("Модель", "Модель шины", "Модель диска"), "weight": ("Вес",),
    "viscosity": ("Класс вязкости SAE", "Вязкость по SAE"), "volume_liters": ("Объем упаковки, л",), "oil_type": ("Вид масла", "Тип"), "engine_type": ("Область применения",),
    "specification": ("Класс API", "Стандарт API", "Стандарт DOT"), "product_line": ("Специализация",), "acea_class": ("Класс ACEA",), "approvals": ("Допуски", "Допуск"),
    "features": ("Особенности",), "length": ("Длина",), "width": ("Ширина",), "height": ("Высота",), "oem_number": ("oem_numbers",),
    "additional_information": ("Дополнительная информация",), "wheel_width": ("Ширина диска",), "wheel_diameter": ("Посадочный диаметр диска", "Диаметр диска"),
    "bolt_pattern": ("PCD", "Разболтовка"), "et": ("Вылет (ET)", "Вылет"),
}
DEFAULTS = {"currency": "KZT", "city": "almaty"}
#: Numeric and boolean columns of the typed layer; the others stay text.
DOUBLES = {"price", "old_price", "tire_width", "tire_profile", "tire_diameter", "wheel_width", "wheel_diameter", "volume_liters", "capacity_ah", "voltage_v", "start_current_a"}
BOOLEANS = {"studded", "runflat"}
TIMESTAMPS = {"loaded_at", "cleaned_at"}


def raw_schema(columns: Sequence[str]) -> T.StructType:
    """The raw layer: all text."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def typed_schema(group: str) -> T.StructType:
    kind = lambda c: T.DoubleType() if c in DOUBLES else T.BooleanType() if c in BOOLEANS else T.TimestampType() if c in TIMESTAMPS else T.StringType()
    return T.StructType([T.StructField(c, kind(c)) for c in [*BASE_COLUMNS, *GROUP_COLUMNS[group], "normalized_name", "cleaned_at"]])


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, by the header; a byte order mark before the first name goes."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def read_listing(spark: SparkSession, path: str, key: str = "id") -> DataFrame:
    """Saved listing responses, one JSON object a line; each product once, the one from the first page and place."""
    df = spark.read.json(path)
    order = [c for c in ("page", "position") if c in df.columns]
    from ..operators.relational import top_per_key

    return top_per_key(df, [key], [F.col(c).asc_nulls_last() for c in order]) if order else df.dropDuplicates([key])


def first_of(c: Column) -> Column:
    """Up to the first bar; in a list of URLs, up to the first comma."""
    text = strip(F.coalesce(c, F.lit("")))
    by_comma = F.when(text.rlike("^https?://"), strip(F.substring_index(text, ",", 1))).otherwise(text)
    return F.when(text.contains("|"), strip(F.substring_index(text, "|", 1))).otherwise(by_comma)


def pick(df: DataFrame, names: Sequence[str]) -> Column:
    """The first of these columns that holds something, trimmed; otherwise the empty text."""
    found = [F.nullif(F.col(f"`{n}`").cast("string"), F.lit("")) for n in names if n in df.columns]
    return F.coalesce(strip(F.coalesce(*found)), F.lit("")) if found else F.lit("")


def canonical(df: DataFrame, source: str, group: str) -> DataFrame:
    """The group's canonical columns, from whatever names the source uses; a tire's size falls back on its name."""
    out = {c: pick(df, [c, *ALIASES.get(c, ())]) for c in [*BASE_COLUMNS, *GROUP_COLUMNS[group]]}
    out["source"] = F.coalesce(F.nullif(out["source"], F.lit("")), F.lit(source))
    out["category_group"] = F.lit(group)
    out["image_url"] = first_of(out["image_url"])
    for name, default in DEFAULTS.items():
        out[name] = F.coalesce(F.nullif(out[name], F.lit("")), F.lit(default))
    if group == "tires":
        size = r"(?iU)(\d{3})\s*/\s*(\d{2,3})\s*(?:R|ZR|/R)?\s*(\d{2})"
        for k, name in enumerate(("tire_width", "tire_profile", "tire_diameter"), 1):
            out[name] = F.coalesce(F.nullif(out[name], F.lit("")), F.regexp_extract(out["product_name"], size, k))
    return df.select(*[v.alias(k) for k, v in out.items()])


def with_audit(df: DataFrame, source_file: str, load_id: str, loaded_at: Column) -> DataFrame:
    return df.withColumns({"source_file": F.lit(source_file), "loaded_at": loaded_at, "load_id": F.lit(load_id)})


def typed(df: DataFrame) -> DataFrame:
    """Columns by name to their types; what can't be read becomes null."""
    kinds = {c: "double" for c in DOUBLES} | {c: "boolean" for c in BOOLEANS} | {c: "timestamp" for c in TIMESTAMPS}
    return df.select(*[F.col(c).try_cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in df.columns])


def widening_union(*frames: DataFrame) -> DataFrame:
    """Rows of all, columns of any, missing ones null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def safe_names(names: Sequence[str]) -> list[str]:
    """Column names fit for any store: transliterated, numbered, at most 55 bytes with a hash for what is cut, unique."""
    out: list[str] = []
    for k, name in enumerate(names, 1):
        latin = "".join(V.TRANSLITERATION.get(c, c) for c in name.lower())
        base = f"c{k:03d}_{re.sub(r'[^a-z0-9]+', '_', latin).strip('_') or 'column'}"
        if len(base) > 55:
            base = f"{base[:46].rstrip('_')}_{hashlib.sha1(name.encode()).hexdigest()[:8]}"
        found, k2 = base, 2
        while found in out:
            found, k2 = f"{base[: 63 - len(f'_{k2}')]}_{k2}", k2 + 1
        out.append(found)
    return out


def allowed_url(url: Column, hosts: Sequence[str], forbidden: Sequence[str] = ()) -> Column:
    """http(s), one of the hosts, no forbidden part in the path, and no query. Other characters and escapes in it don't matter."""
    piece = lambda k: F.lower(F.regexp_extract(url, r"^([^:/?#]+)://(?:[^/?#@]*@)?([^/?#:]*)(?::\d*)?([^?#]*)\??([^#]*)", k))
    bad = F.lit(False)
    for part in forbidden:
        bad = bad | piece(3).contains(part)
    return F.coalesce(piece(1).isin("http", "https") & piece(2).isin(*hosts) & ~bad & (piece(4) == ""), F.lit(False))


def robots_allowed(urls: DataFrame, rules: Sequence[tuple[str, str]], url_col: str = "url", out: str = "allowed") -> DataFrame:
    """Longest matching rule wins, allow wins ties, no match allows. ``rules``: (allow or disallow, path pattern with * and $).

    A site's rules are a short list, so they become one expression and no join."""
    raw = F.regexp_extract(F.col(url_col), r"^[a-z]+://[^/?#]*([^?#]*)", 1)
    plain = F.coalesce(F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))), raw)  # a plus is a plus; bad escapes stay as they are
    path = F.coalesce(F.nullif(plain, F.lit("")), F.lit("/"))
    verdict = None
    for kind, pattern in sorted((r for r in rules if r[1]), key=lambda r: (-len(r[1]), r[0] != "allow")):
        ends = pattern.endswith("$")
        regex = "^" + ".*".join(re.escape(p) for p in pattern.rstrip("$").split("*")) + ("$" if ends else "")
        verdict = (F if verdict is None else verdict).when(path.rlike(regex), kind == "allow")
    return urls.withColumn(out, F.lit(True) if verdict is None else verdict.otherwise(True))


def sitemap_urls(spark: SparkSession, path: str) -> DataFrame:
    """Distinct pages of the sitemaps saved under ``path``, an index and those it names alike. The locations of child sitemaps are no pages."""
    pages = F.regexp_replace("value", r"(?is)<sitemap\b.*?</sitemap>|<!--.*?-->", "")
    found = spark.read.text(path, wholetext=True).select(F.explode(F.regexp_extract_all(pages, F.lit(r"(?is)<loc>\s*(.*?)\s*</loc>"), F.lit(1))).alias("url"))
    return found.distinct()
