"""Products as listings and pages give them: nested JSON and linked data, made into flat rows. Every function takes and gives a Column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import parsing as P
from ..functions.text import extract, strip, strip_tags

#: The columns of a flat product, and the places in a listing's product where each is looked for, in order.
PRODUCT_PATHS = {
    "product_id": ("$.productId", "$.id"),
    "name": ("$.info.title", "$.title", "$.name"),
    "price": ("$.cost_info.price", "$.finalPrice", "$.price"),
    "price_old": ("$.cost_info.price_old", "$.oldPrice"),
    "slug": ("$.slug",),
    "brand": ("$.info.brand_name", "$.analytics.brand"),
    "quantity_available": ("$.maxAvailableCount",),
}
#: Keys of a picture's address, of an attribute's name and of its value, in order of preference.
IMAGE_KEYS = ("image_path", "url", "src")
NAME_KEYS, VALUE_KEYS = ("name", "code"), ("value_name", "value")
#: What stands before the word for an availability in linked data.
SCHEMA_HOSTS = r"https?://schema\.org/"


def items(text: Column) -> Column:
    """The elements of a JSON list as JSON texts; an empty list for anything else."""
    nothing = F.array().cast("array<string>")
    return F.when(F.ltrim(text).startswith("["), F.coalesce(F.from_json(text, "array<string>"), nothing)).otherwise(nothing)


def first_filled(text: Column, paths: Sequence[str]) -> Column:
    """What the first path leads to that isn't empty, trimmed; else the empty text."""
    return F.coalesce(*[F.nullif(strip(F.get_json_object(text, path)), F.lit("")) for path in paths], F.lit(""))


def _member(item: Column, keys: Sequence[str]) -> Column:
    return first_filled(item, [f"$.{key}" for key in keys])


def attribute_map(listed: Column) -> Column:
    """A JSON list of attributes as a map of names to values: both filled, the last of equal names."""
    pairs = F.transform(items(listed), lambda a: F.struct(_member(a, NAME_KEYS).alias("key"), _member(a, VALUE_KEYS).alias("value")))
    filled = F.filter(pairs, lambda p: (p["key"] != "") & (p["value"] != ""))
    last = F.filter(filled, lambda p, at: ~F.exists(F.slice(filled, at + 2, F.size(filled)), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(last)


def flat_product(product: Column, category: Column | str = "", page: str = "") -> Column:
    """A listing's nested product (JSON text) as a flat row: its fields by PRODUCT_PATHS, its page below ``page``, the names of its
    categories (else ``category``) and its pictures joined by bars, and its attributes as a map. Text that is no JSON gives empty fields."""
    out = {name: first_filled(product, paths) for name, paths in PRODUCT_PATHS.items()}
    out["url"] = F.when(out["slug"] != "", F.concat(F.lit(f"{page}/p/"), out["slug"])).otherwise("")
    named = F.filter(F.transform(items(F.get_json_object(product, "$.categories")), lambda c: _member(c, ("name",))), lambda n: n != "")
    other = F.lit(category) if isinstance(category, str) else category
    out["category"] = F.when(F.size(named) > 0, F.array_join(named, " | ")).otherwise(other)
    media = items(F.coalesce(F.nullif(F.get_json_object(product, "$.media"), F.lit("[]")), F.get_json_object(product, "$.images")))
    pictures = F.filter(F.transform(media, lambda m: _member(m, IMAGE_KEYS)), lambda url: url != "")
    out["images"] = F.array_join(pictures, " | ")
    out["attributes"] = attribute_map(F.get_json_object(product, "$.attributes"))
    return F.struct(*[value.alias(name) for name, value in out.items()])


def size_text(width: Column, profile: Column, diameter: Column) -> Column:
    """A tire's size as ``205/55 R16``; empty unless all three are known."""
    width, profile, diameter = (F.nullif(strip(c.cast("string")), F.lit("")) for c in (width, profile, diameter))
    return F.coalesce(F.concat(width, F.lit("/"), profile, F.lit(" R"), diameter), F.lit(""))


def linked_data(html: Column) -> Column:
    """The JSON texts of all linked-data objects of a page, in order: lists are taken apart, and so is the graph of an object that has one."""
    graph = lambda text: F.get_json_object(text, "$['@graph']")
    parts = lambda text: F.when(F.ltrim(text).startswith("["), items(text)).when(F.ltrim(graph(text)).startswith("["), items(graph(text))).otherwise(F.array(text))
    return F.filter(F.flatten(F.transform(P.json_ld(html), lambda text: parts(F.trim(text)))), lambda node: F.ltrim(node).startswith("{"))


def linked_node(nodes: Column, kind: str) -> Column:
    """The first object of this type (its type, or one of its types); null without one."""
    types = lambda node: F.get_json_object(node, "$['@type']")
    return F.try_element_at(F.filter(nodes, lambda n: F.coalesce((types(n) == kind) | F.array_contains(items(types(n)), kind), F.lit(False))), F.lit(1))


def page_product(html: Column, url: Column) -> Column:
    """A product page as a flat row, from its linked data; the name falls back on the heading. The first of several offers counts."""
    nodes = linked_data(html)
    product, crumbs = linked_node(nodes, "Product"), linked_node(nodes, "BreadcrumbList")
    given = F.get_json_object(product, "$.offers")
    offer = F.when(F.ltrim(given).startswith("["), F.try_element_at(items(given), F.lit(1))).otherwise(given)
    heading = strip_tags(extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1))
    price = P.price(first_filled(offer, ("$.price",)))
    brand = F.get_json_object(product, "$.brand")
    image = F.get_json_object(product, "$.image")
    pictures = F.when(F.ltrim(image).startswith("["), items(image)).otherwise(F.array(image))
    path = F.filter(F.transform(items(F.get_json_object(crumbs, "$.itemListElement")), lambda c: first_filled(c, ("$.item.name",))), lambda n: n != "")
    return F.struct(
        url.alias("url"), F.coalesce(extract(url, r"/p(\d+)-", 1), F.lit("")).alias("product_id"),
        F.coalesce(F.nullif(strip_tags(F.get_json_object(product, "$.name")), F.lit("")), heading, F.lit("")).alias("name"), price.alias("price"),
        F.when(price.isNull(), "").otherwise(F.coalesce(F.nullif(F.get_json_object(offer, "$.priceCurrency"), F.lit("")), F.lit("KZT"))).alias("currency"),
        F.regexp_replace(first_filled(offer, ("$.availability",)), SCHEMA_HOSTS, "").alias("availability"),
        F.when(F.ltrim(brand).startswith("{"), first_filled(brand, ("$.name",))).otherwise(P.empty(brand)).alias("brand"),
        F.coalesce(F.array_join(path, " | "), F.lit("")).alias("category"), P.empty(strip_tags(F.get_json_object(product, "$.description"))).alias("description"),
        F.array_join(F.array_distinct(F.filter(pictures, lambda p: p.isNotNull() & (p != ""))), " | ").alias("images"), P.page_title(html).alias("title"), P.spec_table(html).alias("attributes"),
    )
