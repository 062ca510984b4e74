"""Extraction from marketplace texts and pages: every function takes and gives a Column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import values as V
from .text import contains_any, extract, ladder, strip, strip_tags, to_float

#: Labels as the marketplaces write them.
FILTER_LABELS = (("Масляный", ("масл",)), ("Воздушный", ("воздуш",)), ("Топливный", ("топлив",)), ("Салонный", ("салон",)), ("Гидравлический", ("гидравл",)), ("Трансмиссионный", ("трансмисс",)))
SEASON_LABELS = (
    ("Всесезонная", ("всесезон", "vsesezon", "all season", "all-season", "all weather", "a/s")),
    ("Зимняя", ("зимн", "зим", "zimn", "winter", "шип", "ice", "snow", "frost")), ("Летняя", ("летн", "letn", "summer")),
)
OIL_LABELS = (
    ("Полусинтетическое", ("полусинт", "semi")), ("Гидрокрекинговое", ("гидрокрекинг", "hc-synth", "hydrocrack")),
    ("Синтетическое", ("синтет", "synthetic")), ("Минеральное", ("минерал", "mineral")),
)
BATTERY_LABELS = (("AGM", ("agm",)), ("EFB", ("efb",)), ("GEL", ("gel", "гелев")), ("Ca/Ca", ("ca/ca",)), ("lead_acid", ("свинц",)))
POLARITY_LABELS = (("Обратная", ("обратн", "правый", "правая")), ("Прямая", ("прям", "левый", "левая")))
#: Words for tires without studs, and for studs.
STUDLESS_WORDS, STUD_WORD = ("без шип", "нешип", "липучк", "фрикцион"), "шип"
#: Words that are no brand at the head of a name.
NOT_BRANDS = ("автомобильный", "автомобильная", "автомобильное", "автомобильные", "для", "моторное", "масло", "шина", "шины", "аккумулятор", "фильтр")

#: Makes of vehicles that a filter's name may give, and those of them that are written in capitals.
VEHICLE_MAKES = (
    "камаз", "газ", "газель", "паз", "маз", "урал", "белаз", "краз", "case", "liebherr", "volvo", "cummins", "toyota", "hyundai", "kia", "nissan",
    "renault", "volkswagen", "audi", "bmw", "mercedes",
)
CAPITAL_MAKES = ("газ", "маз", "паз", "урал", "камаз")


def empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def price(c: Column) -> Column:
    """The first run of digits and blanks, as a number."""
    return to_float(F.regexp_replace(extract(c, r"\d[\d\s ]*"), r"[\s ]", ""))


def first_number(c: Column) -> Column:
    return to_float(F.translate(extract(c, r"-?\d+(?:[.,]\d+)?"), ",", "."))


def tire_size(c: Column) -> Column:
    """width, profile, diameter, load index and speed index."""
    p = r"(?iU)(\d{3})\s*/\s*(\d{2,3})\s*(?:Z?R)?\s*(\d{2}(?:[.,]\d)?)(?:\s+(\d{2,3})([A-Z]))?"
    number = lambda k, t: F.translate(extract(c, p, k), ",", ".").try_cast(t)
    return F.struct(
        number(1, "int").alias("tire_width"), number(2, "int").alias("tire_profile"), number(3, "double").alias("tire_diameter"),
        empty(extract(c, p, 4)).alias("load_index"), F.upper(empty(extract(c, p, 5))).alias("speed_index"),
    )


def season_label(c: Column) -> Column:
    return ladder(F.lower(empty(c)), SEASON_LABELS, F.lit(""))


def runflat(c: Column) -> Column:
    return empty(c).rlike(r"(?iU)run\s*-?\s*flat|\brft\b|\bzp\b")


def studded_label(c: Column) -> Column:
    low = F.lower(c)
    return F.when(contains_any(low, STUDLESS_WORDS), False).when(low.contains(STUD_WORD), True)


def viscosity(c: Column) -> Column:
    grade, mono = r"(?iU)\b(\d{1,2})\s*W\s*[-–]?\s*(\d{2})\b", r"(?iU)\bSAE\s*(\d{2,3}\w*)"
    multi = F.concat(extract(c, grade, 1).try_cast("int").cast("string"), F.lit("W-"), extract(c, grade, 2))
    return F.coalesce(multi, F.concat(F.lit("SAE "), F.upper(extract(c, mono, 1))), F.lit(""))


def volume_liters(c: Column) -> Column:
    number = lambda p: to_float(F.translate(extract(c, p, 1), ",", "."))
    small, large = r"(?iU)(\d+(?:[.,]\d+)?)\s*(?:мл|ml)\b", r"(?iU)(\d+(?:[.,]\d+)?)\s*(?:л|l|литр)"
    return F.coalesce(F.round(number(small) / 1000, 4), number(large))


def oil_label(c: Column) -> Column:
    return ladder(F.lower(empty(c)), OIL_LABELS, F.lit(""))


def filter_label(c: Column) -> Column:
    return ladder(F.lower(empty(c)), FILTER_LABELS, F.lit(""))


def battery_label(c: Column) -> Column:
    return ladder(F.lower(empty(c)), BATTERY_LABELS, F.lit(""))


def capacity_ah(c: Column) -> Column:
    return extract(c, r"(?iU)\b(\d{2,3})\s*(?:ah|а/?ч|ач)\b", 1).try_cast("int")


def voltage_v(c: Column) -> Column:
    return extract(c, r"(?iU)\b(6|12|24)\s*(?:v|в)\b", 1).try_cast("int")


def polarity_label(c: Column) -> Column:
    low = F.lower(empty(c))
    words = ladder(low, POLARITY_LABELS)
    signs = F.when(low.rlike(r"(?:^|\s)-\+(?:\s|$)"), "Обратная").when(low.rlike(r"(?:^|\s)\+-(?:\s|$)"), "Прямая")
    return F.coalesce(words, signs, F.lit(""))


def availability_label(c: Column, default: str = "В наличии") -> Column:
    """From the least number of days among the preorder texts."""
    days = F.transform(F.regexp_extract_all(empty(c), F.lit(r"(?iU)(\d+)\s*(?:дн|день|дня)"), F.lit(1)), lambda d: d.try_cast("int"))
    best = F.array_min(days)
    return F.when(best > 0, F.concat(F.lit("Под заказ: "), best.cast("string"), F.lit(" дн"))).otherwise(default)


def title_case(c: Column) -> Column:
    """A capital after anything that is no letter, small letters after letters."""
    return F.replace(F.initcap(F.regexp_replace(c, r"([^\p{L}])", "$1\u0001 ")), F.lit("\u0001 "), F.lit(""))


def infer_brand(name: Column, known: Sequence[str], explicit: Column | None = None) -> Column:
    """An explicit brand; else the longest known one standing alone in the name; else its first word that is no filler."""
    low = F.lower(empty(name))
    found = None
    for brand in sorted(known, key=lambda b: (-len(b), b)):
        found = (F if found is None else found).when(low.rlike(rf"(?U)(?<!\w)\Q{brand}\E(?!\w)"), brand)
    words = F.filter(F.split(strip_tags(name), " "), lambda w: ~F.lower(w).isin(*NOT_BRANDS) & w.rlike("[A-Za-zА-Яа-я]"))
    head = title_case(F.regexp_replace(F.try_element_at(words, F.lit(1)), r"^[ ,.;:]+|[ ,.;:]+$", ""))
    given = title_case(F.nullif(strip_tags(explicit), F.lit(""))) if explicit is not None else F.lit(None)
    return F.coalesce(given, title_case(found) if found is not None else F.lit(None), head, F.lit(""))


def compatible_brands(name: Column, makes: Sequence[str] = VEHICLE_MAKES) -> Column:
    """The makes of vehicles that stand alone in the name, in the order of the list, joined by semicolons; null where there is none."""
    low = F.lower(empty(name))
    label = lambda make: make.upper() if make in CAPITAL_MAKES else make.title()
    found = [F.when(low.rlike(rf"(?U)(?<!\w)\Q{make}\E(?!\w)"), label(make)) for make in makes]
    return F.nullif(F.concat_ws("; ", *found), F.lit(""))


def compatible_models(name: Column, first: int = 8) -> Column:
    """Codes of vehicles and engines (letters, then two to five digits) among the ``first`` in the name, distinct, joined by semicolons; null without any."""
    codes = F.regexp_extract_all(empty(name), F.lit(r"(?iuU)\b(?:двс\s*)?[A-ZА-Я]{1,6}[- ]?\d{2,5}(?:[.-]\d+)?\b"), F.lit(0))
    plain = F.transform(F.slice(codes, 1, first), lambda code: F.upper(strip_tags(code)))
    return F.nullif(F.array_join(F.array_distinct(plain), "; "), F.lit(""))


def product_url(host: str, product_id: Column, slug: Column) -> Column:
    """A product's page: its id, then its slug if it has one; empty without an id."""
    number = F.nullif(product_id.cast("string"), F.lit(""))
    return F.coalesce(F.concat(F.lit(f"{host}/p"), number, F.coalesce(F.concat(F.lit("-"), F.nullif(slug, F.lit(""))), F.lit("")), F.lit(".html")), F.lit(""))


def image_urls(product: Column) -> Column:
    """The distinct http addresses under the image keys of a product's JSON text, in order: texts, and lists of texts or of objects with url or src."""
    entries = F.map_entries(F.from_json(empty(product), "map<string,string>"))
    address = lambda item: F.when(item.startswith("{"), F.coalesce(F.nullif(F.get_json_object(item, "$.url"), F.lit("")), F.get_json_object(item, "$.src"))).otherwise(item)
    listed = lambda e: F.transform(F.from_json(e["value"], "array<string>"), address)
    given = lambda e: F.when(e["key"].startswith("images") & e["value"].startswith("["), listed(e)).otherwise(F.array(e["value"]))
    found = F.flatten(F.transform(F.filter(entries, lambda e: e["key"].startswith("image") & e["value"].isNotNull()), lambda e: F.coalesce(given(e), F.array().cast("array<string>"))))
    return F.coalesce(F.array_distinct(F.filter(found, lambda url: url.startswith("http"))), F.array().cast("array<string>"))


def category_key(category_id: Column, path: Column, keys: Mapping[int, str], fallback: Column | None = None) -> Column:
    """The key of a product's own category if it is among ``keys``, else that of the deepest one on its path, else ``fallback``.
    Rows where it is null are those that a category filter drops."""
    table = F.create_map(*[F.lit(x) for item in keys.items() for x in item])
    above = F.filter(F.transform(F.reverse(path), lambda k: F.try_element_at(table, k.cast("int"))), lambda k: k.isNotNull())
    return F.coalesce(F.try_element_at(table, category_id.cast("int")), F.try_element_at(above, F.lit(1)), F.lit(None) if fallback is None else fallback)


def product_line(name: Column, brand: Column) -> Column:
    """The name without brand, filler words, grade and volume, its distinct words in order."""
    text = F.lower(strip_tags(name))
    words = F.split(F.regexp_replace(text, r"(?iU)\b\d{1,2}w[- ]?\d{2}\b|\b\d+(?:[.,]\d+)?\s*(?:мл|ml|л|l)\b", " "), r"(?U)\s+")
    own = F.split(F.lower(empty(brand)), " ")
    kept = F.filter(words, lambda w: (w != "") & ~w.isin(*V.OIL_STOP_WORDS) & ~F.array_contains(own, w))
    return F.array_join(F.array_distinct(kept), " ")


def product_name(*parts: Column) -> Column:
    """Parts joined by blanks, without repeats and blank ones."""
    found = F.filter(F.array(*[strip(empty(p.cast("string"))) for p in parts]), lambda p: p != "")
    return F.array_join(F.array_distinct(found), " ")


def attribute_name(c: Column, aliases: Mapping[str, str] | None = None) -> Column:
    key = F.translate(F.lower(strip_tags(c)), "ё", "е")
    renamed = key
    for alias, name in (aliases or {}).items():
        renamed = F.when(key == alias, name).otherwise(renamed)
    tidy = F.regexp_replace(F.regexp_replace(renamed, r"[^0-9a-zа-я_]+", "_"), "^_+|_+$", "")
    return F.when(key.rlike("^допуски? "), "approvals").otherwise(F.coalesce(F.nullif(tidy, F.lit("")), F.lit("unknown_attribute")))


def merge_values(values: Column) -> Column:
    """Distinct values in order, joined by semicolons."""
    return F.array_join(F.array_distinct(F.flatten(F.transform(values, lambda v: F.split(v, "; ")))), "; ")


def allowed_attributes(attributes: Column, allowed: Sequence[str]) -> Column:
    return F.map_filter(attributes, lambda k, _: k.isin(*allowed))


def derived_attributes(name: Column) -> Column:
    """Everything that a product name tells, as a map of the attributes found."""
    size = tire_size(name)
    found = {
        "tire_width": size["tire_width"], "tire_profile": size["tire_profile"], "tire_diameter": size["tire_diameter"], "season": season_label(name),
        "viscosity": viscosity(name), "volume_liters": volume_liters(name), "oil_type": oil_label(name), "filter_type": filter_label(name),
        "battery_type": battery_label(name), "capacity_ah": capacity_ah(name), "voltage_v": voltage_v(name), "polarity": polarity_label(name),
    }
    entries = F.array(*[F.struct(F.lit(k).alias("key"), F.nullif(v.cast("string"), F.lit("")).alias("value")) for k, v in found.items()])
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def classify_group(text: Column, present: Mapping[str, Column] | None = None) -> Column:
    """Product group by keywords of its texts, else by which columns are filled."""
    found = ladder(F.lower(empty(text)), V.GROUP_KEYWORDS)
    for group, names in V.GROUP_COLUMNS:
        filled = [empty(present[n]) != "" for n in names if present and n in present]
        if filled:
            some = filled[0]
            for one in filled[1:]:
                some = some | one
            found = F.coalesce(found, F.when(some, group))
    return F.coalesce(found, F.lit(""))


def trailing_id(c: Column) -> Column:
    """Digits at the end of a path, else its last part."""
    path = F.regexp_replace(F.regexp_replace(c, "[?#].*$", ""), "/+$", "")
    return F.coalesce(extract(path, r"(\d+)$", 1), F.substring_index(path, "/", -1))


def shorten(c: Column, size: int = 80) -> Column:
    text = strip(F.regexp_replace(c, r"(?U)\s+", " "))
    return F.when(F.length(text) > size, F.concat(F.substring(text, 1, size - 1), F.lit("…"))).otherwise(text)


def transliterate(c: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in V.TRANSLITERATION.items() for x in pair])
    return F.array_join(F.transform(F.split(F.lower(c), ""), lambda ch: F.coalesce(table[ch], ch)), "")


def page_title(html: Column) -> Column:
    return strip_tags(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


def page_links(html: Column) -> Column:
    """Distinct link targets in order."""
    return F.array_distinct(F.regexp_extract_all(html, F.lit(r'(?i)<a\s+[^>]*href="([^"]*)"'), F.lit(1)))


def embedded_json(html: Column, element_id: str = "__NEXT_DATA__") -> Column:
    """JSON text of the script element with this id."""
    return extract(html, rf'(?s)<script[^>]*id="{element_id}"[^>]*>(.*?)</script>', 1)


def json_ld(html: Column) -> Column:
    """Texts of all JSON-LD scripts; parse with from_json or parse_json and pick by @type."""
    return F.regexp_extract_all(html, F.lit(r'(?is)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>'), F.lit(1))


def spec_table(html: Column) -> Column:
    """Rows of two cells as a map from the first to the second; the first of equal names counts."""
    cells = r"(?is)<t[hd][^>]*>(.*?)</t[hd]>\s*<t[hd][^>]*>(.*?)</t[hd]>"
    keys, values = (F.regexp_extract_all(html, F.lit(cells), F.lit(k)) for k in (1, 2))
    entries = F.zip_with(keys, values, lambda k, v: F.struct(strip_tags(k).alias("key"), strip_tags(v).alias("value")))
    first = F.filter(entries, lambda e, at: ~F.exists(F.slice(entries, F.lit(1), at), lambda p: p["key"] == e["key"]))
    return F.map_from_entries(first)
