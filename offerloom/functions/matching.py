"""Features and scores for matching offers: every function takes and gives a Column; unknown values are the text ``unknown``."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import values as V
from .text import extract, first_contained, ladder, or_unknown, round_text, strip, to_float


def clean_text(c: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(F.coalesce(F.lower(c), F.lit("")), r"(?U)[^\w\s]", " "), r"(?U)\s+", " "))


def clean_text_oils(c: Column) -> Column:
    words = F.split(clean_text(c), " ")
    return F.array_join(F.filter(words, lambda w: ~w.isin(*V.OIL_STOP_WORDS)), " ")


def viscosity_from_name(c: Column) -> Column:
    return or_unknown(extract(F.lower(c), r"(?U)\b\d+w-\d+\b"))


def clean_volume(c: Column) -> Column:
    """All л and l go first, so a spelt-out unit leaves letters behind and is unknown."""
    v = strip(F.translate(F.translate(F.lower(strip(c.cast("string"))), "лl", ""), ",", "."))
    return or_unknown(round_text(to_float(v)))


def volume_from_name(c: Column) -> Column:
    name = F.lower(c)
    patterns = (r"(?U)\((\d+(?:[.,]\d+)?)\s*[lл]\)", r"(?U)\b(\d+(?:[.,]\d+)?)\s*[lл]\b", r"(?U)\b(\d+(?:[.,]\d+)?)\s*литр")
    return or_unknown(F.coalesce(*[round_text(to_float(F.translate(extract(name, p, 1), ",", "."))) for p in patterns]))


def clean_oil_type(c: Column, strict: bool = False) -> Column:
    """``strict`` tests for semi-synthetic first; otherwise its names, which contain the other's, count as synthetic."""
    classes = V.OIL_TYPE_KEYWORDS
    return ladder(F.lower(strip(c)), (classes[1], classes[0], classes[2]) if strict else classes, F.lit("unknown"))


def oil_product_line(c: Column) -> Column:
    return or_unknown(F.replace(F.lower(first_contained(F.upper(c), V.OIL_LINES)), F.lit(" "), F.lit("_")))


def brand_from_name(c: Column) -> Column:
    return or_unknown(first_contained(F.lower(c), V.OIL_BRANDS))


def clean_width(c: Column) -> Column:
    v = F.translate(F.replace(F.lower(strip(c.cast("string"))), F.lit("мм"), F.lit("")), "\"'", "")
    return or_unknown(round_text(to_float(F.substring_index(F.substring_index(v, "/", 1), ";", 1))))


def clean_profile(c: Column) -> Column:
    return or_unknown(strip(F.translate(c.cast("string"), '"', "")))


def clean_diameter(c: Column) -> Column:
    v = F.translate(F.lower(strip(c.cast("string"))), "r\"'с", "")
    return or_unknown(round_text(to_float(F.substring_index(v, ";", 1))))


def clean_season(c: Column) -> Column:
    return ladder(F.lower(strip(c)), V.SEASON_KEYWORDS, F.lit("unknown"))


def tyre_model(c: Column) -> Column:
    name = F.regexp_replace(F.regexp_replace(c, r"(?U)\d+/\d+\s*r?\d+", ""), r"(?U)\b\d{3}\b", "")
    words = F.filter(F.split(name, r"(?U)\s+"), lambda w: w != "")
    return F.when(F.size(words) > 1, F.array_join(F.slice(words, 2, 2), "_")).otherwise("unknown")


def speed_index(c: Column) -> Column:
    found = F.regexp_extract_all(F.upper(c), F.lit(r"(?U)\b\d{2,3}([A-Z])\b"), F.lit(1))
    return or_unknown(F.lower(F.try_element_at(found, F.lit(-1))))


def clean_filter_type(c: Column) -> Column:
    return ladder(F.lower(strip(c)), V.FILTER_KEYWORDS, F.lit("unknown"))


def article(c: Column) -> Column:
    return or_unknown(F.lower(F.try_element_at(F.regexp_extract_all(c, F.lit(r"(?U)[A-Z]{2,}[\d]+[A-Z\d]*"), F.lit(0)), F.lit(-1))))


def clean_oem(c: Column) -> Column:
    return or_unknown(F.translate(F.lower(strip(c)), " -", ""))


def clean_capacity(c: Column) -> Column:
    return or_unknown(round_text(to_float(c.cast("string"))))


def battery_model(c: Column) -> Column:
    return or_unknown(extract(c, r"(?U)s\d+|silver|blue|black|asia|agm"))


def battery_type(c: Column) -> Column:
    return first_contained(F.upper(c), V.BATTERY_TYPES)


def vehicle_type(c: Column) -> Column:
    return ladder(F.coalesce(c, F.lit("")), V.VEHICLE_KEYWORDS, F.lit("passenger"))


def studded(c: Column) -> Column:
    return F.when(c.contains("нешип"), False).when(c.contains("шип"), True)


def is_known(c: Column) -> Column:
    return F.coalesce(~F.lower(strip(c.cast("string"))).isin(*V.UNKNOWN_TEXTS), F.lit(False))


def hard_value(c: Column) -> Column:
    """Comparable text of an attribute; null where it is unknown."""
    text = F.regexp_replace(F.regexp_replace(F.lower(strip(c.cast("string"))), r"\.0$", ""), r"(?U)\s+", " ")
    return F.when(is_known(c), text)


def given(c: Column) -> Column:
    """A comparable text as it is."""
    return c


def block_key(category: Column, brand: Column, attrs: Sequence[Column]) -> Column:
    """category|brand|attributes; null where one of them is unknown."""
    return F.when(is_known(brand), F.concat(category, *[F.concat(F.lit("|"), hard_value(c)) for c in (brand, *attrs)]))


#: Attributes that weigh more, and the weights.
HARD = ("brand_clean", "width_clean", "profile_clean", "diameter_clean", "viscosity_clean", "volume_clean", "capacity_clean", "voltage_clean", "oem_clean")
HARD_WEIGHT, SOFT_WEIGHT, MISMATCH_FACTOR = 1.5, 1.0, 0.65


def rule_score(left: dict[str, Column], right: dict[str, Column], value: Callable[[Column], Column] = hard_value) -> Column:
    """Weighted share of equal values among the attributes known on both sides; 0 where there is none. ``value`` makes the
    comparable text of an attribute: ``given`` where the columns hold it already, worked out once for each offer and not for each pair."""
    score, total = F.lit(0.0), F.lit(0.0)
    for name in left:
        a, b, weight = value(left[name]), value(right[name]), HARD_WEIGHT if name in HARD else SOFT_WEIGHT
        total = total + F.when(a.isNotNull() & b.isNotNull(), weight).otherwise(0.0)
        score = score + F.when(a == b, weight).otherwise(0.0)
    return F.when(total > 0, score / total).otherwise(0.0)


def hard_mismatch(left: dict[str, Column], right: dict[str, Column], value: Callable[[Column], Column] = hard_value) -> Column:
    bad = F.lit(False)
    for name in left:
        if name in HARD and name != "oem_clean":
            bad = bad | F.coalesce(value(left[name]) != value(right[name]), F.lit(False))
    return bad


def explanation(left: dict[str, Column], right: dict[str, Column], value: Callable[[Column], Column] = hard_value) -> Column:
    """Maps of matched and mismatched attributes (name to both values), and the names of missing ones."""
    pair = lambda n: F.struct(value(left[n]).alias("left"), value(right[n]).alias("right"))
    pairs = F.map_from_entries(F.array(*[F.struct(F.lit(n), pair(n)) for n in left]))
    both = lambda v: v["left"].isNotNull() & v["right"].isNotNull()
    missing = F.map_keys(F.map_filter(pairs, lambda k, v: ~both(v)))
    return F.struct(
        F.map_filter(pairs, lambda k, v: both(v) & (v["left"] == v["right"])).alias("matched_fields"),
        F.map_filter(pairs, lambda k, v: both(v) & (v["left"] != v["right"])).alias("mismatched_fields"),
        missing.alias("missing_fields"),
    )


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is bound to a name: worked out once for each row, and not wherever it is used or for each element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def dot(a: Column, b: Column) -> Column:
    """The inner product of two vectors: of unit vectors, their cosine."""
    return F.aggregate(F.zip_with(a, b, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)


def unit(vector: Column) -> Column:
    """The vector at length 1, as doubles; one without length stays as it is. Done once for each row, it spares the pairs the work."""
    return once(vector, lambda v: once(F.sqrt(dot(v, v)), lambda size: once(F.when(size > 0, size).otherwise(1.0), lambda length: F.transform(v, lambda p: p.cast("double") / length))))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; 0 where one has no length."""
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(size > 0, dot(a, b) / size).otherwise(0.0)


def name_vector(c: Column, bins: int = 64, gram: int = 3) -> Column:
    """A deterministic stand-in for a sentence encoder: counts of hashed character n-grams."""
    text = F.concat(F.lit(" "), F.coalesce(c, F.lit("")), F.lit(" "))
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - gram + 1, F.lit(1)))
    hashed = F.transform(starts, lambda k: F.pmod(F.crc32(F.substr(text, k, F.lit(gram)).cast("binary")), F.lit(bins)))
    return once(hashed, lambda all_: F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda b: F.size(F.filter(all_, lambda h: h == b)).cast("float")))


def number_penalty(a: Column, b: Column) -> Column:
    """Lower where the names' numbers disagree."""
    numbers = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(r"(?U)\b\d+\b"), F.lit(0)))
    x, y = numbers(a), numbers(b)
    common = F.size(F.array_intersect(x, y))
    return (
        F.when((F.size(x) == 0) | (F.size(y) == 0), 1.0).when(common == 0, 0.2)
        .when(common / F.greatest(F.size(x), F.size(y)) < 0.5, 0.6).otherwise(1.0)
    )


def tyre_size_penalty(a: Column, b: Column) -> Column:
    size = lambda c: F.regexp_extract_all(F.lower(c), F.lit(r"(?U)(\d{3})\s*/\s*(\d{2})\s*r\s*(\d{2})"), F.lit(0))
    tidy = lambda c: F.regexp_replace(F.try_element_at(size(c), F.lit(1)), r"(?U)\s", "")
    return F.when(F.coalesce(tidy(a) != tidy(b), F.lit(False)), 0.1).otherwise(1.0)


def confidence_bucket(score: Column, method: Column) -> Column:
    return F.when(method.isin("OEM", "root", "single_source") | (score >= 0.9), "High").when(score >= 0.75, "Medium").otherwise("Low")


def category_id(group: Column, oil_type: Column, season: Column, vehicle: Column, studs: Column, filter_type: Column, battery: Column) -> Column:
    """Leaf of the category tree, from cleaned features (their names as the functions above give them)."""
    pick = lambda c, table, default: F.coalesce(*[F.when(c == k, v) for k, v in table.items()], F.lit(default))
    winter = F.when(studs, 34).when(~studs, 35).otherwise(33)
    passenger = F.when(season == "winter", winter).otherwise(pick(season, {"summer": 32, "allseason": 36}, 32))
    tires = (
        F.when(vehicle == "suv", pick(season, {"summer": 38, "winter": 39, "allseason": 40}, 38))
        .when(vehicle == "truck", 42).when(vehicle == "moto", 44).otherwise(passenger)
    )
    filters = {"air": 61, "oil": 62, "cabin": 63, "fuel": 64, "transmission": 65, "hydraulic": 66}
    return (
        F.when(group == "oils", pick(oil_type, {"synthetic": 4, "semi": 5, "mineral": 6}, 3)).when(group == "tires", tires)
        .when(group == "filters", pick(filter_type, filters, 60)).when(group == "batteries", pick(battery, {"AGM": 53, "EFB": 54, "GEL": 55}, 52)).otherwise(999)
    )


