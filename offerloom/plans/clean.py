"""The cleaning plan of an offer table: typed, normalised, completed from its texts, one row per offer and load."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..functions.text import strip, to_float
from ..operators.relational import top_per_key
from ..sources.scans import GROUP_COLUMNS


def clean_table(df: DataFrame, group: str, brands: DataFrame, cleaned_at: Column) -> DataFrame:
    """All steps in order as one projection (and the brand joins): names, brands, numbers, keyword columns, then values found in
    the row's texts for what is still missing, and the first row of each offer in each load."""
    has = lambda *names: [n for n in names if n in df.columns]
    if has("product_name"):
        df = df.withColumn("product_name", strip(F.col("product_name"))).withColumn("normalized_name", C.normalized_name(F.col("product_name")))
    if has("brand"):
        df = C.clean_brand(df, "brand", brands, out="brand")
    steps = dict.fromkeys(has("price", "old_price"), C.clean_price) | dict.fromkeys(has("availability"), C.normalize_availability)
    steps |= dict.fromkeys(has("season"), C.normalize_season) | dict.fromkeys(has("tire_diameter", "wheel_diameter"), C.normalize_diameter)
    steps |= dict.fromkeys(has("tire_width", "tire_profile", "wheel_width", "capacity_ah", "voltage_v", "start_current_a"), to_float)
    steps |= dict.fromkeys(has("speed_index"), C.normalize_speed_index) | dict.fromkeys(has("studded", "runflat"), C.normalize_bool)
    steps |= {c: f for c, f in (("viscosity", C.normalize_viscosity), ("volume_liters", C.normalize_volume), ("oil_type", C.normalize_oil_type), ("engine_type", C.normalize_engine_type)) if has(c)}
    df = df.withColumns({c: f(F.col(c)) for c, f in steps.items()})
    text = C.row_text(df)
    fill: dict[str, Column] = {}
    if group == "tires":
        fill["season"] = C.normalize_season(C.fill_missing(df, "season", C.tire_season(text)))
        fill |= {c: to_float(C.fill_missing(df, c, C.tire_size_part(text, k)).cast("string")) for k, c in enumerate(("tire_width", "tire_profile", "tire_diameter"), 1)}
    elif group == "oils":
        fill["package_type"] = C.fill_missing(df, "package_type", C.oil_package(text, F.col("volume_liters") if has("volume_liters") else None))
    elif group == "batteries":
        fill |= {"polarity": C.fill_missing(df, "polarity", C.battery_polarity(text)), "terminal_type": C.fill_missing(df, "terminal_type", C.battery_terminal(text))}
    elif group == "filters":
        fill["oem_number"] = C.fill_missing(df, "oem_number", C.oem_numbers(text))
    df = df.withColumns(fill) if fill else df
    keys = [c for c in ("load_id", "source", "source_product_id", "source_url") if c in df.columns]
    df = top_per_key(df, keys, []) if keys else df.distinct()
    return df.withColumn("cleaned_at", cleaned_at)


def clean_named(name: str, df: DataFrame, brands: DataFrame, cleaned_at: Column, groups: Mapping[str, str] | None = None) -> DataFrame:
    """The cleaning plan of a table by its name: that of the group ``groups`` has for it, else of the group its name ends in."""
    found = (groups or {}).get(name) or next((g for g in GROUP_COLUMNS if name == g or name.endswith(f"_{g}")), None)
    if found not in GROUP_COLUMNS:
        raise ValueError(f"no cleaner for {name}; there are {', '.join(GROUP_COLUMNS)}")
    return clean_table(df, found, brands, cleaned_at)
