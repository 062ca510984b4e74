"""One query per column function: inputs dealt over the rows of ``part``, and the SQL that states the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..functions import matching as M
from ..functions import parsing as P
from ..functions import values as V
from ..functions.text import NUMBER, strip_tags
from ..sources.scans import first_of

EDGE = r"(?:^|[^\p{L}\p{N}_])"
END = r"(?:$|[^\p{L}\p{N}_])"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _float(x: str) -> str:
    return f"CASE WHEN regexp_matches({_strip(x)}, {q(NUMBER)}) THEN TRY_CAST({_strip(x)} AS DOUBLE) END"


def _lookup(x: str, table: dict, default: str = "NULL") -> str:
    return f"CASE {x} " + " ".join(f"WHEN {q(k)} THEN {'NULL' if v is None else q(v)}" for k, v in table.items()) + f" ELSE {default} END"


def _ladder(x: str, classes, default: str = "NULL") -> str:
    cases = (f"WHEN {' OR '.join(f'contains({x}, {q(w)})' for w in words)} THEN {q(name)}" for name, words in classes)
    return f"CASE {' '.join(cases)} ELSE {default} END"


def _ex(x: str, pattern: str, group: int = 0) -> str:
    return f"NULLIF(regexp_extract({x}, {q(pattern)}, {group}), '')"


def _sub(x: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(by)}, 'g')"


def _round(x: str) -> str:
    return f"CAST(CAST(round_even({x}, 0) AS BIGINT) AS VARCHAR)"


def _unknown(x: str) -> str:
    return f"COALESCE({x}, 'unknown')"


def _ordered_distinct(x: str) -> str:
    return f"list_filter({x}, lambda v, i: list_position({x}, v) = i)"


def _comma(x: str) -> str:
    return f"replace({x}, ',', '.')"


_low = "lower(x)"
_lowstrip = f"lower({_strip('x')})"
_clean = rf"trim(regexp_replace(regexp_replace(lower(x), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"
_litre = r"(\d+(?:[.,]\d+)?)"
_fixed_name = f"{_strip('x')}"
_names = [
    "Акция! Масло Castrol  5W-30, ", "Шина Triangle TR259 205/55 R16 91V", "Масло Mobil 1 EDGE 4 л 5w-40", "Фильтр MANN HU7008Z", "Аккумулятор AGM s5 60 Ah", "", None,
    "triangle tr259 205 55 r16 91v", "LIQUI MOLY Leichtlauf 10W40 (1 л)", "zzz", "Шина зимняя нешип 195/65R15 T", "Масло TOTAL super 2000 20 литров",
]

_volume_unit = r"(мл|ml|литра|литров|литр|л|l)"
_pkg_value = _float(_comma(_ex("x", f"(?i){EDGE}{_litre}\\s*{_volume_unit}{END}", 1)))
_pkg_litres = f"(CASE WHEN lower({_ex('x', f'(?i){EDGE}{_litre}\\s*{_volume_unit}{END}', 2)}) IN ('мл', 'ml') THEN ({_pkg_value}) / 1000 ELSE {_pkg_value} END)"
_numbers = r"list_distinct(regexp_extract_all(lower({0}), '\b\d+\b'))"

#: name: (inputs, Spark expression, SQL over x)
SCALARS: dict[str, tuple[list[str | None], Callable[[Column], Column], str]] = {
    "normalized_name": (_names, C.normalized_name, f"NULLIF(lower({_sub(_sub(_sub(_sub(_strip('x'), '[!@#$%^&*]+'), f'(?i)(^|[^\\p{{L}}\\p{{N}}_])({"|".join(V.PROMO_WORDS)})($|[^\\p{{L}}\\p{{N}}_])', '\\1\\3'), '\\s{2,}', ' '), '^[ ,;-]+|[ ,;-]+$')}), '')"),
    "clean_price": (["1200.5", "0", "-5", "abc", None, " 7 ", "5d", "1e3"], C.clean_price, f"CASE WHEN ({_float('x')}) > 0 THEN {_float('x')} END"),
    "normalize_availability": (["В наличии", "нет", "Под заказ", "Под заказ: 3 дн", None, "instock "], C.normalize_availability, _lookup(_lowstrip, dict.fromkeys(V.IN_STOCK, "in_stock") | dict.fromkeys(V.OUT_OF_STOCK, "out_of_stock"))),
    "normalize_bool": (["Да", "0", "maybe", None, "TRUE", "нет"], C.normalize_bool, f"CASE WHEN {_lowstrip} IN ('true','да','есть','1') THEN true WHEN {_lowstrip} IN ('false','нет','0') THEN false END"),
    "normalize_season": (["Зимние шины под шип", "лето", "summer", None, " Летние "], C.normalize_season, _lookup(_lowstrip, V.SEASONS)),
    "normalize_diameter": (['R16"', "16C", "r17", "15.5", None, "RR18''"], C.normalize_diameter, _float(_sub(_sub(_sub(f"upper({_strip('x')})", "^R+"), '"+$'), "'+$"))),
    "normalize_speed_index": (["Т", "h  xl", "Н", "", None], C.normalize_speed_index, f"NULLIF(upper({_strip(_sub(f'translate({_strip("x")}, {q("НТ")}, {q("HT")})', '(?i)\\s+XL$', ' XL'))}), '')"),
    "normalize_viscosity": (["5w30", "5W 30; 5W-40", "0W–20", "SAE 30", "отсутствует", "abc", None], C.normalize_viscosity, f"CASE WHEN lower({_strip('split_part(x, chr(59), 1)')}) NOT IN ('отсутствует','') THEN COALESCE({_sub(f'''replace(replace(upper({_ex(_strip('split_part(x, chr(59), 1)'), '(?i)([0-9]{1,2}W[-–\\s]?[0-9]{1,2}|[0-9]{1,2}W|\\bSAE\\s*[0-9]+\\w*)')}), '–', '-'), ' ', '')''', '(\\d+W)(\\d+)', '\\1-\\2')}, {_strip('split_part(x, chr(59), 1)')}) END"),
    "normalize_volume": (["400 мл", "4,5 л", "3", "3,5", None, "1.2.3 л"], C.normalize_volume, f"CASE WHEN regexp_matches({_lowstrip}, '[\\d.,]+\\s*мл') THEN round(({_float(_comma(_ex(_lowstrip, '([\\d.,]+)\\s*мл', 1)))}) / 1000, 3) WHEN regexp_matches({_lowstrip}, '[\\d.,]+\\s*(л|l|литр)') THEN {_float(_comma(_ex(_lowstrip, '([\\d.,]+)\\s*(л|l|литр)', 1)))} ELSE {_float(_lowstrip)} END"),
    "normalize_oil_type": (["Полусинтетическое", "масло для двигателя", "PAO", "минеральное; x", None, ""], C.normalize_oil_type, f"CASE WHEN lower({_strip('split_part(x, chr(59), 1)')}) = 'масло для двигателя' THEN NULL ELSE NULLIF({_lookup(f'lower({_strip("split_part(x, chr(59), 1)")})', {k: v for k, v in V.OIL_TYPES.items() if v}, f'lower({_strip("split_part(x, chr(59), 1)")})')}, '') END"),
    "normalize_engine_type": (["Бензиновый; Дизельный", "xyz", "diesel,diesel", None, "4T/газовый"], C.normalize_engine_type, f"""COALESCE(NULLIF(array_to_string({_ordered_distinct(f'''list_filter(list_transform(string_split_regex(x, '[;/,]'), lambda p: {_lookup("lower(trim(p))", V.ENGINE_TYPES)}), lambda p: p IS NOT NULL)''')}, '/'), ''), {_strip('x')})"""),
    "tire_width": (_names, lambda c: C.tire_size_part(c, 1), _float(_ex("x", f"(?i){EDGE}(\\d{{3}})\\s*/\\s*(\\d{{2,3}})\\s*(?:ZR|R)?\\s*(\\d{{2}}(?:[.,]\\d)?){END}", 1))),
    "tire_diameter": (_names, lambda c: C.tire_size_part(c, 3), _float(_comma(_ex("x", f"(?i){EDGE}(\\d{{3}})\\s*/\\s*(\\d{{2,3}})\\s*(?:ZR|R)?\\s*(\\d{{2}}(?:[.,]\\d)?){END}", 3)))),
    "tire_season": (_names, C.tire_season, _ladder(_low, V.TIRE_SEASON_KEYWORDS)),
    "oil_package": ([*_names, "бочка", "масло 250 мл"], C.oil_package, f"COALESCE({_ladder(_low, V.PACKAGE_KEYWORDS)}, CASE WHEN {_pkg_litres} >= 20 THEN 'barrel' WHEN {_pkg_litres} >= 4 THEN 'canister' WHEN {_pkg_litres} > 0 THEN 'bottle' END)"),
    "battery_polarity": (["обратная", "L+", "60Ah 0", "1 x", None, "60"], C.battery_polarity, f"COALESCE({_ladder(_low, V.POLARITY_KEYWORDS)}, CASE WHEN regexp_matches({_low}, '{EDGE}0{END}') THEN 'reverse' WHEN regexp_matches({_low}, '{EDGE}1{END}') THEN 'direct' END)"),
    "battery_terminal": (["Евро клеммы", "ASIA", "под болт", None, "x"], C.battery_terminal, _ladder(_low, V.TERMINAL_KEYWORDS)),
    "text_value": ([" x ", "NaN", "none", "", None, "0"], C.text_value, f"CASE WHEN {_lowstrip} NOT IN ('','nan','none','null') THEN {_strip('x')} END"),
    "clean_text": (_names, M.clean_text, f"COALESCE({_clean}, '')"),
    "clean_text_oils": (_names, M.clean_text_oils, f"COALESCE(array_to_string(list_filter(string_split({_clean}, ' '), lambda w: w NOT IN ({', '.join(map(q, V.OIL_STOP_WORDS))})), ' '), '')"),
    "viscosity_from_name": (_names, M.viscosity_from_name, _unknown(_ex(_low, r"\b\d+w-\d+\b"))),
    "clean_volume": (["4.5", "5 литров", "5,5 л", "1L", None, "2.5"], M.clean_volume, _unknown(_round(_float(f"replace(replace(replace({_lowstrip}, 'л', ''), 'l', ''), ',', '.')")))),
    "volume_from_name": (_names, M.volume_from_name, _unknown(f"COALESCE({_round(_float(_comma(_ex(_low, f'[(]{_litre}\\s*[lл][)]', 1))))}, {_round(_float(_comma(_ex(_low, f'{EDGE}{_litre}\\s*[lл]{END}', 1))))}, {_round(_float(_comma(_ex(_low, f'{EDGE}{_litre}\\s*литр', 1))))})")),
    "clean_oil_type": (["полусинтетическое", "semi", "минеральное", None, "x", "full syn"], M.clean_oil_type, _ladder(_lowstrip, V.OIL_TYPE_KEYWORDS, "'unknown'")),
    "oil_product_line": (_names, M.oil_product_line, _unknown(f"replace(lower({_ladder('upper(x)', [(w, (w,)) for w in V.OIL_LINES])}), ' ', '_')")),
    "brand_from_name": (_names, M.brand_from_name, _unknown(_ladder(_low, [(w, (w,)) for w in V.OIL_BRANDS]))),
    "clean_width": (['205', "205/55", "7.5\"", "мм", None, "185;195", "204.5"], M.clean_width, _unknown(_round(_float(f"split_part(split_part(replace(replace(replace({_lowstrip}, 'мм', ''), '\"', ''), '''', ''), '/', 1), ';', 1)")))),
    "clean_diameter": (["R16С", "R16C", "17", "15.5", None, "r18;r19"], M.clean_diameter, _unknown(_round(_float(f"split_part(replace(replace(replace(replace({_lowstrip}, 'r', ''), '\"', ''), '''', ''), 'с', ''), ';', 1)")))),
    "clean_season": (["нешипованная", "sport", "4S", "x", None, "Летняя"], M.clean_season, _ladder(_lowstrip, V.SEASON_KEYWORDS, "'unknown'")),
    "tyre_model": (["triangle tr259 205 55 r16 91v", "one", "", None, "a b 205/55r16 c"], M.tyre_model, "CASE WHEN len(list_filter(string_split_regex(regexp_replace(regexp_replace(x, '\\d+/\\d+\\s*r?\\d+', '', 'g'), '\\b\\d{3}\\b', '', 'g'), '\\s+'), lambda w: w <> '')) > 1 THEN array_to_string(list_filter(string_split_regex(regexp_replace(regexp_replace(x, '\\d+/\\d+\\s*r?\\d+', '', 'g'), '\\b\\d{3}\\b', '', 'g'), '\\s+'), lambda w: w <> '')[2:3], '_') ELSE 'unknown' END"),
    "speed_index": (["205 55 r16 91v", "91T 95H", "x", "", None], M.speed_index, _unknown(r"lower(list_last(regexp_extract_all(upper(x), '\b\d{2,3}([A-Z])\b', 1)))")),
    "clean_filter_type": (["Салонный", "transmission", "oil", "гидравлический", None], M.clean_filter_type, _ladder(_lowstrip, V.FILTER_KEYWORDS, "'unknown'")),
    "article": (["Фильтр MANN HU7008Z", "AB12 CD34", "x", None], M.article, _unknown(r"lower(list_last(regexp_extract_all(x, '[A-Z]{2,}\d+[A-Z\d]*')))")),
    "clean_oem": ([" AB-12 34", None, "x"], M.clean_oem, _unknown(f"replace(replace({_lowstrip}, ' ', ''), '-', '')")),
    "clean_capacity": (["60", "62.5", "x", None, "61.5"], M.clean_capacity, _unknown(_round(_float("x")))),
    "battery_model": (["varta s5 silver", "blue", "x", None], M.battery_model, _unknown(_ex("x", r"s\d+|silver|blue|black|asia|agm"))),
    "battery_type": (["varta agm", "EFB gel", "x", None], M.battery_type, _ladder("upper(x)", [(w, (w,)) for w in V.BATTERY_TYPES])),
    "vehicle_type": (["suv", "грузовая", "moto", None, "x"], M.vehicle_type, _ladder("COALESCE(x, '')", V.VEHICLE_KEYWORDS, "'passenger'")),
    "studded": (["нешип", "шипованная", "x", None], M.studded, "CASE WHEN contains(x, 'нешип') THEN false WHEN contains(x, 'шип') THEN true END"),
    "is_known": (["x", "-", "не указано", "", None, " NaN "], M.is_known, f"COALESCE({_lowstrip} NOT IN ({', '.join(map(q, V.UNKNOWN_TEXTS))}), false)"),
    "hard_value": (["16.0", " A  b ", "unknown", None], M.hard_value, f"CASE WHEN {_lowstrip} NOT IN ({', '.join(map(q, V.UNKNOWN_TEXTS))}) THEN {_sub(_sub(_lowstrip, '\\.0$'), '\\s+', ' ')} END"),
    "number_penalty": (["5w 30 4", "5w 40 4 1", "30", "a", None], lambda c: M.number_penalty(c, F.lit("30 4")), f"CAST(CASE WHEN x IS NULL THEN 1.0 WHEN len({_numbers.format('x')}) = 0 THEN 1.0 WHEN len(list_intersect({_numbers.format('x')}, ['30','4'])) = 0 THEN 0.2 WHEN len(list_intersect({_numbers.format('x')}, ['30','4'])) / greatest(len({_numbers.format('x')}), 2) < 0.5 THEN 0.6 ELSE 1.0 END AS DOUBLE)"),
    "tyre_size_penalty": (["205/55 R16", "205/60 R16", "x", None], lambda c: M.tyre_size_penalty(c, F.lit("205/55r16")), f"CAST(CASE WHEN {_sub(_ex(_low, '(\\d{3})\\s*/\\s*(\\d{2})\\s*r\\s*(\\d{2})'), '\\s')} <> '205/55r16' THEN 0.1 ELSE 1.0 END AS DOUBLE)"),
    "strip_tags": (["<p>a &amp; b</p>", "<script>x</script>y", " a b ", None], strip_tags, "trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(x, '(?is)<script[^>]*>.*?</script>', ' ', 'g'), '(?is)<style[^>]*>.*?</style>', ' ', 'g'), '(?s)<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&quot;', '\"'), '&#39;', ''''), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), chr(160), ' '), '\\s+', ' ', 'g'))"),
    "parse_price": (["12 500 ₸", "от 7", "x", None], P.price, _float(_sub(_ex("x", r"\d[\d\s\x{00A0}]*"), r"[\s\x{00A0}]"))),
    "first_number": (["a -3,5 b", "7", "x", None], P.first_number, _float(_comma(_ex("x", r"-?\d+(?:[.,]\d+)?")))),
    "season_label": (["зимние", "summer", "x", None], P.season_label, _ladder("lower(COALESCE(x, ''))", P.SEASON_LABELS, "''")),
    "oil_label": (["semi-synthetic", "HC-Synth", "синтетика", None, "x"], P.oil_label, _ladder("lower(COALESCE(x, ''))", P.OIL_LABELS, "''")),
    "filter_label": (["фильтр масляный", "воздушный", None], P.filter_label, _ladder("lower(COALESCE(x, ''))", P.FILTER_LABELS, "''")),
    "battery_label": (["AGM", "гелевый", "x", None], P.battery_label, _ladder("lower(COALESCE(x, ''))", P.BATTERY_LABELS, "''")),
    "parse_viscosity": (["5w30", "05W-40", "SAE 30", None, "x"], P.viscosity, "COALESCE(CAST(TRY_CAST(" + _ex("x", r"(?i)\b(\d{1,2})\s*W\s*[-–]?\s*(\d{2})\b", 1) + " AS INT) AS VARCHAR) || 'W-' || " + _ex("x", r"(?i)\b(\d{1,2})\s*W\s*[-–]?\s*(\d{2})\b", 2) + ", 'SAE ' || upper(" + _ex("x", r"(?i)\bSAE\s*(\d{2,3}\w*)", 1) + "), '')"),
    "classify_group": (["Шина зимняя", "масло", "battery", "диск", "x", None], lambda c: P.classify_group(c), _ladder("lower(COALESCE(x, ''))", V.GROUP_KEYWORDS, "''")),
    "availability_label": (["3 дн, 5 дн", "0 дн", "есть", None], P.availability_label, "CASE WHEN list_min(list_transform(regexp_extract_all(COALESCE(x, ''), '(\\d+)\\s*дн', 1), lambda d: CAST(d AS INT))) > 0 THEN 'Под заказ: ' || list_min(list_transform(regexp_extract_all(x, '(\\d+)\\s*дн', 1), lambda d: CAST(d AS INT))) || ' дн' ELSE 'В наличии' END"),
    "trailing_id": (["/p/shina-123/", "https://a.kz/x/y?z=1", "/77", None], P.trailing_id, "COALESCE(" + _ex(_sub(_sub("x", "[?#].*$"), "/+$"), r"(\d+)$", 1) + f", list_last(string_split({_sub(_sub('x', '[?#].*$'), '/+$')}, '/')))"),
    "shorten": (["a  b", "x" * 100, None], P.shorten, f"CASE WHEN length({_strip(_sub('x', '\\s+', ' '))}) > 80 THEN left({_strip(_sub('x', '\\s+', ' '))}, 79) || '…' ELSE {_strip(_sub('x', '\\s+', ' '))} END"),
    "transliterate": (["Щётка Юг", "abc", "", None], P.transliterate, "array_to_string(list_transform(string_split(lower(x), ''), lambda c: " + _lookup("c", V.TRANSLITERATION, "c") + "), '')"),
    "attribute_name": (["Допуски MB", "Объём, л", "", None, "A b"], lambda c: P.attribute_name(F.coalesce(c, F.lit(""))), "CASE WHEN regexp_matches(lower(COALESCE(x, '')), '^допуски? ') THEN 'approvals' ELSE COALESCE(NULLIF(" + _sub(_sub("replace(lower(trim(COALESCE(x, ''))), 'ё', 'е')", "[^0-9a-zа-я_]+", "_"), "^_+|_+$") + ", ''), 'unknown_attribute') END"),
    "first_of": (["a | b", "https://a/1,https://a/2", "a,b", None], first_of, "CASE WHEN contains(COALESCE(x, ''), '|') THEN trim(split_part(x, '|', 1)) WHEN regexp_matches(COALESCE(x, ''), '^https?://') THEN trim(split_part(x, ',', 1)) ELSE trim(COALESCE(x, '')) END"),
}
#: Lookaheads, which the other engine's patterns lack: these are tested against expectations instead.
UNSTATED: dict[str, tuple[list[str | None], Callable[[Column], Column]]] = {
    "oem_numbers": (["Фильтр 04152-YZZA1 / OC-123", "OEM: 90915YZZD2, 123456", "x", None], C.oem_numbers),
    "product_line": (["Моторное масло Castrol EDGE 5W-30 4 л", "x", None], lambda c: P.product_line(c, F.lit("Castrol"))),
    "infer_brand": (["Масло liqui moly 5w30", "шина Foo", None], lambda c: P.infer_brand(c, V.OIL_BRANDS)),
    "derived_attributes": (_names, lambda c: F.to_json(P.derived_attributes(c))),
}


def _inputs(values: list[str | None]) -> str:
    cases = " ".join(f"WHEN {k} THEN {'NULL' if v is None else q(v)}" for k, v in enumerate(values))
    return f"CASE p_partkey % {len(values)} {cases} END"


def _query(values: list[str | None], function: Callable[[Column], Column]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        part = spark.read.parquet(f"{sf_dir}/part.parquet")
        chosen = F.lit(None).cast("string")
        for k, v in enumerate(values):
            chosen = F.when(F.col("p_partkey") % len(values) == k, F.lit(v).cast("string")).otherwise(chosen)
        return part.select(F.col("p_partkey").alias("id"), chosen.alias("x")).select("id", "x", function(F.col("x")).alias("value"))

    return run


QUERIES = {f"scalar_{name}": _query(values, function) for name, (values, function, _) in SCALARS.items()}
QUERIES |= {f"scalar_{name}": _query(values, function) for name, (values, function) in UNSTATED.items()}
ORACLES = {f"scalar_{name}": f"WITH t AS (SELECT p_partkey AS id, {_inputs(values)} AS x FROM part) SELECT id, x, {sql} AS value FROM t" for name, (values, _, sql) in SCALARS.items()}
