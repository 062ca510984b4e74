"""Expressions that the column functions are made of. Patterns use (?U) so that word and space classes are Unicode's."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a float may look like; narrower than what casts accept (no suffixes, no underscores).
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
#: Named characters of HTML as the standard library lists them; numbers from 128 to 159 mean Windows-1252.
ENTITIES = {f"&{name}": char for name, char in html5.items() if name.endswith(";")} | {
    f"&#{n};": bytes([n]).decode("cp1252") for n in range(128, 160) if n not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)
}
_ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


def strip(c: Column, chars: str = r"\s") -> Column:
    return F.regexp_replace(c, f"(?U)^[{chars}]+|[{chars}]+$", "")


def blank_to_null(c: Column) -> Column:
    return F.when(strip(c) != "", c)


def to_float(c: Column) -> Column:
    """A double, or null for anything that isn't plainly a number."""
    text = strip(c)
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def round_text(c: Column) -> Column:
    """Rounded half to even, as text without a fraction; null stays."""
    return F.bround(c, 0).cast("long").cast("string")


def or_unknown(c: Column) -> Column:
    return F.coalesce(c, F.lit("unknown"))


def extract(c: Column, pattern: str, group: int = 0) -> Column:
    """The first match's group; null without a match or if it is empty."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def lookup(c: Column, table: Mapping[str, object]) -> Column:
    """The value of an exact key; null for others (and where the value is None)."""
    out = F.lit(None)
    for value in dict.fromkeys(table.values()):
        if value is not None:
            out = F.when(c.isin([k for k, v in table.items() if v == value]), F.lit(value)).otherwise(out)
    return out


def contains_any(c: Column, words: Iterable[str]) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | c.contains(word)
    return found


def ladder(c: Column, classes: Iterable[tuple[str, Iterable[str]]], default: Column | None = None) -> Column:
    """The first class that has a keyword contained in the text."""
    out = None
    for name, words in classes:
        out = (F if out is None else out).when(contains_any(c, words), name)
    return out.otherwise(default) if default is not None else out


def first_contained(c: Column, words: Iterable[str]) -> Column:
    """The first of ``words`` (in their order) that the text contains, or null."""
    return ladder(c, [(word, (word,)) for word in words])


def unescape_html(c: Column) -> Column:
    """Entities, by name or number, become their characters, once; unknown ones stay. A no-break space becomes a blank."""
    names = F.create_map(*[F.lit(x) for pair in ENTITIES.items() for x in pair])

    def decoded(mark: Column) -> Column:
        digits = F.regexp_extract(mark, r"^&#[xX]?([0-9a-fA-F]+);$", 1)
        code = F.when(mark.rlike("^&#[xX]"), F.conv(digits, 16, 10)).otherwise(digits).try_cast("long")
        fine = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        char = F.when(fine, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        return F.coalesce(F.try_element_at(names, mark), char, mark)

    marks = F.transform(F.regexp_extract_all(c, F.lit(_ENTITY), F.lit(0)), decoded)
    text = F.array_join(F.zip_with(F.split(c, _ENTITY, -1), marks, lambda part, mark: F.concat(part, F.coalesce(mark, F.lit("")))), "")
    return F.replace(F.when(c.contains("&"), text).otherwise(c), F.lit("\u00a0"), F.lit(" "))


def strip_tags(c: Column) -> Column:
    """Text of a piece of HTML: tags become blanks, entities characters, and white space single blanks."""
    text = F.regexp_replace(c, r"(?is)<(script|style)[^>]*>.*?</\1>", " ")
    text = unescape_html(F.regexp_replace(text, r"(?s)<[^>]+>", " "))
    return strip(F.regexp_replace(F.translate(text, " ", " "), r"(?U)\s+", " "))
