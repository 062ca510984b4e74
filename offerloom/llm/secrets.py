"""Secret scanning: three fixed patterns, and a guess-cost model for values in a credential context.

A value that follows a credential word is cut by dynamic programming into dictionary words, dates,
repeats, keyboard walks and brute-force characters so that the product of the guesses is least; values
that would take at least ``10 ** least_cost`` guesses are reported as kind ``guess``. Each text is one map
step: cheap byte searches decide whether a pattern can occur at all before a regular expression runs.

Defined results: a null or empty text has no spans; every row is scanned by itself, so repeated rows get
equal results; offsets are code points, ends exclusive; columns other than id and text are ignored. A value that
one fixed-pattern span holds whole isn't reported again; one that reaches beyond it is, and redaction takes the union.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded, carried, restored, table

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
#: A bare word ends here: no letter follows, or the capital of a next word (passValue).
_END = r"(?:(?![a-z])|(?-i:(?<=[a-z])(?=[A-Z])))"
#: Names of credentials, wider than the assign pattern's: one of the words, with letters, digits, _ and - around it. Left out are
#: ordinary words that only begin or end alike: passage, author, compass, secretary, tokenizer.
#: Each name is looked at once, so a long run of letters costs no more.
CONTEXT = re.compile(
    rf"""(?ai)(?<![\w-])(?=[\w-]*?(?:pass(?:word|wd|phrase|code|key)|(?<!com)pass{_END}|pwd|secret(?!(?-i:ar|AR))|token(?!(?-i:i[sz]|I[SZ]))"""
    rf"""|api[_-]?key|(?:secret|access|private|client)[_-]?key|credential|authkey|auth{_END}|bearer))[\w-]++"""
    r"""["']?\x20{0,8}([:=]|\bis\b)\x20{0,8}["']?([^\s"'<>,;]{6,})"""
)
_ASSIGN_HINTS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_CONTEXT_HINTS = (b"pass", b"pwd", b"secret", b"token", b"key", b"credential", b"auth", b"bearer")
_HEX_MAP = bytes(120 if chr(b) in "0123456789abcdef" else 32 for b in range(256))
_HEX_RUN = b"x" * 32

#: Frequent password words, most frequent first; the rank is the number of guesses.
COMMON_WORDS = (
    "password pass admin root login user guest test secret welcome master dragon monkey shadow sunshine "
    "princess football baseball iloveyou superman batman trustno letmein changeme default access hello "
    "freedom whatever qazwsx michael jordan hunter ranger buster soccer hockey george andrew charlie "
    "thomas robert daniel jennifer joshua summer winter spring autumn love baby angel flower purple orange "
    "silver golden computer internet server database system token key example sample demo temp public"
).split()
RANK = {word: rank for rank, word in enumerate(COMMON_WORDS, 1)}
_LONGEST = max(map(len, COMMON_WORDS))
#: The rows of a keyboard.
KEYBOARD_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
_NEXT = {(a, b) for row in KEYBOARD_ROWS for a, b in zip(row, row[1:])}
_NEXT |= {(b, a) for a, b in _NEXT}
DATE = re.compile(r"(?:19|20)\d\d[-/.]?[01]\d[-/.]?[0-3]\d|[0-3]\d[-/.]?[01]\d[-/.]?(?:19|20)\d\d|(?:19|20)\d\d")
_LEET = str.maketrans("@4310$57!", "aaeiosst" + "i")


def _brute(char: str) -> float:
    """log10 of the guesses for one character on its own."""
    return math.log10(10 if char.isdigit() else 26 if char.isalpha() else 33)


def guess_cost(value: str) -> tuple[float, list[tuple[str, int, int]]]:
    """log10 of the guesses of the cheapest segmentation, and its segments (kind, start, end)."""
    n, low = len(value), value.lower()
    plain = low.translate(_LEET)
    ends: list[list[tuple[float, str, int]]] = [[] for _ in range(n + 1)]
    for at in range(n):
        for size in range(3, min(_LONGEST, n - at) + 1):
            if rank := RANK.get(plain[at : at + size]):
                odd = (low[at : at + size] != value[at : at + size]) + (low[at : at + size] != plain[at : at + size])
                ends[at + size].append((math.log10(rank + 1) + 0.3 * odd, "word", at))
    for at in range(n):
        if m := DATE.match(value, at):
            ends[m.end()].append((math.log10(200 * (366 if m.end() - at > 4 else 1)), "date", at))
    at = 0
    while at < n:  # maximal runs of one character, and of neighbouring keys
        end = at + 1
        while end < n and value[end] == value[at]:
            end += 1
        if end - at >= 3:
            ends[end].append((_brute(value[at]) + math.log10(end - at), "repeat", at))
        at = end
    at = 0
    while at < n:
        end = at + 1
        while end < n and (low[end - 1], low[end]) in _NEXT:
            end += 1
        if end - at >= 3:
            ends[end].append((math.log10(47 * 2 * (end - at)), "walk", at))
        at = end if end > at + 1 else at + 1
    best: list[tuple[float, str, int]] = [(0.0, "", 0)]
    for end in range(1, n + 1):
        choices = [(best[end - 1][0] + _brute(value[end - 1]), "brute", end - 1)]
        choices += [(best[start][0] + cost, kind, start) for cost, kind, start in ends[end]]
        best.append(min(choices))
    parts, end = [], n
    while end:
        _, kind, start = best[end]
        if kind == "brute" and parts and parts[-1][0] == "brute" and parts[-1][1] == end:
            parts[-1] = ("brute", start, parts[-1][2])
        else:
            parts.append((kind, start, end))
        end = start
    return best[n][0], parts[::-1]


def find_spans(raw: bytes | None, least_cost: float) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all findings, sorted."""
    if not raw:
        return []
    low, text, spans = raw.lower(), None, []
    context = any(hint in low for hint in _CONTEXT_HINTS)
    if context:
        text = raw.decode()
        if any(hint in low for hint in _ASSIGN_HINTS):
            spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if b"AKIA" in raw:
        text = text or raw.decode()
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    if _HEX_RUN in raw.translate(_HEX_MAP):
        text = text or raw.decode()
        spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if context:
        known = sorted((start, end) for start, _, end in spans)
        reach = list(accumulate((end for _, end in known), max))  # the furthest end of the spans so far
        for m in CONTEXT.finditer(text):
            start, end = m.span(2)
            value = m[2]
            # after "is" comes prose as well: there, only letters and digits together make a credential
            likely = m[1] in ":=" or any(c.isdigit() for c in value) and any(c.isalpha() for c in value)
            before = bisect_right(known, (start, len(text)))
            if likely and not (before and reach[before - 1] >= end) and guess_cost(value)[0] >= least_cost:
                spans.append((start, 3, end))
    return sorted(spans)


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
SPANS = "array<struct<kind:string,start:long,end:long>>"


def _scanner(least_cost: float, redact: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            raws = batch.column(at).cast(pa.large_binary()).to_pylist()
            found = [find_spans(raw, least_cost) for raw in raws]
            if redact is None:
                spans = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans] for spans in found]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _SPANS)], ["id", "spans"])
            elif not any(found):
                yield batch
            else:
                texts = [
                    None if raw is None else _cut(raw.decode(), spans, redact) if spans else raw.decode()
                    for raw, spans in zip(raws, found)
                ]
                columns = [*batch.columns]
                columns[at] = pa.array(texts, batch.schema.field(at).type)
                yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return run


def _cut(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def find_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_cost: float = 10.0) -> DataFrame:
    """Per document: id and spans, an array of (kind, start, end)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["id"], T.StructField("spans", T.DataType.fromDDL(SPANS))])
    return rows.mapInArrow(bounded(_scanner(least_cost, None), 1), schema).withColumnRenamed("id", id_col)


def redact_secrets(docs: DataFrame, *, text_col: str = "text", least_cost: float = 10.0, mark: str = "[secret]") -> DataFrame:
    """All documents, each finding in their text replaced by ``mark``; other columns pass unchanged."""
    rows = carried(docs, text_col)
    return restored(rows.mapInArrow(bounded(_scanner(least_cost, mark), 1), rows.schema), docs.columns, text_col)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and the digest of the fixed patterns' spans, and all spans."""
    found = find_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != "guess")
    digest = F.sha2(joined(base).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), digest, joined(F.col("spans")).alias("spans"))
