"""Benchmark decontamination with one Aho-Corasick automaton over the normalised test items.

Text is lower-cased (A-Z) and cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. Each run of
``window`` item words (a shorter item as a whole) is a pattern, delimited by blanks; the automaton over
all patterns reads each document once, and its matches are mapped back to word numbers and to code point
offsets of the original text. Nothing is shuffled: the scan is a map over the documents.

Defined results: a null or empty text has no words and no hits; an item with a null id or without words
is no item; repeated documents and repeated items each count by their own row and id; an empty benchmark
hits nothing. The columns of the documents other than id and text are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded, carried, materialize, restored, table

#: Letters A-Z become small; bytes that belong to no word become blanks; UTF-8 above ASCII stays.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Most bytes of item text that one automaton is built from (its nodes take some 30 times as much); items
#: beyond that go into further automata, each read over all documents in a pass of its own.
AUTOMATON_BYTES = 4 << 20
STATE = "struct<n_words:long,spans:array<struct<start:long,end:long,first_word:long,end_word:long>>,items:array<string>>"
_ARROW = pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "end", "first_word", "end_word")]))
_built: dict[str, object] = {}


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(FOLD).split()


def windows_of(text: str | None, window: int) -> set[str]:
    """The patterns of one item: blank-delimited word windows, as one character per UTF-8 byte."""
    words = words_of((text or "").encode())
    runs = (words[i : i + window] for i in range(max(1, len(words) - window + 1)))
    return {f" {b' '.join(run).decode('latin-1')} " for run in runs if run}


def build(items: list[tuple[str, str | None]], window: int):
    """The automaton over all windows; a match gives the window's word count and its items."""
    owners: dict[str, set[str]] = defaultdict(set)
    for item_id, text in items:
        for pattern in windows_of(text, window):
            owners[pattern].add(item_id)
    automaton = ahocorasick.Automaton()
    for pattern, ids in owners.items():
        automaton.add_word(pattern, (pattern.count(" ") - 1, tuple(ids)))
    if owners:
        automaton.make_automaton()
    return automaton if owners else None


def scan(automaton, words: list[bytes]) -> tuple[list[list[int]], set[str]]:
    """Merged [first word, end word) runs that windows cover, and the items they belong to."""
    runs: list[list[int]] = []
    items: set[str] = set()
    if automaton is None or not words:
        return runs, items
    text = f" {b' '.join(words).decode('latin-1')} "
    seen = at = 0
    for end, (n, ids) in automaton.iter(text):
        seen += text.count(" ", at, end)
        at = end
        items.update(ids)
        if runs and seen - n <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], seen)
            runs[-1][0] = min(runs[-1][0], seen - n)
            while len(runs) > 1 and runs[-1][0] <= runs[-2][1]:
                last = runs.pop()
                runs[-1] = [min(runs[-1][0], last[0]), max(runs[-1][1], last[1])]
        else:
            runs.append([seen - n, seen])
    return runs, items


def _merged(runs: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for first, end in sorted(runs):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([first, end])
    return out


def _scanner(shared, window: int, keep_text: bool):
    """Reads ``text``, takes and gives ``state``; all other columns pass."""
    key = uuid.uuid4().hex  # a worker builds the automaton once and keeps it for its later tasks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _built:
            _built.clear()
            _built[key] = build(shared.value, window)
        automaton = _built[key]
        for batch in batches:
            names = batch.schema.names
            before = batch.column(names.index("state")).to_pylist() if "state" in names else None
            counts, spans, items = [], [], []
            for k, text in enumerate(batch.column(names.index("text")).cast(pa.large_binary()).to_pylist()):
                words = words_of(text)
                runs, found = scan(automaton, words)
                if before and before[k]["items"]:
                    runs = _merged(runs + [[s["first_word"], s["end_word"]] for s in before[k]["spans"]])
                    found |= set(before[k]["items"])
                at = [m.span() for m in WORD.finditer(text.decode())] if runs else []
                counts.append(len(words))
                spans.append([{"start": at[a][0], "end": at[b - 1][1], "first_word": a, "end_word": b} for a, b in runs])
                items.append(sorted(found))
            kept = [k for k, name in enumerate(names) if name != "state" and (keep_text or name != "text")]
            state = [pa.array(counts, pa.int64()), pa.array(spans, _ARROW), pa.array(items, pa.list_(pa.string()))]
            state = pa.StructArray.from_arrays(state, ["n_words", "spans", "items"])
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), state], [*(names[k] for k in kept), "state"])

    return run


def _scanned(docs: DataFrame, columns: list, items: DataFrame, keep_text: bool, window: int, automaton_bytes: int) -> DataFrame:
    """``columns`` of the documents (one named text) with ``state``: n_words, spans, items."""
    spark = docs.sparkSession
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, -(-total // automaton_bytes))
    rows = docs.select(*columns)
    for k in range(passes):
        part = items if passes == 1 else items.filter(F.pmod(F.xxhash64("text"), F.lit(passes)) == k)
        shared = spark.sparkContext.broadcast([tuple(r) for r in part.collect()])
        keep = keep_text or k < passes - 1
        fields = [f for f in rows.schema.fields if f.name != "state" and (keep or f.name != "text")]
        schema = T.StructType(fields).add("state", T.DataType.fromDDL(STATE))
        rows = rows.mapInArrow(bounded(_scanner(shared, window, keep), rows.columns.index("text")), schema)
        if k < passes - 1:
            rows = materialize(rows, f"decontaminate_{k}")
    return rows


def _items(benchmark: DataFrame, item_col: str, text_cols: tuple[str, ...]) -> DataFrame:
    texts = F.explode(F.array(*[F.col(c) for c in text_cols]))
    return benchmark.filter(F.col(item_col).isNotNull()).select(F.col(item_col).cast("string").alias("id"), texts.alias("text"))


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_cols: tuple[str, ...] = ("text",), window: int = 10, automaton_bytes: int = AUTOMATON_BYTES,
) -> DataFrame:
    """Per document: id, n_words, spans (merged hit runs: code points and words) and items (sorted ids).

    The items are a stated query set. Their size is measured first: up to ``automaton_bytes`` they are
    broadcast as one automaton; more are cut into several, and each pass carries its findings on.
    """
    columns = [F.col(id_col).alias("id"), F.col(text_col).alias("text")]
    rows = _scanned(docs, columns, _items(benchmark, item_col, item_text_cols), False, window, automaton_bytes)
    return rows.select(F.col("id").alias(id_col), "state.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
                      item_text_cols: tuple[str, ...] = ("text",), window: int = 10,
                      automaton_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """The documents without any hit, all columns as they were (whatever their names); map-only."""
    columns = [F.col("doc"), F.col("text")]
    rows = _scanned(carried(docs, text_col), columns, _items(benchmark, item_col, item_text_cols), True, window, automaton_bytes)
    return restored(rows.filter(F.size("state.items") == 0), docs.columns, text_col)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contamination of every document by any benchmark item, as counts and digests."""
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end_word"] - s["first_word"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )
