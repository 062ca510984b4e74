"""Exact removal of repeated byte strings with a sparse, bucketed enhanced suffix array.

Every ``length``-byte window has one anchor: its ``GRAM``-byte substring with the least hash, the leftmost on a tie. Equal
windows have equal anchors at equal offsets, wherever they stand, so the suffixes that begin at anchors, bucketed by
their first GRAM bytes, hold every repeat of ``length`` bytes or more within one bucket. A first scan counts the anchors'
hashes; those seen once can't repeat. A second one sends the others' contexts, the bytes of all windows that have this anchor,
to their bucket. Equal contexts need no tree: one whose 128-bit hash its task has sent before from an earlier place is reported
as removed at once, so that copies and common passages are collapsed before the shuffle, and a bucket holds equal ones once.
The contexts of very frequent anchors are split by ranges of offsets, so that a bucket stays small whatever surrounds them.

In a bucket the suffixes of the different contexts are sorted and their common prefixes scanned with a stack, which gives the tree of common-prefix
intervals. The members of an interval are then split by left-extension diversity: as far as their left contexts agree they
are one maximal repeat group with all its occurrences; where they differ, the group ends and its parts go on. Of each group
the earliest occurrence stays, and the windows of all others are removed.

Order: an occurrence is earlier if its document id is smaller, or at a smaller start in the same id; a null id comes last. Defined
results: a null text is empty; texts under ``length`` bytes lose nothing; rows with one id and equal texts get equal
results, and none removes the other; an empty table gives no rows; columns other than id and text are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import binary_parts, bitmap_bits, blocks, bounded, collect_bitmap, materialize, mix64, table

LENGTH, GRAM = 100, 32
#: Bytes of a text handled at once; a longer text is read in pieces that overlap by a window.
PIECE = 1 << 17
#: Contexts that a task remembers for collapsing repeats before the shuffle.
REMEMBERED = 150_000
#: Rows of contexts that a task holds before it sends them.
ROWS = 10_000
#: Offsets of the anchor that share a context where the anchor is very frequent, and what that means: this many occurrences,
#: or a share of all so large that no more than 2**15 anchors can have it, which bounds what is broadcast.
SEGMENT, HOT, HOT_SHARE = 8, 1000, 1 << 15
_LAST = (1 << 63) - 1
_POSITION = np.uint64(0xFFFFFFFF)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Of the texts data[offsets[k]:offsets[k + 1]]: per run of windows with one anchor, the text's number, the anchor's
    hash and place, and the first and last window start (places in ``data``)."""
    none = (np.zeros(0, np.int64), np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3)))
    if len(data) < length:
        return none
    hashes = data.astype(np.uint64) + np.uint64(1)
    for k in (1, 2, 4, 8, 16):
        hashes = hashes[:-k] * np.uint64(pow(0x100000001B3, k, 1 << 64)) + hashes[k:]
    hashes = mix64(hashes)
    keys = hashes & ~_POSITION | np.arange(len(hashes), dtype=np.uint64)
    span, least = length - GRAM + 1, keys
    k = 1
    while 2 * k <= span:
        least = np.minimum(least[:-k], least[k:])
        k *= 2
    if span > k:
        least = np.minimum(least[: len(least) - (span - k)], least[span - k :])
    valid = np.zeros(len(least), bool)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= length:
            valid[a : b - length + 1] = True
    starts = np.flatnonzero(valid)
    if not len(starts):
        return none
    places = (least[starts] & _POSITION).astype(np.int64)
    new = np.concatenate([[True], (places[1:] != places[:-1]) | (starts[1:] != starts[:-1] + 1)])
    heads = np.flatnonzero(new)
    first, last, places = starts[heads], starts[np.append(heads[1:], len(starts)) - 1], places[heads]
    return np.searchsorted(offsets, first, side="right") - 1, hashes[places], places, first, last


def _pieces(column: pa.Array, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, bytes before in that row, data, offsets) of blocks of rows, or of parts of one long row."""
    data, offsets = binary_parts(column)
    for a, b in blocks(offsets, PIECE):
        low, high = int(offsets[a]), int(offsets[b])
        if b == a + 1 and high - low > 2 * PIECE:
            for at in range(low, high - length + 1, PIECE):
                part = data[at : min(at + PIECE + length - 1, high)]
                yield a, at - low, part, np.array([0, len(part)])
        else:
            yield a, 0, data[low:high], offsets[a : b + 1] - low


def _count_anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [anchors(data, offsets, length)[1] for _, _, data, offsets in _pieces(batch.column(0), length)]
            values, counts = np.unique(np.concatenate(found or [np.zeros(0, np.uint64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts, pa.int64())], ["anchor", "n"])

    return run


CONTEXT = "route long, id long, text_key long, start long, end long, left int, context binary"
_CONTEXT = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
_NAMES = [f.split()[0] for f in CONTEXT.split(", ")]


def text_key(raw: bytes) -> int:
    return _signed(xxhash.xxh3_64_intdigest(raw))


def segments(length: int) -> list[tuple[int, int]]:
    """Ranges of offsets of the anchor in a window, for splitting what a very frequent anchor has around it."""
    return [(low, min(low + SEGMENT, length - GRAM + 1) - 1) for low in range(0, length - GRAM + 1, SEGMENT)]


def _send_contexts(shared, length: int):
    """Contexts of repeated anchors; where the same one was sent from an earlier place, only its extent, to be removed.

    Around a very frequent anchor, each range of offsets has a context of its own, of only the bytes of its windows. It goes
    to the bucket of the bytes that all its windows have in common, so that neither a bucket nor a context grows with what
    else surrounds the anchor; equal windows still meet, for they agree in those bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, bits, hot = shared.value
        bitmap, parts = np.frombuffer(bitmap, np.uint8), segments(length)
        sent: dict[bytes, tuple[int, int, int]] = {}
        rows: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows))
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _CONTEXT)], _NAMES)

        def put(route: int, here: tuple[int, int, int], left: int, context: bytes) -> None:
            mark = xxhash.xxh3_128_digest(context, left)
            there = sent.get(mark)
            if there == here:
                return
            if there is not None and there[:2] < here[:2]:
                route = _signed((here[0] * 0x9E3779B97F4A7C15 + here[1]) & 0xFFFFFFFFFFFFFFFF)
                rows.append((route, here[0], here[2], here[1], here[1] + len(context), None, None))
                return
            if len(sent) >= REMEMBERED:
                sent.clear()
            sent[mark] = here
            rows.append((route, here[0], here[2], here[1], here[1] + len(context), left, context))

        for batch in batches:
            ids = [_LAST if x is None else x for x in batch.column(0).to_pylist()]
            texts = batch.column(1).cast(pa.large_binary())
            keys: dict[int, int] = {}
            for row, before, data, offsets in _pieces(texts, length):
                numbers, hashes, places, first, last = anchors(data, offsets, length)
                at = (hashes & np.uint64(bits - 1)).astype(np.int64)
                use = np.flatnonzero(bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1)
                raw = data.tobytes()
                for k, h, place, a, b in zip(*(x[use].tolist() for x in (numbers, hashes.view(np.int64), places, first, last))):
                    base = before - int(offsets[k])
                    if row + k not in keys:
                        keys[row + k] = text_key(texts[row + k].as_py() or b"")
                    if h not in hot:
                        put(h, (ids[row + k], a + base, keys[row + k]), place - a, raw[a : b + length])
                    else:
                        for low, high in parts:
                            start, end = max(a, place - high), min(b, place - low)  # first and last window of the range
                            if start <= end:
                                common = xxhash.xxh3_64_intdigest(raw[place - low : place - high + length], low)
                                put(_signed(common), (ids[row + k], start + base, keys[row + k]), place - start, raw[start : end + length])
                    if len(rows) >= ROWS:
                        yield flush()
        if rows:
            yield flush()

    return run


def common_prefix(a: bytes, b: bytes) -> int:
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low < high - 1:
        middle = (low + high) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle
    return low


def interval_tree(suffixes: list[bytes]) -> Iterator[tuple[int, int, list[int]]]:
    """Common-prefix intervals of the sorted suffixes: depth, the parent's depth, and all members (numbers of suffixes)."""
    order = sorted(range(len(suffixes)), key=suffixes.__getitem__)
    stack = [(0, 0)]  # depth, first member
    for k in range(1, len(order) + 1):
        depth = common_prefix(suffixes[order[k - 1]], suffixes[order[k]]) if k < len(order) else -1
        first = k - 1
        while stack and depth < stack[-1][0]:
            deep, first = stack.pop()
            above = max(depth, stack[-1][0] if stack else 0)
            if deep:
                yield deep, above, order[first:k]
        if not stack or depth > stack[-1][0]:
            stack.append((depth, first))


def repeat_groups(contexts: list[tuple[bytes, int]], length: int = LENGTH) -> Iterator[tuple[int, int, list[int]]]:
    """Maximal repeats among contexts (bytes, anchor's place): least and greatest offset of the anchor in the repeated windows,
    and all members. Within an interval of right extensions, groups split where left extensions differ."""
    rights = [c[at:] for c, at in contexts]
    lefts = [c[:at][::-1] for c, at in contexts]
    for depth, above, members in interval_tree(rights):
        low, high = max(0, length - depth), length - 1 - above
        stack = [(low, [m for m in members if len(lefts[m]) >= low])]
        if low:
            parts = defaultdict(list)
            for m in stack.pop()[1]:
                parts[lefts[m][:low]].append(m)
            stack = [(low, part) for part in parts.values()]
        while stack:
            at, group = stack.pop()
            if len(group) < 2:
                continue
            agree = common_prefix(min(lefts[m] for m in group), max(lefts[m] for m in group))
            yield at, min(agree, high), group
            if agree < high:
                parts = defaultdict(list)
                for m in group:
                    if len(lefts[m]) > agree:
                        parts[lefts[m][agree]].append(m)
                stack += [(agree + 1, part) for part in parts.values()]


def _hold(held: dict[tuple, tuple], row: tuple) -> tuple | None:
    """Of rows (id, key, start, end, left, context) with one context, the earliest is held; gives the one that is removed."""
    kept = held.setdefault((row[5], row[4]), row)
    if kept is row or (kept[0], kept[1], kept[2]) == (row[0], row[1], row[2]):
        return None
    if (kept[0], kept[2]) == (row[0], row[2]):  # rows of one id with different texts: neither is earlier
        held.setdefault((row[5], row[4], row[1]), row)
        return None
    if (kept[0], kept[2]) < (row[0], row[2]):
        return row
    held[row[5], row[4]] = row
    return kept


def _bucket(held: dict[tuple, tuple], length: int) -> Iterator[tuple[int, int, int, int]]:
    """Removed spans (id, text key, start, end) among one bucket's different contexts."""
    kept = list(held.values())
    if len(kept) < 2:
        return
    marked: dict[int, int] = defaultdict(int)  # a bit for each offset of the anchor in a removed window
    for low, high, group in repeat_groups([(r[5], r[4]) for r in kept], length):
        place = lambda m: (kept[m][0], kept[m][2] + kept[m][4])
        earliest = min(map(place, group))
        for m in group:
            if place(m) != earliest:
                marked[m] |= (1 << high + 1) - (1 << low)
    for m, bits in marked.items():
        ident, key, start, _, left, _ = kept[m]
        while bits:
            low = (bits & -bits).bit_length() - 1
            run = bits >> low
            size = (~run & (run + 1)).bit_length() - 1
            yield ident, key, start + left - (low + size - 1), start + left - low + length
            bits &= ~((1 << low + size) - 1)


def _buckets(length: int):
    """Rows come sorted by bucket; only one bucket's distinct contexts are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, out = None, {}, []
        for batch in batches:
            for route, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[5] is None:
                    out.append(tuple(row[:4]))
                    continue
                if route != now:
                    out += _bucket(held, length)
                    now, held = route, {}
                if (removed := _hold(held, tuple(row))) is not None:
                    out.append(removed[:4])
            if len(out) > 50_000:
                yield _spans(out)
                out = []
        out += _bucket(held, length)
        if out:
            yield _spans(out)

    return run


def _spans(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["id", "text_key", "start", "end"])


def repeated_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """Per document with any: id, text_key, spans of removed bytes (they may touch and overlap). Ids are integers; null becomes the largest."""
    if length < GRAM:
        raise ValueError(f"length must be {GRAM} or more")
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter(F.octet_length("text") >= length)
    counts = rows.select("text").mapInArrow(bounded(_count_anchors(length), 0), "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    often = materialize(counts.filter("n > 1"), "repeated_anchors")
    known, total = often.agg(F.count("n"), F.coalesce(F.sum("n"), F.lit(0))).first()
    bits = bitmap_bits(known, most=1 << 27)
    bitmap = collect_bitmap(often.select(F.col("anchor").bitwiseAND(F.lit(bits - 1)).alias("place")), bits)
    hot = often.filter(F.col("n") > max(HOT, total // HOT_SHARE)).select("anchor").toArrow()["anchor"].to_pylist()
    shared = spark.sparkContext.broadcast((bitmap, bits, frozenset(hot)))
    contexts = rows.mapInArrow(bounded(_send_contexts(shared, length), 1), CONTEXT)
    contexts = contexts.repartition("route").sortWithinPartitions("route")
    spans = contexts.mapInArrow(_buckets(length), "id long, text_key long, start long, end long").distinct()
    return spans.groupBy("id", "text_key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))


def cut(raw: bytes, spans: list[dict]) -> tuple[bytes, int, int]:
    """What the spans leave, the number of bytes removed and of maximal removed runs. Spans are sorted by start."""
    kept, at, runs, end = [], 0, 0, -1
    for span in spans:
        if span["start"] > end:
            runs += 1
            kept.append(raw[at : span["start"]])
        end = max(end, span["end"])
        at = end
    kept.append(raw[at:])
    out = b"".join(kept)
    return out, len(raw) - len(out), runs


def _order(batch: pa.RecordBatch) -> list[int]:
    return [_LAST if x is None else x for x in batch.column(1).to_pylist()]


def _marked(shared):
    """The rows whose id is marked in the bitmap, with the text's key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, bits = shared.value
        for batch in batches:
            use = [k for k, x in enumerate(_order(batch)) if bitmap[(x & bits - 1) >> 3] >> (x & 7) & 1]
            part = batch.take(pa.array(use, pa.int64()))
            keys = [text_key(x or b"") for x in part.column(2).cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(keys, pa.int64())], [*part.schema.names, "text_key"])

    return run


def _unmarked(shared):
    """The finished rows of all others: they lose nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, bits = shared.value
        for batch in batches:
            use = [k for k, x in enumerate(_order(batch)) if not bitmap[(x & bits - 1) >> 3] >> (x & 7) & 1]
            part = batch.take(pa.array(use, pa.int64())).drop_columns(["order"])
            yield from _cutter(iter([part]))

    return run


def _cutter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, spans) to (id, kept bytes, counts); the digest is of the remaining bytes, which need not be UTF-8."""
    for batch in batches:
        names = batch.schema.names
        raws = [x or b"" for x in batch.column(names.index("text")).cast(pa.large_binary()).to_pylist()]
        spans = batch.column(names.index("spans")).to_pylist() if "spans" in names else [None] * len(raws)
        made = [cut(raw, s) if s else (raw, 0, 0) for raw, s in zip(raws, spans)]
        columns = [[len(r) for r in raws], [m[1] for m in made], [m[2] for m in made]]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, pa.int64()) for c in columns), pa.array([m[0] for m in made], pa.binary())],
            ["id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """Per document: id, n_bytes, n_removed, n_spans, kept (the remaining bytes).

    Only the texts of documents that lose something are shuffled, to meet their spans; a bitmap of their ids, of bounded size,
    tells the others, which are finished in place."""
    spark = docs.sparkSession
    spans = materialize(repeated_spans(docs, id_col=id_col, text_col=text_col, length=length), "repeats")
    bits = bitmap_bits(spans.count(), most=1 << 27)
    shared = spark.sparkContext.broadcast((collect_bitmap(spans.select(F.col("id").bitwiseAND(F.lit(bits - 1)).alias("place")), bits), bits))
    rows = docs.select(F.col(id_col).alias("id"), F.col(id_col).cast("long").alias("order"), F.col(text_col).alias("text"))
    schema = T.StructType([*rows.schema.fields, T.StructField("text_key", T.LongType())])
    out = T.StructType([rows.schema["id"], *T.DataType.fromDDL("n_bytes long, n_removed long, n_spans long, kept binary").fields])
    clean = rows.mapInArrow(bounded(_unmarked(shared), 2), out)
    hit = rows.mapInArrow(bounded(_marked(shared), 2), schema).withColumn("order", F.coalesce("order", F.lit(_LAST)))
    hit = hit.join(spans.withColumnRenamed("id", "order"), ["order", "text_key"], "left").select("id", "text", "spans")
    return clean.unionByName(hit.mapInArrow(bounded(_cutter, 1), out)).withColumnRenamed("id", id_col)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What repeats of 100 bytes leave of every document."""
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
