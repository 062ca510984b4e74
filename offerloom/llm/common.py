"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.scratch import materialize, shared_dir  # noqa: F401

#: Bytes of text handled at once by the vectorised kernels: their temporaries are a few dozen times this.
BLOCK_BYTES = 1 << 20


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True for the fold that no model may learn from: crc32 of the id as text leaves 0 modulo 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def binary_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column (null: empty) and the int64 offsets of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary()
    column = column.cast(kind) if column.type != kind else column
    if column.null_count:
        column = column.fill_null(b"")
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data or b"", np.uint8), offsets


def blocks(offsets: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each; a longer row stands alone."""
    at, rows = 0, len(offsets) - 1
    while at < rows:
        end = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
        end = min(max(end, at + 1), rows)
        yield at, end
        at = end


def release() -> None:
    """Give memory that a kernel no longer uses back to the system: workers live on between stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def bounded(kernel: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], column: int, most: int = 4 * BLOCK_BYTES):
    """The kernel, fed with slices that hold at most ``most`` bytes of a text column (a longer row stands alone), whatever
    the size of the batches; so what it makes of a slice is bounded as well. It must treat rows alike in any batch."""

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in blocks(binary_parts(batch.column(column))[1], most):
                yield batch.slice(a, b - a)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from kernel(slices(batches))
        finally:
            release()

    return run


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64 (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def carried(docs: DataFrame, text_col: str) -> DataFrame:
    """``text`` beside all other columns in one struct, so that their names can't clash with an operator's."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    return docs.select(F.struct(*rest or [F.lit(0).alias("none")]).alias("doc"), F.col(f"`{text_col}`").alias("text"))


def restored(rows: DataFrame, columns: list[str], text_col: str) -> DataFrame:
    """The columns that ``carried`` packed, in their old order."""
    return rows.select(*[F.col("text").alias(c) if c == text_col else F.col(f"doc.`{c}`").alias(c) for c in columns])


_CHUNK = 18


def _bitmap_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    chunks: dict[int, np.ndarray] = {}
    for batch in batches:
        places = batch.column(0).to_numpy(zero_copy_only=False)
        for chunk in np.unique(places >> _CHUNK).tolist():
            flags = chunks.setdefault(chunk, np.zeros(1 << _CHUNK, bool))
            flags[places[places >> _CHUNK == chunk] & ((1 << _CHUNK) - 1)] = True
    packed = [np.packbits(flags, bitorder="little").tobytes() for flags in chunks.values()]
    yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int64()), pa.array(packed, pa.binary())], ["chunk", "bits"])


def collect_bitmap(places: DataFrame, bits: int) -> bytes:
    """A bitmap of ``bits`` bits with those of the column ``place`` set. It is put together in chunks by the executors; its size is
    the bound of what comes to the driver, however many rows there are."""
    rows = places.select("place").repartition(F.expr(f"shiftright(place, {_CHUNK})"))
    found = rows.mapInArrow(_bitmap_chunks, "chunk long, bits binary").toArrow()
    bitmap = bytearray(max(bits >> 3, 1))
    for chunk, part in zip(found["chunk"].to_pylist(), found["bits"].to_pylist()):
        at = chunk << (_CHUNK - 3)
        bitmap[at : at + len(part)] = part
    return bytes(bitmap[: bits >> 3])


def bitmap_bits(count: int, least: int = 1 << 16, most: int = 1 << 26) -> int:
    """A power of two with 64 bits or more for each of ``count`` entries, within the limits (the largest is 8 MB)."""
    return min(max(1 << (64 * count).bit_length(), least), most)


def bitmap_filter(shared, column: str, wanted: bool):
    """For mapInArrow: the rows whose integer ``column`` is marked in a broadcast (bitmap, bits), or those it is not; null is not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, bits = shared.value
        for batch in batches:
            values = batch.column(batch.schema.get_field_index(column)).to_pylist()
            hit = (x is not None and bool(bitmap[(x & bits - 1) >> 3] >> (x & 7) & 1) for x in values)
            use = [k for k, found in enumerate(hit) if found == wanted]
            yield batch if len(use) == len(values) else batch.take(pa.array(use, pa.int64()))

    return run
