"""Variable-capacity best-fit packing of documents into training sequences of several permitted lengths.

Documents become pieces of at most the largest capacity, measured in byte-level tokens (UTF-8 bytes of the
text, and one end mark). Pieces are dealt evenly into packing groups of a bounded number of rows; within a
group they are placed, longest first, into the open sequence with the least room that still holds them.
Where none does, the capacity with the least cost per token it can still be filled with is opened. Plans that
open one capacity only compete with that one, and the cheapest plan counts after every sequence has been
cut down to the least permitted capacity that holds its contents.

Defined results: a null or empty text is a piece of one token (the end mark); a null id is kept and comes last among equals; repeated rows are packed each
by itself; an empty table gives no rows; columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import table

CAPACITIES = (2048, 4096, 8192, 16384)
#: Pieces that one task packs, about.
GROUP_ROWS = 50_000


def sequence_cost(capacity: int) -> float:
    """A fixed part for each sequence, one for each token, and attention's square."""
    return 64 + capacity + capacity * capacity / 65536


def _plan(lengths: list[int], rest: list[int], capacities: Sequence[int], cost: Callable, only: int | None):
    """Bin and offset of each piece, in the given order, and the contents of each bin."""
    by_room: list[list[int]] = [[] for _ in range(capacities[-1] + 1)]
    rooms = 0  # bit r: some open bin has room r
    room: list[int] = []
    used: list[int] = []
    bins, offsets = [], []
    for k, size in enumerate(lengths):
        fitting = rooms >> size
        if fitting:
            r = size + (fitting & -fitting).bit_length() - 1
            b = by_room[r].pop()
            if not by_room[r]:
                rooms ^= 1 << r
        else:
            able = [c for c in capacities if c >= size]
            if only is None:
                capacity = min(able, key=lambda c: (cost(c) / min(c, size + rest[k]), c))
            else:
                capacity = next((c for c in able if c >= only), able[0])
            b, r = len(room), capacity
            room.append(capacity)
            used.append(0)
        bins.append(b)
        offsets.append(used[b])
        used[b] += size
        left = r - size
        if not by_room[left]:
            rooms |= 1 << left
        by_room[left].append(b)
    return bins, offsets, used


def pack_group(lengths: np.ndarray, capacities: Sequence[int], cost: Callable = sequence_cost):
    """For lengths in descending order: bin, offset and final capacity of each piece."""
    sizes = np.asarray(sorted(capacities))
    values = [int(x) for x in lengths]
    rest = (np.sum(lengths) - np.cumsum(lengths)).tolist()
    best = None
    for only in (None, *map(int, sizes)):
        bins, offsets, used = _plan(values, rest, sizes.tolist(), cost, only)
        final = sizes[np.searchsorted(sizes, used)]
        total = float(sum(map(cost, final.tolist())))
        if best is None or total < best[0]:
            best = total, bins, offsets, final
    _, bins, offsets, final = best
    bins = np.asarray(bins, np.int64)
    return bins, np.asarray(offsets, np.int64), final[bins].astype(np.int64)


def pack_sequences(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: str | None = None,
    capacities: Sequence[int] = CAPACITIES, group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Per piece: id, piece, start and length in tokens of the document, sequence, capacity, offset.

    ``length`` names a column of token counts to use instead of bytes plus end mark.
    """
    most = int(max(capacities))
    tokens = F.col(length) if length else F.octet_length(F.coalesce(F.col(text_col), F.lit(""))) + 1
    rows = docs.select(F.col(id_col).alias("id"), F.greatest(F.coalesce(tokens.cast("long"), F.lit(1)), F.lit(1)).alias("tokens"))
    pieces = rows.select("id", "tokens", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("tokens") - 1) / most))).alias("piece"))
    start = F.col("piece") * most
    pieces = pieces.select("id", "piece", start.alias("start"), F.least(F.col("tokens") - start, F.lit(most)).alias("length"))
    count = rows.agg(F.sum(F.floor((F.col("tokens") - 1) / most) + 1)).first()[0] or 0
    pieces = pieces.repartition(max(1, -(-count // group_rows)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches([b for b in batches if len(b)], held)
        if len(rows):
            order = pc.sort_indices(rows, [("length", "descending"), ("id", "ascending"), ("piece", "ascending")])
            rows = rows.take(order)
            bins, offsets, final = pack_group(rows["length"].to_numpy(), capacities)
            placed = {"sequence": (TaskContext.get().partitionId() << 32) + bins, "capacity": final, "offset": offsets}
            for name, values in placed.items():
                rows = rows.append_column(name, pa.array(values, pa.int64()))
            yield from rows.to_batches()

    held = to_arrow_schema(pieces.schema)
    schema = f"id {pieces.schema['id'].dataType.simpleString()}, piece long, start long, length long, sequence long, capacity long, offset long"
    return pieces.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def op7_best_fit_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the packed sequences."""
    return pack_sequences(table(spark, sf_dir, "documents"))
