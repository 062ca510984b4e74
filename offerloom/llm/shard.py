"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Each (key, shard) pair gets a uniform number u from an md5 digest; the record goes to the shard with the
least -ln(u) / weight. A new shard can only win records over, so growth moves records into the new shard
alone, and its share follows its weight. Everything is built from SQL functions, so that rows without
their texts are the only thing shuffled, once, to number the slots.

Defined results: a null text has size 1 and the checksum of no bytes; a null key hashes as the empty
string; equal keys share a shard and get slots of their own; an empty table gives no rows. Columns other
than key and text are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import table

#: Rows that one task numbers at a time, about; slots are numbered per cell of so many rows.
CELL_ROWS = 50_000
#: 52 bits of the digest make the number: exact as a double.
_BITS = 1 << 52


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The winning shard, 0 to len(weights) - 1; a tie goes to the lower number."""
    text = F.coalesce(key.cast("string"), F.lit(""))

    def cost(shard: int, weight: float) -> Column:
        digest = F.substring(F.md5(F.concat(text, F.lit(f":{shard}")).cast("binary")), 1, 13)
        u = (F.conv(digest, 16, 10).cast("long") + 0.5) / F.lit(float(_BITS))
        return F.struct((-F.log(u) / F.lit(float(weight))).alias("cost"), F.lit(shard).alias("shard"))

    costs = [cost(k, w) for k, w in enumerate(weights)]
    return (F.least(*costs) if len(costs) > 1 else costs[0])["shard"]


def assign_shards(
    docs: DataFrame, weights: Sequence[float], grown_weights: Sequence[float] | None = None, *,
    key_col: str = "doc_id", text_col: str = "text", cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Per record: key, size (UTF-8 bytes + 1), text_crc32, shard, slot, grown_shard.

    ``slot`` numbers each shard's records from 0 without gaps. Shards are cut into cells by a hash of
    the key; the cells' counts (one row each, a fixed share of the input) give every cell its first slot, and a
    window numbers the rows within a cell, so that no task ever holds a whole shard.
    """
    if not weights or min(*weights, 1) <= 0:
        raise ValueError("weights must be positive")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(key_col).alias("key"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        shard_of(F.col(key_col), weights).alias("shard"),
        (shard_of(F.col(key_col), grown_weights) if grown_weights else F.lit(None).cast("int")).alias("grown_shard"),
    )
    cells = max(1, docs.count() // (len(weights) * cell_rows))
    rows = rows.withColumn("cell", F.pmod(F.xxhash64(F.lit("cell"), "key"), F.lit(cells)).cast("int"))
    counts = rows.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
    firsts = counts.select("shard", "cell", F.coalesce(before, F.lit(0)).alias("first"))
    order = Window.partitionBy("shard", "cell").orderBy("key", "size", "text_crc32")
    numbered = rows.withColumn("rank", F.row_number().over(order) - 1)
    return numbered.join(firsts, ["shard", "cell"]).select(
        F.col("key").alias(key_col), "size", "text_crc32", "shard", (F.col("first") + F.col("rank")).cast("long").alias("slot"), "grown_shard"
    )


def op3_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents over eight equal shards, and over nine."""
    out = assign_shards(table(spark, sf_dir, "documents"), [1.0] * 8, [1.0] * 9)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
