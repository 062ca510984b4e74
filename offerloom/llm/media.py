"""Media columns as content-defined chunks.

A text's UTF-8 bytes, padded with 255 to a positive multiple of 576, are the samples of an 8-bit mono WAV file.
The payload is cut where a rolling gear hash over the last 32 bytes has its top bits clear (within a least and a
largest size), so that equal passages give equal chunks wherever they stand. Chunk digests are counted by a Spark
aggregate; digests that occur more than once set bits in a bitmap of bounded size, which is broadcast. Chunks
in the bitmap go to the chunk store, once per digest; all others stay in their document's pack beside
the ordered chunk list. (A bit set by chance only sends a unique chunk to the store.) So payload bytes are shuffled
only where documents share them.

Reading back, packs without store chunks are joined in place; the others' lists are joined with the store,
once per distinct medium, gathered in order and verified against the digest of the whole medium.

Defined results: a null text is empty, and an empty one is one frame of padding; equal texts have equal media;
repeated rows and ids each give a row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bitmap_bits, collect_bitmap, materialize, mix64, table

FRAME, PAD = 576, 255
LEAST, MOST, CLEAR_BITS = 512, 8192, 11
_GEAR = (mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)
_RATE = 8000


def payload_of(raw: bytes | None) -> bytes:
    raw = raw or b""
    return raw + bytes([PAD]) * (max(FRAME, -(-len(raw) // FRAME) * FRAME) - len(raw))


def header(size: int) -> bytes:
    """The head of a WAV file of ``size`` 8-bit mono samples."""
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + size, b"WAVE", b"fmt ", 16, 1, 1, _RATE, _RATE, 1, 8, b"data", size)


def cuts(payload: bytes, *, least: int = LEAST, most: int = MOST, clear_bits: int = CLEAR_BITS) -> list[int]:
    """Ends of the chunks. The gear hash of a place is the sum of its last 32 bytes' codes, each shifted by its distance."""
    hashes = _GEAR[np.frombuffer(payload, np.uint8)]
    for k in (1, 2, 4, 8, 16):
        hashes[k:] += hashes[:-k] << np.uint32(k)
    ends, start, size = [], 0, len(payload)
    for place in (np.flatnonzero(hashes >> np.uint32(32 - clear_bits) == 0) + 1).tolist():
        while place - start > most:
            start += most
            ends.append(start)
        if place - start >= least:
            start = place
            ends.append(start)
    while size - start > most:
        start += most
        ends.append(start)
    if start < size:
        ends.append(size)
    return ends


def chunks_of(payload: bytes) -> list[bytes]:
    ends = cuts(payload)
    return [payload[a:b] for a, b in zip([0, *ends], ends)]


def digest_of(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


def _bit(digest: bytes, bits: int) -> int:
    return int.from_bytes(digest[:4], "little") & (bits - 1)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [digest_of(c) for raw in batch.column(0).cast(pa.large_binary()).to_pylist() for c in chunks_of(payload_of(raw))]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["digest"])


def _shared_chunks(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, bits = shared.value
        sent: set[bytes] = set()  # spares the shuffle most copies; the store is made unique below
        for batch in batches:
            digests, parts = [], []
            for raw in batch.column(0).cast(pa.large_binary()).to_pylist():
                for chunk in chunks_of(payload_of(raw)):
                    digest = digest_of(chunk)
                    at = _bit(digest, bits)
                    if bitmap[at >> 3] >> (at & 7) & 1 and digest not in sent:
                        if len(sent) >= 1_000_000:
                            sent.clear()
                        sent.add(digest)
                        digests.append(digest)
                        parts.append(chunk)
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(parts, pa.binary())], ["digest", "chunk"])

    return run


_LIST = pa.list_(pa.struct([("digest", pa.binary()), ("length", pa.int32()), ("stored", pa.bool_())]))
PACK = "n_bytes long, media_sha256 string, chunks array<struct<digest:binary,length:int,stored:boolean>>, own binary"


def _packer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, bits = shared.value
        for batch in batches:
            sizes, wholes, lists, owns = [], [], [], []
            for raw in batch.column(1).cast(pa.large_binary()).to_pylist():
                payload = payload_of(raw)
                listed, own = [], []
                for chunk in chunks_of(payload):
                    digest = digest_of(chunk)
                    at = _bit(digest, bits)
                    stored = bool(bitmap[at >> 3] >> (at & 7) & 1)
                    listed.append({"digest": digest, "length": len(chunk), "stored": stored})
                    if not stored:
                        own.append(chunk)
                sizes.append(len(raw or b""))
                wholes.append(hashlib.sha256(header(len(payload)) + payload).hexdigest())
                lists.append(listed)
                owns.append(b"".join(own))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(wholes, pa.string()), pa.array(lists, _LIST), pa.array(owns, pa.binary())],
                ["id", "n_bytes", "media_sha256", "chunks", "own"],
            )

    return run


def store_media(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Packs (id, n_bytes, media_sha256, ordered chunk list, own bytes) and the chunk store (digest, chunk), both written."""
    spark = docs.sparkSession
    texts = docs.select(F.col(text_col).alias("text"))
    counts = texts.mapInArrow(_digests, "digest binary").groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
    often = materialize(counts.filter("n > 1").select("digest"), "shared_digests")
    bits = bitmap_bits(often.count())
    # the first four bytes, little-endian, as ``_bit`` reads them
    byte = lambda k: F.conv(F.substring(F.hex("digest"), 2 * k + 1, 2), 16, 10).cast("long")
    place = (byte(0) + byte(1) * 256 + byte(2) * 65536 + byte(3) * 16777216).bitwiseAND(F.lit(bits - 1))
    shared = spark.sparkContext.broadcast((collect_bitmap(often.select(place.alias("place")), bits), bits))
    store = texts.mapInArrow(_shared_chunks(shared), "digest binary, chunk binary")
    store = materialize(store.groupBy("digest").agg(F.first("chunk").alias("chunk")), "chunk_store")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["id"], *T.DataType.fromDDL(PACK).fields])
    return materialize(rows.mapInArrow(_packer(shared), schema), "packs"), store


def features_of(media: bytes) -> dict:
    """What is computed from a stored medium; its payload is taken from the samples themselves."""
    size = struct.unpack_from("<I", media, 40)[0]
    payload = media[44 : 44 + size]
    samples = np.frombuffer(payload, np.uint8)
    sign = samples >= 128
    turns = int(np.count_nonzero(sign[1:] != sign[:-1]))
    return {
        "payload_bytes": len(payload), "payload_sha256": hashlib.sha256(payload).hexdigest(), "tail_crc32": zlib.crc32(payload[-32:]),
        "media_bytes": len(media), "feature": f"sum={int(samples.sum(dtype=np.int64))};min={samples.min()};max={samples.max()};turns={turns}",
    }


FEATURES = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, feature string"
_NAMES = [f.split()[0] for f in FEATURES.split(", ")]


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First come columns that pass, then media_sha256, chunks, own, and the parts from the store by digest."""
    for batch in batches:
        get = lambda name: batch.column(batch.schema.get_field_index(name)).to_pylist()
        made = []
        for whole, listed, own, parts in zip(get("media_sha256"), get("chunks"), get("own"), get("parts")):
            stored = {p["digest"]: p["chunk"] for p in parts or ()}
            out, at = [], 0
            for entry in listed:
                if entry["stored"]:
                    out.append(stored[entry["digest"]])
                else:
                    out.append(own[at : at + entry["length"]])
                    at += entry["length"]
            payload = b"".join(out)
            media = header(len(payload)) + payload
            if hashlib.sha256(media).hexdigest() != whole:
                raise ValueError(f"medium {whole} does not come back from its chunks")
            made.append(features_of(media))
        kept = [k for k, name in enumerate(batch.schema.names) if name not in ("chunks", "own", "parts")]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        columns = [pa.array([m[n] for m in made], t) for n, t in zip(_NAMES, kinds)]
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), *columns], [*(batch.schema.names[k] for k in kept), *_NAMES])


def read_media(packs: DataFrame, store: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document: id, n_bytes, media_sha256 and the features of its medium, rebuilt from chunks and verified."""
    parts = "array<struct<digest:binary,chunk:binary>>"
    fields = T.DataType.fromDDL(FEATURES).fields
    alone = ~F.exists("chunks", lambda c: c["stored"])
    whole = packs.filter(alone).withColumn("parts", F.lit(None).cast(parts))
    whole = whole.mapInArrow(_verify, T.StructType([*(packs.schema[c] for c in ("id", "n_bytes", "media_sha256")), *fields]))
    mixed = packs.filter(~alone)
    media = mixed.groupBy("media_sha256").agg(F.first(F.struct("chunks", "own")).alias("pack")).select("media_sha256", "pack.*")
    wanted = F.array_distinct(F.transform(F.filter("chunks", lambda c: c["stored"]), lambda c: c["digest"]))
    needs = media.select("media_sha256", F.explode(wanted).alias("digest"))
    got = needs.join(store, "digest").groupBy("media_sha256").agg(F.collect_list(F.struct("digest", "chunk")).alias("parts"))
    media = media.join(got, "media_sha256").select("media_sha256", "chunks", "own", "parts")
    media = media.mapInArrow(_verify, T.StructType([packs.schema["media_sha256"], *fields]))
    mixed = mixed.select("id", "n_bytes", "media_sha256").join(media, "media_sha256")
    return whole.unionByName(mixed).withColumnRenamed("id", id_col)


def op2_media_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document stored as chunked media, read back and described."""
    packs, store = store_media(table(spark, sf_dir, "documents"))
    return read_media(packs, store).select(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"
    )
