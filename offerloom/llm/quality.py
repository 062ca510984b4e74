"""A quality classifier on supervised subword embeddings.

Features of a text are hashed: its words, their character n-grams (of 3 to 5, with word ends), neighbouring
word pairs and a mark for a word repeated at once. Each bucket has a learned vector; a document is the
average of its features' vectors, and a softmax layer gives the label's probability. Training is numpy
stochastic gradient descent on the driver over a bounded sample of the labelled documents; scoring reads each
whole text once and adds up what its buckets contribute to the output. Texts are hashed many at a time.

Defined results: a null or empty text gets the model's bias alone; repeated rows get equal scores; labels that
are null or have no document are not used, of several labels for one id the least counts; without any label all
scores are 0.5; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held_out, mix64, table

BUCKETS = 1 << 16
#: Labelled documents that the model is fitted on at most: those with the least hash of their id.
SAMPLE = 4000
DIMENSIONS = 8
GRAMS = (3, 4, 5)
_REPEATED = BUCKETS  # the bucket of a word that follows itself
#: Bytes handled at once. A longer text is read in parts cut between words, each counted for its document.
PART = 1 << 17
_BLANKS = bytes(32 if b in b"\t\n\r\x0b\x0c" else b for b in range(256))
_POWERS = mix64(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def _parts(texts: list[bytes]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Texts, or parts of long ones, with their numbers, some PART bytes at a time."""
    numbers, held, size = [], [], 0
    for number, text in enumerate(texts):
        at = 0
        while True:
            end = len(text) if len(text) - at <= 2 * PART else text.find(b" ", at + PART)
            end = len(text) if end < 0 else end
            numbers.append(number)
            held.append(text[at:end])
            size += end - at
            if size >= PART:
                yield numbers, held
                numbers, held, size = [], [], 0
            at = end
            if at >= len(text):
                break
    if held:
        yield numbers, held


def features(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Arrays of (text number, bucket), one entry per occurrence of a feature."""
    for numbers, held in _parts([t.translate(_BLANKS) for t in texts]):
        data = np.frombuffer(b" " + b" ".join(held) + b"     ", np.uint8)
        sizes = np.fromiter(map(len, held), np.int64) + 1
        owner = np.repeat(np.asarray(numbers), sizes)  # a blank before a text belongs to it
        blank = data == 32
        n, wide = len(owner), data.astype(np.uint32)
        fine = ~blank[1 : n + 1]
        code = wide[:n] * np.uint32(0x85EBCA6B) + wide[1 : n + 1]
        for size in range(2, max(GRAMS)):
            code = code * np.uint32(0x9E3779B1) + wide[size : n + size]
            if size + 1 in GRAMS:
                use = np.flatnonzero(fine)
                mixed = code[use] ^ code[use] >> np.uint32(15)
                yield owner[use], (mixed * np.uint32(0xC2B2AE35) >> np.uint32(16)).astype(np.int64)
            fine &= ~blank[size : n + size]
        inside = ~blank[:n]
        starts = np.flatnonzero(inside & np.concatenate([[True], blank[: n - 1]]))
        if not len(starts):
            continue
        first = np.zeros(n, np.int64)
        first[starts] = starts
        place = np.arange(n) - np.maximum.accumulate(first)
        words = mix64(np.add.reduceat(np.where(inside, (wide[:n] + np.uint32(1)) * _POWERS[place & 63] + place.astype(np.uint64), np.uint64(0)), starts))
        whose = owner[starts]
        yield whose, (words >> np.uint64(48)).astype(np.int64)
        pair = np.flatnonzero(whose[1:] == whose[:-1])
        left, right = words[pair], words[pair + 1]
        mixed = (left * np.uint64(0x9E3779B97F4A7C15) + right) * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(48)
        yield whose[pair], np.where(left == right, _REPEATED, mixed.astype(np.int64))


def document_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a whole text and how often each occurs."""
    counts = np.zeros(BUCKETS + 1, np.int64)
    for _, buckets in features([text]):
        counts += np.bincount(buckets, minlength=BUCKETS + 1)
    used = np.flatnonzero(counts)
    return used.astype(np.int32), counts[used].astype(np.int32)


def fit(samples: list[tuple[np.ndarray, np.ndarray, int]], *, dimensions: int = DIMENSIONS, epochs: int = 6, rate: float = 2.0, seed: int = 7):
    """Bucket vectors, output weights and bias, by stochastic gradient descent on the log loss."""
    random = np.random.default_rng(seed)
    vectors = random.normal(0, 0.1, (BUCKETS + 1, dimensions))
    output, bias = random.normal(0, 0.1, (dimensions, 2)), np.zeros(2)
    steps = max(1, epochs * len(samples))
    for step in range(epochs * len(samples)):
        if step % len(samples) == 0:
            order = random.permutation(len(samples))
        buckets, counts, label = samples[order[step % len(samples)]]
        pace = rate * (1 - step / steps)
        share = counts / max(1, counts.sum())
        hidden = share @ vectors[buckets]
        logits = hidden @ output + bias
        error = np.exp(logits - logits.max())
        error /= error.sum()
        error[label] -= 1
        back = output @ error
        output -= pace * np.outer(hidden, error)
        bias -= 0.1 * pace * error
        vectors[buckets] -= pace * share[:, None] * back
    return vectors, output, bias


def _featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [document_features(x or b"") for x in batch.column(2).cast(pa.large_binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *(pa.array([r[k] for r in rows], pa.list_(pa.int32())) for k in (0, 1))],
            ["id", "label", "buckets", "counts"],
        )


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE):
    """Per-bucket weight for label 1 against 0, and bias: all that scoring needs. None without labels.

    The sample's ids (at most ``sample`` rows) are broadcast; its feature counts come to the driver."""
    label = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).cast("int").alias("label"))
    chosen = label.orderBy(F.xxhash64("id"), "id").limit(sample)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = texts.join(F.broadcast(chosen), "id").select("id", "label", "text")
    schema = T.StructType([rows.schema["id"], *T.DataType.fromDDL("label int, buckets array<int>, counts array<int>").fields])
    one = F.min_by(F.struct("buckets", "counts"), F.xxhash64("buckets", "counts"))  # of texts that share an id, always the same one
    found = rows.mapInArrow(_featurize, schema).groupBy("id", "label").agg(one.alias("text")).select("id", "label", "text.*").toArrow().sort_by("id")
    samples = [
        (buckets.values.to_numpy(), counts.values.to_numpy(), int(label > 0))
        for label, buckets, counts in zip(found["label"].to_pylist(), found["buckets"], found["counts"])
    ]
    if not samples:
        return None
    vectors, output, bias = fit(samples)
    return vectors @ (output[:, 1] - output[:, 0]), float(bias[1] - bias[0])


def _scorer(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if shared.value is None:
            weights, bias = np.zeros(BUCKETS + 1), 0.0
        else:
            weights, bias = shared.value
        for batch in batches:
            texts = [x or b"" for x in batch.column(1).cast(pa.large_binary()).to_pylist()]
            sums, counts = np.zeros(len(texts)), np.zeros(len(texts))
            for whose, buckets in features(texts):
                sums += np.bincount(whose, weights[buckets], minlength=len(texts))
                counts += np.bincount(whose, minlength=len(texts))
            levels = bias + sums / np.maximum(counts, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(levels, -500, 500))))], ["id", "score"])

    return run


def score_quality(docs: DataFrame, model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id and score, the probability of label 1. The model (one number per bucket) is broadcast."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_scorer(shared), T.StructType([rows.schema["id"], T.StructField("score", T.DoubleType())])).withColumnRenamed("id", id_col)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learnt from labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels").filter(~held_out()))
    out = score_quality(docs, model)
    return out.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))
