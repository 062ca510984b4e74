"""Language identification by multilingual mixture inference.

Training counts hashed byte trigrams of the labelled documents per language (all of them, pre-aggregated in
each task). A document is then a bag of trigrams drawn from a mixture of languages: expectation-maximisation
estimates the proportions, and languages enter the set one by one while the log-likelihood they add exceeds
a penalty that grows with the logarithm of the number of trigrams.

Defined results: a null text or one without letters is ``und`` with score 0 and no proportions; without any
labelled document all are ``und``; ties go to the language first in alphabetical order; repeated rows count as
often as they occur in training and get equal results; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BLOCK_BYTES, bounded, carried, held_out, restored, table

BINS = 1 << 14
#: Log-likelihood that a further language must add, per log of the number of trigrams.
PENALTY = 4.0
SMOOTHING = 0.5
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_ASCII_LETTERS = bytes(b for b in range(128) if chr(b).isalpha())
#: ASCII letters become small, other ASCII becomes a blank.
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)], np.uint8)
STATE = "struct<lang_pred:string,score:double,proportions:map<string,double>>"
_TYPE = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("proportions", pa.map_(pa.string(), pa.float64()))])


def has_letter(raw: bytes) -> bool:
    return len(raw.translate(None, _ASCII_LETTERS)) < len(raw) or bool(_LETTER.search(raw.decode()))


def trigram_bins(texts: list[bytes]) -> Iterator[np.ndarray]:
    """Per text, the bins of its trigrams, with a blank at either end; runs of blanks hold none."""
    at = 0
    while at < len(texts):
        size, end = 0, at
        while end < len(texts) and (end == at or size + len(texts[end]) <= BLOCK_BYTES):
            size += len(texts[end]) + 1
            end += 1
        data = _FOLD[np.frombuffer(b" " + b" ".join(texts[at:end]) + b" ", np.uint8)]
        capital = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)) + 1
        data[capital] += 0x20  # Latin-1 capitals in UTF-8
        wide = data.astype(np.uint32)
        bins = (wide[:-2] * np.uint32(0x9E3779B1) ^ wide[1:-1] * np.uint32(0x85EBCA6B) ^ wide[2:] * np.uint32(0xC2B2AE35)) * np.uint32(0x27D4EB2F) >> np.uint32(18)
        blank = data == 32
        fine = ~(blank[1:-1] & (blank[:-2] | blank[2:]))
        start = 0
        for text in texts[at:end]:
            stop = start + len(text)
            yield bins[start:stop][fine[start:stop]]
            start = stop + 1
        at = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        texts = batch.column(1).cast(pa.large_binary()).to_pylist()
        for lang, bins in zip(batch.column(0).to_pylist(), trigram_bins(texts)):
            if lang not in counts:
                counts[lang] = np.zeros(BINS, np.int64)
            counts[lang] += np.bincount(bins, minlength=BINS)
    for lang, found in counts.items():
        used = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int64()), pa.array(found[used])], ["lang", "bin", "n"])


def train_profiles(docs: DataFrame, *, lang_col: str = "lang", text_col: str = "text") -> dict[str, np.ndarray]:
    """Trigram probabilities of each language, from all given documents with a language and a text.

    Each task sends at most one count per language and bin; languages x bins numbers reach the driver."""
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).dropna()
    counts = rows.mapInArrow(bounded(_count, 1), "lang string, bin long, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n")).toPandas()
    profiles = {}
    for lang, part in counts.groupby("lang"):
        found = np.full(BINS, SMOOTHING)
        found[part["bin"].to_numpy()] += part["n"].to_numpy()
        profiles[str(lang)] = found / found.sum()
    return dict(sorted(profiles.items()))


def mixture(counts: np.ndarray, odds: np.ndarray, rounds: int = 50, close: float = 1e-4) -> tuple[np.ndarray, float]:
    """Proportions of the columns of ``odds`` (likelihoods per trigram) by expectation-maximisation, and the log-likelihood."""
    share = np.full(odds.shape[1], 1 / odds.shape[1])
    total = counts.sum()
    if odds.shape[1] > 1:
        for _ in range(rounds):
            new = share * (counts / (odds @ share) @ odds) / total
            done = np.abs(new - share).max() < close
            share = new
            if done:
                break
    return share, float(counts @ np.log(odds @ share))


def infer(counts: np.ndarray, odds: np.ndarray, penalty: float) -> dict[int, float]:
    """Language numbers and proportions of the selected set; it grows greedily by penalised likelihood."""
    price = penalty * np.log(counts.sum() + 1)
    single = counts @ np.log(odds)
    chosen = [int(np.argmax(single))]
    share, level = np.ones(1), float(single[chosen[0]])
    while len(chosen) < odds.shape[1]:
        blend = odds[:, chosen] @ share
        slopes = (counts / blend) @ odds - counts.sum()  # the log-likelihood is concave: no gain exceeds its slope
        best = None
        for lang in map(int, np.flatnonzero(slopes > price)):
            if lang not in chosen:
                trial = mixture(counts, odds[:, [*chosen, lang]])
                if best is None or trial[1] > best[0][1]:
                    best = trial, lang
        if best is None or best[0][1] - level <= price:
            break
        (share, level), lang = best
        chosen.append(lang)
    return dict(zip(chosen, share.tolist()))


def _predictor(shared, penalty: float, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, matrix = shared.value
        for batch in batches:
            out = []
            raws = [x or b"" for x in batch.column(1).cast(pa.large_binary()).to_pylist()]
            for raw, bins in zip(raws, trigram_bins(raws)):
                if not langs or not has_letter(raw):
                    out.append({"lang_pred": UNKNOWN, "score": 0.0, "proportions": []})
                    continue
                counts = np.bincount(bins, minlength=BINS)
                used = np.flatnonzero(counts)
                found = infer(counts[used].astype(np.float64), matrix[used], penalty)
                top = min(found, key=lambda k: (-found[k], k))
                out.append({"lang_pred": langs[top], "score": min(1.0, found[top]), "proportions": [(langs[k], v) for k, v in sorted(found.items())]})
            kept = [batch.column(0), *([batch.column(1)] if keep_text else [])]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(out, _TYPE)], [*batch.schema.names[: len(kept)], "state"])

    return run


def _predicted(rows: DataFrame, profiles: dict[str, np.ndarray], penalty: float, keep_text: bool) -> DataFrame:
    """``rows``: any first column, then text; ``state`` is put after them. The profiles (languages x bins numbers) are broadcast."""
    langs = list(profiles)
    matrix = np.stack([profiles[x] for x in langs], axis=1) if langs else np.zeros((BINS, 0))
    shared = rows.sparkSession.sparkContext.broadcast((langs, matrix))
    schema = T.StructType(rows.schema.fields[: 1 + keep_text]).add("state", T.DataType.fromDDL(STATE))
    return rows.mapInArrow(bounded(_predictor(shared, penalty, keep_text), 1), schema)


def identify_languages(docs: DataFrame, profiles: dict[str, np.ndarray], *, id_col: str = "doc_id", text_col: str = "text", penalty: float = PENALTY) -> DataFrame:
    """Per document: id, lang_pred (largest proportion), score (that proportion), proportions."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return _predicted(rows, profiles, penalty, False).select(F.col("id").alias(id_col), "state.*")


def keep_identified(docs: DataFrame, profiles: dict[str, np.ndarray], *, text_col: str = "text", penalty: float = PENALTY) -> DataFrame:
    """The documents whose language can be told, all columns as they were."""
    rows = _predicted(carried(docs, text_col), profiles, penalty, True)
    return restored(rows.filter(F.col("state.lang_pred") != UNKNOWN), docs.columns, text_col)


def op4_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from those outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    profiles = train_profiles(docs.filter(~held_out()))
    out = identify_languages(docs, profiles)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", F.to_json("proportions").alias("proportions"))
