"""From raw documents to packed training sequences, as stages that each read what the one before kept.

1. language_id: documents without a recognisable language (null, or no letters) go.
2. near_duplicates: of each group of documents that five-word shingles link at 0.8 or more, the least id stays.
3. decontamination: documents in which a ten-word window of a benchmark item occurs go.
4. secrets: secrets in the texts are replaced by a mark; all documents stay, ``n_chars`` follows the new text.
5. packing: the documents' places in training sequences of several lengths.

Stages 1 to 4 return the columns they get. Defined results for nulls, empty texts, ties and repeated rows are those
of the operators; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.llm.common import held_out, materialize, table
from offerloom.llm.decontaminate import drop_contaminated
from offerloom.llm.jaccard import keep_one_per_group
from offerloom.llm.language import keep_identified, train_profiles
from offerloom.llm.pack import pack_sequences
from offerloom.llm.secrets import redact_secrets


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs, train_profiles(docs.filter(~held_out())))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = redact_secrets(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_sequences(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

#: SQL can't state the mixture model, the components or the packing; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each one's result is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
