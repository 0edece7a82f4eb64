"""The training-data pipeline: five stages over ``documents``, each written before the next reads it.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns of ``documents``;
the last one adds the token ids. Rejected documents go, of every group of near copies one
document stays, personal data is replaced by its kind, sources are mixed to their weights (a
document taken twice is two rows), and what is left is encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incidentlens.llm import jaccard, mixing, personal, pieces, quality
from incidentlens.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = quality.quality_rules(docs, table(spark, sf_dir, "labels"))
    return judged.where("kept").select(*docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.without_near_copies(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = personal.find_personal_data(docs, redact=True)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeated(mixing.mix(docs)).select(*docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("personal_data", personal_data),
    ("mixing_sources", mixing_sources),
    ("sentencepiece", sentencepiece),
]

#: The n-gram model's verdict and the tokeniser cannot be said in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
