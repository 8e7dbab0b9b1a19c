"""A training-data pipeline: documents of good quality, one of each near-duplicate group, without secrets, mixed and packed.

Each stage takes (spark, docs, sf_dir) and works on all that the one before has kept. ORACLE_SQL is None, as no stage
can be written in SQL; the tests hold the stages against brute-force versions.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.llm import mixing, packing, quality, secrets, simhash
from loam.llm.common import saved, table, unused
from loam.llm.queries import TOKENIZER


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labels of what is in docs.

    Null and empty texts are scored like any other, rows of no id are never labelled, and repeated rows stay or go together.
    """
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    score, accepted = unused(docs.columns, "score", "accepted")
    return quality.scores(docs, model, score, accepted).where(F.col(accepted) == 1).drop(score, accepted)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component, that of least doc_id. Texts without words are copies of one another."""
    return simhash.one_of_each(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets masked to their end; null and empty texts stay as they are."""
    return secrets.redacted(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, up to three times; those without words drop out."""
    return mixing.mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed sequences, one row a piece; a text that is null or empty is its end id alone."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality", quality_stage),
    ("dedup", dedup_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
