"""The corpus pipeline: toxicity, near-duplicates, decontamination, secrets, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one before kept; all but the last return the
columns of documents.

Edge cases, in every stage: null and empty texts stay (they are clean, and pack as one end id); rows with null doc_id stay;
exactly repeated rows count as copies, of which the second stage keeps one; one doc_id may stand on different texts, which
are judged each by its own; further columns are carried along, whatever their names, and dropped by packing; empty
tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voxmill.llm import decontamination, neardup, packing, secrets, toxicity
from voxmill.llm.common import durable, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar rejects go; without labels of both classes nothing is rejected but by their base rate."""
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity 0.8) stays: that of the least doc_id.
    Documents without words are in no group."""
    return neardup.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage, with at most a tenth of it edited, go; an empty benchmark takes none."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text; every document stays."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: No stage but the last step of the third can be put in SQL (models, closures, a tokenizer); tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
