"""From raw documents to packed training sequences: five stages, each over all that the one before kept.

All stages but the last keep the columns of the documents, repeated rows as rows and other columns as they are; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidegauge.llm import mixing, near_texts, packing, pii, quality
from tidegauge.llm.common import stored, table
from tidegauge.llm.queries import vocabulary


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects (a score below 0.3) go; null and empty texts are one empty passage and scored like any."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"), 0.3)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: that of the smallest doc_id (a null one only if the group has no other).

    SimHash fingerprints propose links, which are verified; as fingerprints alone can't find all texts of a similarity of 0.8 in five-word shingles
    (see the README), an exact rule adds the others. Null and empty texts, and those without words, are one group.
    """
    return near_texts.dedup(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced by their kind; a null text stays null, overlapping spans are replaced as one."""
    return pii.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken at the rates that bring the domains to their target weights; texts without tokens at the rate of the prior."""
    return mixing.mixed(docs, table(spark, sf_dir, "labels"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens; a null or empty text is its end id alone."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), 4096)


STAGES = [
    ("quality classifier", quality_filter),
    ("near-dedup", near_dedup),
    ("pii", personal_data),
    ("mixing", mix),
    ("packing", pack),
]

#: Trained models, redaction and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "-"))
    return docs
