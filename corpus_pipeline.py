"""Corpus pipeline over ``documents``: every stage works on all that the stage
before it kept and is written as Parquet and read again.

Toxic documents go; one document of each class of copies and near copies stays;
documents that overlap a benchmark item go; confirmed secrets are replaced by a
mark (the document stays); the rest is packed into sequences.

Every stage takes any columns beside doc_id, text and source, whatever their names,
with nulls in all of them, and all but the last return them unchanged (secrets: with
``n_chars`` recounted).  A null text counts as empty; an empty table gives an empty one;
texts of any length are read whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from auditmart.llm import bagminhash, decontamination, packing, secret_scan, toxicity
from auditmart.llm.common import materialise, prepare, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows scored below the threshold stay.  Repeated rows share their fate; null and
    empty texts stay; without labels of both classes nothing goes."""
    prepare(spark)
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of copies and near copies the row with the least doc_id stays (a
    null id counts as larger than any; of tied rows one stays).  Null and empty texts
    are copies of each other."""
    return bagminhash.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that share no passage with a benchmark item stay; null and empty texts and
    items match nothing."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows stay, repeated ones too; a confirmed secret becomes ``<secret>``; null texts
    stay null."""
    return secret_scan.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document.  A null or empty text is its end id alone; a
    repeated row is packed again; a null source is a source of its own."""
    return packing.pack(docs).drop("ids")


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

# No SQL can express the learned and hashing stages; tests compare each stage
# with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline/{i}_{name}")
    return docs
