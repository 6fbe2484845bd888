"""From raw documents to packed training sequences, in five stages.

A stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; all but the last return
the columns of ``documents``. Documents that the quality rules reject go; of each group of near-duplicates the
document with the least id stays; secrets are masked in the text; the mix repeats and leaves out documents
to meet its sources' targets (a row per copy); the last stage returns the token pieces of every row with
their ids, the ids' digest and their places in sequences. Nulls, empty texts and repeated rows fare as each operator's module says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskloom.llm import fertility, mixing, neardup, packing, secrets
from deskloom.llm.common import Stage, documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return fertility.keep_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one_of_each(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact_secrets(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("secret_scans", secret_scans),
    ("mixing_sources", mixing_sources),
    ("best_fit_packing", best_fit_packing),
]

# Token vocabularies and signatures are beyond SQL; tests/llm/test_pipeline.py holds the stages against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written and read again before the next."""
    written = Stage(spark)
    docs = documents(spark, sf_dir)
    for number, (_, stage) in enumerate(STAGES[:-1]):
        docs = written(stage(spark, docs, sf_dir))
        if number:  # nothing reads the table of the stage before any more
            written.drop(number)
    return STAGES[-1][1](spark, docs, sf_dir)
