"""The operators as queries over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from deskloom.llm import audit, fertility, infill, langid, mixing, nearest, neardup, packing, phrases, secrets, sharding, tokencount, toxicity
from deskloom.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.measure_quality(documents(spark, sf_dir, "doc_id", "text", "lang")).drop("text", "lang")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    named = docs.select("doc_id", langid.held_out(docs["doc_id"]).alias("held_out"), "text", "lang")
    return toxicity.fit_and_score(named, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(documents(spark, sf_dir, "doc_id", "text"))
    columns = [F.crc32("ids").alias("ids_crc32") if c == "ids" else c for c in packed.columns]
    return packed.select(columns)


def op4_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.with_next(documents(spark, sf_dir, "doc_id", "text"))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    named = docs.select("doc_id", langid.held_out(docs["doc_id"]).alias("held_out"), "text")
    return langid.predict(named, langid.fit(docs)).drop("text")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir, "doc_id", "text", "source"))


def op7_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir, "doc_id", "text"), width=4)


def op8_tokencount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(documents(spark, sf_dir, "doc_id", "text")).drop("text")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(documents(spark, sf_dir, "doc_id", "text")))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign_shards(documents(spark, sf_dir, "doc_id", "text"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digest(infill.fill_in_middle(documents(spark, sf_dir, "doc_id", "text")).drop("text"))


def op12_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


def op13_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(documents(spark, sf_dir, "doc_id", "text", "source"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_fertility,
        op2_toxicity,
        op3_packing,
        op4_phrases,
        op5_langid,
        op6_mixing,
        op7_neardup,
        op8_tokencount,
        op9_secrets,
        op10_sharding,
        op11_infill,
        op12_nearest,
        op13_audit,
    )
} | {"pipeline": corpus_pipeline.run}

# What needs a vocabulary, a model or a hash that SQL does not have is tested against brute force instead.
ORACLES: dict[str, str] = {"op6_mixing": mixing.ORACLE, "op11_infill": infill.ORACLE, "op13_audit": audit.ORACLE}
