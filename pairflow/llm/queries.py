"""The registered queries of the training-data operators.

Each reads its whole table and returns its operator's full result. None of
them is expressible in SQL (trained models, random projections, tokenisers)
unless ORACLE names it; the tests hold the rest against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (ann, centroids, chat, decontaminate, divergence, extract, minhash, packing, quality,
               secrets, sharding, toxicity, urls)
from .common import table

QUERIES = {}
ORACLE: dict[str, str] = {}


def register(key: str):
    def deco(fn):
        QUERIES[key] = fn
        return fn
    return deco


@register("op1_minhash")
def q_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", "kept")


@register("op2_packing")
def q_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@register("op3_ann")
def q_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


@register("op4_urls")
def q_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.pages_judged(table(spark, sf_dir, "pages"))


ORACLE["op4_urls"] = urls.ORACLE_SQL


@register("op5_decontamination")
def q_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"),
                                    table(spark, sf_dir, "benchmark"))


@register("op6_sharding")
def q_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards_digest(table(spark, sf_dir, "documents"))


@register("op7_toxicity")
def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"),
                                    table(spark, sf_dir, "labels"))


@register("op8_secrets")
def q_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.findings_digest(table(spark, sf_dir, "documents"))


@register("op9_extraction")
def q_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages"))


@register("op10_quality")
def q_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"),
                                  table(spark, sf_dir, "labels"))


@register("op11_chat")
def q_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted_digest(table(spark, sf_dir, "conversations"))


ORACLE["op11_chat"] = chat.ORACLE_SQL


@register("op12_divergence")
def q_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


ORACLE["op12_divergence"] = divergence.ORACLE_SQL


@register("op13_centroids")
def q_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters_digest(table(spark, sf_dir, "embeddings"))


ORACLE["op13_centroids"] = centroids.ORACLE_SQL
