"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table


def _of(module: str):
    return importlib.import_module(f".{module}", __package__)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of("toxicity").toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of("top_k").top_k(table(spark, sf_dir, "embeddings"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of("quality").quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of("set_join").jaccard_components(table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of("suffix_dedup").repeated_bytes(table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of("url_filter").url_filter(table(spark, sf_dir, "pages"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _of("sharding").reshard(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of("decontamination").contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _of("kneser_ney")
    return model.perplexities(table(spark, sf_dir, "documents"), model.ORDER)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of("packing").best_fit(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of("merkle").verified(table(spark, sf_dir, "documents"))


def op12_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of("chat").chat_formatting(table(spark, sf_dir, "conversations"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _of("alignment").cross_alignment(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_toxicity, op2_top_k, op3_quality, op4_jaccard_join, op5_suffix_dedup, op6_url_filter, op7_sharding, op8_decontamination, op9_lm_scoring, op10_packing)
    own += (op11_merkle_manifest, op12_chat_formatting, op13_alignment)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    modules = {"op2_top_k": "top_k", "op4_jaccard_join": "set_join", "op5_suffix_dedup": "suffix_dedup", "op6_url_filter": "url_filter", "op12_chat_formatting": "chat"}
    return {name: _of(module).ORACLE_SQL for name, module in modules.items()} | {"op11_merkle_manifest": _of("merkle").oracle_sql()}
