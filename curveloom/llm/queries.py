"""The operators of this subpackage as queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from curveloom.llm import decontamination, embedding_dedup, language, mixing, secrets, sharding, simhash, substring_dedup, url_filter, warc
from curveloom.llm.common import table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_verdicts(table(spark, sf_dir, "pages"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeats_digest(table(spark, sf_dir, "documents"))


def op4_embedding_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op6_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digest(table(spark, sf_dir, "documents"))


def op7_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_digest(table(spark, sf_dir, "documents"))


def op8_secret_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_findings(table(spark, sf_dir, "documents"))


def op9_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontaminate,
        op2_url_verdicts,
        op3_substring_dedup,
        op4_embedding_near_dup,
        op5_language_id,
        op6_rendezvous_shards,
        op7_simhash_components,
        op8_secret_findings,
        op9_warc_round_trip,
        op10_mix_sources,
    )
}
