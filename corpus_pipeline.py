"""From raw documents to shards of a training mix; counted as part of the llm subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curveloom.llm import decontamination, language, minhash, mixing, sharding
from curveloom.llm.common import Workspace, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents without a letter and those whose best language scores under 0.5.

    The model learns from the rows with a language whose id is not held out. Null and empty texts go; long texts are read whole;
    repeated rows are judged alike; null ids stay; without any row that has a language, or of an empty table, nothing stays.
    """
    return language.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest doc_id of each component of texts with 80 % of their five-word shingles in common.

    Null and blank texts are copies of each other. Rows that share an id with unlike texts stay each, equal rows once, rows
    without an id always. An empty table gives no rows.
    """
    return minhash.keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that leak an item of `benchmark`: 13 of its words in place, or all of a shorter one, to 80 %.

    Null and empty texts leak nothing, nor does an empty benchmark find anything; repeated rows are judged alike, whatever their id.
    """
    return decontamination.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents by their source's rate: floor(rate) times, and once more by the hash of doc_id.

    A null source is a source of its own; texts without words weigh nothing but are repeated like the others of their source,
    those of a source without any word go; rows that share an id share the draw; an empty table gives no rows.
    """
    return mixing.mix_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the column `shard`, 0 to 7, by rendezvous hashing of doc_id; the copies of a document share a shard.

    A null id is a key like any other. A column of that name is replaced; an empty table gives no rows.
    """
    return sharding.shard_documents(docs)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: XXH64 fingerprints and trained models have no counterpart in SQL: tests hold run() against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written under the shared folder and read again by the next."""
    ws = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, ws.stage(stage(spark, docs, sf_dir), name)
        if hasattr(before, "_cl_path"):
            ws.drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
