"""Sharding by weighted rendezvous hashing. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from curveloom.llm.common import Workspace, unit_hash

#: Slots are numbered within hashed buckets of about so many distinct rows, so that no task sorts a whole shard.
BUCKET_ROWS = 500_000
#: Up to so many buckets per shard their offsets are broadcast.
BROADCAST_BUCKETS = 10_000


def rendezvous(key: Column, weights: Sequence[float], seed: int = 0) -> Column:
    """The shard with the smallest -ln(u) / weight, u being hashed from key, shard and seed.

    The score of a shard depends on no other shard, so adding one moves records only into it, and a shard's share
    is its weight's share. A null key is a key like any other. Shards of weight 0 get nothing.
    """
    scores = [
        F.struct((-F.log(unit_hash(key, F.lit(i), F.lit(seed)) + F.lit(2.0**-54)) / F.lit(float(w))).alias("score"), F.lit(i).alias("shard"))
        for i, w in enumerate(weights)
        if w > 0
    ]
    if not scores:
        raise ValueError("no shard has a weight above 0")
    return F.array_min(F.array(*scores))["shard"]


def shard_documents(docs: DataFrame, key: str = "doc_id", weights: Sequence[float] = (1.0,) * 8, *, seed: int = 0, name: str = "shard") -> DataFrame:
    """docs with an int column `name`. Map-only. Repeated keys share a shard; any other column is left alone."""
    return docs.withColumn(name, rendezvous(F.col(key), weights, seed))


def number_slots(ws: Workspace, df: DataFrame, shard: str, order: Sequence[str], *, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """df with a bigint `slot`, gapless from 0 in each shard.

    Equal rows are counted first and travel as one, so a row that repeats without end fills no task. Distinct rows are numbered
    inside hashed buckets, by `order`; the buckets' sums give each bucket's offset. The same rows get the same slots at every
    run: ties in `order` are broken by the other columns, and equal rows get neighbouring slots.
    """
    rest = [c for c in df.columns if c not in order and c != shard]
    rows = ws.stage(df.groupBy(*df.columns).agg(F.count("*").alias("__n")), "slots")
    buckets = max(1, -(-rows.count() // bucket_rows))
    rows = rows.withColumn("__b", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sums = rows.groupBy(F.col(shard).alias("__s"), F.col("__b").alias("__c")).agg(F.sum("__n").alias("__sum"))
    before = W.partitionBy("__s").orderBy("__c").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select("__s", "__c", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__offset"))
    inside = W.partitionBy(shard, "__b").orderBy(*order, *rest).rowsBetween(W.unboundedPreceding, -1)
    numbered = rows.withColumn("__i", F.coalesce(F.sum("__n").over(inside), F.lit(0)))
    offsets = F.broadcast(offsets) if buckets <= BROADCAST_BUCKETS else offsets
    placed = numbered.join(offsets, (F.col(shard) == F.col("__s")) & (F.col("__b") == F.col("__c")))
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__n") - 1)).alias("__k")
    return placed.select(*df.columns, "__offset", "__i", copies).select(*df.columns, (F.col("__offset") + F.col("__i") + F.col("__k")).cast("bigint").alias("slot"))


def shard_digest(docs: DataFrame, n: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every document over n equal shards.

    The law is `key`: doc_id and the number of shards decide, so repeated rows of one doc_id share a shard while equal texts
    under different ids need not. size is the UTF-8 length plus 1; a null text counts as empty. An empty table gives no rows.
    Slots are gapless within each shard.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    picked = docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    placed = shard_documents(shard_documents(picked, weights=(1.0,) * n), weights=(1.0,) * (n + 1), name="grown_shard")
    return number_slots(Workspace(docs.sparkSession, "shard"), placed, "shard", ["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
