"""Mixing sources to target weights by repetition rates. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curveloom.llm.common import Workspace, global_rank, n_words, unit_hash

#: Above this many sources their table is joined by shuffle instead of being broadcast (about 3 MB).
BROADCAST_SOURCES = 50_000


def source_targets(ws: Workspace, sizes: DataFrame, *, cycle: int = 3, cap: float = 3.0) -> DataFrame:
    """One row per source of sizes(source, size): source, source_size, target.

    Sources by code point, null last, weigh 1, 2, ..., cycle, repeating. They share the sum of all sizes by weight; a target stops
    at cap times its source's size and the excess is shared again by weight until none is above. Sources of size 0 get 0.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    ranked = global_rank(ws, sums, [F.col("source").isNull(), F.col("source")], "sources")
    src = ws.stage(ranked.withColumn("weight", F.col("rank") % cycle + 1), "weights")
    level, held = 0.0, -1
    total = src.agg(F.sum("source_size")).first()[0] or 0
    above = F.lit(False)
    while True:
        free, full, n = src.agg(
            F.sum(F.when(~above, F.col("weight"))), F.sum(F.when(above, F.col("source_size"))), F.count(F.when(above, 1))
        ).first()
        if n == held or not free:
            break
        held, level = n, (total - cap * (full or 0)) / free
        above = F.lit(level) * F.col("weight") > F.lit(cap) * F.col("source_size")
    target = F.when(above, F.lit(cap) * F.col("source_size")).otherwise(F.lit(level) * F.col("weight"))
    return src.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def copies_of(rate: Column, *key: Column) -> Column:
    """floor(rate), plus 1 if the hash of the key falls below the fraction."""
    whole = F.floor(rate)
    return (whole + (unit_hash(*key) < rate - whole).cast("bigint")).cast("bigint")


def with_copies(ws: Workspace, rows: DataFrame, sizes: DataFrame, *, seed: int = 1, cycle: int = 3, cap: float = 3.0) -> DataFrame:
    """rows(doc_id, source, ...) with source_size, target and copies, the targets coming from sizes(source, size)."""
    targets = source_targets(ws, sizes, cycle=cycle, cap=cap).withColumnRenamed("source", "__source")
    if targets.count() <= BROADCAST_SOURCES:
        targets = F.broadcast(targets)
    # A null source is a source of its own: the key gets a mark so that the join stays an equi-join.
    key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    other = F.coalesce(F.concat(F.lit("s"), F.col("__source")), F.lit("n"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return rows.join(targets, key == other).drop("__source").withColumn("copies", copies_of(rate, F.col("doc_id"), F.lit(seed)))


def mix_digest(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken (size x copies) of every document; copies never pass 3.

    Null texts have size 0, a null source is a source of its own, repeated rows of a doc_id share their draw,
    an empty table gives no rows. Reruns agree.
    """
    ws = Workspace(docs.sparkSession, "mix")
    sized = ws.stage(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), "sizes")
    return with_copies(ws, sized, sized).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix: each row of docs as often as its copies say, with the columns of docs."""
    ws = Workspace(docs.sparkSession, "mix")
    sizes = ws.stage(docs.select("source", n_words(F.col("text")).alias("size")).groupBy("source").agg(F.sum("size").cast("bigint").alias("size")), "sizes")
    rows = docs.select(F.struct("*").alias("__row"), "doc_id", "source")
    many = with_copies(ws, rows, sizes).where("copies > 0").select("__row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
    return many.select(*[F.col("__row")[n].alias(n) for n in docs.columns])
