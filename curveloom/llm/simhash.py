"""SimHash near-duplicates found by meet-in-the-middle ball hashing."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from curveloom.llm.common import Workspace, connected_components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE, RADIUS, SEED = 3, 2, 42
#: Shingle hashes whose bits are counted at once, which bounds the memory a very long text takes.
BLOCK = 1 << 16


def fingerprint(text: bytes | None, width: int = SHINGLE) -> int:
    """Bit b is set if it is set in over half of the XXH64 values of the word shingles; 0 without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(width, len(words))
    hashed, n = xxhash.xxh64_intdigest, len(words) - k + 1
    places = ((starts[at : min(n, at + BLOCK)].tolist(), ends[at + k - 1 : at + k - 1 + BLOCK].tolist()) for at in range(0, n, BLOCK))
    return majority(np.array([hashed(joined[i:j], SEED) for i, j in zip(a, b)], "<u8") for a, b in places)


def majority(blocks: Iterable[np.ndarray]) -> int:
    """The bits that are set in over half of the hashes of all blocks."""
    bits, n = np.zeros(64, np.int64), 0
    for h in blocks:
        bits += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        n += len(h)
    return int.from_bytes(np.packbits(2 * bits > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, width: int = SHINGLE, keep: str | None = None) -> DataFrame:
    """(doc_id, fp bigint) of every row of docs, with the column `keep` if one is named; null and empty texts have fingerprint 0."""
    kinds = dict(docs.dtypes)
    more = [keep] if keep else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t, width) for t in batch.column(1).cast(pa.binary()).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64)), *batch.columns[2:]], ["doc_id", "fp", *more])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), *more)
    return rows.mapInArrow(run, ", ".join([f"doc_id {kinds['doc_id']}", "fp bigint", *(f"{c} {kinds[c]}" for c in more)]))


def _with_company(distinct: DataFrame, radius: int) -> DataFrame:
    """The rows of distinct(fp, node) that agree with another one in two of radius + 2 blocks of the fingerprint's bits.

    Fingerprints within the radius differ in that many blocks at most, so whoever has a neighbour there is among them. Six keys a
    row at radius 2 are far less than its 65 variants, which those without company need not emit.
    """
    cuts = [64 * i // (radius + 2) for i in range(radius + 3)]
    blocks = [F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << hi - lo) - 1)) for lo, hi in zip(cuts, cuts[1:])]
    pairs = combinations(range(radius + 2), 2)
    width = -(-64 // (radius + 2))
    keys = F.array(*[F.lit(k << 2 * width) + F.shiftleft(blocks[i], width) + blocks[j] for k, (i, j) in enumerate(pairs)])
    rows = distinct.select("fp", F.explode(keys).alias("key"))
    shared = rows.groupBy("key").agg(F.count("*").alias("times")).where("times > 1").select("key")
    return distinct.join(rows.join(shared, "key").select("fp").distinct(), "fp", "left_semi")


def ball_edges(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Verified edges (u, v) between the nodes of distinct(fp, node) whose fingerprints differ in at most radius bits.

    Every fingerprint that can have a neighbour emits all variants within half the radius, which is even; two fingerprints within
    the radius share one. A variant's fingerprints all lie in its ball, so a group never holds more than 65 of them at radius 2
    (2,081 at 4), whatever the data, and any two of a group are within the radius: each is tied to the group's smallest node, which keeps all components
    without emitting all pairs of a group.
    """
    if radius < 2 or radius % 2:
        raise ValueError("the radius has to be even, so that two balls of half of it meet")
    masks = [sum(1 << b for b in bits) for k in range(radius // 2 + 1) for bits in combinations(range(64), k)]
    flips = F.array(*[F.lit(np.uint64(m).astype(np.int64).item()) for m in masks])
    variants = _with_company(distinct, radius).select("fp", "node", F.explode(F.transform(flips, lambda m: m.bitwiseXOR(F.col("fp")))).alias("variant"))
    least = F.min(F.struct("node", "fp")).over(W.partitionBy("variant"))
    pairs = variants.withColumn("least", least).where(F.col("node") != F.col("least.node"))
    return (
        pairs.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("least.fp"))) <= radius)
        .select(F.col("node").alias("u"), F.col("least.node").alias("v"))
        .distinct()
    )


def _classes(ws: Workspace, marked: DataFrame, radius: int) -> DataFrame:
    """__fp, lead (doc_id, fp), of every fingerprint of marked(doc_id, fp): the class's smallest doc_id and the smallest
    fingerprint of that id. A node is a fingerprint with its smallest doc_id, so that two of one id stay two nodes."""
    distinct = ws.stage(marked.groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct").select("fp", F.struct(F.col("rep").alias("doc_id"), "fp").alias("node"))
    parts = connected_components(ws, ball_edges(distinct.where("node.doc_id is not null"), radius)).withColumnRenamed("node", "__node")
    return distinct.join(parts, F.col("node") == F.col("__node"), "left").select(F.col("fp").alias("__fp"), F.coalesce("component", "node").alias("lead"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp (bigint bits), component_id of every row of docs.

    Documents link if their fingerprints differ in at most `radius` bits; component_id is the smallest doc_id reachable. Equal
    fingerprints are one node, so copies cost nothing past the fingerprint. Null ids take part with their fingerprint but name
    no component unless all ids of it are null; repeated rows stay repeated, and rows that share an id with other texts are
    documents of their own; null and empty texts have fingerprint 0; an empty table gives no rows.
    """
    ws = Workspace(docs.sparkSession, "simhash")
    marked = ws.stage(fingerprints(docs), "fingerprints")
    labels = _classes(ws, marked, radius).select("__fp", F.col("lead.doc_id").alias("component_id"))
    return marked.join(labels, F.col("fp") == F.col("__fp")).select("doc_id", "fp", "component_id")


def near_duplicate_digest(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id."""
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """docs without the near-duplicates: of each component one row of the smallest doc_id stays.

    Rows that share a doc_id with unlike texts are documents of their own and stay each; of the rows of one id and fingerprint
    the one with the smallest hash of its text stays. Rows whose id is null are kept, since no component can be told for them.
    """
    ws = Workspace(docs.sparkSession, "simhash")
    text_hash = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    pairs = docs.where("doc_id is not null").select("doc_id", F.col("text").cast("string").alias("text"), text_hash.alias("hash"))
    marked = ws.stage(fingerprints(pairs, keep="hash"), "fingerprints")
    leads = _classes(ws, marked.select("doc_id", "fp"), radius).select("__fp", "lead")
    first = marked.join(leads, (F.col("fp") == F.col("__fp")) & (F.struct("doc_id", "fp") == F.col("lead"))).groupBy("doc_id", "fp").agg(F.min("hash").alias("__of"))
    first = ws.stage(first.select(F.col("doc_id").alias("__keep"), "__of").distinct(), "keep")
    row = docs.select(F.struct("*").alias("__row"), F.col("doc_id").alias("__id"), text_hash.alias("__hash"))
    once = row.join(first, (F.col("__id") == F.col("__keep")) & (F.col("__hash") == F.col("__of")), "left_semi").dropDuplicates(["__id", "__hash"])
    return once.unionByName(row.where("__id is null")).select(*[F.col("__row")[n].alias(n) for n in docs.columns])
