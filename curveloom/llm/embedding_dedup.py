"""Near-duplicate vectors by sorted projection passes."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curveloom.llm.common import Workspace, connected_components, global_rank

cloudpickle.register_pickle_by_value(sys.modules[__name__])

THRESHOLD = 0.93
#: Sign bits of a pass's key, neighbours compared after each vector, vectors of a block, chance that a round misses a pair at the
#: threshold among evenly spread vectors. Rounds go on until one joins nothing more.
BITS, WINDOW, BLOCK, MISS = 48, 64, 1024, 0.02
#: Vectors of a tile when the pairs inside a component are counted.
TILE = 512


def usable(v: Column) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    fine = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(math.inf)), F.lit(False)))
    return F.coalesce(fine & F.exists(v, lambda x: x != 0), F.lit(False))


def passes_needed(rows: int, threshold: float = THRESHOLD, window: int = WINDOW, miss: float = MISS) -> int:
    """Passes after which a pair at the threshold is missed with probability `miss` at most, among `rows` vectors of one label.

    In a pass the pair meets if its keys share the log2(rows / window) bits after which about `window` vectors are left.
    """
    bits = max(1.0, math.log2(max(rows, 1) / window) + 1)
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return max(4, math.ceil(math.log(miss) / math.log1p(-meet)))


def unit(vectors: list | np.ndarray) -> np.ndarray:
    x = np.asarray(vectors, np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def keys_of(x: np.ndarray, passes: int, first: int = 0) -> np.ndarray:
    """Non-negative keys, one row per vector and a column per pass: the signs of random projections, first one highest."""
    planes = np.random.default_rng((x.shape[1], first)).standard_normal((passes, BITS, x.shape[1]))
    weights = (1 << np.arange(BITS - 1, -1, -1)).astype(np.int64)
    return np.stack([((x @ p.T) > 0) @ weights for p in planes], 1)


def _stack(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and unit vectors of a batch's lists by their dimension."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.values.to_numpy(zero_copy_only=False)
    starts = column.offsets.to_numpy()[:-1]
    groups = []
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        groups.append((rows, unit(values[starts[rows][:, None] + np.arange(d)])))
    return groups


def packed(x: np.ndarray) -> list[bytes]:
    """Unit vectors in a byte per component: the scale, the length of what rounding took away, and the rounded components."""
    scale = np.abs(x).max(1) / 127
    q = np.rint(x / scale[:, None]).astype(np.int8)
    rest = np.linalg.norm(x - q * scale[:, None], axis=1)
    return [h.tobytes() + r.tobytes() for h, r in zip(np.stack((scale, rest), 1), q)]


def unpacked(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Approximate unit vectors, and for each the part of the bound on the error of a cosine that is its own: that of a pair is
    the sum of both."""
    raw = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)
    scale, rest = np.ascontiguousarray(raw[:, :16]).view(np.float64).T
    # (1 + a) b + (1 + b) a + ab <= a + b + 3 ab, and 3 ab <= 1.5 (a + b) max
    return raw[:, 16:].view(np.int8) * scale[:, None], rest * (1 + 1.5 * rest.max()) + 1e-12


def with_keys(vectors: DataFrame, passes: int, first: int = 0) -> DataFrame:
    """vectors(id, label, v) once per pass: pass, label, dim, key, id and the vector in a byte per component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _stack(batch.column(2)):
                part, keys, q = batch.take(pa.array(rows)), keys_of(x, passes, first), pa.array(packed(x), pa.binary())
                for p in range(passes):
                    n = len(rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, p, np.int32)), part.column(1), pa.array(np.full(n, x.shape[1], np.int32)), pa.array(keys[:, p]), part.column(0), q],
                        ["pass", "label", "dim", "key", "id", "q"],
                    )

    kinds = dict(vectors.dtypes)
    return vectors.select("id", "label", "v").mapInArrow(run, f"pass int, label {kinds['label']}, dim int, key bigint, id {kinds['id']}, q binary")


def lowest_of_linked(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n places the lowest that it reaches through the links i-j."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def near_pairs(ws: Workspace, vectors: DataFrame, passes: int, first: int, threshold: float = THRESHOLD, window: int = WINDOW) -> DataFrame:
    """(u, v, sure) of one round of passes: pairs within `window` whose cosine surely reaches the threshold, united within a block
    so that a group of copies gives an edge for each member, and, each by itself, pairs for which the bytes leave it open.

    All passes are sorted at once: vectors get a global rank by (pass, label, dimension, key, id) and are dealt into blocks of
    equal size by it, each with the first `window` vectors of the next block, so that no label or key fills a task.
    """
    ranked = global_rank(ws, with_keys(vectors, passes, first), [F.col(c) for c in ("pass", "label", "dim", "key", "id")], "ranked")
    own = F.floor(F.col("rank") / BLOCK)
    where = F.when((F.col("rank") % BLOCK < window) & (own > 0), F.array(own, own - 1)).otherwise(F.array(own))
    dealt = ranked.select("*", F.explode(where).alias("block"))
    kind = dict(vectors.dtypes)["id"]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rank", kind="stable")
        held = int((pdf["rank"].to_numpy() // BLOCK == pdf["block"].to_numpy()).sum())
        ids, rows, out = pdf["id"].to_numpy(), pdf["q"].to_numpy(), []
        for _, at in pdf.reset_index(drop=True).groupby(["pass", "label", "dim"], sort=False).indices.items():
            x, slack = unpacked(list(rows[at]))
            n, sure, open_ = len(at), [], []
            for lo in range(0, n, 256):  # a band of the product, not the whole
                hi, end = min(n, lo + 256), min(n, lo + 256 + window)
                dot, error = x[lo:hi] @ x[lo:end].T, slack[lo:hi, None] + slack[lo:end]
                i, j = np.nonzero(dot + error >= threshold)
                near = (j > i) & (j - i <= window) & (at[lo + i] < held)
                i, j = i[near], j[near]
                safe = dot[i, j] - error[i, j] >= threshold
                sure.append(np.stack((lo + i[safe], lo + j[safe])))
                open_.append(np.stack((lo + i[~safe], lo + j[~safe])))
            low = lowest_of_linked(n, *np.concatenate(sure, 1))
            moved = np.flatnonzero(low != np.arange(n))
            i, j = np.concatenate(open_, 1)
            apart = low[i] != low[j]
            out.append((ids[at[np.concatenate((moved, i[apart]))]], ids[at[np.concatenate((low[moved], j[apart]))]], np.arange(len(moved) + apart.sum()) < len(moved)))
        u, v, sure = (np.concatenate(c) for c in zip(*out)) if out else (ids[:0], ids[:0], np.zeros(0, bool))
        return pd.DataFrame({"u": np.maximum(u, v), "v": np.minimum(u, v), "sure": sure})

    return dealt.groupBy("block").applyInPandas(run, f"u {kind}, v {kind}, sure boolean").groupBy("u", "v").agg(F.max("sure").alias("sure"))


def exact_pairs(pairs: DataFrame, vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of pairs(u, v) whose vectors(id, v) reach the threshold in double precision."""
    kind = dict(pairs.dtypes)["u"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for (rows, x), (_, y) in zip(_stack(batch.column(2)), _stack(batch.column(3))):
                keep[rows] = (x * y).sum(1) >= threshold
            yield batch.select([0, 1]).filter(pa.array(keep))

    one, two = (vectors.select(F.col("id").alias(c), F.col("v").alias(f"__{c}")) for c in ("u", "v"))
    return pairs.join(one, "u").join(two, "v").select("u", "v", "__u", "__v").mapInArrow(run, f"u {kind}, v {kind}")


def linked_classes(ws: Workspace, vectors: DataFrame, threshold: float = THRESHOLD, window: int = WINDOW) -> DataFrame:
    """(node, component) of what vectors(id, label, v) links, staged: rounds of sorted projection passes, each with projections of
    its own, until a round joins no two classes that were apart.

    Where many vectors crowd into few keys, a window holds a part of a vector's partners only; there every round finds more, so
    the rounds follow the density that is met instead of an assumed one.
    """
    most = vectors.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    passes = passes_needed(most, threshold, window)
    classes, turn = None, 0
    while True:
        pairs = ws.stage(near_pairs(ws, vectors, passes, turn, threshold, window), "pairs")
        turn += 1
        apart = pairs
        if classes is not None:
            own = lambda c: classes.select(F.col("node").alias(c), F.col("component").alias(f"__{c}"))  # noqa: E731, B023
            told = pairs.join(own("u"), "u", "left").join(own("v"), "v", "left")
            apart = told.where(F.coalesce("__u", "u") != F.coalesce("__v", "v")).select("u", "v", "sure")
        links = apart.where("sure").select("u", "v").unionByName(exact_pairs(apart.where("not sure").select("u", "v"), vectors, threshold))
        links = ws.stage(links, "links")
        if not links.limit(1).count():
            ws.drop(pairs)
            return links.select(F.col("u").alias("node"), F.col("v").alias("component")) if classes is None else classes
        if classes is not None:
            links = links.unionByName(classes.where("node <> component").select(F.col("node").alias("u"), F.col("component").alias("v")))
        classes = ws.stage(connected_components(ws, links), "parts")
        ws.drop(pairs)


def count_links(ws: Workspace, members: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(id, links) of members(id, component, dim, weight, v): the weight of the other members of the component that it links with.

    Exact: a component is cut into tiles of about TILE vectors by hash, and every pair of tiles is one task of matrix products
    that returns counts, never pairs; so a component of any size is spread over many tasks.
    """
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    cut = members.join(sizes, "component").withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda o: F.struct(F.least("tile", o).alias("p"), F.greatest("tile", o).alias("q")))
    dealt = cut.select("id", "component", "tile", "weight", "v", F.explode(pairs).alias("pq")).select("*", "pq.p", "pq.q").drop("pq")
    kind = dict(members.dtypes)["id"]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        p, q = int(pdf["p"].iloc[0]), int(pdf["q"].iloc[0])
        tile, w, links = pdf["tile"].to_numpy(), pdf["weight"].to_numpy(), np.zeros(len(pdf), np.int64)
        x = unit(np.stack(pdf["v"].to_numpy()))
        left, right = np.flatnonzero(tile == p), np.flatnonzero(tile == q)
        for lo in range(0, len(left), 256):
            i = left[lo : lo + 256]
            near = x[i] @ x[right].T >= threshold
            near &= i[:, None] != right[None, :]
            links[i] += near @ w[right]
            if p != q:
                links[right] += w[i] @ near
        return pd.DataFrame({"id": pdf["id"], "links": links})

    # Dealt out by tile pairs on purpose: the join's partitioning by component would do, with a whole component in a task.
    counted = dealt.repartition(F.col("component"), F.col("p"), F.col("q")).groupBy("component", "p", "q").applyInPandas(run, f"id {kind}, links bigint")
    return counted.groupBy("id").agg(F.sum("links").alias("links"))


def near_duplicate_vectors(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of rows(vec_id, embedding, label).

    Two vectors link if their labels are equal and not null, their lengths are equal and their cosine in double precision
    reaches the threshold. Vectors that are null, empty, zero, or hold a null or non-finite component, and rows with a null
    vec_id, link with nothing. Equal vectors of a label are one node with a weight, so copies cost nothing; rows that repeat a
    vec_id with other vectors share a component. component_id is the smallest vec_id reachable. An empty table gives no rows.
    """
    ws = Workspace(rows.sparkSession, "embeddings")
    fine = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("embedding"))
    all_rows = rows.select("vec_id", "label", "embedding", fine.alias("__fine"))
    nodes = all_rows.where("__fine").groupBy("label", F.col("embedding").alias("v")).agg(F.min("vec_id").alias("id"), F.count("*").alias("weight"))
    nodes = ws.stage(nodes, "nodes")
    parts = linked_classes(ws, nodes, threshold)
    members = nodes.join(parts, F.col("id") == F.col("node")).select("id", "component", "weight", "v")
    links = ws.stage(count_links(ws, members, threshold), "links")
    about = (
        nodes.join(parts, F.col("id") == F.col("node"), "left")
        .join(links.withColumnRenamed("id", "__id"), F.col("id") == F.col("__id"), "left")
        .select(
            F.col("label").alias("__label"),
            F.col("v").alias("__v"),
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).cast("bigint").alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    linked = all_rows.where("__fine").join(about, (F.col("label") == F.col("__label")) & (F.col("embedding") == F.col("__v")))
    alone = all_rows.where("not __fine").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.select("vec_id", "n_links", "component_id").unionByName(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
