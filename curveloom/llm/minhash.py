"""Near-duplicate texts by five-word shingles: balls of SimHash fingerprints and MinHash bands find candidates, exact Jaccard
similarity decides."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curveloom.llm.common import Workspace, connected_components
from curveloom.llm.simhash import ball_edges, majority
from curveloom.llm.wordhash import WordHasher, mix

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE, SIMILARITY = 5, 0.8
#: Bands of so many least hashes: a pair at 0.8 has no band in common once in 16,000.
BANDS, ROWS = 32, 6
#: A cell compares at most about so many texts of a band, and so many shingles, with as many others.
TILE, CELL = 512, 1 << 21
#: Shingles of a cell that are counted at once.
COLUMNS = 1 << 12
#: Shingles whose hashes are taken at once.
BLOCK = 1 << 11
#: Bytes of texts whose words are hashed at once.
PIECE = 1 << 20


def shingles(texts: list[bytes | None], hasher: WordHasher) -> Iterator[np.ndarray]:
    """Of each text the distinct sorted hashes of its runs of 5 words (of all words, if there are fewer); A-Z count as a-z.

    Words of about PIECE bytes of texts are hashed at once.
    """
    at = size = 0
    for i, text in enumerate(texts):
        size += len(text or b"")
        if size >= PIECE or i == len(texts) - 1:
            part = [(t or b"").lower() for t in texts[at : i + 1]]
            starts, _, words = hasher(np.frombuffer(b" ".join(part), np.uint8))
            first = np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in part]))
            runs = _runs(words, SHINGLE)
            for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
                yield np.unique(runs[lo : hi - SHINGLE + 1] if hi - lo >= SHINGLE else _runs(words[lo:hi], hi - lo))
            at, size = i + 1, 0


def _runs(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the runs of k words; none of no words."""
    n = len(words) - k + 1 if k else 0
    h = np.zeros(max(n, 0), np.uint64)
    for i in range(k if n > 0 else 0):
        h = mix(h + words[i : i + n] * np.uint64(2 * i + 3))
    return h


class Bands:
    """Keys of the bands of a set of shingles. Least values are taken of 32-bit products, which are done in a few vector steps."""

    def __init__(self):
        rng = np.random.default_rng(11)
        self.factors = rng.integers(0, 1 << 31, (BANDS * ROWS, 1), np.uint32) * np.uint32(2) + np.uint32(1)
        self.masks = rng.integers(0, 1 << 32, (BANDS * ROWS, 1), np.uint32)

    def __call__(self, found: np.ndarray) -> np.ndarray:
        short = (found >> np.uint64(32)).astype(np.uint32)
        least = np.full(BANDS * ROWS, np.iinfo(np.uint32).max)
        for lo in range(0, len(short), BLOCK):
            least = np.minimum(least, ((short[None, lo : lo + BLOCK] ^ self.masks) * self.factors).min(1))
        key = np.arange(BANDS, dtype=np.uint64)
        for column in least.astype(np.uint64).reshape(BANDS, ROWS).T:
            key = mix(key + column)
        return key.view(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """id (doc_id, hash of the text), a, b (128 bits for the set of shingles), n, keys, fp (SimHash of the set) of every row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, bands = WordHasher(31), Bands()
        for batch in batches:
            a, b, n, keys, fps = [], [], [], [], []
            for s in shingles(batch.column(1).cast(pa.binary()).to_pylist(), hasher):
                a.append(s.sum(dtype=np.uint64))
                b.append(mix(s ^ np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64))
                n.append(len(s))
                keys.append(bands(s))
                fps.append(majority(s[lo : lo + BLOCK] for lo in range(0, len(s), BLOCK)))
            ends = np.arange(len(keys) + 1, dtype=np.int32) * BANDS
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys) if keys else np.empty(0, np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(np.array(x, np.uint64).view(np.int64)) for x in (a, b, n, fps)), lists, batch.column(2)],
                ["doc_id", "a", "b", "n", "fp", "keys", "hash"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), _hash().alias("hash"))
    rows = rows.mapInArrow(run, f"doc_id {kind}, a bigint, b bigint, n bigint, fp bigint, keys array<bigint>, hash bigint")
    return rows.select(F.struct("doc_id", "hash").alias("id"), "a", "b", "n", "fp", "keys")


def _hash():
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def shingle_sets(texts: DataFrame) -> DataFrame:
    """(id, set) of texts(id, text): the sorted 64-bit hashes of the text's shingles, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(31)
        for batch in batches:
            sets = [s.tobytes() for s in shingles(batch.column(1).cast(pa.binary()).to_pylist(), hasher)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["id", "set"])

    return texts.select("id", "text").mapInArrow(run, f"id {dict(texts.dtypes)['id']}, set binary")


def alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(u, v) of pairs whose sets(id, set) have 80 % of their shingles in common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fine = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                s, t = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(s, t, assume_unique=True))
                fine.append(common >= SIMILARITY * (len(s) + len(t) - common))
            yield batch.select([0, 1]).filter(pa.array(fine, pa.bool_()))

    kind = dict(pairs.dtypes)["u"]
    one, two = (sets.select(F.col("id").alias(c), F.col("set").alias(f"s{c}")) for c in ("u", "v"))
    rows = pairs.join(one, "u").join(two, "v").select("u", "v", "su", "sv")
    return rows.mapInArrow(run, f"u {kind}, v {kind}")


def _classes_of(ws: Workspace, edges: DataFrame | None) -> DataFrame:
    """(id, class) of the nodes that edges(u, v) join."""
    found = connected_components(ws, edges)
    return ws.stage(found.select(F.col("node").alias("id"), F.col("component").alias("class")), "classes")


def _open_bands(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """rows(key, id, n) of the bands that hold more than one class, with `class` (a node without links is its own)."""
    told = rows.join(classes, "id", "left").select("key", "id", "n", F.coalesce("class", "id").alias("class"))
    several = told.groupBy("key").agg(F.min("class").alias("a"), F.max("class").alias("b")).where("a <> b").select("key")
    return told.join(several, "key", "left_semi")


def _cells(told: DataFrame) -> DataFrame:
    """told(key, id, n, class) dealt to cells (key, i, j), side, so that any two texts of a band and unlike classes meet in one.

    A small band is one cell. In others the texts outside the band's largest class are dealt to tiles by hash, which meet each
    other and the tiles of the largest class; its own texts need not meet. In a cell of two tiles, side tells them apart.
    """
    sizes = told.groupBy("key", "class").agg(F.count("*").alias("c"), F.max("n").alias("most"))
    sizes = sizes.groupBy("key").agg(F.sum("c").alias("all"), F.max("most").alias("most"), F.max(F.struct("c", "class")).alias("main"))
    tile = F.least(F.lit(TILE), F.greatest(F.lit(1), F.floor(F.lit(CELL) / F.col("most"))))
    sizes = sizes.select("key", "all", tile.alias("tile"), F.col("main.c").alias("mains"), F.col("main.class").alias("main"))
    sizes = sizes.select("key", "main", (F.col("all") <= F.col("tile")).alias("small"), *[F.ceil(x / F.col("tile")).alias(name) for x, name in ((F.col("all") - F.col("mains"), "tr"), (F.col("mains"), "tm"))])
    cell = lambda i, j, side: F.struct(i.cast("bigint").alias("i"), j.cast("bigint").alias("j"), side.cast("int").alias("side"))
    rows = told.join(sizes, "key")
    rest, at = F.col("class") != F.col("main"), F.col("at")
    rows = rows.withColumn("at", F.pmod(F.xxhash64("id"), F.when(rest, F.col("tr")).otherwise(F.col("tm"))))
    met = lambda j: F.when(j < F.col("tr"), cell(F.least(at, j), F.greatest(at, j), at > j)).otherwise(cell(at, j, F.lit(0)))
    mine = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("tr") + F.col("tm") - 1), met)
    theirs = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("tr") - 1), lambda i: cell(i, F.col("tr") + at, F.lit(1)))
    places = F.when(F.col("small"), F.array(cell(F.lit(0), F.lit(0), F.lit(0)))).when(rest, mine).otherwise(theirs)
    return rows.select("key", "id", "class", F.explode(places).alias("cell")).select("key", "cell.*", "id", "class")


def _common(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many members the sets numbered x have in common with those numbered y."""
    values, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.concatenate(([True], values[1:] != values[:-1]))
    column = np.cumsum(new) - 1
    several = np.bincount(column)[column] > 1
    owner, column = owner[several], (np.cumsum(new & several) - 1)[several]
    out = np.zeros((len(x), len(y)), np.float32)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, (lo, lo + COLUMNS))
        there = np.zeros((len(sets), min(COLUMNS, int(column[b - 1]) - lo + 1)), np.float32)
        there[owner[a:b], column[a:b] - lo] = 1
        out += there[x] @ there[y].T
    return out


def _joining(sets: list[np.ndarray], classes: list, side: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of sets that are alike and join all classes of the cell that such pairs join; fewer than there are classes."""
    numbers: dict = {}
    of = np.array([numbers.setdefault(c, len(numbers)) for c in classes])
    x, y = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if 0 < side.sum() < len(side) else (np.arange(len(sets)),) * 2
    n = np.array([len(s) for s in sets], float)
    common = _common(sets, x, y).astype(float)
    fine = common >= SIMILARITY * (n[x][:, None] + n[y][None, :] - common)
    rows, columns = np.nonzero(fine & (of[x][:, None] != of[y][None, :]))
    u, v = x[rows], y[columns]
    first = np.unique(np.minimum(of[u], of[v]) * len(numbers) + np.maximum(of[u], of[v]), return_index=True)[1]
    root, out = list(range(len(numbers))), []

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    for k in first.tolist():
        c, d = find(int(of[u[k]])), find(int(of[v[k]]))
        if c != d:
            root[c] = d
            out.append((int(u[k]), int(v[k])))
    return out


def alike_in_bands(told: DataFrame, sets: DataFrame) -> DataFrame:
    """(u, v), alike, that join the classes of told(key, id, n, class) of which two texts share a band and 80 % of their shingles.

    All texts of a band are compared exactly with all of other classes, in cells of a bounded size, and a cell gives fewer pairs
    than it has classes. So the work on a band grows with the square of the texts that stay unlike, as it must, though
    never in one task and without pairs between tasks.
    """

    def run(cell: pa.Table) -> pa.Table:
        ids = cell.column("id").combine_chunks()
        packed = [np.frombuffer(s, np.uint64) for s in cell.column("set").to_pylist()]
        classes = [tuple(c.values()) for c in cell.column("class").to_pylist()]
        pairs = np.array(_joining(packed, classes, cell.column("side").to_numpy()), np.int64).reshape(-1, 2)
        return pa.table({"u": ids.take(pa.array(pairs[:, 0])), "v": ids.take(pa.array(pairs[:, 1]))})

    kind = dict(told.dtypes)["id"]
    rows = _cells(told).join(sets, "id").select("key", "i", "j", "side", "id", "class", "set")
    return rows.groupBy("key", "i", "j").applyInArrow(run, f"u {kind}, v {kind}")


def similar_edges(ws: Workspace, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(u, v) that join what nodes(id, n, fp, keys) share a ball or a band and have 80 % of their shingles in common.

    Fingerprints within two bits meet in a ball as in simhash.ball_edges, which finds long texts with few changes; at 0.8 most
    differ in 6 to 11 bits, so bands are the second key. What meets in either way is linked only if the shingles say so. First each
    text of a band is compared with the one of it that shares most bands with others, which settles most bands: texts of one
    class need no further comparison with each other. In the bands that still hold several classes all texts of unlike classes
    are compared.
    """
    rows = nodes.select("id", "n", F.explode("keys").alias("key"))
    shared = rows.join(rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "key")
    shared = ws.stage(shared, "shared")
    # What stands in the middle of a group shares most bands with most texts, so it leads: the others are likely alike to it.
    met = shared.groupBy("id").agg((-F.sum("size")).alias("rank"))
    rows = ws.stage(shared.join(met, "id").select("key", "id", "n", "rank"), "bands")
    ws.drop(shared)
    balls = ws.stage(ball_edges(nodes.select("fp", F.col("id").alias("node"))), "balls")
    wanted = rows.select("id").unionByName(balls.select(F.explode(F.array("u", "v")).alias("id"))).distinct().select(F.col("id.doc_id").alias("__doc"), F.col("id.hash").alias("__hash"))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"), _hash().alias("hash"))
    texts = texts.join(wanted, (F.col("doc_id") == F.col("__doc")) & (F.col("hash") == F.col("__hash")), "left_semi")
    sets = texts.groupBy(F.struct("doc_id", "hash").alias("id")).agg(F.any_value("text").alias("text"))
    sets = ws.stage(shingle_sets(sets), "sets")
    near = F.least("n", "o") >= F.lit(SIMILARITY) * F.greatest("n", "o")
    lead = rows.groupBy("key").agg(F.min(F.struct("rank", "id", "n")).alias("least"))
    stars = rows.join(lead, "key").where(F.col("id") != F.col("least.id")).withColumn("o", F.col("least.n")).where(near)
    pairs = stars.select(F.greatest("id", "least.id").alias("u"), F.least("id", "least.id").alias("v"))
    pairs = ws.stage(pairs.unionByName(balls).distinct(), "pairs")
    edges = ws.stage(alike(pairs, sets), "alike")
    ws.drop(pairs, balls)
    ws.release()
    left = ws.stage(_open_bands(rows, _classes_of(ws, edges)), "open")
    ws.drop(rows)
    found = ws.stage(alike_in_bands(left, sets), "found")
    ws.drop(left)
    ws.release()
    return edges.unionByName(found)


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """docs without near-duplicates: of every component of texts that have 80 % of their five-word shingles in common, the row of
    the smallest doc_id stays (one, if it repeats with the same text).

    Texts are compared exactly once a ball of fingerprints or a band brings them together. Null, empty and blank texts have no shingles: they are copies
    of each other. Of fewer than five words all are one shingle. Long texts are read whole. Rows that share a doc_id with
    different texts are documents of their own; rows whose id is null are kept; all columns stay, whatever their names; an empty
    table gives no rows.
    """
    ws = Workspace(docs.sparkSession, "minhash")
    marked = ws.stage(signatures(docs.where("doc_id is not null")), "signatures")
    nodes = ws.stage(marked.groupBy("a", "b", "n").agg(F.min("id").alias("id"), F.any_value("keys").alias("keys"), F.any_value("fp").alias("fp")), "nodes")
    edges = similar_edges(ws, nodes.where("n > 0"), docs)
    keep = nodes.select("id")
    gone = connected_components(ws, edges).where("node <> component").select(F.col("node").alias("id"))
    keep = ws.stage(keep.join(gone, "id", "left_anti").select(F.col("id.doc_id").alias("__doc"), F.col("id.hash").alias("__of")), "keep")
    row = docs.select(F.struct("*").alias("__row"), F.col("doc_id").alias("__id"), _hash().alias("__hash"))
    once = row.join(keep, (F.col("__id") == F.col("__doc")) & (F.col("__hash") == F.col("__of")), "left_semi").dropDuplicates(["__id", "__hash"])
    return once.unionByName(row.where("__id is null")).select(*[F.col("__row")[n].alias(n) for n in docs.columns])
