"""Benchmark decontamination by spaced seeds over words."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curveloom.llm.common import bound_batches, n_words
from curveloom.llm.wordhash import WordHasher, mix

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Fixed masks by the fewest words of an item that they are for: words under 0 are ignored. Every placing of the substitutions
#: that SIMILARITY allows in so few words leaves one of the masks a place, and so in more words, up to the next masks' items.
MASKS = {
    5: ("1111", "11101", "11011", "10111"),
    7: ("11111", "111011", "110111"),
    10: ("1111011", "11001111", "110110011", "11110101", "10101111"),
    13: ("1111111", "11110111", "11101111", "1110100111"),
}
SHORT = min(MASKS)
#: A leak is this many words of an item (all, if it has fewer) of which at least SIMILARITY agree in place.
OVERLAP, SIMILARITY = 13, 0.8
#: Words of benchmark items that one broadcast index holds (about 100 MB in a worker); more items make more passes.
INDEX_WORDS = 500_000
#: Bytes of texts that are searched at once.
BATCH = 4 << 20


class SeedIndex:
    """Spaced-seed hashes of benchmark items, and the items' word hashes for verification."""

    def __init__(self, items: list[tuple[object, str | None]]):
        self.hasher = WordHasher(7, fold=True)
        self.ids, self.words = [], []
        for i, text in items:
            w = self.hasher((text or "").encode())[2]
            if len(w) >= SHORT:
                self.ids.append(i)
                self.words.append(w)
        self.tables = []
        for least, mask in ((n, m) for n, masks in MASKS.items() for m in masks):
            keys, item, place = [], [], []
            for k, w in enumerate(self.words):
                if least == max(n for n in MASKS if n <= len(w)):
                    h = self.seeds(w, mask)
                    keys.append(h)
                    item.append(np.full(len(h), k, np.int32))
                    place.append(np.arange(len(h), dtype=np.int32))
            if keys:
                keys, item, place = map(np.concatenate, (keys, item, place))
                order = np.argsort(keys, kind="stable")
                filled = np.zeros(1 << 20, bool)
                filled[keys >> np.uint64(44)] = True
                self.tables.append((mask, filled, keys[order], item[order], place[order]))

    @staticmethod
    def seeds(words: np.ndarray, mask: str) -> np.ndarray:
        n = len(words) - len(mask) + 1
        h = np.zeros(max(n, 0), np.uint64)
        for i, c in enumerate(mask):
            if c == "1" and n > 0:
                h += words[i : i + n] * np.uint64(2 * i + 3)
        return mix(h)

    def search(self, texts: list[bytes]) -> list[tuple[int, int, int, int, int, int]]:
        """(text, item, seed hits, words compared, words equal, first word of the text's overlap) of the best overlap per pair."""
        starts, _, words = self.hasher(np.frombuffer(b" ".join(texts), np.uint8))
        sizes = np.cumsum([0] + [len(t) + 1 for t in texts])
        first = np.searchsorted(starts, sizes)  # first word of each text
        found = _Diagonals()
        for mask, filled, keys, item, place in self.tables:
            h = self.seeds(words, mask)
            at = np.flatnonzero(filled[h >> np.uint64(44)])
            lo, hi = np.searchsorted(keys, h[at], "left"), np.searchsorted(keys, h[at], "right")
            text = np.searchsorted(first, at, "right") - 1
            fine = (hi > lo) & (at + len(mask) <= first[text + 1])
            found.add(at[fine], text[fine], lo[fine], hi[fine], item, place)
        best: dict[tuple[int, int], tuple[int, int, int, int]] = {}
        for t, k, shift, n in found.rows():
            w = self.words[k]
            lo, hi = max(0, int(first[t]) - shift), min(len(w), int(first[t + 1]) - shift)
            need = min(OVERLAP, len(w))
            if hi - lo < need:
                continue
            same = w[lo:hi] == words[shift + lo : shift + hi]
            sums = np.concatenate(([0], np.cumsum(same)))
            runs = sums[need:] - sums[:-need]
            top = int(np.argmax(runs))
            if runs[top] >= SIMILARITY * need:
                new = (int(same.sum()), lo - hi, n, shift + lo + top - int(first[t]))
                best[t, k] = max(best.get((t, k), new), new)
        return [(t, k, n, -size, equal, at) for (t, k), (equal, size, n, at) in sorted(best.items())]


class _Diagonals:
    """Counts seed hits by text, item and diagonal (place in the texts less place in the item).

    A seed that fits m places of the texts and n of an item gives m x n hits but m + n + (their spreads) diagonals at most. Where
    the hits of one text and item are many, their diagonals are counted by a convolution of the places instead of one by one.
    """

    MANY = 1 << 16

    def __init__(self):
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.held = 0

    def add(self, at: np.ndarray, text: np.ndarray, lo: np.ndarray, hi: np.ndarray, item: np.ndarray, place: np.ndarray) -> None:
        if not len(at):
            return
        run, which = np.unique(lo, return_inverse=True)  # a run of the table is one seed; many words may share it
        often = np.bincount(which) * (hi - lo)[np.unique(lo, return_index=True)[1]] > self.MANY
        rare = ~often[which]
        a, t, lo_, n = at[rare], text[rare], lo[rare], (hi - lo)[rare]
        ends = np.cumsum(n)
        for i, j in _cuts(ends, 1 << 20):
            m = n[i:j]
            row = np.repeat(np.arange(i, j), m)
            p = lo_[row] + np.arange(len(row)) - np.repeat(np.cumsum(m) - m, m)
            self._put(t[row], item[p], a[row] - place[p])
        for seed in np.flatnonzero(often):
            mine = which == seed
            a, t, p = at[mine], text[mine], np.arange(run[seed], hi[mine][0])
            for x in np.unique(t):
                for k in np.unique(item[p]):
                    self._spread(int(x), int(k), a[t == x], place[p[item[p] == k]])

    def _spread(self, text: int, item: int, a: np.ndarray, p: np.ndarray) -> None:
        if len(a) * len(p) <= self.MANY:
            d = (a[:, None] - p[None, :]).ravel()
            return self._put(np.full(len(d), text), np.full(len(d), item), d)
        x, y = np.zeros(int(np.ptp(a)) + 1), np.zeros(int(np.ptp(p)) + 1)
        x[a - a.min()] = 1
        y[p.max() - p] = 1
        size = 1 << (len(x) + len(y) - 1).bit_length()
        n = np.rint(np.fft.irfft(np.fft.rfft(x, size) * np.fft.rfft(y, size), size)[: len(x) + len(y) - 1]).astype(np.int64)
        d = np.flatnonzero(n)
        self._put(np.full(len(d), text), np.full(len(d), item), d + a.min() - p.max(), n[d])

    def _put(self, text: np.ndarray, item: np.ndarray, shift: np.ndarray, n: np.ndarray | None = None) -> None:
        pair = np.asarray(text, np.int64) << 32 | np.asarray(item, np.int64)
        keys = np.empty(len(pair), [("pair", np.int64), ("shift", np.int64)])
        keys["pair"], keys["shift"] = pair, shift
        self.keys.append(keys)
        self.counts.append(np.ones(len(pair), np.int64) if n is None else n)
        self.held += len(pair)
        if self.held > 1 << 21:
            self._merge()

    def _merge(self) -> None:
        keys, n = np.concatenate(self.keys), np.concatenate(self.counts)
        order = np.lexsort((keys["shift"], keys["pair"]))
        keys, n = keys[order], n[order]
        new = np.concatenate(([True], keys[1:] != keys[:-1]))
        self.keys, self.counts = [keys[new]], [np.add.reduceat(n, np.flatnonzero(new))]
        self.held = 0

    def rows(self) -> Iterator[tuple[int, int, int, int]]:
        """text, item, diagonal, hits."""
        if self.keys:
            self._merge()
            pair = self.keys[0]["pair"]
            yield from zip((pair >> 32).tolist(), (pair & 0xFFFFFFFF).tolist(), self.keys[0]["shift"].tolist(), self.counts[0].tolist())


def _cuts(ends: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose running total `ends` grows by about `most`."""
    at = 0
    while at < len(ends):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + most, "right")))
        yield at, to
        at = to


def _texts(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches that hold at most about BATCH bytes of text each, with the texts."""
    for batch in batches:
        texts = [t or b"" for t in batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()]
        at = size = 0
        for i, t in enumerate(texts):
            size += len(t)
            if size >= BATCH or i == len(texts) - 1:
                yield batch.slice(at, i + 1 - at), texts[at : i + 1]
                at, size = i + 1, 0


def _indexes(benchmark: DataFrame) -> Iterator:
    """Broadcast indexes that hold all items between them, each of at most about INDEX_WORDS words."""
    bound_batches(benchmark.sparkSession)
    sized = benchmark.select("item_id", "text", n_words(F.col("text")).alias("n"))
    total = sized.agg(F.sum("n")).first()[0] or 0
    passes = -(-total // INDEX_WORDS) or 1
    for k in range(passes):
        rows = sized.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k).select("item_id", "text").collect()
        yield benchmark.sparkSession.sparkContext.broadcast(SeedIndex([tuple(r) for r in sorted(rows, key=lambda r: (str(r[0]), r[1] or ""))]))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_hits, n_compared, n_equal, similarity, start for every document and benchmark item that it leaks.

    A document leaks an item if, along an alignment that a spaced seed has hit, 13 words of the item (all, if it has fewer) agree
    with the document's to at least 80 %. Case and the marks .,;:!?"() are ignored. The scan of the documents is map-only: seeds
    of all whole texts are looked up in the broadcast index. Null texts and items of fewer than 5 words leak nothing; repeated
    documents or items give a row each; empty tables give no rows.
    """
    kinds = dict(docs.dtypes)["doc_id"], dict(benchmark.dtypes)["item_id"]
    out = None
    for index in _indexes(benchmark):

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for part, texts in _texts(batches, "text"):
                if found := index.value.search(texts):
                    t, k, n, size, equal, at = map(list, zip(*found))
                    ids = pa.array([index.value.ids[x] for x in k], item_type)
                    ratio = np.array(equal) / np.array(size)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(t)), ids, *(pa.array(x, pa.int64()) for x in (n, size, equal)), pa.array(ratio), pa.array(at, pa.int64())],
                        ["doc_id", "item_id", "n_hits", "n_compared", "n_equal", "similarity", "start"],
                    )

        item_type = pa.int64() if kinds[1] == "bigint" else pa.int32() if kinds[1] == "int" else pa.string()
        schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, n_hits bigint, n_compared bigint, n_equal bigint, similarity double, start bigint"
        found = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return out


def drop_leaking(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the documents that leak a benchmark item, by the rule of leaks()."""
    for index in _indexes(benchmark):

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for part, texts in _texts(batches, "text"):
                keep = np.ones(len(texts), bool)
                keep[[t for t, *_ in index.value.search(texts)]] = False
                yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
