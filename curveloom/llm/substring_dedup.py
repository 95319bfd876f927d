"""Incremental removal of repeated passages with a log-structured index of window fingerprints."""

from __future__ import annotations

import hashlib
import json
import sys
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from curveloom.llm.common import Workspace, partitions
from curveloom.llm.wordhash import WordHasher, mix

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words of a window, and of the shorter gram whose smallest hash in a window is the window's anchor.
WINDOW, GRAM = 20, 8
#: Runs of one level that are compacted into one of the next.
FANOUT = 2
#: A run's rows of one gram are spread over this many keys by their span, so that a frequent gram fills no bucket.
SPREAD = 8
#: Bytes of text hashed at once; anchors or windows compared inside a task before they are shuffled.
PIECE, CHUNK = 4 << 20, 1_000_000
#: Rows without an id count as one document after all others.
NO_ID = (1 << 63) - 1


class Rolling:
    """Hashes of ranges of words from prefix sums."""

    def __init__(self, words: np.ndarray, base: int):
        base = np.uint64(base * 2 + 1)
        up = np.full(len(words) + 1, base)
        down = np.full(len(words) + 1, np.uint64(pow(int(base), -1, 1 << 64)))
        up[0] = down[0] = 1
        self.down = np.cumprod(down)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * np.cumprod(up)[:-1])))

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return mix((self.sums[hi] - self.sums[lo]) * self.down[lo])


BASES = (0x3C6EF372FE94F82B, 0x1F83D9ABFB41BD6B)


def pieces(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about PIECE bytes each; a longer text is a piece of its own."""
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= PIECE or i == len(texts) - 1:
            yield lo, i + 1
            lo, size = i + 1, 0


class Hashers:
    """Two independently seeded hashes of each word; 64 bits of each stand for words in all comparisons."""

    def __init__(self):
        self.one, self.two = WordHasher(21), WordHasher(22)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Both hashes of all words of the texts, and the first word of each text with the number of words at the end."""
        buf = np.frombuffer(b" ".join(texts), np.uint8)
        starts, _, words = self.one(buf)
        return words, self.two(buf)[2], np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in texts]))


def anchors(words: np.ndarray, others: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """fp, span, text, at, n: an anchor is the smallest gram of n consecutive windows, those that start at word `at` of the text.

    fp is the gram's hash and span that of all words the n windows cover, from the words' other hash, with the anchor's place in
    them. Equal windows have equal grams, so they have the same anchor at the same place.
    """
    last = len(words) - WINDOW
    if last < 0:
        none = np.empty(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none
    roll = Rolling(words, BASES[0])
    i = np.arange(len(words) - GRAM + 1)
    grams = roll(i, i + GRAM)
    best, off = grams[: last + 1].copy(), np.zeros(last + 1, np.int64)
    for j in range(1, WINDOW - GRAM + 1):
        less = grams[j : j + last + 1] < best
        best[less] = grams[j : j + last + 1][less]
        off[less] = j
    start = np.arange(last + 1)
    text = np.searchsorted(first, start, "right") - 1
    start = start[start + WINDOW <= first[text + 1]]
    if not len(start):
        return best[:0], best[:0], start, start, start
    place = start + off[start]
    new = np.concatenate(([True], (np.diff(place) != 0) | (np.diff(start) != 1)))
    lo = start[new]
    n = np.diff(np.concatenate((np.flatnonzero(new), [len(start)])))
    at = place[new]
    span = mix(Rolling(others, BASES[1])(lo, lo + n + WINDOW - 1) + (at - lo).astype(np.uint64) * np.uint64(64) + n.astype(np.uint64))
    return best[lo], span, text[lo], lo - first[text[lo]], n


def _local(keys: tuple[np.ndarray, np.ndarray], doc: np.ndarray, at: np.ndarray, row: np.ndarray) -> np.ndarray:
    """For rows of a key by (doc, at): 0 for those at the first doc and at, 1 for later ones, 2 for one that repeats another."""
    order = np.lexsort((row, at, doc, keys[1], keys[0]))
    a, b, d, s, r = (x[order] for x in (*keys, doc, at, row))
    same = np.concatenate(([False], (a[1:] == a[:-1]) & (b[1:] == b[:-1])))
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(a))))
    first = (d == d[head]) & (s == s[head])
    again = np.concatenate(([False], same[1:] & (d[1:] == d[:-1]) & (s[1:] == s[:-1]) & (r[1:] == r[:-1])))
    out = np.empty(len(a), np.int64)
    out[order] = np.where(again, 2, np.where(first, 0, 1))
    return out


ROW = "doc bigint, row bigint, at int, n int, repeated boolean"


def _emit(parts: list[tuple[np.ndarray, ...]], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows (key, key, doc, row, at, n) with whether an earlier place of this chunk has the key; equal rows are left out."""
    if not parts:
        return
    a, b, doc, row, at, n = (np.concatenate(x) for x in zip(*parts))
    state = _local((a, b), doc, at, row)
    keep = np.flatnonzero(state < 2)
    for lo in range(0, len(keep), 100_000):
        k = keep[lo : lo + 100_000]
        columns = [a[k].view(np.int64), b[k].view(np.int64), doc[k], row[k], at[k].astype(np.int32), n[k].astype(np.int32), state[k] == 1]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], [*names, "doc", "row", "at", "n", "repeated"])


def find_anchors(docs: DataFrame) -> DataFrame:
    """fp, span, doc, row, at, n, repeated of every anchor of docs(doc, row, text); repeated: an earlier one lies in the same
    chunk of a task, so that it need not be shuffled to be told."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashers, held, size = Hashers(), [], 0
        for batch in batches:
            ids, rows = (batch.column(k).to_numpy() for k in (0, 1))
            texts = [t or b"" for t in batch.column(2).cast(pa.binary()).to_pylist()]
            for lo, hi in pieces(texts):
                fp, span, text, at, n = anchors(*hashers(texts[lo:hi]))
                held.append((fp, span, ids[lo:hi][text], rows[lo:hi][text], at, n))
                size += len(fp)
                if size >= CHUNK:
                    yield from _emit(held, ["fp", "span"])
                    held, size = [], 0
        yield from _emit(held, ["fp", "span"])

    return docs.select("doc", "row", "text").mapInArrow(run, f"fp bigint, span bigint, {ROW}")


def find_windows(marked: DataFrame) -> DataFrame:
    """h1, h2, doc, row, at, n (1), repeated of the windows at `spans` (at, n) of marked(doc, row, text, spans)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashers, held, size = Hashers(), [], 0
        for batch in batches:
            ids, rows = (batch.column(k).to_numpy() for k in (0, 1))
            texts = [t or b"" for t in batch.column(2).cast(pa.binary()).to_pylist()]
            spans = batch.column(3)
            flat, ends = spans.values, spans.offsets.to_numpy()
            at, n = flat.field(0).to_numpy().astype(np.int64), flat.field(1).to_numpy().astype(np.int64)
            for lo, hi in pieces(texts):
                words, others, first = hashers(texts[lo:hi])
                pick = slice(ends[lo], ends[hi])
                of = np.repeat(np.arange(hi - lo), np.diff(ends[lo : hi + 1]))
                of, start, count = np.repeat(of, n[pick]), at[pick], n[pick]
                steps = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                start = np.repeat(start, count) + steps
                here = start + first[of]
                h1, h2 = (Rolling(w, b)(here, here + WINDOW) for w, b in zip((words, others), BASES))
                held.append((h1, h2, ids[lo:hi][of], rows[lo:hi][of], start, np.ones(len(start), np.int64)))
                size += len(h1)
                if size >= CHUNK:
                    yield from _emit(held, ["h1", "h2"])
                    held, size = [], 0
        yield from _emit(held, ["h1", "h2"])

    return marked.select("doc", "row", "text", "spans").mapInArrow(run, f"h1 bigint, h2 bigint, {ROW}")


def numbered(docs: DataFrame) -> DataFrame:
    """docs(doc, text) with `row`, a hash of the text: it tells rows of one doc apart, and rows equal in both are alike in all."""
    text = F.col("text").cast("string")
    return docs.select("doc", F.xxhash64(F.coalesce(text, F.lit(""))).alias("row"), text.alias("text"))


@contextmanager
def merging(spark: SparkSession):
    """Lets joins use the buckets and the order that runs are written in, and merge instead of broadcasting, whatever a run's size
    is taken for; the session's settings are put back after."""
    wanted = {
        "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


#: The two tables of a run: columns, the keys of its buckets and its order.
SPANS = ("fp bigint, s int, span bigint, doc bigint, row bigint, at int, n int, old boolean, fresh boolean, lead boolean", ("fp", "s"), ("fp", "s", "span"))
HEADS = ("fp bigint, a bigint, b bigint", ("fp",), ("fp",))


class FingerprintIndex:
    """Sorted immutable runs of the fingerprints of all windows seen, for deduplicating batch after batch.

    A run is two bucketed tables under the index's folder, each bucket one sorted file. `spans` holds the anchors of a batch by
    fp and span; its rows with `lead` are the distinct spans that the batch brought. `heads` holds the least and the greatest
    span of each fp. add() merge-joins them with the batch, whose rows alone are shuffled, and FANOUT runs of a level are merged
    into one of the next, bucket by bucket. A manifest in the folder names the runs: FingerprintIndex.open() goes on from there
    in another session.
    """

    def __init__(self, spark: SparkSession, ws: Workspace | None = None, buckets: int | None = None):
        self.spark = spark
        self.ws = ws or Workspace(spark, "fingerprints")
        self.buckets = buckets or partitions(spark)
        self.runs: list[tuple[int, str]] = []
        self.version = 0

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> FingerprintIndex:
        """The index whose runs lie under root, as the newest manifest there names them."""
        ws = Workspace(spark, "fingerprints", root=root)
        names = sorted(n for n in ws.names() if n.startswith("manifest-"))
        if not names:
            raise FileNotFoundError(f"no index in {root}")
        found = json.loads(ws.read_text(names[-1]))
        index = cls(spark, ws, found["buckets"])
        index.version, index.runs = found["version"], [(level, name) for level, name in found["runs"]]
        for _, name in index.runs:
            for kind, shape in (("spans", SPANS), ("heads", HEADS)):
                columns, keys, order = shape
                spark.sql(
                    f"CREATE TABLE IF NOT EXISTS {name}_{kind} ({columns}) USING parquet CLUSTERED BY ({', '.join(keys)}) "
                    f"SORTED BY ({', '.join(order)}) INTO {index.buckets} BUCKETS LOCATION '{root}/{name}_{kind}'"
                )
        return index

    def _manifest(self) -> None:
        self.version += 1
        self.ws.write_text(f"manifest-{self.version:08d}.json", json.dumps({"version": self.version, "buckets": self.buckets, "runs": self.runs}))

    def _write(self, rows: DataFrame, name: str, shape: tuple) -> DataFrame:
        """The bucketed table `name` of rows, which already lie in partitions by its keys."""
        _, keys, order = shape
        rows.write.bucketBy(self.buckets, *keys).sortBy(*order).format("parquet").option("path", f"{self.ws.root}/{name}").saveAsTable(name)
        return self.spark.table(name)

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.ws.remove(f"{self.ws.root}/{name}")

    def spans(self, run: str) -> DataFrame:
        return self.spark.table(f"{run}_spans").where("lead").select("fp", "s", "span", "doc", "row", "at", "n")

    def heads(self, run: str) -> DataFrame:
        return self.spark.table(f"{run}_heads")

    def compact(self) -> None:
        """Merge the newest runs while FANOUT of them have one level. Readers of the former manifest's runs see them until then."""
        while len(self.runs) >= FANOUT and len({level for level, _ in self.runs[-FANOUT:]}) == 1:
            level, merged = self.runs[-1][0], [name for _, name in self.runs[-FANOUT:]]
            name = f"cl_{uuid.uuid4().hex}"
            with merging(self.spark):
                # The runs' spans are disjoint: a batch's are only those that no run has held before.
                rows = self.spans(merged[0])
                for other in merged[1:]:
                    b = self.spans(other).select("fp", "s", "span", *[F.col(c).alias(f"__{c}") for c in ("doc", "row", "at", "n")])
                    rows = rows.join(b, ["fp", "s", "span"], "full").select("fp", "s", "span", *[F.coalesce(c, f"__{c}").alias(c) for c in ("doc", "row", "at", "n")])
                self._write(rows.select("*", F.lit(False).alias("old"), F.lit(True).alias("fresh"), F.lit(True).alias("lead")), f"{name}_spans", SPANS)
                rows = self.heads(merged[0])
                for other in merged[1:]:
                    b = self.heads(other).select("fp", F.col("a").alias("__a"), F.col("b").alias("__b"))
                    rows = rows.join(b, "fp", "full").select("fp", F.least("a", "__a").alias("a"), F.greatest("b", "__b").alias("b"))
                self._write(rows, f"{name}_heads", HEADS)
            self.runs = [*self.runs[:-FANOUT], (level + 1, name)]
            self._manifest()
            for old in merged:
                self._drop(f"{old}_spans")
                self._drop(f"{old}_heads")

    def judged(self, found: DataFrame) -> DataFrame:
        """The anchors of found that no earlier one of their chunk repeats, merge-joined with all runs' spans: old (a run has the
        span), fresh (nothing earlier has it), lead (the first of its span)."""
        new = found.where("not repeated").select("fp", F.pmod("span", F.lit(SPREAD)).cast("int").alias("s"), "span", "doc", "row", "at", "n")
        order = W.partitionBy("fp", "s", "span").orderBy("doc", "at", "row")
        place = F.struct("doc", "at")
        rows = new.repartition(self.buckets, "fp", "s").select("*", (place == F.first(place).over(order)).alias("first"), (F.row_number().over(order) == 1).alias("one"))
        seen = F.lit(False)
        for i, (_, run) in enumerate(self.runs):
            rows = rows.join(self.spans(run).select("fp", "s", "span", F.lit(True).alias(f"in{i}")), ["fp", "s", "span"], "left")
            seen = seen | F.coalesce(F.col(f"in{i}"), F.lit(False))
        return rows.select("fp", "s", "span", "doc", "row", "at", "n", seen.alias("old"), (F.col("first") & ~seen).alias("fresh"), (F.col("one") & ~seen).alias("lead"))

    def several(self, heads: DataFrame) -> DataFrame:
        """(fp) of the grams of heads that stand in more than one span, the runs' counted."""
        rows, low, high = heads, [F.col("a")], [F.col("b")]
        for i, (_, run) in enumerate(self.runs):
            rows = rows.join(self.heads(run).select("fp", F.col("a").alias(f"a{i}"), F.col("b").alias(f"b{i}")), "fp", "left")
            low.append(F.coalesce(f"a{i}", "a"))
            high.append(F.coalesce(f"b{i}", "b"))
        both = rows.where(F.least(*low) != F.greatest(*high)) if self.runs else rows.where("a <> b")
        return both.select("fp")

    def add(self, docs: DataFrame, history: DataFrame | None = None, *, last: bool = False) -> DataFrame:
        """(doc, row, at, n): the windows of docs(doc, text) that repeat an earlier one, as n starts from word `at`, staged.

        Earlier are all windows of former batches and those of docs with a smaller doc, or the same doc and a smaller start.
        history(doc, text) holds the former batches' texts: the windows of an anchor that stands in different surroundings are
        read from there and compared one by one. With last, compaction is left to the caller.
        """
        ws, name = self.ws, f"cl_{uuid.uuid4().hex}"
        cut = ["doc", "row", "at", "n"]
        docs = numbered(docs)
        found = ws.stage(find_anchors(docs), "anchors")
        with merging(self.spark):
            judged = self._write(self.judged(found), f"{name}_spans", SPANS)
            known = ws.stage(judged.where("not fresh").select(cut).unionByName(found.where("repeated").select(cut)), "known")
            ws.drop(found)
            ws.release()
            heads = judged.where("lead").groupBy("fp").agg(F.min("span").alias("a"), F.max("span").alias("b"))
            heads = self._write(heads if partitions(self.spark) == self.buckets else heads.repartition(self.buckets, "fp"), f"{name}_heads", HEADS)
            # An anchor in several spans has windows that may repeat without their whole span.
            several = ws.stage(self.several(heads), "several").select("fp", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("s"))
            doubtful = judged.where("fresh").join(several, ["fp", "s"], "left_semi").select("doc", "row", "at", "n", F.lit(False).alias("old"))
            for _, run in self.runs:
                doubtful = doubtful.unionByName(self.spans(run).join(several, ["fp", "s"], "left_semi").select("doc", "row", "at", "n", F.lit(True).alias("old")))
            marks = ws.stage(doubtful.groupBy("doc", "row", "old").agg(F.collect_list(F.struct("at", "n")).alias("spans")), "doubtful")
            ws.release()
            windows = None
            for old, texts in ((False, docs), (True, numbered(history) if history is not None else None)):
                if texts is not None:
                    mine = marks.where(F.col("old") == old).select(F.col("doc").alias("__doc"), F.col("row").alias("__row"), "spans")
                    marked = texts.join(mine, (F.col("doc") == F.col("__doc")) & (F.col("row") == F.col("__row")))
                    part = find_windows(marked).withColumn("old", F.lit(old))
                    windows = part if windows is None else windows.unionByName(part)
            windows = ws.stage(windows, "windows")
            ws.drop(marks)
            ws.release()
            place = F.struct((~F.col("old")).alias("new"), "doc", "at")
            single = windows.where("not repeated").select("*", place.alias("place"), F.min(place).over(W.partitionBy("h1", "h2")).alias("least"))
            out = single.where("not old and place <> least").select(cut).unionByName(windows.where("repeated and not old").select(cut))
            out = ws.stage(out.unionByName(known), "repeats")
            ws.drop(windows, known)
        ws.release()
        self.runs.append((0, name))
        self._manifest()
        if not last:
            self.compact()
        return out


def strip(docs: DataFrame, repeats: DataFrame) -> DataFrame:
    """docs(doc_id, doc, row, text) without the words that repeats(doc, row, at, n) covers: doc_id, n_words, n_removed, kept_sha256, kept."""
    marks = repeats.groupBy(F.col("doc").alias("__doc"), F.col("row").alias("__row")).agg(F.collect_list(F.struct("at", "n")).alias("spans")).hint("merge")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2)):
                words = (text or b"").split()
                if spans.is_valid and len(spans.values):
                    at, n = (spans.values.field(k).to_numpy().astype(np.int64) for k in (0, 1))
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + n + WINDOW - 1, -1)
                    keep = np.cumsum(edge[:-1]) == 0
                    kept = b" ".join(compress(words, keep.tolist()))
                    removed = len(words) - int(keep.sum())
                else:
                    kept, removed = b" ".join(words), 0
                rows.append((len(words), removed, hashlib.sha256(kept).hexdigest(), kept.decode()))
            n, removed, sha, kept = zip(*rows) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
            )

    rows = docs.join(marks, (F.col("doc") == F.col("__doc")) & (F.col("row") == F.col("__row")), "left").select("doc_id", "text", "spans")
    return rows.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_words bigint, n_removed bigint, kept_sha256 string, kept string")


def remove_repeats(docs: DataFrame, batches: int = 3) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept of every row of docs(doc_id, text): words in repeated windows are removed.

    Words are runs of anything but ASCII whitespace. A word goes if a window of 20 words that covers it also starts earlier, in a
    document of smaller doc_id or earlier in the same one; windows are judged on the input. Documents go through the index in
    `batches` batches of ascending doc_id. Null, empty and short texts lose nothing; long texts are read whole. Rows that share a
    doc_id count as one document: a window at the same start of another of its rows is not earlier, and each row loses its own
    words only, so that equal rows give equal results. Rows without an id count as one document after all others. Other columns
    are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "substrings")
    index = FingerprintIndex(spark, ws)
    rows = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc"), F.col("text").cast("string").alias("text"))
    cuts = rows.agg(F.percentile_approx("doc", [k / batches for k in range(1, batches)], 10_000)).first()[0] or [] if batches > 1 else []
    cuts = sorted(set(cuts))
    out, below = None, None
    for k in range(len(cuts) + 1):
        part = rows
        if k:
            part = part.where(F.col("doc") > cuts[k - 1])
        if k < len(cuts):
            part = part.where(F.col("doc") <= cuts[k])
        repeats = index.add(part, below, last=k == len(cuts))
        kept = strip(part.withColumn("row", F.xxhash64(F.coalesce("text", F.lit("")))), repeats)
        out = kept if out is None else out.unionByName(kept)
        if k < len(cuts):
            below = rows.where(F.col("doc") <= cuts[k])
    return out


def repeats_digest(docs: DataFrame, batches: int = 3) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    return remove_repeats(docs, batches).drop("kept")
