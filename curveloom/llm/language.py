"""Language identification by known words first and character n-grams for the rest."""

from __future__ import annotations

import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curveloom.llm.common import Workspace

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LONGEST = 4
#: Entries of the model: so many words and n-grams of each length, shared by the languages, but at least so many for each of them.
#: The most frequent are taken; rarer words back off to their n-grams, so a model is a parameter's size, not the corpus's.
MODEL_WORDS, MODEL_GRAMS = 200_000, 50_000
LEAST_WORDS, LEAST_GRAMS = 2_000, 1_000
#: Buckets of counts per doubling, for the cut at the model's size.
STEPS = 8
#: Characters that a word may have; longer runs of letters are cut into words of this length.
WIDEST = 40
#: Bytes of the rows that a worker keeps of words and of n-grams it has worked out.
ROOM = 32 << 20


class Words:
    """Finds words: a letter (Unicode category L) and the letters and combining marks (M) that follow it."""

    def __init__(self):
        kinds: dict[str, list[int]] = {"L": [], "M": [], "N": []}
        for c in range(0x32400):  # the planes above hold no letters
            kinds.get(unicodedata.category(chr(c))[0], []).append(c)
        letters, marks = (self._class(kinds[k]) for k in "LM")
        self.exact = re.compile(f"[{letters}][{letters}{marks}]{{0,{WIDEST - 1}}}")
        #: Without marks and without numbers that are no decimal digits, \w says the same and is faster.
        self.plain = re.compile(rf"[^\W\d_]{{1,{WIDEST}}}")
        self.odd = frozenset(chr(c) for c in kinds["M"] + [c for c in kinds["N"] if unicodedata.category(chr(c)) != "Nd"])

    @staticmethod
    def _class(codes: list[int]) -> str:
        cuts = [0, *(i for i in range(1, len(codes)) if codes[i] != codes[i - 1] + 1), len(codes)]
        return "".join(f"\\U{codes[i]:08x}-\\U{codes[j - 1]:08x}" for i, j in zip(cuts, cuts[1:]))

    def __call__(self, text: str) -> list[str]:
        return (self.plain if text.isascii() or self.odd.isdisjoint(text) else self.exact).findall(text)


_words: Words | None = None


def words_of(text: str) -> list[str]:
    """The text's lower-cased words, long runs in pieces."""
    global _words
    if _words is None:
        _words = Words()
    return _words(text.lower())


def count_words(train: DataFrame) -> DataFrame:
    """(lang, word, n) over all rows of train(lang, text), combined within each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}

        def out():
            rows = [(lang, w, n) for lang, c in counts.items() for w, n in c.items()]
            counts.clear()
            for i in range(0, len(rows), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows[i : i + 50_000])], ["lang", "word", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts.setdefault(lang, Counter()).update(words_of(text))
            if sum(map(len, counts.values())) > 300_000:
                yield from out()
        yield from out()

    counted = train.where("lang is not null and text is not null").select("lang", "text").mapInArrow(run, "lang string, word string, n bigint")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, key: str, per_lang: int) -> DataFrame:
    """About per_lang rows of each language of counts(lang, key, n): whole buckets of the highest n, and of the first bucket that
    does not fit the rows whose key's hash is small enough.

    One row per language and bucket of counts reaches the driver; no task sorts a language.
    """
    bucket = F.floor(F.log2("n") * STEPS)
    cut: dict[str, tuple[int, float]] = {}
    kept: dict[str, int] = {}
    for lang, b, rows in sorted(counts.groupBy("lang", bucket.alias("b")).count().collect(), key=lambda r: (r[0], -r[1])):
        have = kept.get(lang, 0)
        if have < per_lang:
            cut[lang] = (b, min(1.0, (per_lang - have) / rows))
        kept[lang] = have + rows
    if not cut:
        return counts.limit(0)
    cuts = counts.sparkSession.createDataFrame([(lang, int(b), float(share)) for lang, (b, share) in sorted(cut.items())], "__lang string, __b bigint, __share double")
    share = (F.xxhash64(key, F.lit(5)).bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))).cast("double")
    found = counts.join(F.broadcast(cuts), F.col("lang") == F.col("__lang"))
    return found.where((bucket > F.col("__b")) | ((bucket == F.col("__b")) & (share < F.col("__share")))).select(counts.columns)


class Table:
    """Log frequencies by language of the keys counted for some of the languages: ln((n + 0.5) / whole), where whole is the
    language's total + 0.5 per key + 1. Held as what each key adds to the row of a key that no language knows."""

    def __init__(self, rows: Iterable[tuple[str, str, int]], totals: dict[str, int], languages: list[str]):
        at = {lang: i for i, lang in enumerate(languages)}
        rows = sorted((key, at[lang], n) for lang, key, n in rows if lang in at)
        keys = list(dict.fromkeys(r[0] for r in rows))
        self.place = {k: i for i, k in enumerate(keys)}
        self.lang = np.array([r[1] for r in rows], np.int32)
        self.more = np.log(np.array([r[2] for r in rows], np.float64) * 2 + 1).astype(np.float32)  # ln((n + 0.5) / 0.5)
        self.ends = np.concatenate(([0], np.cumsum(np.bincount([self.place[r[0]] for r in rows], minlength=len(keys))))).astype(np.int64)
        self.base = np.log(0.5 / (np.array([totals.get(lang, 0) for lang in languages], np.float64) + 0.5 * len(keys) + 1))

    def row(self, key: str) -> np.ndarray | None:
        i = self.place.get(key)
        if i is None:
            return None
        out = self.base.copy()
        at = slice(self.ends[i], self.ends[i + 1])
        out[self.lang[at]] += self.more[at]
        return out

    def sum(self, places: np.ndarray) -> np.ndarray:
        """The sum of the rows of keys by their places, repeats included."""
        start, n = self.ends[places], self.ends[places + 1] - self.ends[places]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - start, n)
        return self.base * len(places) + np.bincount(self.lang[at], self.more[at], len(self.base))


class Model:
    """Log frequencies by language of words and n-grams; languages in code-point order."""

    def __init__(self, languages: list[str], words: list, totals: dict[str, int], grams: list, gram_totals: dict):
        self.languages = sorted(languages)
        self._predictor = None
        self.words = Table(words, totals, self.languages)
        self.grams = [
            Table([r for r in grams if len(r[1]) == k], {lang: gram_totals.get((lang, k), 0) for lang in languages}, self.languages)
            for k in range(1, LONGEST + 1)
        ]

    def predictor(self) -> Predictor:
        """One predictor for all tasks of a worker, so that rows worked out once stay."""
        if self._predictor is None:
            self._predictor = Predictor(self)
        return self._predictor

    def backoff(self, gram: str) -> np.ndarray:
        """The log frequencies of the n-gram, or the mean of its two shorter ones; an unknown character says nothing."""
        if (v := self.grams[len(gram) - 1].row(gram)) is not None:
            return v
        if len(gram) == 1:
            return np.zeros(len(self.languages))
        return (self.backoff(gram[:-1]) + self.backoff(gram[1:])) / 2


class Predictor:
    """Predicts with a model; rows of words and n-grams not in it are kept up to a bound."""

    def __init__(self, model: Model, room: int | None = None):
        room = room or max(1000, ROOM // (4 * max(1, len(model.languages))))
        self.model, self.room = model, max(room, WIDEST + 2)
        self.known = model.words.place
        self.grams: dict[str, int] = {}
        self.gram_rows = np.zeros((self.room, len(model.languages)), np.float32)
        self.new: dict[str, int] = {}
        self.new_rows = np.zeros((self.room, len(model.languages)), np.float32)

    def gram(self, gram: str) -> int:
        """The place of an n-gram's row, which is worked out once."""
        i = self.grams[gram] = len(self.grams)
        self.gram_rows[i] = self.model.backoff(gram)
        return i

    def unseen(self, word: str) -> int:
        """The place of a new word's row, the mean of its longest n-grams' rows."""
        i = self.new[word] = len(self.new)
        marked = f"^{word}$"
        k = min(LONGEST, len(marked))
        if len(self.grams) + WIDEST + 2 > self.room:
            self.grams.clear()
        grams = [marked[j : j + k] for j in range(len(marked) - k + 1)]
        rows = self.gram_rows[[n if (n := self.grams.get(g)) is not None else self.gram(g) for g in grams]]
        self.new_rows[i] = np.add.reduce(rows, 0) / len(grams)
        return i

    def __call__(self, text: str | None) -> tuple[str, float]:
        words = words_of(text or "")
        if not words or not self.model.languages:
            return "und", 0.0
        total = np.zeros(len(self.model.languages))
        get = self.known.get
        step = min(50_000, self.room)
        for at in range(0, len(words), step):
            part = words[at : at + step]
            places = [get(w, -1) for w in part]
            found = np.array(places, np.int64)
            total += self.model.words.sum(found[found >= 0])
            rest = [w for w, i in zip(part, places) if i < 0]
            if rest:
                if len(self.new) + len(rest) > self.room:
                    self.new.clear()
                have = self.new.get
                total += self.new_rows[[i if (i := have(w)) is not None else self.unseen(w) for w in rest]].sum(0, dtype=np.float64)
        mean = total / len(words)
        p = np.exp((mean - mean.max()) * min(len(words), 20))
        best = int(np.argmax(p))
        return self.model.languages[best], float(p[best] / p.sum())


def ngrams(word: Column, k: int) -> Column:
    """The n-grams of k characters of ^word$, or the whole of a shorter one."""
    marked = F.concat(F.lit("^"), word, F.lit("$"))
    places = F.sequence(F.lit(1), F.greatest(F.length(marked) - (k - 1), F.lit(1)))
    return F.transform(places, lambda i: F.substr(marked, i, F.lit(k)))  # a second argument would be the index


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3, is 1; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def fit(ws: Workspace, train: DataFrame) -> Model:
    """A model of train(lang, text): counts cover all rows and all languages; the most frequent entries reach the driver, about
    as many as the model's size says."""
    counts = ws.stage(count_words(train), "words")
    totals = {r[0]: r[1] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    if not totals:
        return Model([], [], {}, [], {})
    words = most_frequent(counts, "word", max(LEAST_WORDS, MODEL_WORDS // len(totals))).collect()
    grams = F.concat(*[ngrams(F.col("word"), k) for k in range(1, LONGEST + 1)])
    spread = counts.select("lang", "n", F.explode(grams).alias("gram"))
    spread = ws.stage(spread.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    sums = {(r[0], r[1]): r[2] for r in spread.groupBy("lang", F.length("gram")).agg(F.sum("n")).collect()}
    kept = []
    for k in range(1, LONGEST + 1):
        kept += most_frequent(spread.where(F.length("gram") == k), "gram", max(LEAST_GRAMS, MODEL_GRAMS // len(totals))).collect()
    return Model(list(totals), [(r["lang"], r["word"], r["n"]) for r in words], totals, [(r["lang"], r["gram"], r["n"]) for r in kept], sums)


def _train(docs: DataFrame) -> DataFrame:
    return docs.where(~held_out(F.col("doc_id"))).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of docs(doc_id, text); the whole text is read.

    lang_pred is `und` with score 0 if the text is null, empty or has no letter (Unicode category L), or if nothing was learned;
    else score is the share of the best language's likelihood per word, sharpened by up to 20 words. Ties go to the first
    language by code point. Repeated rows get the same prediction each; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        guess = shared.value.predictor()
        for batch in batches:
            found = [guess(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """predict() with a model of the rows that are not held out and have a language."""
    return predict(docs, fit(Workspace(docs.sparkSession, "language"), _train(docs)))


def keep_identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """docs without the rows that are `und` or whose best language has a score under `least`, by predict()'s rules.

    All columns stay, whatever their names; repeated rows are judged alike; an empty table gives no rows. Where no row has a
    language, nothing is learned and nothing kept.
    """
    model = fit(Workspace(docs.sparkSession, "language"), _train(docs))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        guess = shared.value.predictor()
        for batch in batches:
            found = [guess(t) for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array([lang != "und" and score >= least for lang, score in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
