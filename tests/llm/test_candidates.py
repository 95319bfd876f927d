"""What brings texts together in the pipeline's stage of near-duplicates."""

import random

import numpy as np
import pytest

minhash = pytest.importorskip("curveloom.llm.minhash")

from test_llm import docs_of, roots  # noqa: E402
from test_near_copies import brute_roots  # noqa: E402


def kept(spark, rows):
    return sorted(r.doc_id for r in minhash.keep_one_of_each(docs_of(spark, rows)).collect())


def words(rng, n):
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def test_balls_of_fingerprints_bring_texts_together(spark, monkeypatch):
    """Without any band in common, the texts whose SimHash is within two bits still meet; what is unlike in shingles stays."""
    monkeypatch.setattr(minhash.Bands, "__call__", lambda self, found: np.random.default_rng().integers(0, 1 << 62, minhash.BANDS))
    rng, rows = random.Random(3), []
    for k in range(5):
        text = words(rng, 3000)
        rows += [(2 * k, " ".join(text)), (2 * k + 1, " ".join([*text[:-1], "changed"]))]
    rows += [(100, " ".join(words(rng, 50)))]
    assert kept(spark, rows) == [0, 2, 4, 6, 8, 100]


def drifting(rng, n, steps, change):
    """A text and followers, each `change` words at one place apart from the one before, all places apart."""
    w, out = words(rng, n), []
    for k in range(steps):
        out.append(" ".join(w))
        w = list(w)
        w[10 * k : 10 * k + change] = words(rng, change)
    return out


def test_every_pair_of_a_crowded_band_is_compared(spark, monkeypatch):
    """All texts share all bands: chains hold together by links between texts that lead no band, whatever the number of classes."""
    monkeypatch.setattr(minhash, "BANDS", 1)
    monkeypatch.setattr(minhash.Bands, "__call__", lambda self, found: np.arange(1))
    rng = random.Random(8)
    texts = [t for _ in range(20) for t in drifting(rng, 80, 6, 2)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    want = brute_roots(rows)
    assert len({*want.values()}) == 20
    assert kept(spark, rows) == sorted({*want.values()})
    monkeypatch.setattr(minhash, "CELL", 1000)  # tiles of 13 texts, many cells
    assert kept(spark, rows) == sorted({*want.values()})


def test_a_large_group_gives_few_pairs(spark):
    """Copies that are unlike each other in one crowded band give no row for each pair of them."""
    rng = random.Random(9)
    base = words(rng, 30)
    told, sets = [], []
    for k in range(700):
        text = list(base)
        for at in rng.sample(range(30), 2):
            text[at] = f"x{k}_{at}"
        found = next(minhash.shingles([" ".join(text).encode()], minhash.WordHasher(31)))
        told.append((1, {"doc_id": k, "hash": 0}, len(found), {"doc_id": k, "hash": 0}))
        sets.append(({"doc_id": k, "hash": 0}, found.tobytes()))
    node = "struct<doc_id: bigint, hash: bigint>"
    told = spark.createDataFrame(told, f"key bigint, id {node}, n bigint, class {node}")
    got = minhash.alike_in_bands(told, spark.createDataFrame(sets, f"id {node}, set binary")).collect()
    assert minhash._cells(told).count() <= 3 * 700
    packed = [set(np.frombuffer(s, np.uint64).tolist()) for _, s in sets]
    close = lambda x, y: 5 * len(x & y) >= 4 * len(x | y)
    pairs = [(i, j) for i in range(700) for j in range(i) if close(packed[i], packed[j])]
    assert roots([(r.u.doc_id, r.v.doc_id) for r in got], range(700)) == roots(pairs, range(700))
    assert len(got) < 3 * 700
