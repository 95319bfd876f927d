"""The pipeline's stage of near-duplicates against brute force over five-word shingles."""

import random

import pytest
from conftest import rows_of  # noqa: F401

pytest.importorskip("curveloom.llm")
pipeline = pytest.importorskip("corpus_pipeline")

from test_llm import WORD, docs_of, roots  # noqa: E402


def shingles(text):
    w = WORD.findall((text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_roots(rows):
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    close = lambda x, y: x == y or 5 * len(x & y) >= 4 * len(x | y)
    return roots([(a, b) for k, a in enumerate(ids) for b in ids[:k] if close(sets[a], sets[b])], ids)


def test_stage_drops_texts_of_four_fifths_common_shingles(spark):
    rng = random.Random(6)
    text = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    rows = []
    for k in range(40):
        base = text(rng.choice((30, 60, 120, 400)))
        rows.append((len(rows), " ".join(base)))
        for _ in range(30 if k == 0 else 3):
            w = list(base)
            for at in rng.sample(range(len(w)), rng.randint(0, max(1, len(w) // 30))):
                w[at] = "new"
            rows.append((len(rows), "\t".join(w).upper()))
    rows += [(9000, "a b c"), (9001, "A b  c"), (9002, "a b d"), (9003, " ")]
    want = brute_roots(rows)
    assert 0 < sum(want[i] != i for i in want) < len(rows)
    docs = docs_of(spark, [*rows, (None, rows[0][1])])
    got = pipeline.drop_near_duplicates(spark, docs, None)
    assert sorted(str(r.doc_id) for r in got.collect()) == sorted([*(str(i) for i in want if want[i] == i), "None"])
    assert got.columns == docs.columns


def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(40)) for c in "xy")
    docs = docs_of(spark, [(1, one), (1, two), (1, two), (2, one), (3, two + " z")])
    assert sorted((r.doc_id, r.text) for r in pipeline.drop_near_duplicates(spark, docs, None).collect()) == [(1, one), (1, two)]


def test_stage_on_the_given_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    want = brute_roots([(r.doc_id, r.text) for r in docs.collect()])
    assert {r.doc_id for r in pipeline.drop_near_duplicates(spark, docs, small).collect()} == {i for i in want if want[i] == i}
