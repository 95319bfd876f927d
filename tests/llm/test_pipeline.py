"""The pipeline against brute force, and each of its stages on odd rows."""

import hashlib
from collections import Counter

import pytest

pytest.importorskip("curveloom.llm")
pipeline = pytest.importorskip("corpus_pipeline")

from test_brute import brute_leaks, brute_model, learned  # noqa: E402
from test_llm import WORD, brute_targets, docs_of, owner  # noqa: E402
from test_near_copies import brute_roots  # noqa: E402


def brute_mix(rows):
    """How often each (id, source, text) of the mix is written."""
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    targets, out = brute_targets(sizes), Counter()
    for i, text, source in rows:
        rate = targets[source] / sizes[source] if sizes[source] else 0.0
        u = int(hashlib.md5(f"{'null' if i is None else i}:1".encode()).hexdigest()[:13], 16) / 2**52
        out[i, text, source] += int(rate) + (u < rate - int(rate))
    return +out


def test_run_by_brute_force(spark, small):
    """Near-duplicates are texts with 80 % of their five-word shingles in common, as stages on word shingles take them."""
    got = pipeline.run(spark, small).collect()
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    items = [r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    predict = brute_model(learned([(r.doc_id, r.text, r.lang) for r in docs]))
    kept = [r for r in docs if (found := predict(r.text))[0] != "und" and found[1] >= 0.5]
    root = brute_roots([(r.doc_id, r.text) for r in kept])
    kept = [r for r in kept if root[r.doc_id] == r.doc_id and not any(brute_leaks(r.text, x) is not None for x in items)]
    assert 0 < len(kept) < len(docs)
    want = brute_mix([(r.doc_id, r.text, r.source) for r in kept])
    assert Counter((r.doc_id, r.text, r.source) for r in got) == want
    assert all(r.shard == owner(r.doc_id, 8) for r in got)
    assert [n for n, _ in pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "mixing", "sharding"]


WORDS = "the quick brown fox jumps over a lazy dog while seven wise owls watch from old trees"
ODD = [
    (1, WORDS, "en", "a"), (1, WORDS, "en", "a"), (1, "quite another text under the same id that is long enough to tell", "en", "a"), (2, WORDS.upper(), "en", None), (None, WORDS, "en", "b"), (None, WORDS, None, "b"),
    (3, None, "en", "b"), (4, "", "en", "c"), (5, "12 34 !", None, "c"), (6, "the owls and the dog " * 20_000, "en", "c"), (7, "an item of the benchmark that leaks in here whole", "en", "d"),
]


@pytest.fixture
def folder(spark, tmp_path):
    rows = [(1, "item of the benchmark that leaks in here"), (2, None), (None, "")]
    spark.createDataFrame(rows, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("name, stage", pipeline.STAGES)
def test_stages_take_empty_tables_and_keep_columns(spark, folder, name, stage):
    docs = docs_of(spark, [])
    out = stage(spark, docs, folder)
    assert out.count() == 0
    full = stage(spark, docs_of(spark, ODD), folder)
    want = docs.columns if name != "sharding" else [*docs.columns[:5], "shard", *docs.columns[6:]]
    assert full.columns == want and all(r["size"] == "y" and r["__x"] == 7 for r in full.collect())


def rows_of_stage(spark, folder, name, rows=ODD):
    return sorted(map(str, ((r.doc_id, (r.text or "")[:20]) for r in dict(pipeline.STAGES)[name](spark, docs_of(spark, rows), folder).collect())))


def shown(*picked):
    return sorted(str((ODD[k][0], (ODD[k][1] or "")[:20])) for k in picked)


def test_language_of_odd_rows(spark, folder):
    assert rows_of_stage(spark, folder, "language") == shown(0, 1, 2, 3, 4, 5, 9, 10)
    assert rows_of_stage(spark, folder, "language", [(1, "no language", None)]) == []


def test_near_duplicates_of_odd_rows(spark, folder):
    assert rows_of_stage(spark, folder, "near_duplicates") == shown(0, 2, 4, 5, 6, 8, 9, 10)  # 3 and 4 are both blank; 12 34 ! is not


def test_decontamination_of_odd_rows(spark, folder):
    assert rows_of_stage(spark, folder, "decontamination") == shown(0, 1, 2, 3, 4, 5, 6, 7, 8, 9)


def test_mixing_of_odd_rows(spark, folder):
    got = Counter((r.doc_id, r.text, r.source) for r in dict(pipeline.STAGES)["mixing"](spark, docs_of(spark, ODD), folder).collect())
    assert got == brute_mix([(i, t, s) for i, t, _, s in ODD])


def test_sharding_of_odd_rows(spark, folder):
    got = dict(pipeline.STAGES)["sharding"](spark, docs_of(spark, ODD), folder).collect()
    assert len(got) == len(ODD) and all(r.shard == owner(r.doc_id, 8) for r in got)
