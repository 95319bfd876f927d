"""The fingerprint index: rows that share an id, reopening, and merges without moving a run."""

import hashlib
import random

import pytest

pytest.importorskip("curveloom.llm")

from test_llm import WORD, docs_of  # noqa: E402

from curveloom.llm import substring_dedup as sd  # noqa: E402


def brute(rows):
    """(id, text) -> what each row keeps: windows go whose words also start at a smaller (id, start), ids null last."""
    key = lambda i: (i is None, i or 0)
    first = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        for s in range(len(w) - 19):
            k, at = tuple(w[s : s + 20]), (key(i), s)
            first[k] = min(first.get(k, at), at)
    out = []
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = {x for s in range(len(w) - 19) if first[tuple(w[s : s + 20])] < (key(i), s) for x in range(s, s + 20)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((str(i), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("batches", [1, 3])
def test_rows_that_share_an_id_or_have_none(spark, batches):
    rng = random.Random(batches)
    text = lambda n: [rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(n)]
    p, q = text(40), text(90)
    rows = [(1, " ".join(text(115) + p)), (2, " ".join(p + text(80) + p)), (2, "only five words are here"), (2, " ".join(text(7) + p))]
    rows += [(None, " ".join(text(60) + p + text(9))), (None, "short one"), (None, " ".join(q)), (None, " ".join(q)), (None, " ".join(text(5) + q)), (None, None)]
    rows += [(5, " ".join(q)), (5, " ".join(q)), (5, " ".join(q[:60] + text(30))), (6, " ".join(q[10:60])), (7, " ".join(text(3) + q[30:] + text(3) + p[:25]))]
    rows += [(i, " ".join(text(rng.randint(0, 40)) + rng.choice((p, q))[rng.randint(0, 15) :])) for i in range(8, 30)]
    got = sd.repeats_digest(docs_of(spark, rows), batches).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute(rows)


def test_an_index_is_opened_again(spark):
    p = " ".join(f"w{i}" for i in range(50))
    one, two, three = (spark.createDataFrame([(k, t)], "doc bigint, text string") for k, t in ((1, "a b " + p), (2, p + " c d"), (3, "e " + p)))
    index = sd.FingerprintIndex(spark)
    index.add(one)
    again = sd.FingerprintIndex.open(spark, index.ws.root)
    for _, name in again.runs:  # as in a session that does not know the tables
        for kind in ("spans", "heads"):
            spark.sql(f"DROP TABLE {name}_{kind}")
    again = sd.FingerprintIndex.open(spark, index.ws.root)
    cover = lambda df: sorted({k for r in df.collect() for k in range(r.at, r.at + r.n)})
    assert cover(again.add(two, one)) == list(range(31)) and [level for level, _ in again.runs] == [1]
    last = sd.FingerprintIndex.open(spark, index.ws.root)
    assert last.runs == again.runs and cover(last.add(three, one.union(two))) == list(range(1, 32))
    with pytest.raises(FileNotFoundError):
        sd.FingerprintIndex.open(spark, index.ws.root + "/none")


def test_runs_are_merged_where_they_lie(spark):
    rows = [(i, " ".join(random.Random(i).choices("abcdefghijklmnop", k=80))) for i in range(20)]
    index = sd.FingerprintIndex(spark)
    index.add(spark.createDataFrame(rows, "doc bigint, text string"))
    found = sd.find_anchors(sd.numbered(spark.createDataFrame(rows, "doc bigint, text string")))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with sd.merging(spark):
            text = index.judged(found)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in text and text.count("Exchange") == 1
    lines = text.splitlines()
    run = next(k for k, line in enumerate(lines) if "_spans" in line and "FileScan" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    above, at = [], depth(lines[run])
    for line in reversed(lines[:run]):
        if depth(line) < at:
            at = depth(line)
            above.append(line.strip(" :+-"))
        if "SortMergeJoin" in line:
            break
    assert "Bucketed: true" in lines[run] and not any(x.startswith(("Exchange", "Sort [")) for x in above)
