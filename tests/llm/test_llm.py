"""Operators of the llm subpackage against brute force, round trips, planted cases and odd inputs."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from conftest import rows_of
from pyspark.sql import functions as F

pytest.importorskip("curveloom.llm")

from curveloom.llm import decontamination, embedding_dedup, language, mixing, oracles, queries, secrets, sharding, simhash, substring_dedup, url_filter, warc  # noqa: E402
from curveloom.llm.common import Workspace, connected_components, global_rank  # noqa: E402
from curveloom.llm.wordhash import WordHasher  # noqa: E402

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, shard string, size string, __x int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs_of(spark, rows):
    """(doc_id, text[, lang, source]) with extra columns whose names clash."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", None, "x", "y", 7) for r in rows]
    return spark.createDataFrame(full, DOCS)


def roots(pairs, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_oracle(name, spark, small, duck):
    got = queries.QUERIES[name](spark, small)
    cur = duck.execute(oracles.ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(got.columns) == sorted(names)
    assert rows_of(got.columns, got.collect()) == rows_of(names, cur.fetchall())


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(name, spark, tmp_path):
    docs_of(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int, v string").write.parquet(str(tmp_path / "embeddings.parquet"))
    spark.createDataFrame([], "page_id bigint, url string, html string, node string").write.parquet(str(tmp_path / "pages.parquet"))
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == 0


# Shared pieces


def test_connected_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(i, i + 1) for i in range(100, 140)] + [(200, 200 + i) for i in range(1, 40)] + [(5, 5)]
    want = roots(pairs, {x for p in pairs if p[0] != p[1] for x in p})
    edges = spark.createDataFrame([*pairs, (None, 3)], "u bigint, v bigint")
    got = {r.node: r.component for r in connected_components(Workspace(spark, "t"), edges).collect()}
    assert got == want
    assert connected_components(Workspace(spark, "t"), edges.limit(0)).count() == 0


def test_global_rank(spark):
    rows = [(i, random.Random(i).choice("abc")) for i in range(200)]
    df = spark.createDataFrame(rows, "i bigint, k string")
    got = {r.i: r["rank"] for r in global_rank(Workspace(spark, "t"), df, [F.col("k"), F.col("i")], "r").collect()}
    assert got == {i: n for n, (k, i) in enumerate(sorted((k, i) for i, k in rows))}


def test_word_hashes():
    text = "".join(random.Random(1).choice("ab é\n\t\x0b ") for _ in range(3000)).encode()
    starts, ends, h = WordHasher(5)(text)
    words = [text[a:b] for a, b in zip(starts, ends)]
    assert words == text.split()
    assert len(set(h.tolist())) == len(set(words)) and len({(w, v) for w, v in zip(words, h.tolist())}) == len(set(words))


# 1: decontamination


def test_leaks(spark):
    rng = random.Random(0)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate((40, 20, 12, 6, 3))] + [(9, None), (10, "")]
    swap = lambda t, at: " ".join("ZZ" if k in at else w for k, w in enumerate(t.split()))
    noise = lambda n: " ".join(word() for _ in range(n))
    rows = [
        (1, f"{noise(50)} {items[0][1].upper()}. {noise(9)}"), (2, f"{noise(5)} {swap(items[0][1], {3, 11, 20, 29, 37})} {noise(5)}"), (3, f"{swap(items[1][1], {7, 15})}"),
        (4, items[2][1]), (5, f"{noise(30)} {items[3][1]}"), (6, f"{noise(8)} {items[4][1]} {noise(8)}"), (7, noise(400)), (8, None), (9, ""), (10, swap(items[0][1], set(range(0, 40, 2)))),
        (11, " ".join(items[0][1].split()[5:20])), (1, f"{noise(50)} {items[0][1]}"),
    ]
    found = decontamination.leaks(docs_of(spark, rows), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(1, 0), (1, 0), (2, 0), (3, 1), (4, 2), (5, 3), (11, 0)]
    kept = decontamination.drop_leaking(docs_of(spark, rows), spark.createDataFrame(items, "item_id bigint, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == [6, 7, 8, 9, 10] and kept.columns == docs_of(spark, rows).columns


def test_leaks_are_found_in_any_number_of_passes(spark, small, monkeypatch):
    t = lambda n: spark.read.parquet(f"{small}/{n}.parquet")
    run = lambda: sorted(tuple(r) for r in decontamination.leaks(t("documents"), t("benchmark")).collect())
    once = run()
    monkeypatch.setattr(decontamination, "INDEX_WORDS", 300)
    assert once and run() == once
    bench = {r.item_id: r.text for r in t("benchmark").collect()}
    whole = {(d.doc_id, i) for d in t("documents").collect() for i, x in bench.items() if x in d.text}
    assert whole <= {(r[0], r[1]) for r in once}


# 2: urls


def test_url_classes(spark):
    link = lambda h: f'<html><head><LINK rel="canonical" class=x href="{h}"></head>'
    rows = [
        (1, "http://A.example.net/x?q#f", link("https://bad.com/de/1")), (2, "https://bad.com/de/1", None), (3, "http://third.net/", '<meta http-equiv=refresh content="0; url=//a.example.net/x?q">'),
        (4, "http://w.org/a", link("https://bad.com/de/1")), (5, "http://lone.net/", link("http://lone.net/")), (6, None, None), (7, "no address", ""), (8, "http://fr.com/fr/z", link("/de/q")),
        (9, "http://fr.com/de/q", None), (10, "http://p.net/d/e", link("f")), (11, "http://p.net/d/f", None), (2, "https://bad.com/de/1", None), (12, "http://example.org/en/12", None), (13, "http://x.EXAMPLE.org/en/2", None),
        (14, "http://example.org", None), (15, "http://myexample.org/es/", None),
    ]
    pages = spark.createDataFrame([(*r, "n") for r in rows], "page_id bigint, url string, html string, node string")
    got = sorted((r.page_id, r.rule, r.verdict) for r in url_filter.url_verdicts(pages).collect())
    want = [
        (1, None, "allow"), (2, "com/de/", "block"), (2, "com/de/", "block"), (3, None, "allow"), (4, "org/", "allow"), (5, None, "allow"), (6, None, "allow"), (7, None, "allow"), (8, "com/fr/", "allow"),
        (9, "com/de/", "block"), (10, None, "allow"), (11, None, "allow"), (12, "example.org/en/1", "block"), (13, "org/", "allow"), (14, None, "allow"), (15, "org/", "allow"),
    ]
    assert got == want
    # Without the allowed page in its class, 1 and 3 are blocked; so are pages linked by a given edge.
    fewer = pages.where("page_id <> 4")
    more = spark.createDataFrame([("http://p.net/d/e", "https://bad.com/de/1")], "src string, dst string")
    got = {r.page_id: r.verdict for r in url_filter.url_verdicts(fewer, edges=more).collect()}
    assert [k for k, v in sorted(got.items()) if v == "block"] == [1, 2, 3, 9, 10, 11, 12]


def test_many_rules_are_joined(spark, small, monkeypatch):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    inline = sorted(map(str, url_filter.url_verdicts(pages).collect()))
    monkeypatch.setattr(url_filter, "INLINE_RULES", 0)
    assert sorted(map(str, url_filter.url_verdicts(pages).collect())) == inline


# 3: substrings


def brute_repeats(rows):
    seen, out = {}, {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        w = WORD.findall(t or "")
        gone = set()
        for s in range(len(w) - 19):
            k = tuple(w[s : s + 20])
            if seen.setdefault(k, (i, s)) != (i, s):
                gone |= set(range(s, s + 20))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out[i] = (len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


@pytest.mark.parametrize("batches", [1, 2, 3, 5])
def test_repeats(spark, batches):
    rng = random.Random(batches)
    word = lambda: rng.choice("abcdefghijklmnop") * rng.randint(1, 3)
    text = lambda n: [word() for _ in range(n)]
    shared = [text(n) for n in (20, 21, 30, 60, 200)]
    rows = []
    for i in range(60):
        w = text(rng.randint(0, 30))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(shared)
            a = rng.randint(0, max(0, len(p) - 20))
            w += p[a : a + rng.randint(15, 80)] + text(rng.randint(0, 12))
        rows.append((i * 3, rng.choice((" ", "  ", "\n\t")).join(w)))
    rows += [(500, None), (501, ""), (502, " ".join(["la"] * 90)), (503, rows[5][1]), (504, "x " * 30 + " ".join(text(5000))), (None, rows[7][1])]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.repeats_digest(docs_of(spark, rows), batches).collect()}
    assert got == brute_repeats(rows)


def test_index_keeps_what_it_has_seen(spark):
    p = " ".join(f"w{i}" for i in range(50))
    index = substring_dedup.FingerprintIndex(spark)
    one = spark.createDataFrame([(1, "a b " + p)], "doc bigint, text string")
    two = spark.createDataFrame([(2, p + " c d")], "doc bigint, text string")
    three = spark.createDataFrame([(3, "e " + p)], "doc bigint, text string")
    assert index.add(one).count() == 0
    cover = lambda df: sorted({k for r in df.collect() for k in range(r.at, r.at + r.n)})
    assert cover(index.add(two, one)) == list(range(31))
    assert [level for level, _ in index.runs] == [1]
    assert cover(index.add(three, one.union(two))) == list(range(1, 32))


# 4: embeddings


def test_vectors(spark):
    rng = np.random.default_rng(5)
    rows, base = [], rng.standard_normal((12, 32))
    for k, n in enumerate((1, 2, 3, 700, 5, 9, 4, 4, 4, 4, 4, 4)):
        for _ in range(n):
            rows.append((len(rows), (base[k] + rng.standard_normal(32) * rng.uniform(0.02, 0.3)).astype(np.float32).tolist(), k % 3))
    rows += [(len(rows) + i, rng.standard_normal(32).astype(np.float32).tolist(), 1) for i in range(300)]
    n = len(rows)
    rows += [(n, None, 1), (n + 1, [0.0] * 32, 1), (n + 2, [math.nan] + [1.0] * 31, 1), (n + 3, rows[0][1], None), (n + 4, [None] + [1.0] * 31, 1), (n + 5, rows[10][1], rows[10][2]), (n + 6, rows[10][1][:16], rows[10][2]), (None, rows[10][1], rows[10][2]), (n + 7, [], 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<float>, label int, v string")
    got = embedding_dedup.near_duplicate_vectors(df).collect()
    assert len(got) == len(rows)
    fine = [(i, np.array(e, float), y) for i, e, y in rows if i is not None and e and y is not None and None not in e and np.isfinite(e).all() and np.any(e)]
    links, pairs = Counter(), []
    for label in (0, 1, 2):
        for d in (16, 32):
            part = [(i, e / np.linalg.norm(e)) for i, e, y in fine if y == label and len(e) == d]
            if part:
                x = np.stack([e for _, e in part])
                a, b = np.nonzero(np.triu(x @ x.T >= 0.93, 1))
                pairs += [(part[i][0], part[j][0]) for i, j in zip(a, b)]
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    want = roots(pairs, [r[0] for r in rows if r[0] is not None])
    have = {r.vec_id: r for r in got if r.vec_id is not None}
    found = sum(min(have[i].n_links, links[i]) for i in have)
    assert found >= 0.98 * sum(links.values()) and all(have[i].n_links <= links[i] for i in have)
    assert np.mean([have[i].component_id == want[i] for i in have]) > 0.99
    assert all(r.kept == (r.vec_id == r.component_id) for r in got) and have[n + 5].n_links == links[n + 5]


# 5: languages


def test_languages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    odd = docs_of(spark, [(90001, None), (90002, "123 --- 456"), (90003, ""), (90004, "the and of with", None), (90005, "x" * 5000)])
    rows = docs.unionByName(odd.select(docs.columns))
    got = {r.doc_id: r for r in language.identify(rows).collect()}
    assert len(got) == rows.count()
    assert [got[i].lang_pred for i in (90001, 90002, 90003)] == ["und"] * 3 and got[90004].lang_pred == "en" and got[90005].lang_pred in {"en", "de", "fr", "es"}
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got.values())
    truth = {r.doc_id: r.lang for r in docs.collect()}
    held = [i for i in truth if got[i].held_out]
    assert np.mean([got[i].lang_pred == truth[i] for i in held]) > 0.95
    kept = {r.doc_id for r in language.keep_identified(rows).collect()}
    assert not kept & {90001, 90002, 90003} and len(kept) > 0.98 * len(truth)


def test_backoff():
    grams = [("a", g, 10) for g in ("x", "xy", "y", "^", "$")] + [("b", g, 10) for g in ("z", "^", "$")]
    m = language.Model(["b", "a"], [("a", "known", 5)], {"a": 5, "b": 5}, grams, {("a", 1): 30, ("b", 1): 30, ("a", 2): 10})
    assert m.languages == ["a", "b"] and m.predictor()("known")[0] == "a" and m.predictor()("zz zzz")[0] == "b" and m.predictor()("xy")[0] == "a"
    assert np.allclose(m.backoff("zx"), (m.backoff("z") + m.backoff("x")) / 2) and not m.backoff("?").any()
    assert language.Model([], [], {}, [], {}).predictor()("abc") == ("und", 0.0)


def test_unlabelled_documents_teach_nothing(spark):
    rows = [(i, "the of and", None) for i in range(6)]
    assert {r.lang_pred for r in language.identify(docs_of(spark, rows)).collect()} == {"und"}


# 6: shards


def owner(doc_id, n):
    u = lambda s: int(hashlib.md5(f"{'null' if doc_id is None else doc_id}:{s}:0".encode()).hexdigest()[:13], 16)
    return max(range(n), key=u)


def test_shards(spark):
    rows = [(i, f"é text {i}" * (i % 4)) for i in range(3000)] + [(5, "again"), (None, None), (None, "b")]
    got = sharding.shard_digest(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    text = {i: t for i, t in rows[:3000]}
    for r in got:
        assert r.shard == owner(r.doc_id, 8) and r.grown_shard == owner(r.doc_id, 9) and r.grown_shard in (r.shard, 8) and r.law == "key"
        if r.doc_id is not None and r.doc_id != 5:
            assert r.size == len(text[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode())
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) < 1.3 * len(rows) / 8


def test_shard_weights(spark):
    docs = docs_of(spark, [(i, "t") for i in range(4000)])
    n = {r.s: r["count"] for r in sharding.shard_documents(docs, weights=(1, 3, 0), name="s").groupBy("s").count().collect()}
    assert set(n) == {0, 1} and 0.70 < n[1] / 4000 < 0.80
    with pytest.raises(ValueError):
        sharding.shard_documents(docs, weights=(0,))


# 7: SimHash


def brute_fingerprint(text):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in WORD.findall(text or "")]
    if not w:
        return 0
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark):
    rng = random.Random(4)
    word = lambda: rng.choice(["Wort", "élan", "foo", "BAR", "x", "y", "zz", "Ärger"])
    rows = []
    for i in range(120):
        w = [word() for _ in range(rng.randint(0, 60))]
        rows.append((2 * i, " ".join(w)))
        if i % 3 == 0:
            rows.append((2 * i + 1, "\n".join(w).upper() if i % 2 else " ".join([*w[:1], "new", *w[2:]])))
    rows += [(1000, None), (1001, " \t"), (1002, "a b"), (1003, "c"), (1004, "é" * 3), (1005, " ".join(word() for _ in range(70_000))), (4, dict(rows)[4]), (None, "lonely words here now")]
    got = simhash.near_duplicate_digest(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    fps = [(i, brute_fingerprint(t)) for i, t in rows]
    assert sorted((str(r.doc_id), r.fingerprint) for r in got) == sorted((str(i), f"{f:016x}") for i, f in fps)
    known = [(i, f) for i, f in fps if i is not None]
    pairs = [(a, b) for k, (a, x) in enumerate(known) for b, y in known[:k] if bin(x ^ y).count("1") <= 2]
    want = roots(pairs, {i for i, _ in known})
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
    kept = simhash.keep_one_of_each(docs_of(spark, rows))
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted([*map(str, {i for i in want if want[i] == i}), "None"]) and kept.columns == docs_of(spark, rows).columns


# 8: secrets


def test_secrets(spark, small):
    rng = random.Random(2)
    key = lambda: "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16))
    hexa = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    rows = [(i, f"some words {key()} go on. token = \"{hexa(40)}\" and password={hexa(18)} then donaudampfschifffahrtsgesellschaft x@mail1234567.example.com 4565410125667261 end") for i in range(120)]
    rows += [(900, None), (901, ""), (902, "short"), (903, "z" * 100_000), (3, rows[3][1])]
    got = secrets.secret_findings(docs_of(spark, rows)).collect()
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    bad = re.compile(r"^(AKIA|password=|[0-9a-f]{40}$)")
    assert len(held) > 50 and np.mean([r.secret == bool(bad.match(r.candidate)) for r in held if r.doc_id < 900]) > 0.98
    assert sum(r.doc_id == 3 for r in got) == 10 and [len(r.candidate) for r in got if r.doc_id == 903] == [100_000]
    assert all(r.p_secret is not None and 0 <= r.p_secret <= 1 for r in got)
    given = spark.createDataFrame([("A" * 20, "", "", "", 1)], "candidate string, before string, after string, path string, label int")
    assert {r.p_secret for r in secrets.secret_findings(docs_of(spark, rows[:3]), given).collect()} == {None}


# 9: WARC


def test_warc(spark, tmp_path):
    rows = [(i, f"http://x/{i} y\n", "<p>é" * (i % 7) if i % 5 else None) for i in range(300)] + [(3, "http://x/3", "other"), (None, None, "<p>é"), (None, "u", "n"), (7, "http://x/7 y\n", "<p>é" * 0)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id bigint, url string, html string, sha int")
    out = f"file://{tmp_path}/a"
    entries = warc.write_warc(pages, out, roll=4000, shard_bytes=22_000)
    assert len(entries) > 8 and sum(e["records"] for e in entries) == len(rows) and not (tmp_path / "a/_temporary").exists()
    names = {p.name for p in (tmp_path / "a").glob("part-*")}
    assert names == {e["name"] for e in entries} and all(hashlib.sha256((tmp_path / "a" / e["name"]).read_bytes()).hexdigest() == e["sha256"] for e in entries)
    again = warc.write_warc(pages.repartition(7), f"file://{tmp_path}/b", roll=4000, shard_bytes=22_000)
    assert again == entries
    got = warc.read_warc(spark, out).collect()
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    want = []
    for i, _, h in rows:
        body = (h or "").encode()
        f = first.get(h or "")
        to = None if f is None or i == f else f
        want.append((str(i), len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if to is None else "revisit", to))
    assert sorted(map(str, want)) == sorted(str((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got)
    some = warc.write_warc(pages, f"file://{tmp_path}/c", least=8)
    types = Counter((r.payload_bytes < 8, r.record_type) for r in warc.read_warc(spark, f"file://{tmp_path}/c").collect())
    assert some and types[True, "revisit"] == 0 and types[False, "revisit"] > 0
    bad = tmp_path / "a" / entries[0]["name"]
    bad.write_bytes(bad.read_bytes()[:-20])
    with pytest.raises(Exception, match="cut off|wrong|Error"):
        warc.read_warc(spark, out).collect()


# 10: mixing


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: k % 3 + 1 for k, s in enumerate(order)}
    left, free, out = float(sum(sizes.values())), set(order), {}
    while free:
        level = left / sum(w[s] for s in free)
        full = {s for s in free if level * w[s] > 3 * sizes[s]}
        if not full:
            return out | {s: level * w[s] for s in free}
        out |= {s: 3.0 * sizes[s] for s in full}
        left -= sum(3.0 * sizes[s] for s in full)
        free -= full
    return out


def test_mixing(spark):
    rng = random.Random(8)
    rows = [(i, " ".join("w" * rng.randint(1, 4) for _ in range(rng.randint(0, 40))), "en", rng.choice(["a", "b", "b", "b", "b", "ü", "z", None, "b2"])) for i in range(2500)]
    rows += [(3000, "one two", "en", "tiny"), (3001, None, "en", "empty"), (3002, "", "en", "empty"), (5, rows[5][1], "en", rows[5][3])]
    got = mixing.mix_digest(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    targets, source = brute_targets(sizes), {r[0]: r[3] for r in rows}
    taken = Counter()
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(targets[s]) and r.taken <= 3 * r.size
        taken[s] += r.taken
    assert targets["tiny"] == 6 and taken["tiny"] == 6 and sum(targets.values()) == pytest.approx(sum(sizes.values()))
    assert all(abs(taken[s] - t) < 0.1 * t + 200 for s, t in targets.items())
    assert sorted(map(str, mixing.mix_digest(docs_of(spark, rows).repartition(5)).collect())) == sorted(map(str, got))
    mixed = mixing.mix_documents(docs_of(spark, rows))
    assert mixed.columns == docs_of(spark, rows).columns
    copies = Counter(r.doc_id for r in mixed.collect())
    assert all(copies[r.doc_id] * r.size == r.taken * (2 if r.doc_id == 5 else 1) for r in got)
