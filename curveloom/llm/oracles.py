"""DuckDB SQL for the queries of this subpackage that SQL can express; written from the contracts, not from the operators."""

from __future__ import annotations

WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

OP2 = r"""
WITH RECURSIVE rules(verdict, host, path) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
p AS (SELECT page_id, html, row_number() OVER () AS r, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, html, r, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^/?#]*([^#]*)', 1) AS tail FROM p),
nodes AS (SELECT *, host || CASE WHEN starts_with(tail, '/') THEN tail ELSE '/' || tail END AS node FROM parts),
tags AS (SELECT r, node, unnest(regexp_extract_all(coalesce(html, ''), '(?is)<(?:link|meta)\b[^>]*>')) AS tag FROM nodes),
hrefs AS (SELECT node AS u, CASE WHEN regexp_matches(tag, '(?is)^<link.*\brel\s*=\s*["'']?canonical\b') THEN regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)
  WHEN regexp_matches(tag, '(?is)^<meta.*\bhttp-equiv\s*=\s*["'']?refresh\b') THEN regexp_extract(tag, '(?is)\burl\s*=\s*["'']?([^"''\s>;]+)', 1) ELSE '' END AS href FROM tags),
targets AS (SELECT u, substr(href, instr(href, '://') + 3) AS rest FROM hrefs WHERE contains(href, '://')),
links AS (SELECT u, lower(regexp_extract(rest, '^([^/?#]*)', 1)) || CASE WHEN starts_with(regexp_extract(rest, '^[^/?#]*([^#]*)', 1), '/') THEN '' ELSE '/' END || regexp_extract(rest, '^[^/?#]*([^#]*)', 1) AS v FROM targets),
sym AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
reach(a, b) AS (SELECT u, u FROM sym UNION SELECT reach.a, sym.v FROM reach JOIN sym ON sym.u = reach.b),
named AS (SELECT DISTINCT b AS node, regexp_extract(b, '^([^/]*)', 1) AS host, regexp_extract(b, '^[^/]*([^?]*)', 1) AS path FROM reach),
fit AS (SELECT n.node, arg_max(rules.verdict, length(rules.host || rules.path)) AS verdict FROM named n JOIN rules ON (n.host = rules.host OR n.host LIKE '%.' || rules.host) AND starts_with(n.path, rules.path) GROUP BY 1),
spread AS (SELECT reach.a AS node, bool_or(fit.verdict = 'allow') AS allowed, bool_or(fit.verdict = 'block') AS blocked FROM reach JOIN fit ON fit.node = reach.b GROUP BY 1),
own AS (SELECT n.r, arg_max(rules.host || rules.path, length(rules.host || rules.path)) AS rule, arg_max(rules.verdict, length(rules.host || rules.path)) AS verdict
  FROM nodes n JOIN rules ON (n.host = rules.host OR n.host LIKE '%.' || rules.host) AND starts_with(n.path, rules.path) GROUP BY 1)
SELECT n.page_id, n.host, n.path, own.rule, coalesce(own.verdict, CASE WHEN s.blocked AND NOT s.allowed THEN 'block' ELSE 'allow' END) AS verdict
FROM nodes n LEFT JOIN own ON own.r = n.r LEFT JOIN spread s ON s.node = n.node
"""

OP3 = rf"""
WITH d AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS ws FROM documents),
win AS (SELECT doc_id, s, array_to_string(ws[s:s + 19], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS s FROM d)),
seen AS (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS n FROM win),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM seen WHERE n > 1),
flat AS (SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM d),
kept AS (SELECT f.doc_id, string_agg(f.w, ' ' ORDER BY f.i) AS t, count(*) AS n FROM flat f ANTI JOIN gone g ON g.doc_id = f.doc_id AND g.i = f.i GROUP BY 1)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(len(d.ws) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256 FROM d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

OP4 = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(u, c) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.v, r.c FROM reach r JOIN links l ON l.u = r.u WHERE r.c < l.v),
low AS (SELECT u, min(c) AS c FROM reach GROUP BY 1), n AS (SELECT u, count(*) AS n FROM links GROUP BY 1)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, low.c AS component_id, low.c = e.vec_id AS kept FROM embeddings e JOIN low ON low.u = e.vec_id LEFT JOIN n ON n.u = e.vec_id
"""

OP6 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), crc(c) AS (SELECT list_transform(range(256), lambda x: list_reduce(list_concat([x], range(8)), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END))),
b AS (SELECT doc_id, octet_length(encode(t)) + 1 AS size, list_concat([4294967295], list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda h: CAST('0x' || h AS BIGINT))) AS bytes FROM d),
k AS (SELECT doc_id, size, xor(list_reduce(bytes, lambda a, x: xor(a >> 8, c[1 + (xor(a, x) & 255)])), 4294967295) AS text_crc32 FROM b CROSS JOIN crc),
u AS (SELECT k.*, s, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || s || ':0'), 1, 13) AS BIGINT) AS u FROM k CROSS JOIN range(9) r(s)),
p AS (SELECT doc_id, size, text_crc32, arg_max(s, u) FILTER (s < 8) AS shard, arg_max(s, u) AS grown FROM u GROUP BY 1, 2, 3)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS slot, CAST(grown AS INTEGER) AS grown_shard FROM p
"""

M64 = "18446744073709551616::UHUGEINT"
# The primes of XXH64.
P1, P2, P3, P4, P5 = (f"{p}::UHUGEINT" for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))


def _rot(z: str, r: int) -> str:
    """z turned left by r of 64 bits."""
    return f"((({z}) * {1 << r}::UHUGEINT) % {M64} + ({z}) // {1 << 64 - r}::UHUGEINT)"


def _xor(a: str, b: str) -> str:
    return f"CAST(xor(CAST({a} AS UBIGINT), CAST({b} AS UBIGINT)) AS UHUGEINT)"


def _round(a: str, x: str) -> str:
    return f"({_rot(f'(({a} + {x} * {P2}) % {M64})', 31)} * {P1} % {M64})"


def _fold(first: str, items: str, step: str) -> str:
    """The items folded from the left, from `first`, by step(a, x)."""
    return f"list_reduce(list_concat([{first}], {items}), lambda a, x: {step})"


def _lane(n: int) -> str:
    """The little-endian numbers of n bytes of a hex text h that start at the places x."""
    return "CAST('0x' || " + " || ".join(f"substr(h, 2 * x + {2 * k + 1}, 2)" for k in reversed(range(n))) + " AS UHUGEINT)"


#: XXH64 (seed 42) of the hex text h of n bytes, in steps: the lanes of 32 bytes each, what is left in eights, in fours and in ones.
XXH64 = f"""
x1 AS (SELECT *, n // 32 * 32 AS done, (n - n // 32 * 32) // 8 * 8 + n // 32 * 32 AS eights, CASE WHEN n % 8 >= 4 THEN n // 8 * 8 + 4 ELSE n // 8 * 8 END AS fours FROM x0),
x2 AS (SELECT *, {", ".join(f"CASE WHEN done > 0 THEN {_fold(v, f'list_transform(range({8 * j}, done, 32), lambda x: {_lane(8)})', _round('a', 'x'))} END AS v{j}" for j, v in enumerate((f"((42::UHUGEINT + {P1} + {P2}) % {M64})", f"((42::UHUGEINT + {P2}) % {M64})", "42::UHUGEINT", f"((42::UHUGEINT + {M64} - {P1}) % {M64})")))} FROM x1),
x3 AS (SELECT *, CASE WHEN done > 0 THEN {_fold(f"(({_rot('v0', 1)} + {_rot('v1', 7)} + {_rot('v2', 12)} + {_rot('v3', 18)}) % {M64})", "[v0, v1, v2, v3]", f"({_xor('a', _round('0::UHUGEINT', 'x'))} * {P1} + {P4}) % {M64}")} ELSE 42::UHUGEINT + {P5} END + n::UHUGEINT AS w FROM x2),
x4 AS (SELECT *, {_fold(f"(w % {M64})", f"list_transform(range(done, eights, 8), lambda x: {_lane(8)})", f"({_rot(_xor('a', _round('0::UHUGEINT', 'x')), 27)} * {P1} + {P4}) % {M64}")} AS w4 FROM x3),
x5 AS (SELECT *, {_fold("w4", f"list_transform(range(eights, fours, 4), lambda x: {_lane(4)})", f"({_rot(_xor('a', f'(x * {P1} % {M64})'), 23)} * {P2} + {P3}) % {M64}")} AS w5 FROM x4),
x6 AS (SELECT *, {_fold("w5", f"list_transform(range(fours, n), lambda x: {_lane(1)})", f"{_rot(_xor('a', f'(x * {P5} % {M64})'), 11)} * {P1} % {M64}")} AS w6 FROM x5),
x7 AS (SELECT *, {_xor("w6", f"w6 // {1 << 33}::UHUGEINT")} * {P2} % {M64} AS w7 FROM x6), x8 AS (SELECT *, {_xor("w7", f"w7 // {1 << 29}::UHUGEINT")} * {P3} % {M64} AS w8 FROM x7),
xxh AS (SELECT *, CAST({_xor("w8", f"w8 // {1 << 32}::UHUGEINT")} AS UBIGINT) AS hash FROM x8)"""

OP7 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, row_number() OVER () AS r, {WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM documents),
g AS (SELECT r, array_to_string(ws[i:i + 2], ' ') AS k FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM d WHERE len(ws) > 0)),
x0 AS (SELECT k, hex(encode(k)) AS h, octet_length(encode(k)) AS n FROM (SELECT DISTINCT k FROM g)), {XXH64},
b AS (SELECT r, count(*) AS n, {", ".join(f"sum((hash >> {i}) & 1) AS b{i}" for i in range(64))} FROM g JOIN xxh ON xxh.k = g.k GROUP BY 1),
f AS (SELECT d.doc_id, coalesce(CAST({" + ".join(f"CASE WHEN 2 * b{i} > n THEN {1 << i}::UHUGEINT ELSE 0::UHUGEINT END" for i in range(64))} AS UBIGINT), 0::UBIGINT) AS fp FROM d LEFT JOIN b ON b.r = d.r),
u AS (SELECT DISTINCT fp FROM f), l AS (SELECT a.fp AS p, b.fp AS q FROM u a JOIN u b ON a.fp <> b.fp AND bit_count(CAST(xor(a.fp, b.fp) AS HUGEINT)) <= 2),
reach(p, q) AS (SELECT fp, fp FROM u UNION SELECT reach.p, l.q FROM reach JOIN l ON l.p = reach.q), low AS (SELECT reach.p, min(f.doc_id) AS c FROM reach JOIN f ON f.fp = reach.q GROUP BY 1)
SELECT f.doc_id, lower(lpad(to_hex(f.fp), 16, '0')) AS fingerprint, low.c AS component_id FROM f JOIN low ON low.p = f.fp
"""

OP9 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages), h AS (SELECT page_id, octet_length(body) AS n, sha1(body) AS sha FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY sha) AS first FROM h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(sha, 1 + 5 * CAST(i // 4 AS INTEGER), 5) AS BIGINT) >> (15 - 5 * CAST(i % 4 AS INTEGER))) & 31 AS INTEGER), 1)), '') AS payload_digest,
CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM f
"""

OP10 = rf"""
WITH d AS (SELECT doc_id, source, CAST(len({WORDS.format("coalesce(text, '')")}) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS z FROM d GROUP BY 1), w AS (SELECT source, z, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY 3 * z / w) AS k, 3 * z / w AS ratio FROM w), t AS (SELECT sum(z) AS t FROM s),
c AS (SELECT o.k, o.ratio, (t.t - 3.0::DOUBLE * coalesce(sum(o.z) OVER b, 0)) / sum(o.w) OVER a AS level FROM o CROSS JOIN t
  WINDOW b AS (ORDER BY o.k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), a AS (ORDER BY o.k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
l AS (SELECT arg_min(level, k) AS level FROM c WHERE level <= ratio), g AS (SELECT source, z, least(level * w, 3.0::DOUBLE * z) AS target FROM w CROSS JOIN l),
m AS (SELECT d.doc_id, d.size, g.z, g.target, CASE WHEN g.z > 0 THEN g.target / g.z ELSE 0 END AS rate, CAST('0x' || substr(md5(coalesce(CAST(d.doc_id AS VARCHAR), 'null') || ':1'), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, z AS source_size, target, CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM m
"""

ORACLES = {
    "op2_url_verdicts": OP2,
    "op3_substring_dedup": OP3,
    "op4_embedding_near_dup": OP4,
    "op6_rendezvous_shards": OP6,
    "op7_simhash_components": OP7,
    "op9_warc_round_trip": OP9,
    "op10_mix_sources": OP10,
}
