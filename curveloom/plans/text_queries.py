"""Queries of text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from curveloom.functions import lexicon as lx
from curveloom.functions import text as X
from curveloom.plans.registry import query
from curveloom.plans.tables import PARAGRAPHS, SAMPLES, paragraphs, samples, table, values_sql

WS = r"trim(regexp_replace(coalesce({0}, ''), '\s+', ' ', 'g'))"
DASH = "replace(replace(lower(coalesce({0}, '')), '–', '-'), '—', '-')"


def _ws(x: str) -> str:
    return WS.format(x)


def _norm(x: str) -> str:
    return _ws(DASH.format(x))


def _match(x: str) -> str:
    return _ws(rf"regexp_replace({DASH.format(x)}, '[^a-z0-9θ\s\-]', ' ', 'g')")


TITLE_SQL = _ws(r"regexp_replace(" + _norm("text") + r", '[^\p{L}\p{M}\p{Nd}\p{Pc}\s]', '', 'g')")
SLUG_SQL = r"coalesce(nullif(regexp_replace(left(regexp_replace(regexp_replace(" + _norm("text") + r", '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 70), '-+$', ''), ''), 'paper')"


@query("text_normal_forms", f"""WITH p AS ({PARAGRAPHS}) SELECT id, md5({_ws('text')}) AS spaces, md5({_norm('text')}) AS plain, md5({_match('text')}) AS matching, md5({TITLE_SQL}) AS title,
{SLUG_SQL} AS slug, 'doc_' || left(sha1(coalesce(text, '')), 12) AS stable_id,
CASE WHEN {_ws('text')} = '' THEN 'Unknown title' WHEN length({_ws('text')}) > 80 THEN rtrim(left({_ws('text')}, 77)) || '...' ELSE {_ws('text')} END AS shown FROM p""")
def text_normal_forms(spark, sf_dir):
    t = F.col("text")
    return paragraphs(spark, sf_dir).select(
        "id", F.md5(X.normalize_whitespace(t)).alias("spaces"), F.md5(X.normalize_text(t)).alias("plain"), F.md5(X.normalize_for_matching(t)).alias("matching"),
        F.md5(X.normalize_title(t)).alias("title"), X.slug(t).alias("slug"), X.stable_id("doc", t).alias("stable_id"), X.display_title(t).alias("shown"),
    )


DOIS = ((1, "https://doi.org/10.1000/ABC.1"), (2, "DOI: 10.1/x "), (3, " http://dx.doi.org/10.2/Y"), (4, "10.3/z"), (5, ""), (6, None), (7, "doi:"))


@query("identifiers", rf"""WITH d AS (SELECT * FROM {values_sql(DOIS, 'id, doi')}), n AS (SELECT id, nullif(trim(lower(regexp_replace(regexp_replace(trim(coalesce(doi, '')), '^https?://(dx\.)?doi\.org/', '', 'i'), '^doi:\s*', '', 'i'))), '') AS doi FROM d)
SELECT id, doi, coalesce('doi:' || doi, 'openalex:W' || id) AS identity, 'W' || id AS short FROM n""")
def identifiers(spark, sf_dir):
    rows = spark.createDataFrame(list(DOIS), "id int, doi string")
    work = F.concat(F.lit("https://openalex.org/W"), F.col("id").cast("string"), F.lit("/"))
    return rows.select("id", X.normalize_doi(F.col("doi")).alias("doi"), X.work_identity(F.col("doi"), work).alias("identity"), X.short_id(work).alias("short"))


@query("page_url_parts", r"""SELECT page_id, regexp_matches(url, '(?i)^https?://[^/?#]+') AS valid, list_extract(string_split(regexp_replace(url, '/+$', ''), '/'), -1) AS short,
lpad(CAST(page_id % 100 AS VARCHAR), 2, '0') || '_' || list_extract(string_split(regexp_replace(url, '/+$', ''), '/'), -1) || '_paper.pdf' AS filename FROM pages""")
def page_url_parts(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select(
        "page_id", X.valid_http_url(F.col("url")).alias("valid"), X.short_id(F.col("url")).alias("short"),
        X.pdf_filename((F.col("page_id") % 100).cast("int"), F.col("url"), F.lit("")).alias("filename"),
    )


@query("inverted_index_round_trip", """SELECT doc_id, md5(text) AS text_md5, len(list_distinct(string_split(text, ' '))) AS words FROM documents""")
def inverted_index_round_trip(spark, sf_dir):
    index = table(spark, sf_dir, "documents").select("doc_id", X.positions_from_text(F.col("text")).alias("ix"))
    known = F.col("ix").isNotNull()
    return index.select("doc_id", F.when(known, F.md5(X.text_from_positions(F.col("ix")))).alias("text_md5"), F.when(known, F.size("ix").cast("bigint")).alias("words"))


def _terms_sql(x: str, weights) -> str:
    return " + ".join(f"CASE WHEN contains({x}, '{t}') THEN {w} ELSE 0 END" for t, w in weights.items())


LEGAL = {"license": 5, "copyright": 4, "the": 1, "der": 1, "lic": 2}


@query("weighted_terms", f"""WITH p AS ({PARAGRAPHS}), n AS (SELECT id, text, {_norm('text')} AS t FROM p)
SELECT id, {_terms_sql('t', LEGAL)} AS legal, {_terms_sql('t', lx.MATERIAL_BODY)} AS material, {_terms_sql('t', lx.XRD_BODY)} AS xrd FROM n""")
def weighted_terms(spark, sf_dir):
    t = F.col("text")
    return paragraphs(spark, sf_dir).select("id", X.weighted_terms(t, LEGAL).alias("legal"), X.weighted_terms(t, lx.MATERIAL_BODY).alias("material"), X.weighted_terms(t, lx.XRD_BODY).alias("xrd"))


def _phrase_sql(x: str, phrases) -> str:
    return "(" + " OR ".join(f"contains({x}, '{X._matching(p)}')" for p in phrases) + ")"


@query("section_kinds", f"""WITH p AS (SELECT CAST(id AS BIGINT) AS id, title AS t FROM {values_sql(SAMPLES, 'id, title, text')} UNION ALL SELECT 1000 + doc_id, text FROM documents), n AS (SELECT id, {_match('t')} AS t FROM p)
SELECT id, CASE {' '.join(f"WHEN {_phrase_sql('t', ps)} THEN '{kind}'" for kind, ps in lx.SECTION_KINDS)} ELSE 'other' END AS kind FROM n""")
def section_kinds(spark, sf_dir):
    rows = samples(spark).select("id", "title").unionByName(table(spark, sf_dir, "documents").select((F.col("doc_id") + 1000).alias("id"), F.col("text").alias("title")))
    return rows.select("id", X.classify_section(F.col("title")).alias("kind"))


DEGREES_SQL = r"list_filter(list_transform(regexp_extract_all(coalesce(text, ''), '(?i)(\d{1,3}(?:\.\d+)?)\s*(?:°|degrees?|deg)', 1), lambda v: v::DOUBLE), lambda v: v BETWEEN 0 AND 180)"
MILLER_SQL = r"list_transform(regexp_extract_all(coalesce(text, ''), '\(\s*[\-−]?\d+\s*[,\s]*[\-−]?\d+\s*[,\s]*[\-−]?\d+\s*\)'), lambda v: trim(regexp_replace(v, '\s+', ' ', 'g')))"


@query("extracted_features", f"""WITH p AS ({PARAGRAPHS}) SELECT id, array_to_string(list_sort(list_transform(list_distinct({DEGREES_SQL}), lambda v: printf('%.3f', v))), ' ') AS degrees,
array_to_string(list_sort(list_distinct({MILLER_SQL})), ' ') AS miller FROM p""")
def extracted_features(spark, sf_dir):
    t = F.col("text")
    degrees = F.array_sort(F.transform(X.extract_degrees(t), lambda v: F.format_string("%.3f", v)))
    return paragraphs(spark, sf_dir).select("id", F.array_join(degrees, " ").alias("degrees"), F.array_join(F.array_sort(X.extract_miller(t)), " ").alias("miller"))


SCORE_SQL = (
    " + ".join(f"CASE WHEN contains(n, '{X._matching(t)}') THEN {w} ELSE 0.0 END" for t, w in lx.PARAGRAPH_STRONG.items())
    + " + "
    + " + ".join(f"CASE WHEN contains(n, '{X._matching(t)}') THEN 0.4 ELSE 0.0 END" for t in lx.PARAGRAPH_ANALYSIS)
    + f" + CASE WHEN regexp_matches(coalesce(text, ''), '(?i)2\\s*(?:theta|θ)') THEN 2.0 ELSE 0.0 END + least(len(list_distinct({DEGREES_SQL})), 5) * 0.5 + least(len(list_distinct({MILLER_SQL})), 5) * 0.5"
    + " + CASE WHEN contains(n, 'figure') OR contains(n || ' ', 'fig ') THEN 0.5 ELSE 0.0 END"
)
PARAGRAPH_SCORES = f"SELECT id, CAST(CASE WHEN n = '' THEN 0 ELSE round({SCORE_SQL}, 3) END AS DOUBLE) AS score FROM (SELECT id, text, {_match('text')} AS n FROM ({PARAGRAPHS}))"


@query("paragraph_scores", PARAGRAPH_SCORES)
def paragraph_scores(spark, sf_dir):
    return paragraphs(spark, sf_dir).select("id", X.score_paragraph(F.col("text")).alias("score"))


SENTENCES_SQL = (
    r"list_transform(list_filter(string_split(regexp_replace(regexp_replace(" + _ws("text") + r", '(?i)\b(Fig(?:ure)?|vs|etc)\.', '\1' || chr(57344), 'g'), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)),"
    " lambda s: trim(s) <> ''), lambda s: replace(s, chr(57344), '.'))"
)


@query("sentences", f"""WITH p AS ({PARAGRAPHS}), s AS (SELECT id, {SENTENCES_SQL} AS s FROM p) SELECT id, len(s) AS n, md5(array_to_string(s, '|')) AS joined FROM s""")
def sentences(spark, sf_dir):
    s = X.split_sentences(F.col("text"))
    return paragraphs(spark, sf_dir).select("id", F.size(s).cast("bigint").alias("n"), F.md5(F.array_join(s, "|")).alias("joined"))


REFS_SQL = r"list_filter(list_transform(regexp_extract_all(coalesce({0}, ''), '(?i)\b(?:supplementary\s+)?fig(?:ure)?s?\.?\s*[(\[\s]*([A-Za-z]?\d+[A-Za-z]?)', 1), lambda v: regexp_extract(v, '\d+')), lambda v: v <> '')"


@query("figure_references", f"""WITH p AS ({PARAGRAPHS}) SELECT id, array_to_string(list_sort(list_distinct({REFS_SQL.format('text')})), ',') AS refs,
regexp_extract(regexp_extract(coalesce(text, ''), '(?i)\\bfig(?:ure)?s?\\.?\\s*([A-Za-z]?\\d+[A-Za-z]?)', 1), '\\d+') AS first_label FROM p""")
def figure_references(spark, sf_dir):
    t = F.col("text")
    return paragraphs(spark, sf_dir).select("id", F.array_join(F.array_sort(X.figure_references(t)), ",").alias("refs"), F.coalesce(X.caption_label(t), F.lit("")).alias("first_label"))


@query("figure_mentions", f"""WITH p AS (SELECT CAST(id AS BIGINT) AS id, text FROM {values_sql(SAMPLES, 'id, title, text')}), l AS (SELECT id, text, unnest(list_distinct({REFS_SQL.format('text')})) AS label FROM p),
s AS (SELECT id, label, {SENTENCES_SQL} AS s FROM l)
SELECT id, label, nullif(array_to_string(list_filter(s, lambda x: list_contains({REFS_SQL.format('x')}, label)), ' '), '') AS mentions FROM s""")
def figure_mentions(spark, sf_dir):
    rows = samples(spark).select("id", "text", F.explode(X.figure_references(F.col("text"))).alias("label"))
    return rows.select("id", "label", X.mention_text(F.col("text"), F.col("label")).alias("mentions"))


@query("figure_specific_text")
def figure_specific_text(spark, sf_dir):
    rows = samples(spark).select("id", "text", F.explode(X.figure_references(F.col("text"))).alias("label"))
    return rows.select("id", "label", X.specific_text(F.col("text"), F.col("label")).alias("specific"))


FIGURE_IDS = ((1, "fig_0", "1", "Fig. 1 a"), (2, "fig_3", "7", "Fig. 8 b"), (3, "fig_4", None, "no label"), (4, "f9", "x", ""), (5, None, None, "only words"), (6, None, "2a", "Figure 2"))


@query("figure_ids")
def figure_ids(spark, sf_dir):
    rows = spark.createDataFrame(list(FIGURE_IDS), "id int, service string, label string, caption string")
    c = F.col
    return rows.select("id", X.normalize_figure_label(c("label")).alias("normal"), X.valid_figure_label(c("label"), c("caption")).alias("valid"), X.figure_id(c("service"), c("label"), c("caption")).alias("figure_id"))


BOXES = ((1, "1,10,20,30,40"), (2, "1,0.5,2,3,4;2,5,6,7,8;"), (3, "1,2,3"), (4, "1,2,3,0,4"), (5, ""), (6, None))


@query("box_strings", f"""WITH b AS (SELECT * FROM {values_sql(BOXES, 'id, s')}), e AS (SELECT id, trim(unnest(string_split(coalesce(s, ''), ';'))) AS box FROM b), f AS (SELECT id, string_split(box, ',') AS f FROM e WHERE box <> ''),
g AS (SELECT id, count(*) AS n, bool_and(len(f) = 5 AND coalesce(try_cast(f[4] AS DOUBLE) > 0 AND try_cast(f[5] AS DOUBLE) > 0, false)) AS fine, sum(try_cast(f[4] AS DOUBLE) * try_cast(f[5] AS DOUBLE)) AS area FROM f GROUP BY 1)
SELECT b.id, CASE WHEN coalesce(fine, true) THEN coalesce(n, 0) END AS n, CASE WHEN coalesce(fine, true) THEN coalesce(area, 0) END AS area FROM b LEFT JOIN g ON b.id = g.id""")
def box_strings(spark, sf_dir):
    boxes = X.boxes_from_text(F.col("s"))
    rows = spark.createDataFrame(list(BOXES), "id int, s string").select("id", boxes.alias("b"))
    area = F.aggregate("b", F.lit(0.0), lambda a, x: a + x["w"] * x["h"])
    back = X.boxes_from_text(X.text_from_boxes(F.col("b")))
    return rows.select("id", F.when(F.col("b").isNotNull() & (back == F.col("b")), F.size("b").cast("bigint")).alias("n"), area.alias("area"))


STEMS = (("pattern_12",), ("Figure_007",), ("fig-3b",), ("sample_figure9",), ("curve",))


@query("file_stems")
def file_stems(spark, sf_dir):
    s = F.col("stem")
    rows = spark.createDataFrame(list(STEMS), "stem string")
    return rows.select("stem", X.pattern_index(s).alias("pattern"), X.output_stem(s).alias("output"), X.curve_stem(F.concat(s, F.lit(".png")), F.lit(1), F.lit(2)).alias("band"))


CAPTION_STRONG = ("xrd", "x-ray diffraction", "2θ", "2 theta")
CAPTION_WEAK = (
    "x ray diffraction", "powder diffraction", "diffraction pattern", "diffractogram", "diffractograms", "two theta", "2-theta", "rietveld", "bragg", "pxrd",
    "synchrotron diffraction",
)


@query("caption_scores", f"""WITH p AS ({PARAGRAPHS}), l AS (SELECT id, lower(coalesce(text, '')) AS t FROM p)
SELECT id, CAST({' + '.join(f"CASE WHEN contains(t, '{k}') THEN {w} ELSE 0 END" for ks, w in ((CAPTION_STRONG, 1.5), (CAPTION_WEAK, 1.0)) for k in ks)} AS DOUBLE) AS score FROM l""")
def caption_scores(spark, sf_dir):
    return paragraphs(spark, sf_dir).select("id", X.caption_keyword_score(F.col("text"), CAPTION_STRONG, CAPTION_WEAK).alias("score"))


@query("page_headings", r"""SELECT page_id, trim(regexp_replace(regexp_replace(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS heading,
regexp_extract(html, '(?s)<html[^>]*\blang="([^"]*)"', 1) AS lang, len(regexp_extract_all(html, '(?i)<p[ >]')) AS paragraphs FROM pages""")
def page_headings(spark, sf_dir):
    h = F.col("html")
    heading = X.normalize_whitespace(F.regexp_replace(F.regexp_extract(h, r"(?s)<h1>(.*?)</h1>", 1), "<[^>]*>", " "))
    return table(spark, sf_dir, "pages").select(
        "page_id", heading.alias("heading"), F.regexp_extract(h, r'(?s)<html[^>]*\blang="([^"]*)"', 1).alias("lang"), F.regexp_count(h, F.lit("(?i)<p[ >]")).cast("bigint").alias("paragraphs")
    )
