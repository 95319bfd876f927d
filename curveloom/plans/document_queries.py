"""Queries of article, figure, deduplication, metadata and geometry operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from curveloom.functions import text as X
from curveloom.operators import dedup, documents, geometry, works
from curveloom.plans.registry import query
from curveloom.plans.tables import table
from curveloom.plans.text_queries import PARAGRAPH_SCORES
from curveloom.sources import tei

TEI = """<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><fileDesc><titleStmt><title type="main">A perovskite</title></titleStmt>
<publicationStmt><date when="2021-03-01">March 2021</date></publicationStmt>
<sourceDesc><biblStruct><analytic><author><persName><forename>Ada</forename><forename>M.</forename><surname>Low</surname></persName><email>a@x.org</email>
<affiliation>Uni A</affiliation><affiliation>Uni A</affiliation><idno type="ORCID">0000-1</idno></author><author><affiliation>Nobody</affiliation></author></analytic>
<monogr><title>J. Test</title></monogr><idno type="DOI">10.1000/tei.1</idno></biblStruct></sourceDesc></fileDesc>
<profileDesc><abstract><p>Short  abstract.</p></abstract><textClass><keywords><term>xrd</term><term> </term><term>oxide</term></keywords></textClass></profileDesc></teiHeader>
<text><body><div xml:id="s1"><head>Results</head><p>Fig. 1 shows the XRD pattern with a peak at 32.1°. Fig. 2 is an image.</p><p>The lattice is indexed to (1 1 0).</p>
<div><head>Details</head><p>Figure 1 has Bragg reflections at 46 degrees; see Fig. 7.</p></div></div>
<div><p>Nothing here.</p></div><p>Loose text with x-ray diffraction.</p>
<figure xml:id="fig_0" coords="1,10,20,300,200"><head><label>Figure 1</label></head><figDesc>XRD patterns of the film.</figDesc><graphic url="a.png" coords="1,10,20,300,200"/></figure>
<figure xml:id="fig_1"><label>2</label><figDesc>A photograph.</figDesc></figure>
<figure type="table" xml:id="tab_0"><head>Table 1</head><figDesc>Cell data.</figDesc><table><row><cell>a</cell><cell>3.9</cell></row></table></figure></body>
<back><div><listBibl><biblStruct xml:id="b0"><analytic><title>Old work</title><author><persName><forename>B</forename><surname>High</surname></persName></author></analytic>
<monogr><title>J. Old</title><imprint><date when="1999">1999</date></imprint></monogr></biblStruct></listBibl></div></back></text></TEI>"""


def articles(spark):
    return tei.parse(spark.createDataFrame([("a", bytearray(TEI.encode())), ("b", bytearray(b"<TEI"))], "doc_id string, content binary"))


@query("tei_metadata")
def tei_metadata(spark, sf_dir):
    m = tei.metadata(articles(spark))
    return m.select("doc_id", "title", "doi", "abstract", "journal", "publication_date", F.array_join("keywords", ",").alias("keywords"), F.to_json("authors").alias("authors"))


@query("tei_sections")
def tei_sections(spark, sf_dir):
    return tei.sections(articles(spark)).select("doc_id", "ordinal", "parent", "section_id", F.array_join("path", "/").alias("path"), "section_type")


@query("tei_paragraphs")
def tei_paragraphs(spark, sf_dir):
    p = tei.paragraphs(articles(spark))
    return p.select("doc_id", "ordinal", "paragraph_id", "section_type", F.array_join("figure_references", ",").alias("refs"), "score", F.to_json("peak_positions").alias("peaks"), F.to_json("miller_indices").alias("miller"))


@query("tei_tables_and_references")
def tei_tables_and_references(spark, sf_dir):
    raw = articles(spark)
    t = tei.tables(raw).select("doc_id", F.lit("table").alias("kind"), F.col("xml_id").alias("id"), F.col("caption").alias("title"), "text")
    b = tei.bibliography(raw).select("doc_id", F.lit("reference").alias("kind"), F.col("xml_id").alias("id"), "title", F.concat_ws("|", "doi", "year", F.array_join("authors", ";")).alias("text"))
    return t.unionByName(b)


@query("tei_figures_linked")
def tei_figures_linked(spark, sf_dir):
    raw = articles(spark)
    f = tei.unique_figure_ids(documents.link_figures(tei.figures(raw), tei.paragraphs(raw)))
    return f.select("doc_id", "ordinal", "figure_id", "new_id", "normalized_label", "score", "likely", F.size("referenced_by").alias("n_refs"), F.size("context").alias("n_context"))


@query("tei_records")
def tei_records(spark, sf_dir):
    raw = articles(spark)
    p = tei.paragraphs(raw)
    r = documents.training_records(documents.link_figures(tei.figures(raw), p), p, tei.metadata(raw))
    return r.select("doc_id", "figure_id", "combined_analysis_text", F.to_json("peak_positions").alias("peaks"), F.to_json("miller_indices").alias("miller"), F.size("analysis_paragraphs").alias("n"))


@query("tei_figure_dataset")
def tei_figure_dataset(spark, sf_dir):
    raw = articles(spark)
    p = tei.paragraphs(raw)
    return documents.figure_dataset(documents.link_figures(tei.figures(raw), p), p)


@query("tei_counts")
def tei_counts(spark, sf_dir):
    raw = articles(spark)
    return documents.document_counts(raw, documents.link_figures(tei.figures(raw), tei.paragraphs(raw)))


@query("conversation_context", f"""WITH s AS ({PARAGRAPH_SCORES}), t AS (SELECT c.conv_id, c.turn, length(c.text) AS n, s.score FROM conversations c JOIN s ON s.id = -(c.conv_id * 1000 + c.turn) - 1)
SELECT a.conv_id, a.turn, count(*) AS near, CAST(sum(b.n) AS BIGINT) AS chars, sum(CASE WHEN b.n >= 60 THEN 0.5 ELSE 0.0 END)::DOUBLE AS gain, round(sum(b.score), 3) AS score
FROM t a JOIN t b ON a.conv_id = b.conv_id AND b.turn BETWEEN a.turn - 4 AND a.turn + 4 GROUP BY 1, 2""")
def conversation_context(spark, sf_dir):
    """Each turn with the turns within four of it: their number, length, gain and score."""
    t = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.length("text").alias("n"), X.score_paragraph(F.col("text")).alias("score"))
    w = documents.neighbours(t, "conv_id", "turn", 4, ["n", "score"])
    return w.groupBy("conv_id", "turn").agg(
        F.count("*").alias("near"), F.sum("n").alias("chars"), F.sum(F.when(F.col("n") >= 60, 0.5).otherwise(0.0)).alias("gain"), F.round(F.sum("score"), 3).alias("score")
    )


@query("unlabelled_documents", "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def unlabelled_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id").distinct().join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")


@query("labelled_or_listed", "SELECT doc_id FROM labels UNION SELECT item_id FROM benchmark")
def labelled_or_listed(spark, sf_dir):
    return table(spark, sf_dir, "labels").select("doc_id").union(table(spark, sf_dir, "benchmark").select("item_id")).distinct()


@query("labelled_documents", "SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def labelled_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels").where("quality = 1").select("doc_id"), "doc_id", "left_semi").select("doc_id", "source")


@query("status_counts", "SELECT quality, toxic, count(*) AS n, count(*) FILTER (doc_id % 2 = 0) AS n_even FROM labels GROUP BY 1, 2")
def status_counts(spark, sf_dir):
    return table(spark, sf_dir, "labels").groupBy("quality", "toxic").agg(F.count("*").alias("n"), F.count_if(F.col("doc_id") % 2 == 0).alias("n_even"))


@query("first_of_equal_texts", "SELECT min(doc_id) AS doc_id, arg_min(source, doc_id) AS source FROM documents GROUP BY text")
def first_of_equal_texts(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    # Hashed before the shuffle, so that texts do not travel.
    slim = d.select("doc_id", "source", F.xxhash64("text").alias("h"), F.sha2("text", 256).alias("s"))
    return dedup.first_wins(slim, [F.col("h"), F.col("s")], [F.col("doc_id")]).select("doc_id", "source")


@query("distinct_page_urls", "SELECT min(page_id) AS page_id, trim(regexp_replace(url, '[?#].*$', '')) AS address FROM pages GROUP BY 2")
def distinct_page_urls(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", F.trim(F.regexp_replace("url", "[?#].*$", "")).alias("address"))
    return dedup.first_wins(p, [F.col("address")], [F.col("page_id")])


@query("best_part_per_name_or_brand", """WITH RECURSIVE k AS (SELECT p_partkey AS id, 'n:' || p_name || ':' || p_type || ':' || p_brand AS key FROM part UNION ALL SELECT p_partkey, 'b:' || p_brand || ':' || p_size || ':' || p_name FROM part),
e AS (SELECT DISTINCT a.id AS u, b.id AS v FROM k a JOIN k b ON a.key = b.key), r AS (SELECT id AS u, id AS g FROM k UNION SELECT e.v, r.g FROM r JOIN e ON e.u = r.u WHERE r.g < e.v),
g AS (SELECT u AS id, min(g) AS grp FROM r GROUP BY 1), t AS (SELECT p.*, grp, row_number() OVER (PARTITION BY grp ORDER BY p_retailprice DESC, p_partkey) AS n FROM part p JOIN g ON g.id = p.p_partkey)
SELECT p_partkey, p_retailprice FROM t WHERE n = 1""")
def best_part_per_name_or_brand(spark, sf_dir):
    """Of parts of a brand and name that share a type or a size, also through others, the dearest."""
    p = table(spark, sf_dir, "part")
    # A part without a name, brand, type or size has no key by it.
    parts = (("n:", "p_name", "p_type", "p_brand"), ("b:", "p_brand", "p_size", "p_name"))
    keys = F.array(*[F.concat(F.lit(kind), a, F.lit(":"), F.col(b).cast("string"), F.lit(":"), c) for kind, a, b, c in parts])
    return dedup.keep_best(p, "p_partkey", keys, [F.desc("p_retailprice")]).select("p_partkey", "p_retailprice")


@query("best_part_in_order")
def best_part_in_order(spark, sf_dir):
    """The sequential rule on the parts of each type."""
    p = table(spark, sf_dir, "part").select("p_type", "p_partkey", "p_retailprice", F.array("p_name", "p_brand").alias("keys"))
    out = dedup.keep_best_in_order(p, ["p_type"], "p_partkey", "keys", "p_retailprice", p.schema)
    return out.select("p_type", "p_partkey", "p_retailprice")


@query("distinct_daily_curves")
def distinct_daily_curves(spark, sf_dir):
    e = table(spark, sf_dir, "events").groupBy("event_type", F.to_date("ts").alias("d")).agg(F.sum("value").alias("y"))
    c = e.groupBy("event_type").agg(F.transform(F.sort_array(F.collect_list(F.struct("d", "y"))), lambda s: s["y"]).alias("ys")).withColumn("g", F.lit(1))
    return dedup.distinct_curves(c, ["g"], "event_type", "ys").select("event_type", F.size("ys").alias("n"))


#: Works as the service gives them.
WORKS = [
    {"id": "https://openalex.org/W1", "doi": "https://doi.org/10.1/A", "title": "Halide perovskite XRD pattern by Rietveld refinement", "type": "article", "publication_year": 2020, "cited_by_count": 5,
     "abstract_inverted_index": {"x-ray": [0], "diffraction": [1], "of": [2], "perovskite": [3]}, "keywords": [{"display_name": "XRD"}], "authorships": [{"author": {"display_name": "Ada Low"}}, {"raw_author_name": "B. High"}],
     "primary_location": {"pdf_url": "https://a.org/1.pdf", "license": "cc-by", "source": {"display_name": "J. A"}}, "locations": [{"url": "https://b.org/x.PDF?d=1", "is_published": True}, {"pdf_url": "https://c.org/y", "is_oa": False}, {"pdf_url": " https://a.org/1.pdf"}], "has_content": {"pdf": True}},
    {"id": "https://openalex.org/W2", "doi": "10.1/a", "title": "Double perovskite powder x-ray diffraction", "type": "article", "publication_year": 2021, "cited_by_count": 50, "abstract_inverted_index": {"xrd": [0]}},
    {"id": "https://openalex.org/W3", "title": "Perovskite oxide crystal structure", "type": "article", "publication_year": 2019, "is_retracted": True},
    {"id": "https://openalex.org/W4", "display_name": "Layered perovskite: neutron diffraction", "type": "article", "publication_year": 2018, "best_oa_location": {"url_for_pdf": "http://d.org/z.pdf", "version": "v1"}},
    {"id": "https://openalex.org/W5", "title": "Cats", "type": "article"}, {"id": "https://openalex.org/W6", "title": "Perovskite XRD", "type": "review"},
]


def sample_works(spark):
    import json

    return spark.createDataFrame([(json.dumps(w),) for w in WORKS], "j string").select(F.from_json("j", works.WORK).alias("w")).select("w.*")


@query("discovered_works")
def discovered_works(spark, sf_dir):
    return works.ranked(works.discover(sample_works(spark))).select("id", "material_score", "xrd_score", "relevance_score")


@query("work_facts")
def work_facts(spark, sf_dir):
    return sample_works(spark).select("id", works.title_of().alias("title"), works.body_of().alias("body"), F.array_join(works.authors_of(), ";").alias("authors"), works.journal_of().alias("journal"))


@query("pdf_candidates")
def pdf_candidates(spark, sf_dir):
    return works.pdf_candidates(sample_works(spark), cached="https://content.example.org/works/{id}.pdf").select("id", "rank", "url", "provider", "license", "version")


@query("ranked_documents", f"""WITH s AS ({PARAGRAPH_SCORES}), d AS (SELECT doc_id, n_chars, score FROM documents JOIN s ON s.id = doc_id + 1000)
SELECT doc_id, score, n_chars, row_number() OVER (ORDER BY score DESC, n_chars DESC, doc_id) AS place FROM d ORDER BY place LIMIT 100""")
def ranked_documents(spark, sf_dir):
    """The hundred documents that score most, longer ones first."""
    from pyspark.sql import Window as W

    d = table(spark, sf_dir, "documents").select("doc_id", X.score_paragraph(F.col("text")).alias("score"), "n_chars")
    order = [F.desc("score"), F.desc("n_chars"), F.col("doc_id")]
    return d.orderBy(*order).limit(100).withColumn("place", F.row_number().over(W.orderBy(*order)).cast("bigint"))


@query("order_bands", """WITH o AS (SELECT o_custkey AS c, epoch_us(o_orderdate) / 86400000000.0 AS y0, epoch_us(o_orderdate) / 86400000000.0 + 60 AS y1 FROM orders),
f AS (SELECT *, CASE WHEN y0 > max(y1) OVER (PARTITION BY c ORDER BY y0, y1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 20 THEN 1 ELSE 0 END AS new FROM o),
b AS (SELECT *, sum(new) OVER (PARTITION BY c ORDER BY y0, y1 ROWS UNBOUNDED PRECEDING) AS band FROM f) SELECT c AS customer, CAST(band AS BIGINT) AS band, min(y0) AS y0, max(y1) AS y1, count(*) AS n FROM b GROUP BY 1, 2""")
def order_bands(spark, sf_dir):
    """Orders of a customer as intervals of 60 days, grouped where gaps are at most 20 days."""
    day = F.unix_micros(F.col("o_orderdate").cast("timestamp")) / F.lit(86400000000.0)
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("customer"), day.alias("y0"), (day + 60).alias("y1"), F.lit(0.0).alias("x0"), F.lit(1.0).alias("x1"))
    return geometry.band_boxes(o, ["customer"]).select("customer", F.col("band").cast("bigint").alias("band"), "y0", "y1", "n")


RECTS = "CAST(l_orderkey % 200 AS BIGINT) AS page, l_quantity * 8 AS x0, l_linenumber * 60.0::DOUBLE AS y0, l_quantity * 8 + 40 + l_tax * 1000 AS x1, l_linenumber * 60.0::DOUBLE + 45 AS y1"


def _rects(spark, sf_dir):
    c = F.col
    top = c("l_linenumber").cast("double") * 60
    return table(spark, sf_dir, "lineitem").select((c("l_orderkey") % 200).alias("page"), (c("l_quantity") * 8).alias("x0"), top.alias("y0"), (c("l_quantity") * 8 + 40 + c("l_tax") * 1000).alias("x1"), (top + 45).alias("y1"))


def _captions(spark):
    return spark.range(200).select(F.col("id").alias("page"), F.lit("c").alias("caption"), F.lit(100.0).alias("caption_x0"), F.lit(300.0).alias("caption_x1"), (F.lit(250.0) + F.col("id")).alias("caption_y0"))


@query("drawings_above_captions", f"""WITH r AS (SELECT {RECTS} FROM lineitem), c AS (SELECT CAST(i AS BIGINT) AS page, 250.0::DOUBLE + i AS cy FROM range(200) t(i)),
o AS (SELECT r.* FROM r JOIN c ON r.page = c.page WHERE y1 <= cy - 12 AND (least(x1, 300.0) - greatest(x0, 100.0)) / 200.0 >= 0.2)
SELECT page, 'c' AS caption, min(x0) AS x0, min(y0) AS y0, round(max(x1), 6) AS x1, max(y1) AS y1 FROM o GROUP BY 1""")
def drawings_above_captions(spark, sf_dir):
    return geometry.drawings_above(_rects(spark, sf_dir), _captions(spark), ["page"], "caption").withColumn("x1", F.round("x1", 6))


@query("pictures_above_captions", f"""WITH r AS (SELECT {RECTS} FROM lineitem), c AS (SELECT CAST(i AS BIGINT) AS page, 250.0::DOUBLE + i AS cy FROM range(200) t(i)),
o AS (SELECT r.*, cy FROM r JOIN c ON r.page = c.page WHERE y1 <= cy - 12 AND ((least(x1, 300.0) - greatest(x0, 100.0)) / 200.0 >= 0.2 OR x1 - x0 >= 50)),
f AS (SELECT *, CASE WHEN y0 > max(y1) OVER (PARTITION BY page ORDER BY y0, y1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 20 THEN 1 ELSE 0 END AS new FROM o),
b AS (SELECT *, sum(new) OVER (PARTITION BY page ORDER BY y0, y1 ROWS UNBOUNDED PRECEDING) AS band FROM f),
u AS (SELECT page, band, any_value(cy) AS cy, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM b GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY y1 DESC, band) AS n FROM u WHERE (x1 - x0) * (y1 - y0) >= 5000 AND y1 - y0 >= 30 AND cy - y1 <= 150)
SELECT page, 'c' AS caption, x0, y0, round(x1, 6) AS x1, y1 FROM k WHERE n = 1""")
def pictures_above_captions(spark, sf_dir):
    return geometry.picture_above(_rects(spark, sf_dir), _captions(spark), ["page"], "caption").withColumn("x1", F.round("x1", 6))


@query("widened_crops")
def widened_crops(spark, sf_dir):
    crops = spark.createDataFrame([(1, "a", 50.0, 100.0, 200.0, 200.0, 260.0)], "page int, crop string, x0 double, y0 double, x1 double, y1 double, caption_y0 double")
    spans = spark.createDataFrame(
        [(1, 35.0, 120.0, 49.0, 130.0, "10"), (1, 80.0, 205.0, 120.0, 215.0, "2 theta"), (1, 60.0, 85.0, 90.0, 99.0, "a"), (1, 0.0, 120.0, 10.0, 130.0, "far"), (1, 80.0, 250.0, 90.0, 258.0, "caption"), (1, 40.0, 150.0, 48.0, 160.0, " ")],
        "page int, x0 double, y0 double, x1 double, y1 double, text string",
    )
    return geometry.widen_to_labels(crops, spans, ["page"], "crop")


@query("nation_paths", """SELECT n_nationkey, r_name || '/' || n_name AS path FROM nation JOIN region ON n_regionkey = r_regionkey""")
def nation_paths(spark, sf_dir):
    """The section tree's walk on another hierarchy: a recursive query from the roots down."""
    table(spark, sf_dir, "nation").createOrReplaceTempView("cl_nation")
    table(spark, sf_dir, "region").createOrReplaceTempView("cl_region")
    return spark.sql("""WITH RECURSIVE edges AS (SELECT concat('n', n_nationkey) AS id, concat('r', n_regionkey) AS parent, n_name AS name FROM cl_nation
        UNION ALL SELECT concat('r', r_regionkey), NULL, r_name FROM cl_region),
        walk AS (SELECT id, name AS path FROM edges WHERE parent IS NULL UNION ALL SELECT e.id, concat(w.path, '/', e.name) FROM edges e JOIN walk w ON e.parent = w.id)
        SELECT CAST(substr(id, 2) AS INT) AS n_nationkey, path FROM walk WHERE startswith(id, 'n')""")
