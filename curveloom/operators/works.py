"""Article metadata: relevance, selection, candidates for download and the acquisition plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from curveloom.functions import lexicon as lx
from curveloom.functions import text as X
from curveloom.operators import dedup

LOCATION = "struct<pdf_url:string,url_for_pdf:string,url:string,license:string,version:string,is_published:boolean,is_accepted:boolean,is_oa:boolean,host_type:string,landing_page_url:string,source:struct<display_name:string>>"
WORK = f"""id string, doi string, title string, display_name string, publication_year int, type string, language string, cited_by_count bigint, is_retracted boolean, is_paratext boolean,
abstract_inverted_index map<string,array<int>>, keywords array<struct<display_name:string>>, topics array<struct<display_name:string>>,
authorships array<struct<author:struct<display_name:string>,raw_author_name:string>>, primary_location {LOCATION}, best_oa_location {LOCATION}, locations array<{LOCATION}>, has_content struct<pdf:boolean>"""


def title_of(_=None) -> Column:
    return F.coalesce(X.or_null(X.text_of(F.col("title"))), X.text_of(F.col("display_name")))


def names(items: Column) -> Column:
    return F.coalesce(F.array_join(F.transform(items, lambda i: X.text_of(i["display_name"])), " "), F.lit(""))


def body_of() -> Column:
    """Abstract, keywords and topics."""
    return F.concat_ws(" ", X.text_from_positions(F.col("abstract_inverted_index")), names(F.col("keywords")), names(F.col("topics")))


def authors_of() -> Column:
    each = F.transform("authorships", lambda a: F.coalesce(X.or_null(a["author"]["display_name"]), X.or_null(a["raw_author_name"])))
    return F.coalesce(F.filter(each, lambda n: n.isNotNull()), F.array().cast("array<string>"))


def journal_of() -> Column:
    return F.coalesce(*[X.or_null(F.col(c)["source"]["display_name"]) for c in ("primary_location", "best_oa_location")])


def with_scores(works: DataFrame) -> DataFrame:
    """works with material_score, xrd_score and relevance_score."""
    parts = works.withColumns({"__t": title_of(), "__b": body_of()})
    scored = parts.withColumns({"material_score": X.score_material(F.col("__t"), F.col("__b")), "xrd_score": X.score_xrd(F.col("__t"), F.col("__b"))})
    return scored.withColumn("relevance_score", F.col("material_score") + F.col("xrd_score")).drop("__t", "__b")


def relevant(works: DataFrame, material: int = lx.MIN_MATERIAL, xrd: int = lx.MIN_XRD) -> DataFrame:
    """Articles that are neither retracted nor paratext and reach both scores. The cheap tests come first."""
    kept = works.where("type = 'article' and not coalesce(is_retracted, false) and not coalesce(is_paratext, false)")
    return with_scores(kept).where((F.col("material_score") >= material) & (F.col("xrd_score") >= xrd))


def ranked(works: DataFrame) -> DataFrame:
    """Best first: by relevance, material, diffraction, citations."""
    return works.orderBy(F.desc("relevance_score"), F.desc("material_score"), F.desc("xrd_score"), F.desc(F.coalesce("cited_by_count", F.lit(0))), "id")


def discover(works: DataFrame) -> DataFrame:
    """Relevant works, the best of those that share a DOI, an id or a title."""
    found = relevant(works)
    keys = dedup.work_keys(F.col("doi"), F.col("id"), title_of())
    return dedup.keep_best(found, "id", keys, [F.desc("relevance_score")])


def by_year(works: DataFrame, first: int, last: int) -> DataFrame:
    return works.where(F.col("publication_year").between(first, last))


def candidate(loc: Column, provider: str) -> Column:
    """A location's PDF address with its provider and license, or null."""
    pdf = F.when(F.lower(F.regexp_extract(X.text_of(loc["url"]), r"^[^?#]*", 0)).endswith(".pdf"), loc["url"])
    url = F.coalesce(X.or_null(loc["pdf_url"]), X.or_null(loc["url_for_pdf"]), pdf)
    version = F.coalesce(X.or_null(loc["version"]), F.when(loc["is_published"], "publishedVersion"), F.when(loc["is_accepted"], "acceptedVersion"))
    made = F.struct(url.alias("url"), F.lit(provider).alias("provider"), loc["license"].alias("license"), version.alias("version"), loc["host_type"].alias("host_type"), loc["landing_page_url"].alias("landing_page_url"))
    return F.when(X.valid_http_url(url), made)


def pdf_candidates(works: DataFrame, other: DataFrame | None = None, cached: str | None = None) -> DataFrame:
    """id, rank, url, provider, ...: the places to fetch a work from, in order, each trimmed address once.

    First the best and the primary location, then open locations, then those of other(doi, best_oa_location, oa_locations), then
    the cache address with `{id}` filled in for works whose content it has.
    """
    rows = works
    lists = [F.array(candidate(F.col("best_oa_location"), "openalex:best_oa_location"), candidate(F.col("primary_location"), "openalex:primary_location"))]
    lists.append(F.coalesce(F.transform(F.filter("locations", lambda x: F.coalesce(x["is_oa"], F.lit(True))), lambda x: candidate(x, "openalex:location")), F.array()))
    if other is not None:
        more = other.select(X.normalize_doi(F.col("doi")).alias("__doi"), F.col("best_oa_location").alias("__best"), F.col("oa_locations").alias("__more"))
        rows = rows.withColumn("__key", X.normalize_doi(F.col("doi"))).join(more, F.col("__key") == F.col("__doi"), "left")
        lists.append(F.array(candidate(F.col("__best"), "unpaywall:best_oa_location")))
        lists.append(F.coalesce(F.transform("__more", lambda x: candidate(x, "unpaywall:oa_location")), F.array()))
    every = F.filter(F.concat(*lists), lambda c: c.isNotNull())
    flat = rows.select("id", "has_content", F.posexplode_outer(every).alias("rank", "c")).select("id", "has_content", "rank", "c.*")
    if cached:
        url = F.replace(F.lit(cached), F.lit("{id}"), X.short_id(F.col("id")))
        null = F.lit(None).cast("string")
        hit = works.where("has_content.pdf").select("id", "has_content", F.lit(1 << 30).alias("rank"), url.alias("url"), F.lit("openalex:cached_content").alias("provider"), *[null.alias(c) for c in ("license", "version", "host_type", "landing_page_url")])
        flat = flat.unionByName(hit)
    flat = flat.where("url is not null").drop("has_content")
    first = F.row_number().over(W.partitionBy("id", F.trim("url")).orderBy("rank"))
    once = flat.withColumn("__n", first).where("__n = 1").drop("__n")
    return once.withColumn("rank", F.row_number().over(W.partitionBy("id").orderBy("rank")) - 1)


def acquisition(works: DataFrame, candidates: DataFrame, contents: DataFrame, known: DataFrame | None = None, target: int | None = None) -> DataFrame:
    """id, url, provider, sha256, size: for each work the first candidate whose content(url, content) is a PDF of accepted size.

    A content that an earlier work or the known(sha256) manifest has is passed over; with a target the best-ranked works are taken.
    """
    fine = contents.select(F.trim("url").alias("__url"), F.sha2("content", 256).alias("sha256"), F.length("content").alias("size")).where(
        (F.col("size") >= 50 * 1024) & (F.col("size") <= 100 * 1024 * 1024) & (F.expr("substr(content, 1, 5)") == F.lit(b"%PDF-"))
    )
    got = candidates.join(fine, F.trim("url") == F.col("__url")).drop("__url")
    first = got.withColumn("__n", F.row_number().over(W.partitionBy("id").orderBy("rank"))).where("__n = 1").drop("__n")
    if known is not None:
        first = first.join(known.select("sha256"), "sha256", "left_anti")
    order = [F.desc("relevance_score"), F.desc("material_score"), F.desc("xrd_score"), F.desc(F.coalesce("cited_by_count", F.lit(0))), F.col("id")]
    scored = first.join(works.select("id", "relevance_score", "material_score", "xrd_score", "cited_by_count"), "id")
    once = scored.withColumn("__n", F.row_number().over(W.partitionBy("sha256").orderBy(*order))).where("__n = 1").drop("__n")
    return once if target is None else once.orderBy(*order).limit(target)


def records(works: DataFrame, got: DataFrame) -> DataFrame:
    """The manifest's rows: the work's facts and the download's."""
    return works.join(got.select("id", F.struct("url", "provider", "sha256", "size").alias("download")), "id").select(
        F.col("id").alias("openalex_id"), X.work_identity(F.col("doi"), F.col("id")).alias("paper_id"), X.normalize_doi(F.col("doi")).alias("doi"), title_of().alias("title"), authors_of().alias("authors"),
        "publication_year", journal_of().alias("journal"), "cited_by_count", "language", "material_score", "xrd_score", "relevance_score", "download",
    )
