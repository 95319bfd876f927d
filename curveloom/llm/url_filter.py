"""URL filters with block decisions spread over redirect and canonical links. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curveloom.llm.common import Workspace, connected_components

#: (verdict, host, path) of the production rules; fixed by the data contract.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Up to so many rules are compared inside an expression; more are joined by host.
INLINE_RULES = 200
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*?\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*?\burl\s*=\s*["']?([^"'\s>;]+)"""


def _after(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3))


def host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without one or for null."""
    return F.translate(F.coalesce(F.regexp_extract(_after(url), r"^([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; empty without `://` or for null."""
    return F.coalesce(F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def node(url: Column) -> Column:
    """What two spellings of one address share: host, path and query without scheme and fragment. Null without `://`."""
    rest = F.regexp_extract(_after(url), r"^[^/?#]*([^#]*)", 1)
    return F.concat(host(url), F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest)))


def decoded(href: Column) -> Column:
    """href with the references to `&` that addresses are written with in markup replaced."""
    return F.regexp_replace(href, "(?i)&(?:amp|#38|#x26);", "&")


def _resolve(parts: Column) -> Column:
    """The parts of a path, with `.` and `..` resolved; a last one of these leaves an empty part, i.e. a folder."""
    steps = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda done, p: F.when(p == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).when(p == ".", done).otherwise(F.concat(done, F.array(p))),
    )
    return F.when(F.element_at(parts, -1).isin(".", ".."), F.concat(steps, F.array(F.lit("")))).otherwise(steps)


def absolute(href: Column, base: Column) -> Column:
    """href as seen from the page at base: `?query` and `#fragment` keep the page's path, and `.` and `..` are resolved."""
    root = F.concat(F.lit("http://"), host(base))
    here = F.when(path(base) == "", F.lit("/")).otherwise(path(base))
    folder = F.regexp_replace(here, "[^/]*$", "")
    own = F.regexp_extract(href, "^([^?#]*)", 1)
    rest = F.regexp_extract(href, "^[^?#]*(.*)$", 1)
    full = F.when(own.startswith("/"), own).otherwise(F.concat(folder, own))
    clean = F.concat(F.lit("/"), F.array_join(_resolve(F.split(F.substr(full, F.lit(2)), "/")), "/"))
    query = F.regexp_extract(_after(base), r"^[^/?#]*[^?#]*(\?[^#]*)?", 1)
    return (
        F.when(F.locate("://", own) > 0, href)
        .when(href.startswith("//"), F.concat(F.lit("http:"), href))
        .when((own == "") & ~rest.startswith("?"), F.concat(root, here, query, rest))
        .when(own == "", F.concat(root, here, rest))
        .otherwise(F.concat(root, clean, rest))
    )


def apply_rules(rows: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """rows(host, path, __row unique) with `rule` and `ruled`, the longest fitting rule and its verdict, or nulls.

    A rule fits its host and all its subdomains if the path starts with the rule's. Of equally long rules allow wins.
    """
    rules = list(dict.fromkeys(rules))
    if len(rules) <= INLINE_RULES:
        fits = [
            F.when(
                ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p),
                F.struct(F.lit(len(h + p)).alias("size"), F.lit(verdict == "allow").alias("allow"), F.lit(h + p).alias("rule"), F.lit(verdict).alias("ruled")),
            )
            for verdict, h, p in rules
        ]
        best = F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<rule:string,ruled:string>")
        found = rows.withColumn("__best", best)
    else:
        spark = rows.sparkSession
        table = spark.createDataFrame([(v, h, p) for v, h, p in rules], "v string, h string, p string")
        parts = F.split("host", r"\.")
        ends = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
        hits = rows.select("__row", "path", F.explode(ends).alias("h")).join(table, "h").where(F.col("path").startswith(F.col("p")))
        rule = F.concat("h", "p")
        best = F.max(F.struct(F.length(rule).alias("size"), (F.col("v") == "allow").alias("allow"), rule.alias("rule"), F.col("v").alias("ruled")))
        found = rows.join(hits.groupBy("__row").agg(best.alias("__best")), "__row", "left")
    return found.select(*rows.columns, F.col("__best")["rule"].alias("rule"), F.col("__best")["ruled"].alias("ruled"))


def link_edges(pages: DataFrame) -> DataFrame:
    """(src, dst) addresses of all canonical links and meta redirects of pages(url, html), each resolved against its page.

    Comments, scripts, styles and text areas are passed over."""
    live = F.regexp_replace(F.regexp_replace("html", "(?s)<!--.*?(?:-->|$)", " "), r"(?is)<(script|style|textarea)\b.*?(?:</\1\s*>|$)", " ")
    some = F.when(F.col("html").rlike(r"(?i)<(?:link|meta)\b"), live)
    links = F.concat(*[F.coalesce(F.regexp_extract_all(some, F.lit(p), F.lit(1)), F.array().cast("array<string>")) for p in (CANONICAL, REFRESH)])
    hrefs = pages.select("url", F.explode(links).alias("href")).where("url is not null")
    return hrefs.select(F.col("url").alias("src"), absolute(decoded(F.col("href")), F.col("url")).alias("dst"))


def url_verdicts(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, edges: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of pages(page_id, url, html).

    A page that a rule fits gets its verdict. The others get their equivalence class's: classes are the connected components of
    addresses over canonical links and redirects (and `edges(src, dst)`, e.g. of HTTP redirects); an address counts in its class
    by its own rule, also if it is no page. A class with an allowed address is allowed, else one with a blocked address is
    blocked, else it is allowed. Null urls have no address and are allowed; repeated rows get the same verdict each;
    an empty table gives no rows.
    """
    ws = Workspace(pages.sparkSession, "urls")
    rows = pages.select("page_id", "url", F.monotonically_increasing_id().alias("__row"), host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    judged = apply_rules(ws.stage(rows, "pages") if len(rules) > INLINE_RULES else rows, rules)
    links = link_edges(pages)
    if edges is not None:
        links = links.unionByName(edges.select("src", "dst"))
    links = ws.stage(links.where("src is not null and dst is not null").distinct(), "links")
    parts = connected_components(ws, links.select(node(F.col("src")).alias("u"), node(F.col("dst")).alias("v")))
    parts = ws.stage(parts, "parts")
    # The addresses of classes by their own rules; each is spelled once, as a bare http url.
    named = parts.select("node", "component", F.concat(F.lit("http://"), F.col("node")).alias("url"))
    named = named.select("node", "component", F.col("node").alias("__row"), host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    flags = (
        apply_rules(named, rules)
        .groupBy("component")
        .agg(F.max(F.col("ruled") == "allow").alias("allowed"), F.max(F.col("ruled") == "block").alias("blocked"))
        .where("coalesce(blocked, false) and not coalesce(allowed, false)")
    )
    blocked = parts.join(flags, "component", "left_semi").select("node", F.lit("block").alias("spread"))
    out = judged.withColumn("__node", node(F.col("url"))).join(blocked, F.col("__node") == F.col("node"), "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", "spread", F.lit("allow")).alias("verdict"))
