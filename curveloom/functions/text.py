"""Text functions as Column expressions: normal forms, identifiers, extraction and scores. Null counts as the empty text."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from curveloom.functions import lexicon as lx

#: Whitespace beyond ASCII's, turned into spaces before the plain pattern runs: several times as fast as a pattern of Unicode mode.
BLANKS = "\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def text_of(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def let(value: Column, use) -> Column:
    """use(value) with value computed once, however often it stands in the expression."""
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def or_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def strip(c: Column) -> Column:
    """Without spaces of any kind at both ends."""
    odd = f"[\\s{BLANKS}]+"
    return F.regexp_replace(c, f"^{odd}|{odd}$", "")


def normalize_whitespace(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(text_of(c), BLANKS, " " * len(BLANKS)), r"\s+", " "))


def _plain_dashes(c: Column) -> Column:
    return F.translate(F.lower(text_of(c)), "–—" + BLANKS, "--" + " " * len(BLANKS))


def normalize_text(c: Column) -> Column:
    """Lower case, plain dashes, single spaces."""
    return F.trim(F.regexp_replace(_plain_dashes(c), r"\s+", " "))


def normalize_for_matching(c: Column) -> Column:
    """normalize_text of which only a-z, digits, theta and dashes are left."""
    return F.trim(F.regexp_replace(_plain_dashes(c), r"[^a-z0-9θ\-]+", " "))


def normalize_title(c: Column) -> Column:
    return normalize_whitespace(F.regexp_replace(normalize_text(c), r"(?U)[^\w\s]", ""))


def normalize_doi(c: Column) -> Column:
    bare = F.regexp_replace(strip(text_of(c)), r"(?i)^https?://(?:dx\.)?doi\.org/", "")
    return or_null(strip(F.lower(F.regexp_replace(bare, r"(?i)^doi:\s*", ""))))


def short_id(c: Column) -> Column:
    """The last segment of a path-like id."""
    return F.element_at(F.split(F.regexp_replace(text_of(c), "/+$", ""), "/"), -1)


def slug(c: Column, longest: int = 70) -> Column:
    dashed = F.regexp_replace(F.regexp_replace(normalize_text(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.coalesce(or_null(F.regexp_replace(F.left(dashed, F.lit(longest)), "-+$", "")), F.lit("paper"))


def pdf_filename(ordinal: Column, work_id: Column, title: Column) -> Column:
    key = short_id(F.coalesce(or_null(text_of(work_id)), F.lit("unknown")))
    name = slug(F.coalesce(or_null(text_of(title)), F.lit("paper")))
    return F.concat(F.format_string("%02d", ordinal), F.lit("_"), key, F.lit("_"), name, F.lit(".pdf"))


def work_identity(doi: Column, work_id: Column) -> Column:
    return F.coalesce(F.concat(F.lit("doi:"), normalize_doi(doi)), F.concat(F.lit("openalex:"), short_id(work_id)))


def stable_id(prefix: str, *parts: Column) -> Column:
    return F.concat(F.lit(f"{prefix}_"), F.left(F.sha1(F.concat_ws("\n", *[text_of(p) for p in parts]).cast("binary")), F.lit(12)))


def text_from_positions(index: Column) -> Column:
    """The text of an inverted index map<word, array<int>>, words by position; those of one position in the map's order."""
    placed = F.flatten(F.transform(F.map_entries(index), lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("p"), e["key"].alias("w")))))
    ordered = F.sort_array(F.transform(placed, lambda x, i: F.struct(x["p"].alias("p"), i.alias("i"), x["w"].alias("w"))))
    return F.coalesce(F.array_join(F.transform(ordered, lambda x: x["w"]), " "), F.lit(""))


def positions_from_text(c: Column) -> Column:
    """Inverse of text_from_positions for a text of single-spaced words; null for null.

    The words of a row are sorted once and cut into runs of equal ones, so nothing is shuffled and a long text is not searched for each word.
    """
    placed = F.sort_array(F.transform(F.split(c, " "), lambda w, i: F.struct(w.alias("w"), i.alias("p"))))

    def runs(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i)["w"] != F.get(s, i - 1)["w"]))

        def entry(at: Column, b: Column, k: Column) -> Column:
            own = F.slice(s, b + 1, F.coalesce(F.get(at, k + 1), F.size(s)) - b)
            return F.struct(F.get(s, b)["w"].alias("key"), F.transform(own, lambda x: x["p"]).alias("value"))

        return let(starts, lambda at: F.transform(at, lambda b, k: entry(at, b, k)))

    return F.when(c.isNotNull(), F.map_from_entries(let(placed, runs)))


def contains_any(c: Column, phrases: Iterable[str]) -> Column:
    """Whether a text normalized for matching holds one of the phrases, normalized too."""
    fixed = [_matching(p) for p in phrases]
    return let(normalize_for_matching(c), lambda n: reduce(Column.__or__, (n.contains(p) for p in fixed), F.lit(False)))


def _matching(phrase: str) -> str:
    """normalize_for_matching of a fixed phrase, on the driver."""
    kept = "".join(ch if ch.isascii() and (ch.isalnum() or ch in "- ") or ch == "θ" else " " for ch in phrase.lower())
    return " ".join(kept.split())


def weighted_terms(c: Column, weights: Mapping[str, float], kind: str = "int") -> Column:
    """Sum of the weights of all terms that the normalized text holds; overlapping terms all count."""
    zero = F.lit(0).cast(kind)
    return let(normalize_text(c), lambda n: sum((F.when(n.contains(t), F.lit(w).cast(kind)).otherwise(zero) for t, w in weights.items()), zero))


def score_material(title: Column, body: Column) -> Column:
    return weighted_terms(title, lx.MATERIAL_TITLE) + weighted_terms(body, lx.MATERIAL_BODY)


def score_xrd(title: Column, body: Column) -> Column:
    both = normalize_text(F.concat_ws(" ", text_of(title), text_of(body)))
    words = F.when(both.rlike(r"(?U)\bxrd\b"), 8).otherwise(0) + F.when(both.rlike(r"(?U)\bpxrd\b"), 4).otherwise(0)
    return weighted_terms(title, lx.XRD_TITLE) + weighted_terms(body, lx.XRD_BODY) + words


def extract_degrees(c: Column) -> Column:
    """Numbers of 0 to 180 followed by a degree sign or word, each once, in order."""
    found = F.transform(F.regexp_extract_all(text_of(c), F.lit(lx.DEGREES), F.lit(1)), lambda v: v.cast("double"))
    return F.array_distinct(F.filter(found, lambda v: v.between(0, 180)))


def extract_miller(c: Column) -> Column:
    """Parenthesized groups of three integers, each once, in order."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text_of(c), F.lit(lx.MILLER), F.lit(0)), normalize_whitespace))


def score_paragraph(c: Column) -> Column:
    """The diffraction score of a paragraph, rounded to three places."""
    parts = [*((_matching(t), w) for t, w in lx.PARAGRAPH_STRONG.items()), *((_matching(t), 0.4) for t in lx.PARAGRAPH_ANALYSIS)]

    def of_terms(n: Column) -> Column:
        held = sum((F.when(n.contains(t), w).otherwise(0.0) for t, w in parts), F.lit(0.0))
        held = held + F.when(n.contains("figure") | F.concat(n, F.lit(" ")).contains("fig "), 0.5).otherwise(0.0)
        return F.when(n != "", held)

    score = let(normalize_for_matching(c), of_terms) + F.when(text_of(c).rlike(lx.THETA), 2.0).otherwise(0.0)
    score = score + F.least(F.size(extract_degrees(c)), F.lit(5)) * 0.5 + F.least(F.size(extract_miller(c)), F.lit(5)) * 0.5
    return F.coalesce(F.round(score, 3), F.lit(0.0))


def caption_keyword_score(caption: Column, strong: Iterable[str], weak: Iterable[str]) -> Column:
    """1.5 for each strong and 1.0 for each weak keyword that the lower-cased caption holds."""
    low = F.lower(text_of(caption))
    return sum((F.when(low.contains(k), w).otherwise(0.0) for ks, w in ((strong, 1.5), (weak, 1.0)) for k in ks), F.lit(0.0))


def classify_section(title: Column) -> Column:

    def first(n: Column) -> Column:
        hits = [F.when(reduce(Column.__or__, (n.contains(_matching(p)) for p in phrases)), kind) for kind, phrases in lx.SECTION_KINDS]
        return F.coalesce(*hits, F.lit("other"))

    return let(normalize_for_matching(title), first)


def split_sentences(c: Column) -> Column:
    """Sentences that end in . ! or ?; the dots of Fig., Figure., vs. and etc. end none."""
    mark = ""
    held = F.regexp_replace(normalize_whitespace(c), lx.ABBREVIATION, f"$1{mark}")
    return F.filter(F.transform(F.split(held, r"(?<=[.!?])\s+"), lambda s: F.translate(s, mark, ".")), lambda s: F.trim(s) != "")


def normalize_figure_label(c: Column) -> Column:
    """The first run of digits of a label, or the label without spaces and end dots; null if empty."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(normalize_whitespace(c)), "figure", "fig"), r"\s+|\.+$", "")
    return F.coalesce(or_null(F.regexp_extract(bare, r"(\d+)", 1)), or_null(bare))


def figure_references(c: Column) -> Column:
    """Labels of all figures that a text cites, each once, in order."""
    return F.array_distinct(F.filter(F.transform(F.regexp_extract_all(text_of(c), F.lit(lx.FIGURE_REFERENCE), F.lit(1)), normalize_figure_label), lambda x: x.isNotNull()))


def caption_label(c: Column) -> Column:
    return normalize_figure_label(F.regexp_extract(text_of(c), lx.CAPTION_LABEL, 1))


def valid_figure_label(label: Column, caption: Column) -> Column:
    other = caption_label(caption)
    return F.coalesce(label.rlike(r"^\d+[a-z]?$") & (other.isNull() | (other == label)), F.lit(False))


def figure_id(service_id: Column, label: Column, caption: Column) -> Column:
    """One-based figure id: from the label, the caption, the service's zero-based id, or a hash of the caption."""
    number = F.regexp_extract(text_of(service_id), r"(?i)^fig_(\d+)$", 1)
    return (
        F.when(valid_figure_label(label, caption), F.concat(F.lit("fig_"), label))
        .when(caption_label(caption).isNotNull(), F.concat(F.lit("fig_"), caption_label(caption)))
        .when(number != "", F.concat(F.lit("fig_"), (number.try_cast("bigint") + 1).cast("string")))
        .when(text_of(service_id) != "", service_id)
        .otherwise(stable_id("figure", caption))
    )


def _cites(sentence: Column, label: Column) -> Column:
    return F.array_contains(figure_references(sentence), label)


def specific_to_figure(sentence: Column, label: Column) -> Column:
    """Whether a sentence speaks of one figure: it alone is cited, in the sentence or a clause, or a clause says `in Fig. n,`."""
    only = lambda s: F.size(figure_references(s)) == 1
    named = lambda s: F.regexp_like(s, F.concat(F.lit(r"(?i)\bin\s+fig(?:ure)?s?\.?\s*\Q"), label, F.lit(r"\E\s*,")))
    clauses = F.filter(F.split(sentence, lx.CLAUSE), lambda s: F.trim(s) != "")
    return _cites(sentence, label) & (only(sentence) | F.exists(clauses, lambda s: _cites(s, label) & (only(s) | named(s))))


def specific_sentences(c: Column, label: Column) -> Column:
    return F.filter(split_sentences(c), lambda s: specific_to_figure(s, label))


def mention_sentences(c: Column, label: Column) -> Column:
    return F.filter(split_sentences(c), lambda s: _cites(s, label))


def mention_text(c: Column, label: Column) -> Column:
    return or_null(F.array_join(mention_sentences(c, label), " "))


def specific_text(c: Column, label: Column) -> Column:
    return or_null(F.array_join(specific_sentences(c, label), " "))


def valid_http_url(c: Column) -> Column:
    return F.coalesce(c.rlike(r"(?i)^https?://[^/?#]+"), F.lit(False))


def display_title(c: Column, longest: int = 80) -> Column:
    """At most `longest` characters, the last three dots if cut; `Unknown title` if empty."""

    def shown(n: Column) -> Column:
        cut = F.concat(F.rtrim(F.left(n, F.lit(longest - 3))), F.lit("..."))
        return F.when(n == "", "Unknown title").when(F.length(n) > longest, cut).otherwise(n)

    return let(normalize_whitespace(c), shown)


def pattern_index(stem: Column) -> Column:
    return or_null(F.regexp_extract(text_of(stem), r"(?i)^(?:pattern|figure)_(\d+)$", 1)).try_cast("int")


def output_stem(stem: Column) -> Column:
    number = F.regexp_extract(text_of(stem), r"(?i)(?:figure|fig)[_-]?(\d+)", 1)
    return F.when(number != "", F.concat(F.lit("figure_"), number.try_cast("bigint").cast("string"))).otherwise(F.concat(stem, F.lit("_digitized")))


def curve_stem(figure: Column, band: Column, bands: Column) -> Column:
    bare = F.regexp_replace(figure, r"\.png$", "")
    return F.when(bands > 1, F.concat(bare, F.lit("_curve_"), (band + 1).cast("string"))).otherwise(bare)


def utc_now() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")


def boxes_from_text(c: Column) -> Column:
    """page,x,y,w,h;... as structs; null if a box is malformed or has no area."""
    parts = F.filter(F.transform(F.split(text_of(c), ";"), lambda b: F.trim(b)), lambda b: b != "")
    fields = F.transform(parts, lambda b: F.split(b, ","))
    boxes = F.transform(
        fields,
        lambda f: F.struct(
            F.get(f, F.lit(0)).try_cast("int").alias("page"), *[F.get(f, F.lit(i)).try_cast("double").alias(n) for i, n in ((1, "x"), (2, "y"), (3, "w"), (4, "h"))]
        ),
    )
    fine = F.forall(fields, lambda f: F.size(f) == 5) & F.forall(
        boxes, lambda b: b["page"].isNotNull() & b["x"].isNotNull() & b["y"].isNotNull() & F.coalesce((b["w"] > 0) & (b["h"] > 0), F.lit(False))
    )
    return F.when(fine, boxes)


def text_from_boxes(boxes: Column) -> Column:
    return F.array_join(F.transform(boxes, lambda b: F.concat_ws(",", b["page"].cast("string"), *[b[k].cast("string") for k in "xywh"])), ";")
