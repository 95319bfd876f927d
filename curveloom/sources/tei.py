"""Article XML (TEI) as tables. An Arrow kernel walks the trees; everything derived from the texts is Column expressions."""

from __future__ import annotations

import re
import sys
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curveloom.functions import text as X
from curveloom.functions.lexicon import CAPTION_SCORE, DOI

cloudpickle.register_pickle_by_value(sys.modules[__name__])

AUTHOR = "struct<given:string,middle:string,surname:string,email:string,affiliation:string,orcid:string>"
RAW = f"""doc_id string, error string,
    meta struct<title:string,doi:string,header:string,abstract:string,journal:string,publication_date:string,keywords:array<string>,authors:array<{AUTHOR}>>,
    sections array<struct<ordinal:int,parent:int,xml_id:string,title:string,path:array<string>,sibling:int>>,
    paragraphs array<struct<ordinal:int,section:int,nth:int,xml_id:string,text:string>>,
    figures array<struct<ordinal:int,xml_id:string,label:string,caption:string,targets:array<string>,coords:string,graphic_coords:string,type:string>>,
    tables array<struct<ordinal:int,xml_id:string,label:string,caption:string,text:string>>,
    bibliography array<struct<ordinal:int,xml_id:string,title:string,doi:string,year:string,authors:array<string>,raw_text:string>>"""
RAW_NAMES = ["doc_id", "error", "meta", "sections", "paragraphs", "figures", "tables", "bibliography"]
META_NAMES = ("title", "doi", "header", "abstract", "journal", "publication_date", "keywords", "authors")
XML_ID = "{http://www.w3.org/XML/1998/namespace}id"


def squeeze(text: str | None) -> str:
    return re.sub(r"\s+", " ", text or "").strip()


class Tree:
    """One parsed article; tags are compared without their namespace."""

    def __init__(self, data: bytes):
        self.root = ET.fromstring(data)
        for e in self.root.iter():
            if isinstance(e.tag, str):
                e.tag = e.tag.rpartition("}")[2]

    @staticmethod
    def text(e: ET.Element | None) -> str | None:
        """All text below an element, pieces joined by spaces; null if there is none."""
        return None if e is None else squeeze(" ".join(e.itertext())) or None

    def first(self, e: ET.Element | None, *paths: str) -> str | None:
        """Text of the first match of the first path that has a text."""
        if e is not None:
            for p in paths:
                if t := self.text(e.find(p)):
                    return t
        return None

    def all(self, e: ET.Element, path: str) -> list[str]:
        return [t for x in e.findall(path) if (t := self.text(x))]

    def doi(self, e: ET.Element | None) -> str | None:
        found = [] if e is None else [x for x in e.iter("idno") if (x.get("type") or "").lower() == "doi"]
        return self.text(found[0]) if found else None

    def author(self, a: ET.Element) -> dict:
        names = self.all(a, ".//persName/forename")
        ids = [x for x in a.iter("idno") if "orcid" in (x.get("type") or "").lower()]
        places = list(dict.fromkeys(self.all(a, ".//affiliation")))
        return {
            "given": names[0] if names else None,
            "middle": " ".join(names[1:]) or None,
            "surname": self.first(a, ".//persName/surname"),
            "email": self.first(a, ".//email"),
            "affiliation": "; ".join(places) or None,
            "orcid": self.text(ids[0]) if ids else None,
        }

    def meta(self) -> dict:
        head = self.root.find(".//teiHeader")
        if head is None:
            return dict.fromkeys(META_NAMES)
        when = head.find(".//publicationStmt/date[@when]")
        authors = [self.author(a) for a in head.findall("./fileDesc/sourceDesc//author")]
        return {
            "title": self.first(head, "./fileDesc/titleStmt/title[@type='main']", "./fileDesc/titleStmt/title"),
            "doi": self.doi(head),
            "header": self.text(head),
            "abstract": self.first(head, "./profileDesc/abstract"),
            "journal": self.first(head, ".//monogr/title"),
            "publication_date": (squeeze(when.get("when")) if when is not None else "") or self.first(head, ".//publicationStmt/date"),
            "keywords": self.all(head, "./profileDesc/textClass/keywords//term"),
            "authors": [a for a in authors if a["given"] or a["surname"] or a["email"]],
        }

    def body(self) -> tuple[list[dict], list[dict]]:
        """Sections and paragraphs in document order; paragraphs right under the body come last, in a section of their own that comes first."""
        body = self.root.find(".//text/body")
        sections, paragraphs = [], []
        if body is None:
            return sections, paragraphs
        loose = body.findall("./p")
        start = 1 if loose else 0
        todo = [(d, None, [], i) for i, d in reversed(list(enumerate(body.findall("./div"))))]
        while todo:
            div, parent, path, sibling = todo.pop()
            title = self.first(div, "./head") or f"Untitled section {sibling + 1}"
            at = start + len(sections)
            sections.append({"ordinal": at, "parent": parent, "xml_id": div.get(XML_ID), "title": title, "path": [*path, title], "sibling": sibling})
            paragraphs += [(at, nth, p) for nth, p in enumerate(div.findall("./p"))]
            todo += [(d, at, [*path, title], i) for i, d in reversed(list(enumerate(div.findall("./div"))))]
        if loose:
            title = "Unclassified body text"
            sections.insert(0, {"ordinal": 0, "parent": None, "xml_id": "section_body_unclassified", "title": title, "path": [title], "sibling": 0})
            paragraphs += [(0, nth, p) for nth, p in enumerate(loose)]
        rows = [{"section": s, "nth": n, "xml_id": p.get(XML_ID), "text": t} for s, n, p in paragraphs if (t := self.text(p))]
        return sections, [{"ordinal": i, **r} for i, r in enumerate(rows)]

    def figures(self) -> tuple[list[dict], list[dict]]:
        figures, tables = [], []
        body = self.root.find(".//text/body")
        for e in () if body is None else body.iter("figure"):
            label = self.first(e, "./head/label", "./label")
            if e.get("type") == "table":
                inner = e.find(".//table")
                tables.append({"ordinal": len(tables), "xml_id": e.get(XML_ID), "label": label, "caption": self.first(e, "./figDesc", "./head") or "", "text": self.text(e if inner is None else inner) or ""})
                continue
            graphics = list(e.iter("graphic"))
            places = [c for g in graphics if (c := (g.get("coords") or "").strip())]
            figures.append(
                {
                    "ordinal": len(figures), "xml_id": e.get(XML_ID), "label": label, "caption": self.first(e, "./figDesc", "./head") or "",
                    "targets": [v for g in graphics for k in ("url", "target") if (v := (g.get(k) or "").strip())],
                    "coords": e.get("coords"), "graphic_coords": ";".join(places) or None, "type": e.get("type"),
                }
            )
        return figures, tables

    def bibliography(self) -> list[dict]:
        out = []
        for e in self.root.findall(".//text/back//listBibl/biblStruct"):
            when = e.find(".//imprint/date[@when]")
            names = (squeeze(" ".join(x for x in (self.first(a, ".//forename"), self.first(a, ".//surname")) if x)) for a in e.findall(".//analytic/author"))
            out.append(
                {
                    "ordinal": len(out), "xml_id": e.get(XML_ID), "title": self.first(e, ".//analytic/title", ".//monogr/title"), "doi": self.doi(e),
                    "year": (squeeze(when.get("when")) if when is not None else "") or self.first(e, ".//imprint/date"), "authors": [n for n in names if n], "raw_text": self.text(e) or "",
                }
            )
        return out


def read_tree(doc_id: str, data: bytes) -> dict:
    """The raw row of an article, or a row whose error says why it can't be parsed."""
    try:
        tree = Tree(data)
    except ET.ParseError as e:
        return dict.fromkeys(RAW_NAMES) | {"doc_id": doc_id, "error": str(e)}
    sections, paragraphs = tree.body()
    figures, tables = tree.figures()
    return {"doc_id": doc_id, "error": None, "meta": tree.meta(), "sections": sections, "paragraphs": paragraphs, "figures": figures, "tables": tables, "bibliography": tree.bibliography()}


def parse(articles: DataFrame) -> DataFrame:
    """One nested row per article of articles(doc_id, content); unparsable ones keep a row with `error`."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [read_tree(i, bytes(c) if c is not None else b"") for i, c in zip(pdf["doc_id"], pdf["content"])]
            yield pd.DataFrame(rows, columns=RAW_NAMES)

    return articles.select(F.col("doc_id").cast("string"), F.col("content").cast("binary")).mapInPandas(run, RAW)


def read(spark: SparkSession, path: str) -> DataFrame:
    """parse() of all .xml files under a path; doc_id is the file's name without its suffix."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.xml").load(path)
    return parse(files.select(F.regexp_extract("path", r"([^/]+?)(?:\.tei)?\.xml$", 1).alias("doc_id"), "content"))


def metadata(raw: DataFrame) -> DataFrame:
    """doc_id, title, doi (of the header's text if no element has it), abstract, journal, publication_date, keywords, authors."""
    m = F.col("meta")
    spoken = F.regexp_replace(F.regexp_extract(F.coalesce(m["header"], F.lit("")), DOI, 0), "[.,;)]+$", "")
    return raw.where("error is null").select(
        "doc_id", m["title"].alias("title"), F.coalesce(m["doi"], X.or_null(spoken)).alias("doi"), *[m[k].alias(k) for k in ("abstract", "journal", "publication_date", "keywords", "authors")]
    )


def sections(raw: DataFrame) -> DataFrame:
    """One row per section with parent, path and kind; `other` takes its parent's kind if that is results or methods."""
    rows = raw.select("doc_id", F.explode("sections").alias("s")).select("doc_id", "s.*")
    own, parent = X.classify_section(F.col("title")), X.classify_section(F.get("path", F.size("path") - 2))
    kind = F.when((own == "other") & (F.size("path") > 1) & parent.isin("results", "methods"), parent).otherwise(own)
    made = X.stable_id("section", F.array_join("path", "/"), F.col("sibling"))
    return rows.select("doc_id", "ordinal", "parent", F.coalesce("xml_id", made).alias("section_id"), "title", "path", kind.alias("section_type"))


def paragraphs(raw: DataFrame) -> DataFrame:
    """One row per paragraph with its section's path and kind, figure references, score, peak positions and Miller indices."""
    rows = raw.select("doc_id", F.explode("paragraphs").alias("p")).select("doc_id", "p.*")
    of = sections(raw).select("doc_id", F.col("ordinal").alias("section"), F.col("path").alias("section_path"), "section_type")
    made = X.stable_id("paragraph", F.array_join("section_path", "/"), F.col("nth"), F.col("text"))
    t = F.col("text")
    return rows.join(of, ["doc_id", "section"]).select(
        "doc_id", "ordinal", F.coalesce("xml_id", made).alias("paragraph_id"), "text", "section_path", "section_type", X.figure_references(t).alias("figure_references"),
        X.score_paragraph(t).alias("score"), X.extract_degrees(t).alias("peak_positions"), X.extract_miller(t).alias("miller_indices"),
    )


def figures(raw: DataFrame) -> DataFrame:
    """One row per figure that is no table, with its normalized label and its caption's score."""
    rows = raw.select("doc_id", F.explode("figures").alias("f")).select("doc_id", "f.*")
    label, score = X.normalize_figure_label(F.col("label")), X.score_paragraph(F.col("caption"))
    return rows.select(
        "doc_id", "ordinal", F.coalesce("xml_id", X.figure_id(F.col("xml_id"), label, F.col("caption"))).alias("figure_id"), "label", label.alias("normalized_label"), "caption",
        "targets", "coords", "graphic_coords", "type", score.alias("score"), (score >= CAPTION_SCORE).alias("caption_fits"),
    )


def tables(raw: DataFrame) -> DataFrame:
    return raw.select("doc_id", F.explode("tables").alias("t")).select("doc_id", "t.*")


def bibliography(raw: DataFrame) -> DataFrame:
    return raw.select("doc_id", F.explode("bibliography").alias("b")).select("doc_id", "b.*")


def unique_figure_ids(figs: DataFrame) -> DataFrame:
    """figs with `new_id`, one-based and unique in its document: the second figure of an id gets `_2`, and so on."""
    from pyspark.sql import Window as W

    wish = X.figure_id(F.col("figure_id"), F.col("normalized_label"), F.col("caption"))
    nth = F.row_number().over(W.partitionBy("doc_id", "__wish").orderBy("ordinal"))
    return figs.withColumn("__wish", wish).withColumn("__n", nth).withColumn(
        "new_id", F.when(F.col("__n") == 1, F.col("__wish")).otherwise(F.concat("__wish", F.lit("_"), F.col("__n").cast("string")))
    ).drop("__wish", "__n")
