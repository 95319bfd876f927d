"""Figures and the paragraphs that speak of them: linking, context, analysis texts and records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from curveloom.functions import lexicon as lx
from curveloom.functions import text as X


def neighbours(rows: DataFrame, group: str, at: str, reach: int, columns: list[str]) -> DataFrame:
    """Pairs of rows of a group at most `reach` apart: `<at>` and `<at>_near` with the columns of the near row.

    The near rows are dealt to the positions they serve, so the pairing is an equi-join on (group, position) and no range join.
    """
    near = rows.select(group, F.col(at).alias(f"{at}_near"), *columns)
    dealt = near.withColumn("__to", F.explode(F.sequence(F.col(f"{at}_near") - reach, F.col(f"{at}_near") + reach)))
    left = rows.select(F.col(group).alias("__g"), F.col(at).alias(at))
    return left.join(dealt, (F.col("__g") == F.col(group)) & (F.col(at) == F.col("__to"))).select(group, at, f"{at}_near", *columns)


def link_figures(figures: DataFrame, paragraphs: DataFrame, reach: int = lx.CONTEXT_WINDOW) -> DataFrame:
    """figures with referenced_by, context (arrays of paragraph ids in order), score and likely.

    Of figures with one label the last takes the references. Each reference adds half a point per paragraph of its window that
    scores 2 or more; a figure is likely at 2.5 points, or if the distinct paragraphs of its windows score 4 together.
    """
    last = F.row_number().over(W.partitionBy("doc_id", "normalized_label").orderBy(F.desc("ordinal")))
    target = figures.where("normalized_label is not null").withColumn("__k", last).where("__k = 1")
    target = target.select("doc_id", F.col("normalized_label").alias("ref"), F.col("ordinal").alias("figure"))
    cites = paragraphs.select("doc_id", F.col("ordinal").alias("p"), "paragraph_id", F.explode("figure_references").alias("ref")).join(target, ["doc_id", "ref"])
    windows = neighbours(paragraphs.select("doc_id", F.col("ordinal").alias("p"), "paragraph_id", "score"), "doc_id", "p", reach, ["paragraph_id", "score"])
    seen = cites.select("doc_id", "figure", "p").join(windows, ["doc_id", "p"])
    per_row = seen.groupBy("doc_id", "figure", "p_near").agg(F.first("paragraph_id").alias("pid"), F.first("score").alias("s"), F.sum(F.when(F.col("score") >= lx.PARAGRAPH_CONTEXT, 0.5).otherwise(0.0)).alias("gain"))
    ordered = lambda at, x: F.array_distinct(F.transform(F.sort_array(F.collect_list(F.struct(at, x))), lambda v: v[x]))
    context = per_row.groupBy("doc_id", "figure").agg(ordered("p_near", "pid").alias("context"), F.sum("gain").alias("gain"), F.sum("s").alias("around"))
    refs = cites.groupBy("doc_id", "figure").agg(ordered("p", "paragraph_id").alias("referenced_by"))
    none = F.array().cast("array<string>")
    score = F.round(F.col("score") + F.coalesce("gain", F.lit(0.0)), 3)
    joined = figures.join(refs.withColumnRenamed("figure", "ordinal"), ["doc_id", "ordinal"], "left").join(context.withColumnRenamed("figure", "ordinal"), ["doc_id", "ordinal"], "left")
    likely = F.col("caption_fits") | (F.col("gain").isNotNull() & (score >= lx.CAPTION_SCORE)) | F.coalesce(F.col("around") >= lx.CONTEXT_SUM, F.lit(False))
    return joined.select(
        *[c for c in figures.columns if c != "score"], F.coalesce("referenced_by", none).alias("referenced_by"), F.coalesce("context", none).alias("context"), score.alias("score"), likely.alias("likely")
    )


def _selected(figures: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """doc_id, figure, at, text, mention: sentences that cite the figure, and other paragraphs that are relevant to it.

    Figures meet paragraphs by label, by id and by section, never all of a document; texts join the pairs that are left.
    """
    f = figures.where("normalized_label is not null").select("doc_id", F.col("ordinal").alias("figure"), F.col("normalized_label").alias("ref"), "referenced_by", "context")
    p = paragraphs.select("doc_id", F.col("ordinal").alias("at"), "paragraph_id", "section_path", "section_type", "figure_references", "score")
    pair = ["doc_id", "figure", "at"]

    def by_id(column: str) -> DataFrame:
        named = f.select("doc_id", "figure", F.explode(column).alias("paragraph_id")).distinct()
        return named.join(p.select("doc_id", "at", "paragraph_id", "section_path"), ["doc_id", "paragraph_id"])

    anchors = by_id("referenced_by")
    found = {
        "cites": p.select("doc_id", "at", F.explode(F.array_distinct("figure_references")).alias("ref")).join(f.select("doc_id", "figure", "ref"), ["doc_id", "ref"]),
        "anchor": anchors,
        "same": anchors.select("doc_id", "figure", "section_path").distinct().join(p.select("doc_id", "at", "section_path"), ["doc_id", "section_path"]),
        "near": by_id("context"),
    }
    pairs = None
    for how, rows in found.items():
        marked = rows.select(*pair, *[F.lit(how == k).alias(k) for k in found])
        pairs = marked if pairs is None else pairs.unionByName(marked)
    pairs = pairs.groupBy(*pair).agg(*[F.max(k).alias(k) for k in found])
    judged = pairs.join(p.select("doc_id", "at", "section_type", F.size("figure_references").alias("n_refs"), "score"), ["doc_id", "at"])
    near = F.col("near") & (F.col("score") >= lx.WINDOW_SCORE) & (F.col("same") | F.col("section_type").isin("results", "methods"))
    relevant = ~F.col("anchor") & ((F.col("n_refs") == 0) | F.col("cites")) & ((F.col("same") & (F.col("score") >= lx.SECTION_SCORE)) | near)
    kept = judged.withColumn("relevant", F.coalesce(relevant, F.lit(False))).where("cites or relevant")
    rows = kept.join(paragraphs.select("doc_id", F.col("ordinal").alias("at"), "text"), ["doc_id", "at"]).join(f.select("doc_id", "figure", "ref"), ["doc_id", "figure"])
    rows = rows.withColumn("mention", F.when(F.col("cites"), X.mention_text(F.col("text"), F.col("ref"))))
    return rows.where("mention is not null or relevant").select(*pair, F.coalesce("mention", "text").alias("text"), F.col("mention").isNotNull().alias("mention"))


def analysis_texts(figures: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """doc_id, figure (ordinal), analysis: the selected texts in document order, divided by blank lines."""
    parts = F.transform(F.sort_array(F.collect_list(F.struct("at", "text"))), lambda v: v["text"])
    return _selected(figures, paragraphs).groupBy("doc_id", "figure").agg(F.array_join(parts, "\n\n").alias("analysis"))


def training_records(figures: DataFrame, paragraphs: DataFrame, documents: DataFrame) -> DataFrame:
    """One nested row per likely figure with a label and an analysis text: document, figure, analysis_paragraphs, combined text and features."""
    likely = figures.where("likely and normalized_label is not null")
    cites = paragraphs.select("doc_id", F.struct("*").alias("p"), F.explode("figure_references").alias("normalized_label"))
    told = likely.select("doc_id", "ordinal", "normalized_label").join(cites, ["doc_id", "normalized_label"])
    told = told.withColumn("relevant_text", X.mention_text(F.col("p.text"), F.col("normalized_label"))).where("relevant_text is not null")
    facts = told.groupBy("doc_id", "ordinal").agg(
        F.sort_array(F.collect_list(F.struct("p.ordinal", "p.paragraph_id", "p.text", "relevant_text"))).alias("analysis_paragraphs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("p.peak_positions")))).alias("peak_positions"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("p.miller_indices")))).alias("miller_indices"),
    )
    texts = analysis_texts(likely, paragraphs).withColumnRenamed("figure", "ordinal")
    return (
        likely.join(texts, ["doc_id", "ordinal"])
        .join(facts, ["doc_id", "ordinal"], "left")
        .join(documents.select("doc_id", F.struct("title", "doi", "journal", "publication_date").alias("document")), "doc_id", "left")
        .select("doc_id", "ordinal", "document", "figure_id", "normalized_label", "caption", "score", "analysis_paragraphs", F.col("analysis").alias("combined_analysis_text"), "peak_positions", "miller_indices")
    )


def figure_dataset(figures: DataFrame, paragraphs: DataFrame, only_fitting: bool = False) -> DataFrame:
    """doc_id, figure, figure_path, caption, text: the first figure of each numeric label, and labels that only the text cites."""
    first = F.row_number().over(W.partitionBy("doc_id", "normalized_label").orderBy("ordinal"))
    own = figures.where("normalized_label rlike '^[0-9]+$'")
    own = (own.where("caption_fits") if only_fitting else own).withColumn("__k", first).where("__k = 1").drop("__k")
    texts = analysis_texts(own, paragraphs).withColumnRenamed("figure", "ordinal")
    caption, analysis = X.normalize_whitespace(F.col("caption")), X.normalize_whitespace(F.col("analysis"))
    path = F.coalesce(F.get("image_paths", F.lit(0)), F.lit("")) if "image_paths" in figures.columns else F.lit("")
    rows = own.join(texts, ["doc_id", "ordinal"], "left").select("doc_id", F.col("normalized_label").cast("int").alias("figure"), path.alias("figure_path"), caption.alias("caption"), F.trim(F.concat_ws(" ", caption, analysis)).alias("text"))
    rows = rows.where("text <> ''")
    if only_fitting:
        return rows
    cited = paragraphs.select("doc_id", "ordinal", "text", F.explode("figure_references").alias("normalized_label")).where("normalized_label rlike '^[0-9]+$'")
    orphans = cited.join(own.select("doc_id", "normalized_label"), ["doc_id", "normalized_label"], "left_anti")
    told = orphans.withColumn("mention", X.mention_text(F.col("text"), F.col("normalized_label"))).where("mention is not null")
    parts = F.array_distinct(F.transform(F.sort_array(F.collect_list(F.struct("ordinal", "mention"))), lambda v: v["mention"]))
    lonely = told.groupBy("doc_id", "normalized_label").agg(X.normalize_whitespace(F.array_join(parts, "\n\n")).alias("text"))
    return rows.unionByName(lonely.select("doc_id", F.col("normalized_label").cast("int").alias("figure"), F.lit("").alias("figure_path"), F.lit("").alias("caption"), "text").where("text <> ''"))


def document_counts(raw: DataFrame, linked: DataFrame) -> DataFrame:
    """doc_id with the numbers of sections, paragraphs, figures, likely figures, tables and references."""
    sizes = raw.where("error is null").select("doc_id", *[F.size(c).cast("bigint").alias(f"n_{c}") for c in ("sections", "paragraphs", "figures", "tables", "bibliography")])
    likely = linked.groupBy("doc_id").agg(F.count_if("likely").alias("n_likely"), F.count_if(F.col("likely") & (F.size("targets") > 0)).alias("n_likely_with_image"))
    return sizes.join(likely, "doc_id", "left").fillna(0, ["n_likely", "n_likely_with_image"])
