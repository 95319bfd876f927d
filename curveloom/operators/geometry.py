"""Boxes on pages: bands of pictures, the picture above a caption, and crops widened to their labels.

Boxes are rows page-wise keyed by `group` columns (document, page); captions are joined to the boxes of their page only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Distances and sizes in points.
BAND_GAP, CAPTION_GAP, MIN_OVERLAP, MIN_WIDTH, MIN_HEIGHT, MIN_AREA, MAX_DISTANCE = 20.0, 12.0, 0.2, 50.0, 30.0, 5000.0, 150.0
LABEL_LEFT, LABEL_BOTTOM, LABEL_TOP, LABEL_RIGHT = 18.0, 40.0, 20.0, 15.0


def corners(box: Column) -> Column:
    """A box (page, x, y, w, h) by its corners."""
    return F.struct(box["page"].alias("page"), box["x"].alias("x0"), box["y"].alias("y0"), (box["x"] + box["w"]).alias("x1"), (box["y"] + box["h"]).alias("y1"))


def captions_by_page(boxes: DataFrame, doc: str) -> DataFrame:
    """One row per document and page of boxes(doc, page, x, y, w, h): the captions' union and the list of corners."""
    c = boxes.select(doc, "page", F.col("x").alias("x0"), F.col("y").alias("y0"), (F.col("x") + F.col("w")).alias("x1"), (F.col("y") + F.col("h")).alias("y1"))
    return c.groupBy(doc, "page").agg(F.sort_array(F.collect_list(F.struct("x0", "y0", "x1", "y1"))).alias("captions"), F.min("y0").alias("caption_y0"), F.min("x0").alias("caption_x0"), F.max("x1").alias("caption_x1"))


def distinct_rects(rects: DataFrame, group: Sequence[str]) -> DataFrame:
    """Rectangles that differ after rounding to a tenth."""
    keys = [F.round(c, 1).alias(f"__{c}") for c in ("x0", "y0", "x1", "y1")]
    return rects.select("*", *keys).dropDuplicates([*group, "__x0", "__y0", "__x1", "__y1"]).drop("__x0", "__y0", "__x1", "__y1")


def bands(rects: DataFrame, group: Sequence[str], gap: float | Column = BAND_GAP, start: str = "y0", end: str = "y1") -> DataFrame:
    """rects with `band`, from 0 downwards: a new one begins more than `gap` below everything above it.

    Equal rectangles share a band; those without a start come last and join the last band.
    """
    w = W.partitionBy(*group).orderBy(F.asc_nulls_last(start), F.asc_nulls_last(end))
    reach = F.max(end).over(w.rowsBetween(W.unboundedPreceding, -1))
    flag = F.when(F.col(start) > reach + gap, 1).otherwise(0)
    return rects.withColumn("__new", flag).withColumn("band", F.sum("__new").over(w)).drop("__new")


def band_boxes(rects: DataFrame, group: Sequence[str], gap: float = BAND_GAP) -> DataFrame:
    """The union of the rectangles of each band."""
    return bands(rects, group, gap).groupBy(*group, "band").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.count("*").alias("n"))


def _share() -> Column:
    """The share of the caption's width that a rectangle covers."""
    wide = F.greatest(F.col("caption_x1") - F.col("caption_x0"), F.lit(1.0))
    return (F.least("x1", "caption_x1") - F.greatest("x0", "caption_x0")) / wide


def picture_above(rects: DataFrame, captions: DataFrame, key: Sequence[str], caption: str) -> DataFrame:
    """The lowest band of pictures that ends above each caption, is large enough and near enough.

    A picture counts if it covers a fifth of the caption's width or is 50 points wide.
    """
    over = rects.join(captions, list(key)).where(F.col("y1") <= F.col("caption_y0") - CAPTION_GAP).where((_share() >= MIN_OVERLAP) | (F.col("x1") - F.col("x0") >= MIN_WIDTH))
    found = band_boxes(over.select(*key, caption, "x0", "y0", "x1", "y1", "caption_y0"), [*key, caption, "caption_y0"])
    fits = ((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")) >= MIN_AREA) & (F.col("y1") - F.col("y0") >= MIN_HEIGHT) & (F.col("caption_y0") - F.col("y1") <= MAX_DISTANCE)
    best = F.max_by(F.struct("x0", "y0", "x1", "y1"), F.struct(F.col("y1"), -F.col("band")))
    return found.where(fits).groupBy(*key, caption).agg(best.alias("b")).select(*key, caption, "b.*")


def drawings_above(rects: DataFrame, captions: DataFrame, key: Sequence[str], caption: str) -> DataFrame:
    """The union of all drawings that end above a caption and cover a fifth of its width."""
    over = rects.join(captions, list(key)).where(F.col("y1") <= F.col("caption_y0") - CAPTION_GAP).where(_share() >= MIN_OVERLAP)
    return over.groupBy(*key, caption).agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


def widen_to_labels(crops: DataFrame, spans: DataFrame, key: Sequence[str], crop: str) -> DataFrame:
    """crops(key, crop, x0, y0, x1, y1, caption_y0) widened to the text spans(key, x0, y0, x1, y1, text) that label their axes.

    Spans left of the crop move its left edge, spans under it the lower and spans over it the upper edge; text at or below the
    caption, and far from the crop, is no label.
    """
    s = spans.where(F.trim("text") != "").select(*key, *[F.col(c).alias(f"s{c}") for c in ("x0", "y0", "x1", "y1")])
    both = crops.join(s, list(key), "left")
    c = F.col
    limit = c("caption_y0") - CAPTION_GAP
    near = (c("sy0") < limit) & (c("sy1") >= c("y0") - LABEL_TOP) & (c("sy0") <= c("y1") + LABEL_BOTTOM)
    aside = (c("sx1") <= c("x0") + 2.0) & (c("sx0") >= c("x0") - LABEL_LEFT)
    across = (c("sx1") >= c("x0") - 5.0) & (c("sx0") <= c("x1") + LABEL_RIGHT)
    under = across & (c("sy0") >= c("y1") - 2.0) & (c("sy0") <= limit)
    above = across & (c("sy1") <= c("y0") + 2.0) & (c("sy0") >= c("y0") - LABEL_TOP)
    names = ["x0", "y0", "x1", "y1", "caption_y0"]
    wide = both.groupBy(*key, crop, *names).agg(
        F.min(F.when(near & aside, c("sx0"))).alias("l"), F.max(F.when(near & under, c("sy1"))).alias("b"), F.min(F.when(near & above, c("sy0"))).alias("t")
    )
    return wide.select(*key, crop, F.least("x0", "l").alias("x0"), F.least("y0", "t").alias("y0"), "x1", F.greatest("y1", "b").alias("y1"), "caption_y0")


def crop_region(boxes: DataFrame, doc: str, pages: DataFrame, pad: tuple[float, float, float, float] = (12.0, 8.0, 8.0, 12.0)) -> DataFrame:
    """Per page the union of boxes(doc, page, x, y, w, h), padded left, top, right, bottom and clipped to pages(doc, page, width, height)."""
    left, top, right, bottom = pad
    u = boxes.groupBy(doc, "page").agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.max(F.col("x") + F.col("w")).alias("x1"), F.max(F.col("y") + F.col("h")).alias("y1"))
    at = u.join(pages, [doc, "page"])
    zero = F.lit(0.0)
    out = at.select(
        doc, "page", F.greatest(zero, F.col("x0") - left).alias("x0"), F.greatest(zero, F.col("y0") - top).alias("y0"),
        F.least(F.col("width"), F.col("x1") + right).alias("x1"), F.least(F.col("height"), F.col("y1") + bottom).alias("y1"),
    )
    return out.where("x1 > x0 and y1 > y0")


def choose_crop(figure: Column, graphic: Column) -> Column:
    """The graphic's boxes where there are any of 30 points height and 50 points width, else the figure's."""
    usable = F.exists(graphic, lambda b: (b["h"] >= MIN_HEIGHT) & (b["w"] >= MIN_WIDTH))
    return F.when(F.coalesce(usable, F.lit(False)), graphic).otherwise(figure)


def inset(box: Column, by: int, least: int = 8) -> Column:
    """A box (left, top, right, bottom) shrunk on all sides, or unchanged if less than `least` pixels would be left."""
    left, top, right, bottom = (box[k] for k in ("left", "top", "right", "bottom"))
    fits = (right - left - 2 * by >= least) & (bottom - top - 2 * by >= least)
    moved = F.struct((left + by).alias("left"), (top + by).alias("top"), (right - by).alias("right"), (bottom - by).alias("bottom"))
    return F.when(fits, moved).otherwise(F.struct(left.alias("left"), top.alias("top"), right.alias("right"), bottom.alias("bottom")))


def grow_band(top: Column, bottom: Column, height: Column, least: int = 120) -> tuple[Column, Column]:
    """A band grown around its middle to `least` pixels, within the picture."""
    short = bottom - top < least
    middle = F.floor((top + bottom) / 2)
    lo = F.greatest(F.lit(0), middle - least // 2)
    hi = F.least(height, lo + least)
    return F.when(short, F.greatest(F.lit(0), hi - least)).otherwise(top), F.when(short, hi).otherwise(bottom)


def flip_rows(row: Column, height: Column) -> Column:
    """A row counted from the bottom."""
    return height - 1 - row
