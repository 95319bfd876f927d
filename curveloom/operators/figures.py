"""Pictures of plots to calibrated curves: Arrow kernels per picture, Column expressions for everything after the path."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curveloom.functions import images as I
from curveloom.functions import signal as S
from curveloom.functions import ticks as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BOX = "struct<left:int,top:int,right:int,bottom:int>"
TICKS = "array<struct<px:int,value:double>>"
FIGURE = f"figure_id string, error string, box {BOX}, frame {BOX}, score double, crop_confidence double, layout string, dark boolean, grid boolean, warnings array<string>, bands array<struct<top:int,bottom:int>>"
CURVE = "figure_id string, band int, mode string, coverage double, span double, ok boolean, px array<double>, row array<double>"
CALIBRATION = f"figure_id string, x_min double, x_max double, x_confidence double, method string, x_ticks {TICKS}, y_min double, y_max double, y_confidence double, y_scale double, y_reliable boolean, warnings array<string>"

FIGURE_NAMES = ["figure_id", "error", "box", "frame", "score", "crop_confidence", "layout", "dark", "grid", "warnings", "bands"]
CURVE_NAMES = ["figure_id", "band", "mode", "coverage", "span", "ok", "px", "row"]
CALIBRATION_NAMES = ["figure_id", "x_min", "x_max", "x_confidence", "method", "x_ticks", "y_min", "y_max", "y_confidence", "y_scale", "y_reliable", "warnings"]


def pictures(spark: SparkSession, path: str, glob: str = "*.png") -> DataFrame:
    """figure_id and the picture's height, width and bytes (blue, green, red) of all files under a path, in no order."""
    files = spark.read.format("image").option("dropInvalid", True).option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    stem = F.regexp_extract("image.origin", r"([^/]+?)\.[^./]+$", 1)
    return files.select(stem.alias("figure_id"), F.col("image.origin").alias("path"), "image.height", "image.width", "image.nChannels", "image.data")


def decode(row) -> np.ndarray:
    img = np.frombuffer(row["data"], np.uint8).reshape(row["height"], row["width"], row["nChannels"])
    return np.repeat(img, 3, 2) if img.shape[2] == 1 else img[..., :3]


def pixel_rows(images: DataFrame) -> DataFrame:
    """One row per pixel: figure_id, row, col, b, g, r. For pictures of three channels."""
    n = F.col("nChannels")
    at = F.explode(F.sequence(F.lit(0), F.col("height") * F.col("width") - 1)).alias("i")
    byte = lambda k: F.conv(F.hex(F.substr("data", F.col("i") * n + k + 1, F.lit(1))), 16, 10).cast("int")
    flat = images.where("nChannels = 3").select("figure_id", "width", "data", "nChannels", at)
    return flat.select("figure_id", F.floor(F.col("i") / F.col("width")).cast("int").alias("row"), (F.col("i") % F.col("width")).alias("col"), *[byte(k).alias(c) for k, c in enumerate("bgr")])


def column_tops(pixels: DataFrame, dark: int = 95) -> DataFrame:
    """figure_id, col, top: the highest pixel of each column darker than the limit."""
    shade = 0.114 * F.col("b") + 0.587 * F.col("g") + 0.299 * F.col("r")
    return pixels.where(shade < dark).groupBy("figure_id", "col").agg(F.min("row").alias("top"))


def row_occupancy(pixels: DataFrame, dark: int = 85) -> DataFrame:
    """figure_id, row, n: coloured or dark pixels per row."""
    shade = 0.114 * F.col("b") + 0.587 * F.col("g") + 0.299 * F.col("r")
    high, low = F.greatest("b", "g", "r"), F.least("b", "g", "r")
    busy = (255 * (high - low) > 35 * high) | (shade < dark)
    return pixels.groupBy("figure_id", "row").agg(F.count_if(busy).alias("n"))


def analyse(images: DataFrame) -> DataFrame:
    """One row per picture: plot box, inner frame (in the box), score, layout, bands; a picture that fails keeps a row with its error."""

    def one(row) -> dict:
        img = decode(row)
        crop = I.plot_crop(img)
        left, top, right, bottom = crop["box"]
        inner = img[top:bottom, left:right]
        frame = I.axis_frame(inner)
        frame = (frame[0], frame[1], min(I.right_of_frame(inner, frame), inner.shape[1]), frame[3])
        score, notes = I.figure_score(img)
        names = ("left", "top", "right", "bottom")
        return {
            "box": dict(zip(names, crop["box"])), "frame": dict(zip(names, frame)), "score": score, "crop_confidence": crop["confidence"],
            "layout": I.layout(I.curve_masks(inner, frame), frame[3] - frame[1], frame[2] - frame[0]), "dark": I.is_dark(img), "grid": I.has_grid(inner),
            "warnings": sorted({*crop["warnings"], *(n for n in notes if n.startswith(("low_", "possible_")))}),
            "bands": [{"top": a, "bottom": b} for a, b in I.figure_bands(inner, frame)],
        }

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                try:
                    out.append({"figure_id": row["figure_id"], "error": None} | one(row))
                except (ValueError, IndexError) as e:
                    out.append({"figure_id": row["figure_id"], "error": str(e)})
            yield pd.DataFrame(out, columns=FIGURE_NAMES)

    return images.select("figure_id", "height", "width", "nChannels", "data").mapInPandas(run, FIGURE)


def trace_curves(images: DataFrame, analysed: DataFrame, inset: int = 3) -> DataFrame:
    """One row per picture and band: the path as columns `px` and rows `row` of the plot box, with its quality."""
    both = images.select("figure_id", "height", "width", "nChannels", "data").join(analysed.where("error is null").select("figure_id", "box", "frame", "bands"), "figure_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                b, f = row["box"], row["frame"]
                img = decode(row)[b["top"] : b["bottom"], b["left"] : b["right"]]
                for k, band in enumerate(row["bands"]):
                    left, right, top, bottom = f["left"] + inset, f["right"] - inset, band["top"] + inset, band["bottom"] - inset
                    if right - left < 8 or bottom - top < 8:
                        continue
                    found = I.extract_curve(img, (left, top, right, bottom))
                    at = np.flatnonzero(np.isfinite(found["path"]))
                    out.append({"figure_id": row["figure_id"], "band": k} | {c: found[c] for c in ("mode", "coverage", "span", "ok")} | {"px": (left + at).astype(float), "row": top + found["path"][at]})
            yield pd.DataFrame(out, columns=CURVE_NAMES)

    return both.mapInPandas(run, CURVE)


def calibrate(analysed: DataFrame, readings: DataFrame) -> DataFrame:
    """Axes of each picture from its tick readings(figure_id, axis 'x'/'y', px, value), pixels in the plot box.

    Readings come from a table: recognising characters is not part of the engine. Without usable ticks the default ranges hold.
    """
    ticks = F.collect_list(F.when(F.col("axis") == "x", F.struct("px", "value")))
    packed = readings.groupBy("figure_id").agg(ticks.alias("xs"), F.collect_list(F.when(F.col("axis") == "y", F.struct("px", "value"))).alias("ys"))
    both = analysed.where("error is null").select("figure_id", "frame").join(packed, "figure_id", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                pairs = lambda c: [(t["px"], t["value"]) for t in (row[c] if row[c] is not None else [])]  # noqa: B023, E731
                xs, ys, f = pairs("xs"), pairs("ys"), row["frame"]
                x = T.x_axis(xs, f["left"], f["right"])
                y = T.y_axis(ys, f["top"], f["bottom"])
                reliable = bool(y and T.reliable_y(ys, y["y_min"], y["y_max"]))
                top = y["y_max"] if y else None
                out.append(
                    {
                        "figure_id": row["figure_id"], "x_min": x["x_min"], "x_max": x["x_max"], "x_confidence": x["confidence"], "method": x["method"],
                        "x_ticks": [{"px": p, "value": v} for p, v in x["ticks"]], "y_min": y["y_min"] if y else None, "y_max": top, "y_confidence": y["confidence"] if y else None,
                        "y_scale": y["y_max"] - y["y_min"] if reliable else T.highest_label(ys, top), "y_reliable": reliable,
                        "warnings": [w for w, on in (("x_axis_default_range", x["method"] == "default_range"), ("y_axis_not_reliable", not reliable)) if on],
                    }
                )
            yield pd.DataFrame(out, columns=CALIBRATION_NAMES)

    return both.mapInPandas(run, CALIBRATION)


def calibrated_points(curves: DataFrame, analysed: DataFrame, calibration: DataFrame) -> DataFrame:
    """figure_id, band, x, y of all points of traced curves: pixel positions through the axes' lines, heights not below 0."""
    a = analysed.select("figure_id", "frame", "bands")
    long = curves.select("figure_id", "band", F.explode(F.arrays_zip("px", "row")).alias("p")).select("figure_id", "band", "p.px", "p.row")
    rows = long.join(a, "figure_id").join(calibration.drop("warnings"), "figure_id")
    wide = F.greatest(F.col("frame.right") - F.col("frame.left"), F.lit(1))
    x = F.col("x_min") + (F.col("px") - F.col("frame.left")) / wide * (F.col("x_max") - F.col("x_min"))
    low = F.get("bands", F.col("band"))
    share = (low["bottom"] - F.col("row")) / F.greatest(low["bottom"] - low["top"], F.lit(1))
    tall = F.greatest(F.col("frame.bottom") - F.col("frame.top"), F.lit(1))
    whole = F.col("y_max") - (F.col("row") - F.col("frame.top")) / tall * (F.col("y_max") - F.col("y_min"))
    y = F.when(F.col("y_reliable") & (F.size("bands") == 1), F.greatest("y_min", F.least("y_max", whole))).otherwise(F.greatest(F.lit(0.0), share) * F.col("y_scale"))
    return rows.select("figure_id", "band", x.alias("x"), y.alias("y")).where(F.col("x").isNotNull() & F.col("y").isNotNull())


PEAK = "peaks array<struct<two_theta:double,relative_intensity:double,prominence:double>>"


def peaks_of(points: DataFrame, group: list[str], method: str = "substantial", most: int | None = None) -> DataFrame:
    """Peaks of each curve of points(group, x, y): `substantial` merges to major ones, `traced` lists up to 30 of a traced curve."""
    kinds = dict(points.dtypes)

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("x", kind="stable")
        x, y = pdf["x"].to_numpy(float), pdf["y"].to_numpy(float)
        found = S.substantial_peaks(x, y, most=most or S.MOST_PEAKS) if method == "substantial" else S.smooth_peaks(x, y, most=most or 30)
        names = ("two_theta", "relative_intensity", "prominence")
        return pd.DataFrame({**{g: [k] for g, k in zip(group, key)}, "peaks": [[dict(zip(names, p)) for p in found]]})

    return points.select(*group, "x", "y").groupBy(*group).applyInPandas(run, ", ".join(f"{g} {kinds[g]}" for g in group) + f", {PEAK}")


def peaks_percent(peaks: DataFrame) -> DataFrame:
    """peaks with heights as percent of the highest positive one."""
    top = F.array_max(F.transform("peaks", lambda p: p["relative_intensity"]))
    scale = F.when(top > 0, 100.0 / top).otherwise(1.0)
    return peaks.withColumn("peaks", F.transform("peaks", lambda p: p.withField("relative_intensity", p["relative_intensity"] * scale)))


def merged_amplitudes(first: DataFrame, second: DataFrame, key: list[str], tolerance: float = 0.25) -> DataFrame:
    """Peaks of `first` with the height of the peak at the same place of `second`, where the two agree within the tolerance."""
    other = second.select(*key, F.col("peaks").alias("__other"))
    pick = lambda a, b: F.when(F.abs(a["relative_intensity"] - b["relative_intensity"]) <= tolerance * F.greatest(a["relative_intensity"], F.lit(1e-6)), a.withField("relative_intensity", b["relative_intensity"])).otherwise(a)
    both = first.join(other, key, "left")
    return both.withColumn("peaks", F.filter(F.when(F.col("__other").isNull(), F.col("peaks")).otherwise(F.zip_with("peaks", "__other", pick)), lambda p: p.isNotNull())).drop("__other")


def mean_confidence(analysed: DataFrame, calibration: DataFrame, curves: DataFrame) -> DataFrame:
    """figure_id, confidence: the mean of those of classification, crop, calibration and curve."""
    has = curves.groupBy("figure_id").agg(F.count_if("ok").alias("n"))
    rows = analysed.where("error is null").join(calibration.drop("warnings"), "figure_id", "left").join(has, "figure_id", "left")
    label = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("score")) / 4)
    axis = F.coalesce((F.col("x_confidence") + F.col("y_confidence")) / 2, F.col("x_confidence"), F.lit(0.3))
    return rows.select("figure_id", ((label + F.col("crop_confidence") + axis + F.when(F.col("n") > 0, 0.8).otherwise(0.1)) / 4).alias("confidence"))


def digitize(images: DataFrame, readings: DataFrame) -> dict[str, DataFrame]:
    """The whole way from pictures to tables: figures, calibration, curves, points, peaks, confidence."""
    figures = analyse(images).checkpoint()
    axes = calibrate(figures, readings).checkpoint()
    curves = trace_curves(images, figures).checkpoint()
    points = calibrated_points(curves.where("ok"), figures, axes)
    return {"figures": figures, "calibration": axes, "curves": curves, "points": points, "peaks": peaks_of(points, ["figure_id", "band"]), "confidence": mean_confidence(figures, axes, curves)}
