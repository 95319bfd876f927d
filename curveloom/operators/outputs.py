"""Digitizing by colour masks, what a digitizing run leaves behind, and the plots of it."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curveloom.functions import images as I
from curveloom.functions import masks as M
from curveloom.functions import plots as P
from curveloom.operators import figures

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PEAKS = "array<struct<two_theta:double,relative_intensity:double,prominence:double>>"
CURVES = f"figure_id string, curve int, curve_id string, color string, x array<double>, y array<double>, peaks {PEAKS}, warnings array<string>, error string"
CURVE_NAMES = ["figure_id", "curve", "curve_id", "color", "x", "y", "peaks", "warnings", "error"]
FIGURE_DIR = r"^(?:figure|pattern)_\d+$"


def mask_curves(images: DataFrame, analysed: DataFrame, calibration: DataFrame, points: int = 2000, same_colour: bool = False) -> DataFrame:
    """One row per picture and curve: x, y, the colour, peaks and warnings, by the colour masks of the plot.

    analysed and calibration are those of figures.analyse() and figures.calibrate(). A plot without a curve gives one row with
    empty arrays, a picture that fails one with its error. With same_colour, curves of a stack that share a colour are told apart
    by their rows.
    """
    axes = calibration.select("figure_id", "x_min", "x_max", "y_min", "y_max", "y_reliable")
    known = analysed.where("error is null").select("figure_id", "box", "frame")
    both = images.select("figure_id", "height", "width", "nChannels", "data").join(known, "figure_id").join(axes, "figure_id")

    def one(row: dict) -> list[M.Curve]:
        b, f = row["box"], row["frame"]
        img = figures.decode(row)[b["top"] : b["bottom"], b["left"] : b["right"]]
        frame = M.Frame(f["left"], f["top"], f["right"], f["bottom"], row["x_min"], row["x_max"])
        if row["y_reliable"]:
            frame.y_min, frame.y_max = row["y_min"], row["y_max"]
            frame.y_ticks = [(f["top"], row["y_max"]), (f["bottom"], row["y_min"])]
        return M.stacked_by_rows(img, frame, points) if same_colour else M.digitized(img, frame, points)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ("two_theta", "relative_intensity", "prominence")
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                try:
                    for k, c in enumerate(one(row)):
                        peaks = [dict(zip(names, map(float, p))) for p in c.peaks]
                        out.append((row["figure_id"], k, c.name, c.colour, c.x.astype(float), c.y.astype(float), peaks, c.warnings, None))
                except (ValueError, IndexError) as e:
                    out.append((row["figure_id"], 0, None, None, None, None, None, None, str(e)))
            yield pd.DataFrame(out, columns=CURVE_NAMES)

    return both.mapInPandas(run, CURVES)


def points_of(curves: DataFrame) -> DataFrame:
    """figure_id, curve, x, y of the points of curves."""
    zipped = curves.select("figure_id", "curve", F.explode(F.arrays_zip("x", "y")).alias("p"))
    return zipped.select("figure_id", "curve", F.col("p.x").alias("x"), F.col("p.y").alias("y"))


def digitize_pictures(images: DataFrame, readings: DataFrame, points: int = 2000, least_score: float | None = None) -> dict[str, DataFrame]:
    """figures, calibration and curves of all pictures by the mask path; with least_score only those that look enough like a plot."""
    found = figures.analyse(images).checkpoint()
    if least_score is not None:
        found = found.where(F.col("error").isNotNull() | (F.col("score") >= least_score))
    axes = figures.calibrate(found, readings).checkpoint()
    return {"figures": found, "calibration": axes, "curves": mask_curves(images, found, axes, points).checkpoint()}


# Results of a run, read as columns.


def all_curves(result: Column) -> Column:
    """The curves of all panels of a figure's result (schemas.FIGURE_RESULT)."""
    return F.flatten(F.transform(result["panels"], lambda p: p["curves"]))


def first_calibration(result: Column) -> Column:
    """The calibration of the first panel; null without panels."""
    return F.get(result["panels"], F.lit(0))["calibration"]


def first_curve(result: Column) -> Column:
    """The first curve of all panels; null without curves."""
    return F.get(all_curves(result), F.lit(0))


def first_peaks(result: Column) -> Column:
    """The peaks of the first curve; an empty list without curves."""
    found = first_curve(result)["peaks"]
    return F.coalesce(found, F.array().cast(PEAKS))


def figure_context(pictures: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """image_path, figure_id, caption, source_pdf, page of pictures(figure_id, path), with what records(figure_id, ...) tell."""
    rows = pictures.select(F.col("path").alias("image_path"), F.coalesce("figure_id", F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1)).alias("figure_id"))
    for name, kind in (("caption", "string"), ("source_pdf", "string"), ("page", "int")):
        if records is None or name not in records.columns:
            rows = rows.withColumn(name, F.lit(None).cast(kind))
        else:
            rows = rows.join(records.select("figure_id", F.col(name).cast(kind).alias(name)).dropDuplicates(["figure_id"]), "figure_id", "left")
    return rows.select("image_path", "figure_id", "caption", "source_pdf", "page")


def pictures_to_do(pictures: DataFrame, done: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """pictures(figure_id, path) outside of result folders: `pattern_N`, else `figure_N`, else all; without those done, in order."""
    free = pictures.where(~F.element_at(F.split("path", "/"), -2).rlike(FIGURE_DIR))
    rank = F.when(F.col("figure_id").rlike(r"^pattern_\d+$"), 0).when(F.col("figure_id").rlike(r"^figure_\d+$"), 1).otherwise(2)
    kinds = free.agg(F.min(rank)).first()[0]
    kept = free.where(rank == kinds) if kinds is not None and kinds < 2 else free
    if done is not None:
        kept = kept.join(done.select("figure_id").distinct(), "figure_id", "left_anti")
    return kept.orderBy("figure_id").limit(limit) if limit else kept


def analysis_pictures(entries: DataFrame, known: DataFrame) -> DataFrame:
    """entries(figure, figure_path, caption, text) of a figure dataset with `path`, the first of their places that known(path) has:
    as written, beside the dataset, in its `figures` folder. Entries without a picture are left out."""
    name = F.regexp_extract("figure_path", r"([^/]+)$", 1)
    places = F.array(F.struct(F.lit(0).alias("rank"), F.col("figure_path").alias("place")), F.struct(F.lit(1).alias("rank"), F.concat(F.lit("/"), name).alias("place")), F.struct(F.lit(2).alias("rank"), F.concat(F.lit("/figures/"), name).alias("place")))
    offered = entries.withColumn("__entry", F.xxhash64("figure", "figure_path")).withColumn("__p", F.explode(places))
    files = known.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("__file"))
    met = offered.withColumn("__file", name).join(files, "__file").where((F.col("path") == F.col("__p.place")) | ((F.col("__p.rank") > 0) & F.col("path").endswith(F.col("__p.place"))))
    best = met.groupBy("__entry", *entries.columns).agg(F.min_by("path", F.struct("__p.rank", "path")).alias("path"))
    return best.drop("__entry")


def outcome_counts(curves: DataFrame) -> DataFrame:
    """status (success, empty, failed) and the number of pictures of each."""
    status = F.when(F.max(F.col("error").isNotNull()), "failed").when(F.max(F.size("x") > 0), "success").otherwise("empty")
    return curves.groupBy("figure_id").agg(status.alias("status")).groupBy("status").agg(F.count("*").alias("n"))


def summary_line(index: Column, extracted: Column, total: Column, success: Column, title: Column) -> Column:
    """One line on a parsed article: its figures where known, its title and how it went."""
    counts = F.when(success & extracted.isNotNull() & total.isNotNull(), F.concat_ws("/", extracted, total)).otherwise(F.lit("-/-"))
    return F.concat(F.lit("PDF "), index.cast("string"), F.lit(": "), counts, F.lit(" XRD figures | "), title, F.lit(" | "), F.when(success, "Successful").otherwise("Failed"))


def output_folder(source: str, is_file: bool, stem: str, chosen: str | None = None) -> str:
    """Where a job writes: the chosen folder, or one named by default; of a batch a folder per article in it."""
    if is_file:
        return chosen or "parsed_output"
    return f"{chosen or 'grobid_output/' + source.rstrip('/').rsplit('/', 1)[-1]}/{stem}"


# Files of a run.


def figure_files(curves: DataFrame, calibration: DataFrame, contexts: DataFrame | None = None) -> DataFrame:
    """(figure_id, name, content) of the files that each figure's folder holds: its table of curves, its plot, peaks, calibration
    and description. A figure's curves, a handful, are gathered in its row."""
    one = curves.where("error is null").groupBy("figure_id").agg(
        F.sort_array(F.collect_list(F.struct("curve", "curve_id", "color", "x", "y", "peaks", "warnings"))).alias("curves")
    )
    rows = one.join(calibration.withColumnRenamed("warnings", "axis_warnings"), "figure_id", "left")
    if contexts is not None:
        rows = rows.join(contexts, "figure_id", "left")
    listed = F.transform("curves", lambda c: F.struct(c["curve_id"].alias("curve_id"), c["color"].alias("color"), F.size(c["peaks"]).alias("num_peaks"), c["peaks"].alias("peaks"), c["warnings"].alias("warnings")))
    plain = F.transform("curves", lambda c: F.struct(c["curve_id"].alias("curve_id"), c["color"].alias("color"), c["warnings"].alias("warnings")))
    axis = F.struct("method", "x_min", "x_max", "y_min", "y_max", F.col("x_confidence").alias("confidence"), F.col("x_ticks").alias("tick_pairs"))
    told = [c for c in ("caption", "source_pdf", "page", "image_path") if contexts is not None and c in contexts.columns]
    kept = {"ignoreNullFields": "false"}
    rows = rows.select(
        "figure_id",
        "curves",
        F.struct("y_reliable", "y_min", "y_max").alias("axis"),
        F.to_json(F.struct("figure_id", F.size("curves").alias("num_curves"), listed.alias("curves")), kept).alias("peaks"),
        F.to_json(F.struct("figure_id", axis.alias("calibration"), plain.alias("curves"), F.col("axis_warnings").alias("warnings")), kept).alias("panel"),
        F.to_json(F.struct("figure_id", *told, F.flatten(F.transform("curves", lambda c: c["warnings"])).alias("warnings")), kept).alias("metadata"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = [(np.array(c["x"] or [], float), np.array(c["y"] or [], float), c["color"]) for c in row["curves"]]
                axis = row["axis"]
                limits = P.axis_texts(bool(axis["y_reliable"]), axis["y_min"], axis["y_max"])[2:]
                stem = row["figure_id"]
                files = {
                    f"{stem}_digitized.xy": wide_text([(x, y) for x, y, _ in found if len(x)]).encode(),
                    f"{stem}_digitized.png": P.png(found, y_limits=limits),
                    f"{stem}.peaks.json": row["peaks"].encode(),
                    f"{stem}.json": row["panel"].encode(),
                    f"{stem}.metadata.json": row["metadata"].encode(),
                }
                yield pa.RecordBatch.from_arrays([pa.array([stem] * len(files)), pa.array(list(files)), pa.array(list(files.values()), pa.binary())], ["figure_id", "name", "content"])

    return rows.mapInArrow(run, "figure_id string, name string, content binary")


def wide_text(curves: Sequence[tuple[np.ndarray, np.ndarray]]) -> str:
    """x and a column of y per curve, `nan` outside a curve's range."""
    if not curves:
        return "# two_theta\n"
    grid = curves[0][0] if len(curves) == 1 else np.unique(np.concatenate([x for x, _ in curves]))
    columns = [np.interp(grid, x, y, np.nan, np.nan) if len(curves) > 1 else y for x, y in curves]
    head = "# two_theta " + " ".join(f"curve_{k}" for k in range(1, len(curves) + 1))
    return "\n".join([head, *(" ".join(f"{v:.6g}" for v in line) for line in zip(grid, *columns))]) + "\n"


def write_files(files: DataFrame, out: str, folder: str = "figure_id") -> DataFrame:
    """Write files(folder, name, content) as out/<folder>/<name>; returns folder, name and bytes of each, staged by the caller.

    Each file is written under a temporary name of its own and moved into place, so that a task that runs twice leaves one file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        fs, root = pyarrow.fs.FileSystem.from_uri(out)
        for batch in batches:
            names, parents = batch.column(1).to_pylist(), batch.column(0).to_pylist()
            sizes = []
            for parent, name, content in zip(parents, names, batch.column(2).to_pylist()):
                fs.create_dir(f"{root}/{parent}", recursive=True)
                temp = f"{root}/{parent}/.{uuid.uuid4().hex}"
                with fs.open_output_stream(temp) as sink:
                    sink.write(content)
                fs.move(temp, f"{root}/{parent}/{name}")
                sizes.append(len(content))
            yield pa.RecordBatch.from_arrays([pa.array(parents, pa.string()), pa.array(names, pa.string()), pa.array(sizes, pa.int64())], ["folder", "name", "bytes"])

    return files.select(F.col(folder).cast("string").alias("folder"), "name", "content").mapInArrow(run, "folder string, name string, bytes bigint")


def remove_stale(spark: SparkSession, out: str, written: DataFrame) -> int:
    """Removes from the folders of written(folder, name) what an earlier run has left under the names of a run; returns how many.

    A task lists and clears the folders of its own rows.
    """
    kept = written.groupBy("folder").agg(F.collect_set("name").alias("names"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        fs, root = pyarrow.fs.FileSystem.from_uri(out)
        for batch in batches:
            gone = 0
            for row in batch.to_pylist():
                ours = re.compile(rf"{re.escape(row['folder'])}(?:[_.].*)?\.(?:xy|csv|png|json)$")
                for f in fs.get_file_info(pyarrow.fs.FileSelector(f"{root}/{row['folder']}", allow_not_found=True)):
                    if f.is_file and ours.match(f.base_name) and f.base_name not in row["names"] and f.base_name != f"{row['folder']}.png":
                        fs.delete_file(f.path)
                        gone += 1
            yield pa.RecordBatch.from_arrays([pa.array([gone], pa.int64())], ["n"])

    return kept.mapInArrow(run, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def save_run(curves: DataFrame, calibration: DataFrame, out: str, contexts: DataFrame | None = None) -> DataFrame:
    """Writes each figure's files under out/<figure_id>/ and clears what earlier runs left there; returns folder, name, bytes."""
    spark = curves.sparkSession
    written = write_files(figure_files(curves, calibration, contexts), out).checkpoint()
    remove_stale(spark, out, written)
    return written


def drawn(points: DataFrame, curve: Sequence[str], color: str | None = None, size: tuple[int, int] = (480, 800)) -> DataFrame:
    """(curve, name, content) with a PNG of each plot of points(curve, x, y): a plot's points are gathered in its row."""
    shown = F.col(color) if color else F.lit(None).cast("string")
    packed = points.groupBy(*curve).agg(F.sort_array(F.collect_list(F.struct("x", "y"))).alias("p"), F.any_value(shown).alias("color"))
    kinds = dict(points.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pngs = [P.png([(np.array([q["x"] for q in p]), np.array([q["y"] for q in p]), c)], size) for p, c in zip(batch.column(len(curve)).to_pylist(), batch.column(len(curve) + 1).to_pylist())]
            names = ["_".join(str(v) for v in key) + ".png" for key in zip(*(batch.column(k).to_pylist() for k in range(len(curve))))]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(curve))), pa.array(names), pa.array(pngs, pa.binary())], [*curve, "name", "content"])

    return packed.mapInArrow(run, ", ".join([*(f"{c} {kinds[c]}" for c in curve), "name string", "content binary"]))


def overlays(truth: DataFrame, other: DataFrame, curve: Sequence[str], size: tuple[int, int] = (480, 800)) -> DataFrame:
    """(curve, name, content): each curve's truth in black and its digitized form in red, both scaled to 0..1."""
    sides = [df.select(*curve, F.lit(k).alias("side"), "x", "y") for k, df in enumerate((truth, other))]
    both = sides[0].unionByName(sides[1])
    packed = both.groupBy(*curve).agg(F.sort_array(F.collect_list(F.struct("side", "x", "y"))).alias("p"))
    kinds = dict(truth.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pngs = []
            for p in batch.column(len(curve)).to_pylist():
                shown = []
                for side, colour in ((0, "black"), (1, "red")):
                    x, y = (np.array([q[c] for q in p if q["side"] == side], float) for c in ("x", "y"))
                    wide = np.ptp(y) if len(y) else 0.0
                    shown.append((x, (y - y.min()) / wide if wide > 0 else np.zeros(len(y)), colour))
                pngs.append(P.png(shown, size, (0.0, 1.05)))
            names = ["_".join(str(v) for v in key) + "_overlay.png" for key in zip(*(batch.column(k).to_pylist() for k in range(len(curve))))]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(curve))), pa.array(names), pa.array(pngs, pa.binary())], [*curve, "name", "content"])

    return packed.mapInArrow(run, ", ".join([*(f"{c} {kinds[c]}" for c in curve), "name string", "content binary"]))


def prepared_pictures(images: DataFrame, analysed: DataFrame | None = None) -> DataFrame:
    """figure_id, source, remove_grid, invert, content: the pictures that an outside digitizer is tried on, in order of `attempt`."""
    rows = images.select("figure_id", "height", "width", "nChannels", "data")
    box = "struct<left:int,top:int,right:int,bottom:int>"
    if analysed is not None:
        rows = rows.join(analysed.select("figure_id", "box", "frame"), "figure_id", "left")
    else:
        rows = rows.select("*", F.lit(None).cast(box).alias("box"), F.lit(None).cast(box).alias("frame"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.to_dict("records"):
                where = None
                if row["box"] is not None and row["frame"] is not None:
                    corner, f = row["box"], row["frame"]
                    where = M.whole_frame((f["left"], f["top"], f["right"], f["bottom"]), (corner["left"], corner["top"]))
                made = [(row["figure_id"], k, grid, inverted, I.png(p)) for k, (p, grid, inverted) in enumerate(M.attempts(figures.decode(row), where))]
                yield pd.DataFrame(made, columns=["figure_id", "attempt", "remove_grid", "invert", "content"])

    return rows.mapInPandas(run, "figure_id string, attempt int, remove_grid boolean, invert boolean, content binary")


def debug_pictures(images: DataFrame, analysed: DataFrame) -> DataFrame:
    """(figure_id, name, content): the plot box and frame on the picture, the plot alone, what could be curve, and what text took."""
    both = images.select("figure_id", "height", "width", "nChannels", "data").join(analysed.where("error is null").select("figure_id", "box", "frame"), "figure_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.to_dict("records"):
                img, b, f = figures.decode(row).copy(), row["box"], row["frame"]
                inner = img[b["top"] + f["top"] : b["top"] + f["bottom"], b["left"] + f["left"] : b["left"] + f["right"]].copy()
                shown = img.copy()
                for x0, y0, x1, y1, colour in ((b["left"], b["top"], b["right"] - 1, b["bottom"] - 1, (0, 0, 255)), (b["left"] + f["left"], b["top"] + f["top"], b["left"] + f["right"] - 1, b["top"] + f["bottom"] - 1, (0, 160, 0))):
                    shown[[y0, y1], x0 : x1 + 1] = colour
                    shown[y0 : y1 + 1, [x0, x1]] = colour
                score, candidates, _ = I.score_map(inner, np.ones(inner.shape[:2], bool))
                del score
                kept = I.without_text(candidates)
                gray = lambda m: np.repeat(np.where(m, 0, 255).astype(np.uint8)[..., None], 3, 2)
                made = {"overlay": shown, "roi": inner, "candidates": gray(kept), "rejected": gray(candidates & ~kept)}
                yield pd.DataFrame([(row["figure_id"], f"{row['figure_id']}.{k}.png", I.png(v)) for k, v in made.items()], columns=["figure_id", "name", "content"])

    return both.mapInPandas(run, "figure_id string, name string, content binary")


def y_anchor_rows(analysed: DataFrame, readings: DataFrame, highest: float = 1e6) -> DataFrame:
    """figure_id, row_bottom, row_top: the rows of y = 0 and of the highest y tick, the frame's where no line fits the readings."""
    ticks = readings.where("axis = 'y'").where(F.col("value").between(0, highest)).groupBy("figure_id", "px").agg(F.min("value").alias("value"))
    line = ticks.groupBy("figure_id").agg(F.regr_slope("value", "px").alias("a"), F.regr_intercept("value", "px").alias("b"), F.max("value").alias("top"), F.count("*").alias("n"))
    rows = analysed.select("figure_id", "frame").join(line, "figure_id", "left")
    fits = (F.col("n") >= 2) & (F.abs("a") > 1e-12)
    at = lambda value: F.rint((value - F.col("b")) / F.col("a")).cast("int")
    low = F.when(fits, at(F.lit(0.0))).otherwise(F.col("frame.bottom"))
    high = F.when(fits, at(F.col("top"))).otherwise(F.col("frame.top"))
    sane = high < low
    return rows.select("figure_id", F.when(sane, low).otherwise(F.col("frame.bottom")).alias("row_bottom"), F.when(sane, high).otherwise(F.col("frame.top")).alias("row_top"))
