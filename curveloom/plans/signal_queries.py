"""Queries of peak, tick, path and picture kernels. SQL can't express them; tests hold them against brute force."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from curveloom.functions import images as I
from curveloom.functions import signal as S
from curveloom.functions import ticks as T
from curveloom.operators import curves as C
from curveloom.operators import figures as G
from curveloom.plans.registry import query
from curveloom.plans.tables import daily_points, table, user_points, values_sql

TICK_SETS = {
    "ghost": [(114, 5), (630, 10), (1146, 15), (1662, 20), (2178, 25), (2694, 30), (2280, 7)],
    "gap": [(100, 10), (200, 20), (400, 40), (500, 50)],
    "unit": [(10, 1.0), (20, 0.8), (30, 0.6), (40, 0.4), (50, 0.2), (60, 0.0)],
    "counts": [(10, 500), (60, 400), (110, 300), (160, 2), (210, 100)],
}


def tick_rows(spark):
    return spark.createDataFrame([(k, i, int(p), float(v)) for k, ts in TICK_SETS.items() for i, (p, v) in enumerate(ts)], "axis string, i int, px int, value double")


def _per_axis(spark, use):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        out = use(list(zip(pdf["px"], pdf["value"])))
        return pd.DataFrame({"axis": key[0], "k": range(len(out)), "px": [int(p) for p, _ in out], "value": [float(v) for _, v in out]})

    return tick_rows(spark).groupBy("axis").applyInPandas(run, "axis string, k int, px int, value double")


@query("tick_chain")
def tick_chain(spark, sf_dir):
    """Raw readings through the whole chain: conflicts, monotony, outliers, repair, snap, fill, extrapolation."""
    return _per_axis(spark, lambda t: T.x_ticks(t, 2700))


@query("tick_filter_y")
def tick_filter_y(spark, sf_dir):
    return _per_axis(spark, T.filter_y)


@query("tick_axes")
def tick_axes(spark, sf_dir):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        t = list(zip(pdf["px"], pdf["value"]))
        x, y = T.x_axis(t, 0, 2700), T.y_axis(t, 0, 300)
        return pd.DataFrame([{"axis": key[0], "x_min": x["x_min"], "x_max": x["x_max"], "method": x["method"], "y_min": y and y["y_min"], "y_max": y and y["y_max"], "top_label": T.highest_label(t, None), "step": T.snap_step([v for _, v in t])}])

    return tick_rows(spark).groupBy("axis").applyInPandas(run, "axis string, x_min double, x_max double, method string, y_min double, y_max double, top_label double, step double")


TICK_VALUES = [(k, float(p), float(v)) for k, ts in TICK_SETS.items() for p, v in ts]


@query("tick_regression", f"""SELECT axis, round(regr_slope(v, px), 8) AS slope, round(regr_intercept(v, px), 6) AS intercept,
round(sqrt(greatest(regr_syy(v, px) - regr_sxy(v, px) * regr_sxy(v, px) / regr_sxx(v, px), 0) / count(*)), 6) AS rmse,
coalesce(min(v) >= -0.05 AND max(v) <= 1.5 AND count(*) >= 2, false) AS unit FROM {values_sql(TICK_VALUES, 'axis, px, v')} GROUP BY 1""")
def tick_regression(spark, sf_dir):
    fit = C.linear_fit(tick_rows(spark), ["axis"], "px", "value")
    unit = tick_rows(spark).groupBy("axis").agg(((F.min("value") >= -0.05) & (F.max("value") <= 1.5) & (F.count("*") >= 2)).alias("unit"))
    return fit.join(unit, "axis").select("axis", F.round("slope", 8).alias("slope"), F.round("intercept", 6).alias("intercept"), F.round("rmse", 6).alias("rmse"), "unit")


@query("tick_rising", f"""WITH t AS (SELECT * FROM {values_sql(TICK_VALUES, 'axis, px, v')}), m AS (SELECT *, max(v) OVER (PARTITION BY axis ORDER BY px ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM t)
SELECT axis, CAST(px AS DOUBLE) AS px, CAST(v AS DOUBLE) AS v FROM m WHERE seen IS NULL OR v > seen + 1e-6""")
def tick_rising(spark, sf_dir):
    """The greedy rule as a running maximum."""
    from pyspark.sql import Window as W

    seen = F.max("value").over(W.partitionBy("axis").orderBy("px").rowsBetween(W.unboundedPreceding, -1))
    return tick_rows(spark).withColumn("seen", seen).where("seen is null or value > seen + 1e-6").select("axis", F.col("px").cast("double").alias("px"), F.col("value").alias("v"))


@query("user_peaks")
def user_peaks(spark, sf_dir):
    """Major peaks of every user's curve, heights as percent of the highest."""
    from pyspark.sql import Window as W

    p = user_points(spark, sf_dir).withColumn("x", F.col("x") - F.min("x").over(W.partitionBy("curve")))
    peaks = G.peaks_percent(G.peaks_of(p, ["curve"]))
    return peaks.select("curve", F.posexplode("peaks").alias("k", "p")).select("curve", "k", F.round("p.two_theta", 6).alias("x"), F.round("p.relative_intensity", 4).alias("percent"))


@query("traced_peaks")
def traced_peaks(spark, sf_dir):
    peaks = G.peaks_of(user_points(spark, sf_dir), ["curve"], "traced")
    return peaks.select("curve", F.posexplode("peaks").alias("k", "p")).select("curve", "k", F.round("p.two_theta", 6).alias("x"), F.round("p.relative_intensity", 4).alias("y"), F.round("p.prominence", 4).alias("prominence"))


@query("peak_reconstruction")
def peak_reconstruction(spark, sf_dir):
    """Each event type's daily curve as equal-width peaks, read at 60 steps, and its divergence from the curve."""
    d = daily_points(spark, sf_dir).select("curve", "x", "y")
    peaks = G.peaks_of(d, ["curve"]).select("curve", F.explode("peaks").alias("p")).select("curve", F.col("p.two_theta").alias("x"), F.col("p.relative_intensity").alias("height"))
    rebuilt = C.gaussian_sum(peaks, C.uniform_grid(d, ["curve"], 60), ["curve"], fwhm=2.0)
    out = C.compare_curves(d, rebuilt, ["curve"])
    return out.select("curve", *[F.round(c, 6).alias(c) for c in ("forward", "reverse", "divergence")], "n")


@query("event_paths")
def event_paths(spark, sf_dir):
    """The best way through each event type's map of values by day: one of 40 rows per day."""
    e = table(spark, sf_dir, "events").select("event_type", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(86400000000.0)).alias("day"), F.least(F.floor(F.col("value") / 12.5), F.lit(39)).alias("row"))
    cells = e.groupBy("event_type", "day", "row").agg(F.count("*").alias("n"))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        first = int(pdf["day"].min())
        score = np.zeros((40, int(pdf["day"].max()) - first + 1))
        score[pdf["row"].to_numpy(int), pdf["day"].to_numpy(int) - first] = pdf["n"]
        path = S.best_path(score / score.max())
        return pd.DataFrame({"event_type": key[0], "day": first + np.arange(len(path)), "row": path})

    return cells.groupBy("event_type").applyInPandas(run, "event_type string, day bigint, row double")


def sample_pictures(spark):
    """Two drawn plots as the image source gives them."""
    rows = []
    for name, peaks in (("pattern_0", (20.0, 35.0, 50.0)), ("pattern_1", (28.0, 47.0, 62.0))):
        x = np.linspace(5, 80, 2000)
        img = I.draw_curves([(x, S.gaussians([(p, h, 0.0) for p, h in zip(peaks, (100.0, 60.0, 40.0))], x, 1.2))])
        rows.append((name, img.shape[0], img.shape[1], 3, bytearray(img.tobytes())))
    return spark.createDataFrame(rows, "figure_id string, height int, width int, nChannels int, data binary")


def sample_readings(spark):
    return spark.createDataFrame([(f"pattern_{k}", "x", int(6 + (v - 5) / 75 * 690), float(v)) for k in (0, 1) for v in range(10, 80, 10)], "figure_id string, axis string, px int, value double")


@query("picture_analysis")
def picture_analysis(spark, sf_dir):
    a = G.analyse(sample_pictures(spark))
    return a.select("figure_id", "error", F.to_json("box").alias("box"), F.to_json("frame").alias("frame"), "score", "layout", "dark", "grid", F.size("bands").alias("bands"))


@query("picture_pixels")
def picture_pixels(spark, sf_dir):
    """Column tops and row counts of pictures as tables of pixels."""
    pixels = G.pixel_rows(sample_pictures(spark))
    tops = G.column_tops(pixels).groupBy("figure_id").agg(F.count("*").alias("columns"), F.min("top").alias("top"))
    return tops.join(G.row_occupancy(pixels).groupBy("figure_id").agg(F.sum("n").alias("busy")), "figure_id")


@query("picture_peaks")
def picture_peaks(spark, sf_dir):
    """Drawn plots through cropping, calibration, tracing and peak finding."""
    images = sample_pictures(spark)
    figures = G.analyse(images)
    points = G.calibrated_points(G.trace_curves(images, figures).where("ok"), figures, G.calibrate(figures, sample_readings(spark)))
    peaks = G.peaks_percent(G.peaks_of(points, ["figure_id", "band"]))
    return peaks.select("figure_id", "band", F.posexplode("peaks").alias("k", "p")).select("figure_id", "band", "k", F.round("p.two_theta", 3).alias("x"), F.round("p.relative_intensity", 2).alias("percent"))
