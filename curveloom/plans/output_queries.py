"""Queries of the mask path, of what a run leaves behind, and of the checks around it."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from curveloom.functions import plots as P
from curveloom.operators import calibration as K
from curveloom.operators import dedup as D
from curveloom.operators import figures as G
from curveloom.operators import outputs as O
from curveloom.plans.registry import query
from curveloom.plans.tables import USER_POINTS, table, user_points, values_sql

#: Drawn patterns: name, colour and the places of their peaks; the highest comes second.
DRAWN = {"pattern_1": ("blue", (20, 31, 45, 62)), "pattern_2": ("red", (24, 38, 52, 70)), "pattern_3": ("green", (16, 28, 49, 66)), "pattern_4": ("black", (22, 41, 55, 73))}
HEIGHTS = (40.0, 100.0, 60.0, 30.0)


def drawn_pattern(peaks, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    x = np.linspace(10, 80, 2000)
    y = 4 + sum(h * np.exp(-0.5 * ((x - c) / 0.25) ** 2) for c, h in zip(peaks, HEIGHTS))
    return x, y + np.random.default_rng(seed).normal(0, 1.2, len(x))


def drawn_pictures(spark):
    """The patterns as pictures and the readings of their ticks."""
    rows, readings = [], []
    for name, (colour, peaks) in DRAWN.items():
        img = P.plot([(*drawn_pattern(peaks), colour)], (480, 900))
        rows.append((name, f"/data/{name}.png", img.shape[0], img.shape[1], 3, bytearray(img.tobytes())))
        # Ticks of a plot of 900 columns: the axis runs from column 90 to 873, the crop starts three columns to the left.
        readings += [(name, "x", round(90 + (v - 10) / 70 * 783) - 87, float(v)) for v in range(20, 80, 10)]
    images = spark.createDataFrame(rows, "figure_id string, path string, height int, width int, nChannels int, data binary")
    return images, spark.createDataFrame(readings, "figure_id string, axis string, px int, value double")


MAIN = values_sql([(name, float(peaks[1])) for name, (_, peaks) in DRAWN.items()], "figure_id, place")


@query("mask_main_peaks", f"SELECT figure_id, true AS within_a_degree FROM {MAIN}")
def mask_main_peaks(spark, sf_dir):
    """Drawn plots of four colours by the mask path: whether the main peak lies within a degree of where it was drawn."""
    images, readings = drawn_pictures(spark)
    figures = G.analyse(images)
    curves = O.mask_curves(images, figures, G.calibrate(figures, readings))
    best = O.points_of(curves).groupBy("figure_id").agg(F.max_by("x", "y").alias("x"))
    true = spark.createDataFrame([(n, float(p[1])) for n, (_, p) in DRAWN.items()], "figure_id string, place double")
    return best.join(true, "figure_id").select("figure_id", (F.abs(F.col("x") - F.col("place")) < 1.0).alias("within_a_degree"))


COLOURS = values_sql([(name, None if colour == "black" else colour, "simplified_constant_width_peaks") for name, (colour, _) in DRAWN.items()], "figure_id, color, warnings")


@query("mask_curve_kinds", f"SELECT figure_id, color, warnings, 4::BIGINT AS n_peaks, 2000::BIGINT AS n_points FROM {COLOURS}")
def mask_curve_kinds(spark, sf_dir):
    images, readings = drawn_pictures(spark)
    figures = G.analyse(images)
    curves = O.mask_curves(images, figures, G.calibrate(figures, readings))
    return curves.select("figure_id", "color", F.concat_ws(",", "warnings").alias("warnings"), F.size("peaks").cast("bigint").alias("n_peaks"), F.size("x").cast("bigint").alias("n_points"))


@query("figure_folders", f"""SELECT figure_id, name FROM {MAIN}, LATERAL (SELECT unnest([figure_id || '_digitized.xy', figure_id || '_digitized.png', figure_id || '.peaks.json', figure_id || '.json', figure_id || '.metadata.json']) AS name)""")
def figure_folders(spark, sf_dir):
    """The files that a digitizing run leaves of each figure."""
    images, readings = drawn_pictures(spark)
    figures = G.analyse(images)
    axes = G.calibrate(figures, readings)
    return O.figure_files(O.mask_curves(images, figures, axes), axes, O.figure_context(images)).where("length(content) > 0").select("figure_id", "name")


@query("acceptable_curves", f"""WITH p AS ({USER_POINTS}) SELECT curve, count(y) AS n, round(max(y) - min(y), 6) AS span, count(y) >= 60 AND max(y) - min(y) >= 0.97 * 500 AS acceptable FROM p GROUP BY 1""")
def acceptable_curves(spark, sf_dir):
    """Users with enough events that reach over nearly the whole range of values."""
    a = K.acceptable(user_points(spark, sf_dir), ["curve"], F.lit(500.0), 60, 0.97)
    return a.select("curve", "n", F.round("span", 6).alias("span"), "acceptable")


KEYS = "list_value('doi:' || lower(p_brand) || p_size, 'title:' || p_name)"


@query("saved_matches", f"""WITH p AS (SELECT p_partkey, {KEYS} AS keys FROM part), s AS (SELECT p_partkey AS saved, unnest(keys) AS k FROM p WHERE p_partkey % 3 = 0),
k AS (SELECT k, min(saved) AS saved FROM s GROUP BY 1), n AS (SELECT p_partkey, unnest(keys) AS k, generate_subscripts(keys, 1) AS rank FROM p WHERE p_partkey % 3 <> 0)
SELECT n.p_partkey, arg_min(k.saved, n.rank) AS "match" FROM n JOIN k ON k.k = n.k GROUP BY 1""")
def saved_matches(spark, sf_dir):
    """Parts that a saved one shares a key with, by the first key that any has."""
    new, saved, keys = _parts(spark, sf_dir)
    return D.existing_match(new, "p_partkey", keys, saved, keys, "p_partkey")


@query("unseen_parts", f"""WITH p AS (SELECT p_partkey, {KEYS} AS keys FROM part), s AS (SELECT DISTINCT unnest(keys) AS k FROM p WHERE p_partkey % 3 = 0)
SELECT p_partkey FROM p WHERE p_partkey % 3 <> 0 AND p_partkey NOT IN (SELECT p_partkey FROM (SELECT p_partkey, unnest(keys) AS k FROM p) n WHERE n.k IN (SELECT k FROM s))""")
def unseen_parts(spark, sf_dir):
    """Parts without a key that a saved one has: the rows that a manifest's seeds leave."""
    new, saved, keys = _parts(spark, sf_dir)
    return D.unseen(new, "p_partkey", keys, saved, keys).select("p_partkey")


def _parts(spark, sf_dir):
    """New and saved parts, two thirds and one, of which the third is told by its key, and their keys."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", "p_name")
    keys = F.array(F.concat(F.lit("doi:"), F.lower("p_brand"), F.col("p_size").cast("string")), F.concat(F.lit("title:"), F.col("p_name")))
    return p.where("p_partkey % 3 <> 0"), p.where("p_partkey % 3 = 0"), keys


@query("normalized_y_axes", """WITH o AS (SELECT o_custkey AS figure_id, o_totalprice / 300000 AS v FROM orders) SELECT figure_id, min(v) >= -0.05 AND max(v) <= 1.5 AS by_range,
min(v) >= -0.05 AND max(v) <= 1.5 AS by_ticks, min(v) IS NOT NULL AND figure_id % 2 = 0 AS has_y FROM o GROUP BY 1""")
def normalized_y_axes(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("figure_id"), (F.col("o_totalprice") / 300000).alias("v"))
    g = o.groupBy("figure_id").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.collect_list(F.struct(F.lit(1).alias("px"), F.col("v").alias("value"))).alias("t"))
    none, method = F.lit(None).cast("double"), F.when(F.col("figure_id") % 2 == 0, "ocr_line").otherwise("default")
    return g.select("figure_id", K.normalized_y(F.col("lo"), F.col("hi"), F.array().cast("array<struct<px:int,value:double>>")).alias("by_range"), K.normalized_y(none, none, F.col("t")).alias("by_ticks"), K.has_y(F.col("lo"), F.col("hi"), method).alias("has_y"))


@query("y_anchors", """WITH f AS (SELECT c_custkey AS figure_id, 400 + CAST(c_custkey % 50 AS INTEGER) AS bottom FROM customer), t AS (SELECT o_custkey AS figure_id, CAST(o_orderkey % 300 AS INTEGER) AS px, min(o_totalprice) AS v FROM orders GROUP BY 1, 2),
l AS (SELECT figure_id, regr_slope(v, px) AS a, regr_intercept(v, px) AS b, max(v) AS top, count(*) AS n FROM t GROUP BY 1),
r AS (SELECT f.figure_id, bottom, CASE WHEN n >= 2 AND abs(a) > 1e-12 THEN round_even(-b / a, 0) ELSE bottom END AS lo, CASE WHEN n >= 2 AND abs(a) > 1e-12 THEN round_even((top - b) / a, 0) ELSE 20 END AS hi FROM f LEFT JOIN l USING (figure_id))
SELECT figure_id, CAST(CASE WHEN hi < lo THEN greatest(least(lo, 2147483647), -2147483648) ELSE bottom END AS INTEGER) AS row_bottom, CAST(CASE WHEN hi < lo THEN greatest(least(hi, 2147483647), -2147483648) ELSE 20 END AS INTEGER) AS row_top FROM r""")
def y_anchors(spark, sf_dir):
    """The rows of y = 0 and of the highest tick, by the line through the readings."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("figure_id"), (F.lit(400) + (F.col("c_custkey") % 50).cast("int")).alias("bottom"))
    f = c.select("figure_id", F.struct(F.lit(60).alias("left"), F.lit(20).alias("top"), F.lit(600).alias("right"), F.col("bottom")).alias("frame"))
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("figure_id"), F.lit("y").alias("axis"), (F.col("o_orderkey") % 300).cast("int").alias("px"), F.col("o_totalprice").alias("value"))
    return O.y_anchor_rows(f, o)


@query("summary_lines", """SELECT o_orderkey, 'PDF ' || o_orderkey || ': ' || CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey % 5 AS INTEGER) || '/' || 7 ELSE '-/-' END || ' XRD figures | ' || o_orderpriority || ' | ' || CASE WHEN o_orderstatus = 'F' THEN 'Successful' ELSE 'Failed' END AS line FROM orders""")
def summary_lines(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    line = O.summary_line(F.col("o_orderkey"), (F.col("o_orderkey") % 5).cast("string"), F.lit("7"), F.col("o_orderstatus") == "F", F.col("o_orderpriority"))
    return o.select("o_orderkey", line.alias("line"))


@query("pictures_left", """WITH p AS (SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'pattern_' ELSE 'figure_' END || p_partkey AS figure_id, CASE WHEN p_size % 5 = 0 THEN 'figure_1' ELSE 'in' END AS folder FROM part)
SELECT figure_id FROM p WHERE folder = 'in' AND figure_id LIKE 'pattern%' AND p_partkey % 10 <> 0""")
def pictures_left(spark, sf_dir):
    """Patterns outside of result folders that are not done."""
    name = F.concat(F.when(F.col("p_size") % 4 == 0, "pattern_").otherwise("figure_"), F.col("p_partkey"))
    p = table(spark, sf_dir, "part").select("p_partkey", name.alias("figure_id"), F.concat_ws("/", F.lit("/data"), F.when(F.col("p_size") % 5 == 0, "figure_1").otherwise("in"), F.concat(name, F.lit(".png"))).alias("path"))
    return O.pictures_to_do(p.select("figure_id", "path"), p.where("p_partkey % 10 = 0")).select("figure_id")


@query("dataset_pictures", """SELECT CAST(p_partkey AS INTEGER) AS figure, CASE p_partkey % 3 WHEN 0 THEN '/a/f' || p_partkey || '.png' WHEN 1 THEN '/base/f' || p_partkey || '.png' ELSE '/base/figures/f' || p_partkey || '.png' END AS path FROM part WHERE p_partkey % 7 <> 0""")
def dataset_pictures(spark, sf_dir):
    """Where the pictures of a figure dataset lie: as written, beside it, or in its folder of figures."""
    k = F.col("p_partkey")
    file = F.concat(F.lit("f"), k, F.lit(".png"))
    p = table(spark, sf_dir, "part")
    entries = p.select(k.cast("int").alias("figure"), F.concat(F.lit("/a/"), file).alias("figure_path"), F.lit("c").alias("caption"), F.lit("t").alias("text"))
    place = F.when(k % 3 == 0, "/a/").when(k % 3 == 1, "/base/").otherwise("/base/figures/")
    known = p.where("p_partkey % 7 <> 0").select(F.concat(place, file).alias("path"))
    return O.analysis_pictures(entries, known).select("figure", "path")


@query("label_keys", "SELECT p_partkey, CASE WHEN p_size / 20.0::DOUBLE <= 1.5 THEN round_even(p_size / 20.0::DOUBLE, 3) ELSE round_even(p_size / 20.0::DOUBLE, 0) END AS key FROM part")
def label_keys(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", K.label_keys(F.col("p_size") / F.lit(20.0)).alias("key"))


@query("outcomes", "SELECT CASE p_size % 3 WHEN 0 THEN 'failed' WHEN 1 THEN 'empty' ELSE 'success' END AS status, count(*) AS n FROM part GROUP BY 1")
def outcomes(spark, sf_dir):
    size = F.col("p_size") % 3
    c = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("figure_id"), F.when(size == 0, "bad").alias("error"), F.when(size == 2, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>")).alias("x"))
    return O.outcome_counts(c)
