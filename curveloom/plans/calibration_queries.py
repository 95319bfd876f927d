"""Queries of calibration and relational filters on ticks, boxes and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from curveloom.operators import calibration as K
from curveloom.operators import curves as C
from curveloom.operators import geometry as G
from curveloom.operators import hooks
from curveloom.plans.registry import query
from curveloom.plans.tables import DAILY_POINTS, USER_POINTS, daily_points, table, user_points
from curveloom.sources import curves as IO

#: One picture per supplier: a frame and axes that depend on its key.
FRAMES = "SELECT s_suppkey AS figure_id, 40 + s_suppkey % 30 AS plot_left, 600 + s_suppkey % 50 AS plot_right, 20 + s_suppkey % 10 AS plot_top, 400 + s_suppkey % 40 AS plot_bottom, 480 AS image_height, 5.0::DOUBLE + s_suppkey % 5 AS x_min, 80.0::DOUBLE + s_suppkey % 7 AS x_max, 100.0::DOUBLE + s_suppkey % 400 AS y_scale FROM supplier"


def frames(spark, sf_dir):
    k = F.col("s_suppkey")
    i = lambda a, m: (k % m + a).cast("int")
    d = lambda a, m: (k % m).cast("double") + a
    return table(spark, sf_dir, "supplier").select(
        k.alias("figure_id"), i(40, 30).alias("plot_left"), i(600, 50).alias("plot_right"), i(20, 10).alias("plot_top"), i(400, 40).alias("plot_bottom"), F.lit(480).alias("image_height"),
        d(5.0, 5).alias("x_min"), d(80.0, 7).alias("x_max"), d(100.0, 400).alias("y_scale"),
    )


LINES = f"""f AS ({FRAMES}), p AS (SELECT figure_id, x_min, x_max, y_scale, unnest([plot_left, plot_right, plot_left + 1]) AS col, unnest([480 - plot_bottom, 480 - plot_bottom, 480 - plot_top]) AS row,
unnest([0.0, greatest(x_max - x_min, 1.0), 0.0]::DOUBLE[]) AS dx, unnest([0.0, 0.0, y_scale]::DOUBLE[]) AS dy, unnest([1, 2, 3]) AS k FROM f),
l AS (SELECT figure_id, any_value(x_min) AS x_min, any_value(x_max) AS x_max, any_value(y_scale) AS y_scale, regr_intercept(dx, col) AS xi, regr_slope(dx, col) AS xs, regr_intercept(dy, row) AS yi, regr_slope(dy, row) AS ys,
max(CASE WHEN k = 1 THEN col END) AS c1, max(CASE WHEN k = 2 THEN col END) AS c2 FROM p GROUP BY 1),
r AS (SELECT *, least(-(c1 - xs) / xi, -(c2 - xs) / xi) AS lo, greatest(-(c1 - xs) / xi, -(c2 - xs) / xi) AS hi FROM l)"""


@query("anchor_lines", f"WITH {LINES} SELECT figure_id, round(xi, 6) AS x_intercept, round(xs, 8) AS x_slope, round(yi, 6) AS y_intercept, round(ys, 8) AS y_slope, round(lo, 6) AS raw_lo, round(hi, 6) AS raw_hi FROM r")
def anchor_lines(spark, sf_dir):
    b = K.build(frames(spark, sf_dir)).withColumn("l", K.axis_lines(F.col("locations"), F.col("data_points")))
    r = lambda c, n: F.round(c, n)
    return b.select("figure_id", r("l.x_intercept", 6).alias("x_intercept"), r("l.x_slope", 8).alias("x_slope"), r("l.y_intercept", 6).alias("y_intercept"), r("l.y_slope", 8).alias("y_slope"), r("x_raw.lo", 6).alias("raw_lo"), r("x_raw.hi", 6).alias("raw_hi"))


@query("corrected_points", f"""WITH {LINES}, q AS (SELECT l_suppkey AS figure_id, l_quantity AS x, l_extendedprice AS y FROM lineitem), m AS (SELECT q.*, min(y) OVER w AS a, max(y) OVER w AS b FROM q WINDOW w AS (PARTITION BY figure_id))
SELECT m.figure_id, round(x_min + (x - lo) / (hi - lo) * (x_max - x_min), 5) AS x, round(greatest(CASE WHEN abs(b - a) < 1e-12 THEN 0 ELSE (y - a) / (b - a) * y_scale END, 0), 5) AS y FROM m JOIN r ON r.figure_id = m.figure_id""")
def corrected_points(spark, sf_dir):
    """Line items as raw digitizer output, on their suppliers' axes."""
    raw = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("figure_id"), F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"))
    return K.correct(raw, K.build(frames(spark, sf_dir))).select("figure_id", F.round("x", 5).alias("x"), F.round("y", 5).alias("y"))


@query("anchor_positions", f"""WITH f AS ({FRAMES}) SELECT figure_id, 480 - plot_bottom AS row_low, 480 - plot_top AS row_high, plot_left + 1 AS col_high,
CASE WHEN plot_bottom - plot_top - 6 >= 8 AND plot_right - plot_left - 6 >= 8 THEN plot_left + 3 ELSE plot_left END AS inner_left,
CASE WHEN plot_bottom - plot_top < 420 THEN greatest(0, least(480, greatest(0, CAST(floor((plot_top + plot_bottom) / 2) AS BIGINT) - 210) + 420) - 420) ELSE plot_top END AS grown_top FROM f""")
def anchor_positions(spark, sf_dir):
    f = K.build(frames(spark, sf_dir))
    box = F.struct(F.col("plot_left").alias("left"), F.col("plot_top").alias("top"), F.col("plot_right").alias("right"), F.col("plot_bottom").alias("bottom"))
    top, _ = G.grow_band(F.col("plot_top"), F.col("plot_bottom"), F.col("image_height"), 420)
    at = lambda k, c: F.get("locations", F.lit(k))[c].cast("bigint")
    return f.select("figure_id", at(0, "row").alias("row_low"), at(2, "row").alias("row_high"), at(2, "col").alias("col_high"), G.inset(box, 3)["left"].cast("bigint").alias("inner_left"), top.cast("bigint").alias("grown_top"))


@query("panel_axes", f"""WITH f AS ({FRAMES}) SELECT figure_id, p AS panel, round(0.1 * (plot_left + p * 10) + x_min, 6) AS x_min, round(0.1 * (plot_right + p * 10) + x_min, 6) AS x_max FROM f CROSS JOIN range(2) t(p)""")
def panel_axes(spark, sf_dir):
    f = frames(spark, sf_dir)
    axis = f.select("figure_id", F.lit(0.1).alias("slope"), F.col("x_min").alias("intercept"))
    panels = f.select("figure_id", F.explode(F.array(F.lit(0).cast("bigint"), F.lit(1).cast("bigint"))).alias("panel"), F.col("plot_left").alias("left"), F.col("plot_right").alias("right")).withColumn("dx", F.col("panel") * 10)
    return K.panel_axis(axis, panels).select("figure_id", "panel", F.round("x_min", 6).alias("x_min"), F.round("x_max", 6).alias("x_max"))


@query("reliable_axes", """WITH o AS (SELECT o_custkey AS figure_id, CAST(o_orderkey % 7 AS INTEGER) AS px, o_totalprice AS v FROM orders)
SELECT figure_id, min(v) >= 0 AND max(v) > min(v) AND max(v) <= 200000 AND max(v) - min(v) >= CASE WHEN max(v) <= 1.5 THEN 0.05 ELSE 1 END AND count(DISTINCT px) >= 2 AND count(DISTINCT v) >= 2 AS reliable,
round(CASE WHEN min(v) >= 0 AND max(v) > min(v) AND max(v) <= 200000 AND max(v) - min(v) >= 1 AND count(DISTINCT px) >= 2 THEN max(v) - min(v) ELSE 500 END, 6) AS y_scale FROM o GROUP BY 1""")
def reliable_axes(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("figure_id"), (F.col("o_orderkey") % 7).cast("int").alias("px"), F.col("o_totalprice").alias("value"))
    g = o.groupBy("figure_id").agg(F.collect_list(F.struct("px", "value")).alias("t"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    r = K.reliable_y(F.col("lo"), F.col("hi"), F.col("t"))
    return g.select("figure_id", r.alias("reliable"), F.round(K.y_scale(r, F.col("lo"), F.col("hi"), F.lit(None).cast("double")), 6).alias("y_scale"))


@query("tick_label_boxes", f"""WITH f AS ({FRAMES}) SELECT figure_id, CAST(greatest(0, plot_left - 14) AS BIGINT) AS "left", CAST(least(640, plot_left + 14) AS BIGINT) AS "right", 452::BIGINT AS top FROM f""")
def tick_label_boxes(spark, sf_dir):
    f = frames(spark, sf_dir).withColumn("t", F.array(F.struct(F.col("plot_left").alias("px"), F.lit(10.0).alias("value"))))
    b = F.get(K.tick_boxes(F.col("t"), "x", F.col("image_height"), F.lit(640)), F.lit(0))
    return f.select("figure_id", b["left"].cast("bigint").alias("left"), b["right"].cast("bigint").alias("right"), b["top"].cast("bigint").alias("top"))


@query("best_attempts", f"""WITH p AS ({USER_POINTS}), a AS (SELECT curve, curve % 10 AS band, 100.0 * count(DISTINCT round_even(y, 1)) + 0.01 * count(*) - 0.5 * greatest(count(*) - 900, 0) + 10.0 * (max(y) - min(y)) AS score FROM p GROUP BY 1)
SELECT band, arg_max(curve, score) AS best, round(max(score), 4) AS score, count(*) AS attempts FROM a GROUP BY 1""")
def best_attempts(spark, sf_dir):
    """The best of several extractions of one band, by score."""
    s = C.attempt_score(user_points(spark, sf_dir), ["curve"], F.lit(500.0)).withColumn("band", F.col("curve") % 10)
    return s.groupBy("band").agg(F.max_by("curve", "score").alias("best"), F.round(F.max("score"), 4).alias("score"), F.count("*").alias("attempts"))


@query("left_edge_peaks", f"""WITH d AS ({DAILY_POINTS}), m AS (SELECT curve, x, y, min(x) OVER w AS a, max(x) OVER w AS b, max(y) OVER w AS top FROM d WINDOW w AS (PARTITION BY curve)),
k AS (SELECT *, x > a + 0.06 * (b - a) OR y >= 0.4 * top AS keep FROM m), n AS (SELECT *, count(*) FILTER (keep) OVER (PARTITION BY curve) AS kept FROM k) SELECT curve, x, round(y, 6) AS y FROM n WHERE keep OR kept = 0""")
def left_edge_peaks(spark, sf_dir):
    """Points without low ones at the left edge, unless nothing else is left."""
    return K.drop_left_edge(daily_points(spark, sf_dir).select("curve", "x", "y"), ["curve"]).select("curve", "x", F.round("y", 6).alias("y"))


@query("profile_between", f"""WITH d AS ({DAILY_POINTS}), e AS (SELECT curve, min(x) + 5 AS l, min(x) + 12 AS r FROM d GROUP BY 1)
SELECT d.curve, count(*) AS n, round(min(y), 6) AS valley, round(avg(y), 6) AS mean FROM d JOIN e ON d.curve = e.curve AND d.x BETWEEN l AND r GROUP BY 1""")
def profile_between(spark, sf_dir):
    d = daily_points(spark, sf_dir)
    e = d.groupBy("curve").agg((F.min("x") + 5).alias("l"), (F.min("x") + 12).alias("r"))
    return K.points_between(d, e, "curve").groupBy("curve").agg(F.count("*").alias("n"), F.round(F.min("y"), 6).alias("valley"), F.round(F.avg("y"), 6).alias("mean"))


@query("wing_maxima", f"""WITH d AS ({DAILY_POINTS}), m AS (SELECT *, lag(y) OVER w AS l, lead(y) OVER w AS r FROM d WINDOW w AS (PARTITION BY curve ORDER BY x)), p AS (SELECT curve, x, y FROM m WHERE y > l AND y > r)
SELECT p.curve, p.x, round(p.y - greatest(coalesce(max(d.y) FILTER (d.x BETWEEN p.x - 4 AND p.x - 2), 0), coalesce(max(d.y) FILTER (d.x BETWEEN p.x + 2 AND p.x + 4), 0)), 6) AS above FROM p JOIN d ON p.curve = d.curve AND d.x BETWEEN p.x - 4 AND p.x + 4 GROUP BY p.curve, p.x, p.y""")
def wing_maxima(spark, sf_dir):
    """Heights of local maxima over the highest point of either wing, two to four days away."""
    d = K.height_over_wings(daily_points(spark, sf_dir).select("curve", "x", "y"), ["curve"], 2, 4)
    return C.local_maxima(d, ["curve"]).select("curve", "x", F.round("above", 6).alias("above"))


@query("running_median", f"""WITH d AS ({DAILY_POINTS}), w AS (SELECT *, list(y) OVER (PARTITION BY curve ORDER BY x ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS ys FROM d)
SELECT curve, x, round(list_median(ys), 6) AS middle FROM w""")
def running_median(spark, sf_dir):
    return K.running_median(daily_points(spark, sf_dir), ["curve"]).select("curve", "x", F.round("middle", 6).alias("middle"))


@query("value_bands", """WITH v AS (SELECT event_type, median(value) AS m FROM events GROUP BY 1), o AS (SELECT *, lag(m) OVER (ORDER BY m, event_type) AS p FROM v)
SELECT event_type, round(m, 6) AS middle, CAST(sum(CASE WHEN m - p > 2 THEN 1 ELSE 0 END) OVER (ORDER BY m, event_type) AS BIGINT) AS band FROM o""")
def value_bands(spark, sf_dir):
    """Event types chained into bands where their median values lie at most 2 apart. One row per type is ordered."""
    m = table(spark, sf_dir, "events").groupBy("event_type").agg(F.median("value").alias("m")).withColumn("all", F.lit(1))
    return K.chained_bands(m, ["all"], "m", "event_type", 2.0).select("event_type", F.round("m", 6).alias("middle"), "band")


@query("percentile_ladder", f"""WITH p AS ({USER_POINTS}) SELECT curve, {', '.join(f'round(quantile_cont(y, {q / 100}), 6) AS p{q}' for q in (3, 8, 20, 85, 92, 99))} FROM p GROUP BY 1""")
def percentile_ladder(spark, sf_dir):
    return user_points(spark, sf_dir).groupBy("curve").agg(*[F.round(F.percentile("y", F.lit(q / 100)), 6).alias(f"p{q}") for q in (3, 8, 20, 85, 92, 99)])


@query("formatted_numbers", "SELECT p_partkey, format('{:.6g}', p_retailprice) AS shown FROM part")
def formatted_numbers(spark, sf_dir):
    """Prices with six significant digits."""
    return table(spark, sf_dir, "part").select("p_partkey", IO.as_g(F.col("p_retailprice")).alias("shown"))


@query("crop_regions", """WITH b AS (SELECT l_orderkey % 50 AS doc, CAST(1 + l_linenumber % 3 AS INTEGER) AS page, l_quantity AS x, l_discount * 100 AS y, 20.0::DOUBLE AS w, 30.0::DOUBLE AS h FROM lineitem)
SELECT doc, page, greatest(0, min(x) - 12) AS x0, greatest(0, round(min(y), 6) - 8) AS y0, least(60.0::DOUBLE, max(x + w) + 8) AS x1, least(45.0::DOUBLE, round(max(y + h), 6) + 12) AS y1 FROM b GROUP BY 1, 2""")
def crop_regions(spark, sf_dir):
    c = F.col
    b = table(spark, sf_dir, "lineitem").select((c("l_orderkey") % 50).alias("doc"), (c("l_linenumber") % 3 + 1).alias("page"), c("l_quantity").alias("x"), F.round(c("l_discount") * 100, 6).alias("y"), F.lit(20.0).alias("w"), F.lit(30.0).alias("h"))
    pages = b.select("doc", "page").distinct().select("doc", "page", F.lit(60.0).alias("width"), F.lit(45.0).alias("height"))
    return G.crop_region(b, "doc", pages)


@query("parser_commands", "SELECT r_regionkey, 'success' AS status, CAST(0 AS INTEGER) AS return_code, r_name || ' ' || r_regionkey AS said FROM region")
def parser_commands(spark, sf_dir):
    """A user's command, run once per region."""
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return hooks.run_command(r, "echo {r_name} {r_regionkey}", "r_regionkey", ["r_name", "r_regionkey"]).select("r_regionkey", "status", "return_code", F.trim(F.regexp_replace("stdout", r"\s+$", "")).alias("said"))
