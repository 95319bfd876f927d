"""Queries of curve operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from curveloom.operators import curves as C
from curveloom.plans.registry import query
from curveloom.plans.tables import DAILY_POINTS, USER_POINTS, daily_points, day, table, user_points

SID_SQL = """
sums AS (SELECT {k}, p, q, p / sum(p) OVER w AS p1, q / sum(q) OVER w AS q1 FROM pairs WINDOW w AS (PARTITION BY {k})),
floors AS (SELECT {k}, greatest(p1, 1e-12) AS p1, greatest(q1, 1e-12) AS q1 FROM sums),
again AS (SELECT {k}, p1 / sum(p1) OVER w AS p1, q1 / sum(q1) OVER w AS q1 FROM floors WINDOW w AS (PARTITION BY {k})),
sid AS (SELECT {k}, round(sum(p1 * ln(p1 / q1)), 6) AS forward, round(sum(q1 * ln(q1 / p1)), 6) AS reverse,
  round(sum(p1 * ln(p1 / q1)) + sum(q1 * ln(q1 / p1)), 6) AS divergence, count(*) AS n FROM again GROUP BY {k})"""


def _rounded(df, *names, places=6):
    return df.withColumns({c: F.round(c, places) for c in names})


def _daily_means(spark, sf_dir):
    """curve, x (whole day), y of the users' events; means near a half round by the last bit of their sum."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("curve"), F.floor(day("ts")).cast("double").alias("x"), "event_id", F.col("value").alias("y"))
    return C.mean_in_order(e, ["curve", "x"], "event_id")


@query("sid_event_types", f"""WITH d AS ({DAILY_POINTS}),
pairs AS (SELECT l.curve AS a, r.curve AS b, l.y AS p, r.y AS q FROM d l JOIN d r ON l.x = r.x AND l.curve < r.curve),
{SID_SQL.format(k='a, b')} SELECT * FROM sid""")
def sid_event_types(spark, sf_dir):
    """Divergence between the daily spectra of every two event types."""
    d = daily_points(spark, sf_dir)
    left, right = d.select("x", F.col("curve").alias("a"), F.col("y").alias("p")), d.select("x", F.col("curve").alias("b"), F.col("y").alias("q"))
    return _rounded(C.spectral_divergence(left.join(right, "x").where("a < b"), ["a", "b"]), "forward", "reverse", "divergence")


@query("sid_label_spectra", f"""WITH e AS (SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS x FROM embeddings WHERE label IS NOT NULL),
d AS (SELECT label, x, avg(abs(v::DOUBLE)) AS y FROM e GROUP BY 1, 2),
pairs AS (SELECT l.label AS a, r.label AS b, l.y AS p, r.y AS q FROM d l JOIN d r ON l.x = r.x AND l.label < r.label),
{SID_SQL.format(k='a, b')} SELECT * FROM sid""")
def sid_label_spectra(spark, sf_dir):
    """Divergence between the mean absolute vectors of every two labels."""
    v = table(spark, sf_dir, "embeddings").where("label is not null").select("label", F.posexplode("embedding").alias("x", "v"))
    d = v.groupBy("label", "x").agg(F.avg(F.abs(F.col("v").cast("double"))).alias("y"))
    left, right = d.select("x", F.col("label").alias("a"), F.col("y").alias("p")), d.select("x", F.col("label").alias("b"), F.col("y").alias("q"))
    return _rounded(C.spectral_divergence(left.join(right, "x").where("a < b"), ["a", "b"]), "forward", "reverse", "divergence")


@query("normalize_curves", f"""WITH p AS ({USER_POINTS}), s AS (SELECT *, min(y) OVER w AS lo, max(y) OVER w AS hi, quantile_cont(y, 0.99) OVER w AS p99 FROM p WINDOW w AS (PARTITION BY curve))
SELECT curve, round(x, 6) AS x, round(CASE WHEN hi > lo THEN (y - lo) / (hi - lo) ELSE 0 END, 6) AS min_max,
round(CASE WHEN p99 > 0 THEN greatest(0.0, least(100.0, y / p99 * 100)) WHEN hi > 0 THEN greatest(0.0, least(100.0, y / hi * 100)) ELSE y END, 6) AS p99,
round(CASE WHEN hi > 0 THEN y * 100 / hi ELSE y END, 6) AS highest FROM s""")
def normalize_curves(spark, sf_dir):
    p = user_points(spark, sf_dir)
    out = C.scale_to_highest(C.normalize_percentile(C.normalize_min_max(p, ["curve"], out="min_max"), ["curve"], out="p99"), ["curve"], out="highest")
    return _rounded(out.drop("y"), "x", "min_max", "p99", "highest")


@query("fit_curves", f"""WITH p AS ({USER_POINTS}), c AS (SELECT curve, x - min(x) OVER (PARTITION BY curve) AS x, y FROM p)
SELECT curve, round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept,
round(sqrt(greatest(regr_syy(y, x) - regr_sxy(y, x) * regr_sxy(y, x) / nullif(regr_sxx(y, x), 0), 0) / count(*)), 6) AS rmse,
round(corr(y, x), 6) AS corr, count(*) AS n FROM c GROUP BY curve""")
def fit_curves(spark, sf_dir):
    from pyspark.sql import Window as W

    p = user_points(spark, sf_dir).withColumn("x", F.col("x") - F.min("x").over(W.partitionBy("curve")))
    return _rounded(C.linear_fit(p, ["curve"]), "slope", "intercept", "rmse", "corr")


@query("segment_curves", f"""WITH p AS ({USER_POINTS}), s AS (SELECT *, lead(x) OVER (PARTITION BY curve ORDER BY x) - x AS dx FROM p),
g AS (SELECT *, greatest(median(dx) OVER (PARTITION BY curve) * 3, 1.0) AS gap, x - lag(x) OVER (PARTITION BY curve ORDER BY x) AS back FROM s),
i AS (SELECT *, sum(CASE WHEN back > gap THEN 1 ELSE 0 END) OVER (PARTITION BY curve ORDER BY x) AS segment FROM g),
c AS (SELECT *, count(*) OVER (PARTITION BY curve, segment) AS n FROM i), w AS (SELECT *, max(n) OVER (PARTITION BY curve) < 3 AS whole FROM c),
k AS (SELECT curve, CASE WHEN whole THEN 0 ELSE segment END AS segment, x, y FROM w WHERE whole OR n >= 3)
SELECT curve, CAST(segment AS BIGINT) AS segment, round(min(x), 6) AS x0, round(max(x), 6) AS x1, count(*) AS n FROM k GROUP BY 1, 2""")
def segment_curves(spark, sf_dir):
    cut = C.split_segments(user_points(spark, sf_dir), ["curve"])
    return cut.groupBy("curve", F.col("segment").cast("bigint").alias("segment")).agg(F.round(F.min("x"), 6).alias("x0"), F.round(F.max("x"), 6).alias("x1"), F.count("*").alias("n"))


@query("line_breaks", f"""WITH p AS ({USER_POINTS}), s AS (SELECT *, lead(x) OVER (PARTITION BY curve ORDER BY x) - x AS dx FROM p),
g AS (SELECT *, greatest(median(dx) OVER (PARTITION BY curve) * 3, 1.0) AS gap, x - lag(x) OVER (PARTITION BY curve ORDER BY x) AS back FROM s)
SELECT curve, CAST(sum(CASE WHEN back > gap THEN 1 ELSE 0 END) AS BIGINT) AS breaks FROM g GROUP BY 1""")
def line_breaks(spark, sf_dir):
    return C.line_breaks(user_points(spark, sf_dir), ["curve"]).groupBy("curve").agg(F.max("segment").cast("bigint").alias("breaks"))


@query("interpolate_daily", f"""WITH p AS ({USER_POINTS}), days AS (SELECT DISTINCT floor(x) AS x FROM p), grid AS (SELECT DISTINCT p.curve, d.x FROM p CROSS JOIN days d),
k AS (SELECT curve, x, min(y) AS y FROM p GROUP BY 1, 2),
l AS (SELECT g.curve, g.x, k.x AS lx, k.y AS ly FROM grid g ASOF LEFT JOIN k ON g.curve = k.curve AND g.x >= k.x),
r AS (SELECT g.curve, g.x, k.x AS rx, k.y AS ry FROM grid g ASOF LEFT JOIN k ON g.curve = k.curve AND g.x <= k.x)
SELECT l.curve, l.x, round(CASE WHEN lx IS NULL THEN ry WHEN rx IS NULL OR lx = l.x THEN ly ELSE ly + (ry - ly) * (l.x - lx) / (rx - lx) END, 6) AS y,
round(CASE WHEN lx IS NULL OR rx IS NULL THEN NULL WHEN lx = l.x THEN ly ELSE ly + (ry - ly) * (l.x - lx) / (rx - lx) END, 6) AS y_inside
FROM l JOIN r ON l.curve = r.curve AND l.x = r.x""")
def interpolate_daily(spark, sf_dir):
    p = user_points(spark, sf_dir)
    grid = C.full_grid(p.select("curve", F.floor("x").cast("double").alias("x")), ["curve"])
    knots = p.groupBy("curve", "x").agg(F.min("y").alias("y"))
    inside = C.interpolate(grid, knots, ["curve"], outside="null").withColumnRenamed("y", "y_inside")
    return _rounded(C.interpolate(grid, knots, ["curve"]).join(inside, ["curve", "x"]), "y", "y_inside")


@query("resample_uniform", f"""WITH p AS ({USER_POINTS}), k AS (SELECT curve, x, min(y) AS y FROM p GROUP BY 1, 2),
e AS (SELECT curve, min(x) AS a, max(x) AS b FROM k GROUP BY 1), grid AS (SELECT curve, i, a + (b - a) * (i / 49.0::DOUBLE) AS x FROM e CROSS JOIN range(50) t(i)),
l AS (SELECT g.curve, g.i, g.x, k.x AS lx, k.y AS ly FROM grid g ASOF LEFT JOIN k ON g.curve = k.curve AND g.x >= k.x),
r AS (SELECT g.curve, g.i, k.x AS rx, k.y AS ry FROM grid g ASOF LEFT JOIN k ON g.curve = k.curve AND g.x <= k.x)
SELECT l.curve, round(l.x, 6) AS x, round(CASE WHEN lx IS NULL THEN ry WHEN rx IS NULL OR lx = l.x THEN ly ELSE ly + (ry - ly) * (l.x - lx) / (rx - lx) END, 5) AS y
FROM l JOIN r ON l.curve = r.curve AND l.i = r.i""")
def resample_uniform(spark, sf_dir):
    return C.resample_uniform(user_points(spark, sf_dir), ["curve"], 50).select("curve", F.round("x", 6).alias("x"), F.round("y", 5).alias("y"))


@query("compare_shifted_curves", f"""WITH d AS ({DAILY_POINTS}), o AS (SELECT curve, x + 0.5 AS x, y FROM d),
e AS (SELECT curve, min(x) AS a, max(x) AS b FROM o GROUP BY 1), t AS (SELECT d.curve, d.x, d.y AS p FROM d JOIN e ON d.curve = e.curve WHERE d.x BETWEEN a AND b),
l AS (SELECT t.curve, t.x, t.p, o.x AS lx, o.y AS ly FROM t ASOF LEFT JOIN o ON t.curve = o.curve AND t.x >= o.x),
r AS (SELECT t.curve, t.x, o.x AS rx, o.y AS ry FROM t ASOF LEFT JOIN o ON t.curve = o.curve AND t.x <= o.x),
pairs AS (SELECT l.curve AS curve, p, CASE WHEN lx IS NULL THEN ry WHEN rx IS NULL OR lx = l.x THEN ly ELSE ly + (ry - ly) * (l.x - lx) / (rx - lx) END AS q FROM l JOIN r ON l.curve = r.curve AND l.x = r.x),
{SID_SQL.format(k='curve')} SELECT * FROM sid""")
def compare_shifted_curves(spark, sf_dir):
    """Divergence of each event type's daily curve from itself, half a day later."""
    d = daily_points(spark, sf_dir).select("curve", "x", "y")
    return _rounded(C.compare_curves(d, d, ["curve"], shift=0.5), "forward", "reverse", "divergence")


@query("wide_curves", f"""WITH d AS ({DAILY_POINTS}), grid AS (SELECT i, a + (b - a) * (i / 39.0::DOUBLE) AS x FROM (SELECT min(x) AS a, max(x) AS b FROM d) CROSS JOIN range(40) t(i)),
g AS (SELECT c.curve, grid.i, grid.x FROM (SELECT DISTINCT curve FROM d) c CROSS JOIN grid),
l AS (SELECT g.curve, g.i, g.x, d.x AS lx, d.y AS ly FROM g ASOF LEFT JOIN d ON g.curve = d.curve AND g.x >= d.x),
r AS (SELECT g.curve, g.i, d.x AS rx, d.y AS ry FROM g ASOF LEFT JOIN d ON g.curve = d.curve AND g.x <= d.x),
v AS (SELECT l.curve, l.x, CASE WHEN lx IS NULL OR rx IS NULL THEN NULL WHEN lx = l.x THEN ly ELSE ly + (ry - ly) * (l.x - lx) / (rx - lx) END AS y FROM l JOIN r ON l.curve = r.curve AND l.i = r.i)
SELECT round(x, 6) AS x, {', '.join(f"round(max(y) FILTER (curve = '{t}'), 5) AS {t}" for t in ('click', 'purchase', 'view'))} FROM v GROUP BY x""")
def wide_curves(spark, sf_dir):
    names = ["click", "purchase", "view"]
    wide = C.wide_curves(daily_points(spark, sf_dir).select("curve", "x", "y"), "curve", names, 40)
    return wide.select(F.round("x", 6).alias("x"), *[F.round(c, 5).alias(c) for c in names])


@query("smooth_daily_counts", f"""WITH d AS ({DAILY_POINTS}) SELECT curve, x, round(sum(n) OVER (PARTITION BY curve ORDER BY x ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) / 3.0::DOUBLE, 6) AS y_smooth FROM d""")
def smooth_daily_counts(spark, sf_dir):
    return C.moving_average(daily_points(spark, sf_dir), ["curve"], 3, y="n").select("curve", "x", F.round("y_smooth", 6).alias("y_smooth"))


@query("daily_peaks", f"""WITH d AS ({DAILY_POINTS}), m AS (SELECT *, lag(y) OVER w AS l, lead(y) OVER w AS r FROM d WINDOW w AS (PARTITION BY curve ORDER BY x)),
t AS (SELECT curve, x, y, row_number() OVER (PARTITION BY curve ORDER BY y DESC, x) AS k FROM m WHERE y > l AND y > r) SELECT curve, x, round(y, 6) AS y FROM t WHERE k <= 3""")
def daily_peaks(spark, sf_dir):
    d = daily_points(spark, sf_dir).select("curve", "x", "y")
    return _rounded(C.top_peaks(C.local_maxima(d, ["curve"]), ["curve"], 3), "y")


@query("fill_short_gaps", f"""WITH p AS ({USER_POINTS}), d AS (SELECT curve, floor(x) AS x, avg(y) AS y FROM p GROUP BY 1, 2), days AS (SELECT DISTINCT x FROM d),
g AS (SELECT u.curve, days.x, d.y FROM (SELECT DISTINCT curve FROM d) u CROSS JOIN days LEFT JOIN d ON d.curve = u.curve AND d.x = days.x),
i AS (SELECT *, row_number() OVER (PARTITION BY curve ORDER BY x) AS i FROM g), s AS (SELECT *, CASE WHEN y IS NOT NULL THEN i END AS k FROM i),
n AS (SELECT *, last_value(k IGNORE NULLS) OVER b AS li, last_value(y IGNORE NULLS) OVER b AS ly, first_value(k IGNORE NULLS) OVER f AS ri, first_value(y IGNORE NULLS) OVER f AS ry FROM s
WINDOW b AS (PARTITION BY curve ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (PARTITION BY curve ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT curve, x, round(CASE WHEN y IS NOT NULL THEN y WHEN ri - li - 1 <= 2 THEN ly + (ry - ly) * (i - li) / (ri - li) END, 6) AS y FROM n""")
def fill_short_gaps(spark, sf_dir):
    d = _daily_means(spark, sf_dir)
    grid = C.full_grid(d, ["curve"])
    return _rounded(C.fill_short_gaps(grid.join(d, ["curve", "x"], "left"), ["curve"], 2), "y")


@query("busy_day_runs", f"""WITH d AS ({DAILY_POINTS}), t AS (SELECT *, avg(n) OVER (PARTITION BY curve) AS m FROM d),
i AS (SELECT *, row_number() OVER (PARTITION BY curve ORDER BY x) - sum(CASE WHEN n >= m THEN 1 ELSE 0 END) OVER (PARTITION BY curve ORDER BY x) AS run FROM t)
SELECT curve, min(x) AS first, max(x) AS last, count(*) AS size FROM i WHERE n >= m GROUP BY curve, run HAVING count(*) >= 2""")
def busy_day_runs(spark, sf_dir):
    d = daily_points(spark, sf_dir).withColumn("m", F.avg("n").over(C.over(["curve"])))
    return C.runs_where(d, ["curve"], "x", F.col("n") >= F.col("m"), 2)


@query("gaussian_reconstruction", """WITH peaks AS (SELECT p_brand AS curve, p_size::DOUBLE AS x, max(p_retailprice) AS height FROM part GROUP BY 1, 2),
grid AS (SELECT curve, i * 0.5::DOUBLE AS x FROM (SELECT DISTINCT curve FROM peaks) CROSS JOIN range(110) t(i)), top AS (SELECT curve, max(height) AS t FROM peaks GROUP BY 1)
SELECT g.curve, g.x, round(any_value(0.02 * t.t) + sum(p.height * exp(-0.5 * power((g.x - p.x) / (0.45 / 2.3548200450309493), 2))), 4) AS y
FROM grid g JOIN peaks p ON g.curve = p.curve JOIN top t ON t.curve = g.curve GROUP BY 1, 2""")
def gaussian_reconstruction(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    peaks = part.groupBy(F.col("p_brand").alias("curve"), F.col("p_size").cast("double").alias("x")).agg(F.max("p_retailprice").alias("height"))
    grid = peaks.select("curve").distinct().select("curve", F.explode(F.transform(F.sequence(F.lit(0), F.lit(109)), lambda i: i.cast("double") * 0.5)).alias("x"))
    return _rounded(C.gaussian_sum(peaks, grid, ["curve"]), "y", places=4)


@query("active_day_overlap", f"""WITH m AS (SELECT DISTINCT user_id // 15 AS team, user_id AS u, floor(epoch_us(ts) / 86400000000.0) AS d FROM events), s AS (SELECT u, count(*) AS n FROM m GROUP BY 1),
b AS (SELECT l.team, l.u AS a, r.u AS b, count(*) AS shared FROM m l JOIN m r ON l.team = r.team AND l.d = r.d AND l.u < r.u GROUP BY 1, 2, 3)
SELECT b.team, b.a, b.b, shared, x.n + y.n - shared AS total, round(shared / (x.n + y.n - shared), 6) AS jaccard FROM b JOIN s x ON x.u = b.a JOIN s y ON y.u = b.b""")
def active_day_overlap(spark, sf_dir):
    """Common active days of any two users of a team of 15, as of any two masks of a picture."""
    day = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(86400000000.0))
    m = table(spark, sf_dir, "events").select(F.expr("user_id div 15").alias("team"), "user_id", day.alias("d"))
    return _rounded(C.overlap_share(m, "user_id", "d", ["team"]), "jaccard")


@query("path_quality", f"""WITH p AS ({USER_POINTS}), days AS (SELECT DISTINCT floor(x) AS x FROM p), d AS (SELECT curve, floor(x) AS x, avg(y) AS y FROM p GROUP BY 1, 2),
g AS (SELECT u.curve, days.x, d.y FROM (SELECT DISTINCT curve FROM d) u CROSS JOIN days LEFT JOIN d ON d.curve = u.curve AND d.x = days.x),
q AS (SELECT curve, count(y) / count(*) AS coverage, coalesce((max(y) - min(y)) / 500.0::DOUBLE, 0) AS span, count(y) AS n_finite, count(DISTINCT round_even(y, 0)) AS n_rows FROM g GROUP BY 1)
SELECT curve, round(coverage, 6) AS coverage, round(span, 6) AS span, n_finite, n_rows, round(CASE WHEN n_finite < 20 THEN -1 ELSE 100 * coverage + 80 * span + 0.2 * least(n_rows, 200) END, 4) AS score,
coverage >= 0.35 AND span >= 0.06 AND n_finite >= 20 AS ok FROM q""")
def path_quality(spark, sf_dir):
    d = _daily_means(spark, sf_dir)
    grid = C.full_grid(d, ["curve"])
    out = C.path_quality(grid.join(d, ["curve", "x"], "left"), ["curve"], F.lit(500.0))
    return out.withColumns({"coverage": F.round("coverage", 6), "span": F.round("span", 6), "score": F.round("score", 4)})


@query("valid_curves", f"""WITH p AS ({USER_POINTS}), m AS (SELECT *, coalesce(y > lag(y) OVER w AND y > lead(y) OVER w AND y > 8, false) AS peak FROM p WINDOW w AS (PARTITION BY curve ORDER BY x)),
f AS (SELECT curve, count(*) AS n, max(y) AS top, avg(CASE WHEN y > 4 THEN 1.0 ELSE 0.0 END) AS busy, count(*) FILTER (peak) AS peaks FROM m GROUP BY 1)
SELECT curve, n, top, round(busy, 6) AS busy, peaks, n >= 20 AND top >= 12 AND busy >= 0.005 AND peaks >= 1 AS valid FROM f""")
def valid_curves(spark, sf_dir):
    return _rounded(C.valid_curves(user_points(spark, sf_dir), ["curve"]), "busy")


@query("attempt_score", f"""WITH p AS ({USER_POINTS}), a AS (SELECT curve, count(*) AS n, count(DISTINCT round_even(y, 1)) AS "distinct", max(y) - min(y) AS span, 500.0::DOUBLE AS scale FROM p GROUP BY 1)
SELECT curve, n, "distinct", round(span, 6) AS span, scale, round(CASE WHEN n < 20 THEN n WHEN "distinct" < 8 THEN "distinct" WHEN span < greatest(1.0, 0.05 * scale) THEN 0.1 * "distinct"
ELSE 100.0 * "distinct" + 0.01 * n - 0.5 * greatest(n - 900, 0) + 10.0 * span END, 4) AS score FROM a""")
def attempt_score(spark, sf_dir):
    out = C.attempt_score(user_points(spark, sf_dir), ["curve"], F.lit(500.0))
    return out.withColumns({"span": F.round("span", 6), "score": F.round("score", 4)})


@query("remap_axis", f"""WITH p AS ({USER_POINTS}), e AS (SELECT *, min(x) OVER w AS a, max(x) OVER w AS b, min(y) OVER w AS c, max(y) OVER w AS d FROM p WINDOW w AS (PARTITION BY curve))
SELECT curve, round(CASE WHEN abs(b - a) < 1e-12 THEN 5 ELSE 5 + (x - a) / (b - a) * 75 END, 6) AS two_theta,
round(greatest(CASE WHEN abs(d - c) < 1e-12 THEN 0 ELSE (y - c) / (d - c) * 500 END, 0), 6) AS intensity FROM e""")
def remap_axis(spark, sf_dir):
    """Both axes of each curve moved to a calibrated range: 5 to 80 degrees, 0 to 500 counts."""
    w = C.over(["curve"])
    p = user_points(spark, sf_dir)
    x = C.affine(F.col("x"), (F.min("x").over(w), F.max("x").over(w)), (F.lit(5.0), F.lit(80.0)))
    y = C.affine(F.col("y"), (F.min("y").over(w), F.max("y").over(w)), (F.lit(0.0), F.lit(500.0)))
    return p.select("curve", F.round(x, 6).alias("two_theta"), F.round(F.greatest(y, F.lit(0.0)), 6).alias("intensity"))


@query("correlated_event_types", f"""WITH d AS ({DAILY_POINTS}), c AS (SELECT l.curve AS a, r.curve AS b, corr(l.y, r.y) AS r, count(*) AS n FROM d l JOIN d r ON l.x = r.x AND l.curve < r.curve GROUP BY 1, 2)
SELECT a, b, round(r, 6) AS r, n, coalesce(r > 0.92, false) AS similar FROM c""")
def correlated_event_types(spark, sf_dir):
    d = daily_points(spark, sf_dir)
    left, right = d.select("x", F.col("curve").alias("a"), F.col("y").alias("p")), d.select("x", F.col("curve").alias("b"), F.col("y").alias("q"))
    out = left.join(right, "x").where("a < b").groupBy("a", "b").agg(F.corr("p", "q").alias("r"), F.count("*").alias("n"))
    return out.withColumn("similar", F.coalesce(F.col("r") > 0.92, F.lit(False))).withColumn("r", F.round("r", 6))
