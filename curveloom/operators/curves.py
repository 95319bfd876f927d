"""Operators on curves in long form: one row per point, `curve` columns name the curve, x orders it, y is the value.

All of them are grouped aggregates or windows over one curve, so they scale with the number of curves; a curve's points are
sorted once. Null and NaN values should be removed or nulled before (`finite`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def over(curve: Sequence[str]):
    return W.partitionBy(*curve)


def finite(points: DataFrame, *columns: str) -> DataFrame:
    """Rows whose columns are neither null, NaN nor infinite."""
    for c in columns:
        points = points.where(F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < F.lit(float("inf"))))
    return points


def spectral_divergence(pairs: DataFrame, keys: Sequence[str], p: str = "p", q: str = "q", eps: float = 1e-12) -> DataFrame:
    """forward, reverse and symmetric information divergence of the paired intensities of each key.

    Both sides are divided by their sums, raised to eps and divided again. Groups with a negative value or a sum that is not
    positive give nulls.
    """
    w = over(keys)
    shares = pairs.withColumns({"__p": F.col(p) / F.nullif(F.sum(p).over(w), F.lit(0.0)), "__q": F.col(q) / F.nullif(F.sum(q).over(w), F.lit(0.0))})
    floor = shares.withColumns({"__p": F.greatest("__p", F.lit(eps)), "__q": F.greatest("__q", F.lit(eps))})
    again = floor.withColumns({"__p": F.col("__p") / F.sum("__p").over(w), "__q": F.col("__q") / F.sum("__q").over(w)})
    fair = (F.min(p) >= 0) & (F.min(q) >= 0) & (F.sum(p) > 0) & (F.sum(q) > 0)
    forward, reverse = F.sum(F.col("__p") * F.ln(F.col("__p") / F.col("__q"))), F.sum(F.col("__q") * F.ln(F.col("__q") / F.col("__p")))
    return again.groupBy(*keys).agg(
        F.when(fair, forward).alias("forward"), F.when(fair, reverse).alias("reverse"), F.when(fair, forward + reverse).alias("divergence"), F.count("*").alias("n")
    )


def normalize_min_max(points: DataFrame, curve: Sequence[str], y: str = "y", out: str = "y_norm") -> DataFrame:
    """y between the curve's smallest (0) and largest (1); a constant curve is 0."""
    low, high = F.min(y).over(over(curve)), F.max(y).over(over(curve))
    return points.withColumn(out, F.when(high > low, (F.col(y) - low) / (high - low)).otherwise(0.0))


def normalize_percentile(points: DataFrame, curve: Sequence[str], y: str = "y", out: str = "y_norm", share: float = 0.99) -> DataFrame:
    """y as percent of the curve's 99th percentile, or of its largest value if that is not positive, cut to 0..100."""
    top = F.percentile(y, F.lit(share)).over(over(curve))
    top = F.when(top > 0, top).otherwise(F.max(y).over(over(curve)))
    return points.withColumn(out, F.when(top > 0, F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.col(y) / top * 100))).otherwise(F.col(y)))


def scale_to_highest(points: DataFrame, curve: Sequence[str], y: str = "y", out: str = "y_norm") -> DataFrame:
    """y as percent of the curve's largest positive value; unchanged if there is none."""
    top = F.max(F.greatest(F.col(y), F.lit(0.0))).over(over(curve))
    return points.withColumn(out, F.when(top > 0, F.col(y) * 100 / top).otherwise(F.col(y)))


def linear_fit(points: DataFrame, curve: Sequence[str], x: str = "x", y: str = "y") -> DataFrame:
    """slope, intercept, rmse, corr and n of the least-squares line of each curve; nulls for fewer than two x."""
    fit = points.groupBy(*curve).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.sqrt(F.greatest(F.regr_syy(y, x) - F.regr_sxy(y, x) * F.regr_sxy(y, x) / F.nullif(F.regr_sxx(y, x), F.lit(0.0)), F.lit(0.0)) / F.count("*")).alias("rmse"),
        F.corr(y, x).alias("corr"),
        F.count("*").alias("n"),
    )
    return fit


def segment_ids(points: DataFrame, curve: Sequence[str], x: str, gap: Column) -> DataFrame:
    """`segment`, counted from 0 along x: a new one starts where x jumps by more than `gap`."""
    w = over(curve).orderBy(x)
    step = points.withColumn("__step", F.col(x) - F.lag(x).over(w))
    return step.withColumn("segment", F.sum(F.when(F.col("__step") > gap, 1).otherwise(0)).over(w)).drop("__step")


def split_segments(points: DataFrame, curve: Sequence[str], x: str = "x", least_gap: float = 1.0, factor: float = 3.0, least_points: int = 3) -> DataFrame:
    """segment_ids() at gaps over max(factor x median step, least_gap), without segments of fewer points.

    A curve all of whose segments are too short stays whole, as segment 0.
    """
    w = over(curve).orderBy(x)
    steps = points.withColumn("__dx", F.lead(x).over(w) - F.col(x))
    gap = F.greatest(F.median("__dx").over(over(curve)) * factor, F.lit(least_gap))
    cut = segment_ids(steps.withColumn("__gap", gap), curve, x, F.col("__gap"))
    sized = cut.withColumn("__n", F.count("*").over(W.partitionBy(*curve, "segment")))
    whole = F.max("__n").over(over(curve)) < least_points
    return sized.withColumn("__whole", whole).where(F.col("__whole") | (F.col("__n") >= least_points)).withColumn(
        "segment", F.when(F.col("__whole"), 0).otherwise(F.col("segment"))
    ).drop("__dx", "__gap", "__n", "__whole")


def interpolate(grid: DataFrame, knots: DataFrame, curve: Sequence[str], x: str = "x", y: str = "y", outside: str = "clamp") -> DataFrame:
    """grid(curve, x) with y interpolated between the knots around it; beyond them the end value ("clamp") or null ("null").

    One sort of grid and knots together, and two running values; no range join.
    """
    names = [*curve, x]
    both = knots.select(*names, F.col(y).cast("double").alias(y), F.lit(0).alias("__kind")).unionByName(
        grid.select(*names, F.lit(None).cast("double").alias(y), F.lit(1).alias("__kind"))
    )
    knot = F.when(F.col("__kind") == 0, F.struct(F.col(x).alias("x"), F.col(y).alias("y")))
    w = over(curve).orderBy(x, "__kind")
    left = F.last(knot, True).over(w.rowsBetween(W.unboundedPreceding, 0))
    right = F.first(knot, True).over(w.rowsBetween(0, W.unboundedFollowing))
    placed = both.withColumns({"__l": left, "__r": right}).where("__kind = 1")
    lx, ly, rx, ry = (F.col(f"__{s}.{k}") for s in "lr" for k in "xy")
    between = F.when(lx == F.col(x), ly).when(rx == F.col(x), ry).otherwise(ly + (ry - ly) * (F.col(x) - lx) / (rx - lx))
    beyond = F.coalesce(ly, ry) if outside == "clamp" else F.when(lx == F.col(x), ly).when(rx == F.col(x), ry)
    return placed.withColumn(y, F.when(lx.isNotNull() & rx.isNotNull(), between).otherwise(beyond)).drop("__l", "__r", "__kind")


def uniform_grid(points: DataFrame, curve: Sequence[str], n: int, x: str = "x", shared: bool = False) -> DataFrame:
    """n equal steps from each curve's smallest to its largest x, both included; with shared over all curves' range."""
    if shared:
        ends = points.groupBy(*curve).agg(F.lit(1)).select(*curve).crossJoin(F.broadcast(points.agg(F.min(x).alias("__a"), F.max(x).alias("__b"))))
    else:
        ends = points.groupBy(*curve).agg(F.min(x).alias("__a"), F.max(x).alias("__b"))
    steps = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.col("__a") + (F.col("__b") - F.col("__a")) * (i.cast("double") / F.lit(float(max(n - 1, 1)))))
    return ends.select(*curve, F.explode(steps).alias(x))


def resample_uniform(points: DataFrame, curve: Sequence[str], n: int = 2000, x: str = "x", y: str = "y") -> DataFrame:
    """Each curve at n equal steps over its own range; of points with one x the one of the smallest y counts."""
    knots = points.groupBy(*curve, x).agg(F.min(y).alias(y))
    return interpolate(uniform_grid(knots, curve, n, x), knots, curve, x, y)


def wide_curves(points: DataFrame, curve: str, ids: Sequence[str], n: int = 2000, x: str = "x", y: str = "y") -> DataFrame:
    """x and one column per curve on a grid over the whole range, null outside a curve's own."""
    grid = uniform_grid(points, [curve], n, x, shared=True)
    filled = interpolate(grid, points, [curve], x, y, outside="null")
    return filled.groupBy(x).pivot(curve, list(ids)).agg(F.first(y))


def moving_average(points: DataFrame, curve: Sequence[str], k: int, x: str = "x", y: str = "y", out: str = "y_smooth") -> DataFrame:
    """Sum of the k points around each, over k; beyond the ends counts as 0. k is odd."""
    half = k // 2
    return points.withColumn(out, F.sum(y).over(over(curve).orderBy(x).rowsBetween(-half, half)) / F.lit(float(k)))


def local_maxima(points: DataFrame, curve: Sequence[str], x: str = "x", y: str = "y") -> DataFrame:
    """Points strictly above both neighbours."""
    w = over(curve).orderBy(x)
    return points.withColumns({"__l": F.lag(y).over(w), "__r": F.lead(y).over(w)}).where(f"{y} > __l and {y} > __r").drop("__l", "__r")


def top_peaks(peaks: DataFrame, curve: Sequence[str], k: int, x: str = "x", y: str = "y") -> DataFrame:
    """The k highest points of each curve, the first by x of equals."""
    return peaks.withColumn("__k", F.row_number().over(over(curve).orderBy(F.desc(y), x))).where(F.col("__k") <= k).drop("__k")


def fill_short_gaps(points: DataFrame, curve: Sequence[str], most: int = 8, x: str = "x", y: str = "y") -> DataFrame:
    """Nulls of inner runs of at most `most` rows filled along a line between the rows around; x counts rows."""
    w = over(curve).orderBy(x)
    at = points.withColumn("__i", F.row_number().over(w))
    seen = F.when(F.col(y).isNotNull(), F.struct(F.col("__i").alias("i"), F.col(y).cast("double").alias("y")))
    at = at.withColumns({"__l": F.last(seen, True).over(w.rowsBetween(W.unboundedPreceding, 0)), "__r": F.first(seen, True).over(w.rowsBetween(0, W.unboundedFollowing))})
    short = F.col("__r.i") - F.col("__l.i") - 1 <= most
    line = F.col("__l.y") + (F.col("__r.y") - F.col("__l.y")) * (F.col("__i") - F.col("__l.i")) / F.nullif(F.col("__r.i") - F.col("__l.i"), F.lit(0))
    return at.withColumn(y, F.when(F.col(y).isNotNull(), F.col(y).cast("double")).when(short, line)).drop("__i", "__l", "__r")


def runs_where(rows: DataFrame, group: Sequence[str], order: str, inside: Column, least: int = 1) -> DataFrame:
    """first, last and size of each maximal run of consecutive rows for which `inside` holds."""
    w = over(group).orderBy(order)
    marked = rows.withColumn("__in", F.coalesce(inside, F.lit(False)))
    island = marked.withColumn("__run", F.row_number().over(w) - F.sum(F.col("__in").cast("int")).over(w)).where("__in")
    runs = island.groupBy(*group, "__run").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("size"))
    return runs.where(F.col("size") >= least).drop("__run")


def gaussian_sum(peaks: DataFrame, grid: DataFrame, curve: Sequence[str], fwhm: float = 0.45, baseline: float = 0.02, x: str = "x", h: str = "height") -> DataFrame:
    """grid(curve, x) with y: the baseline share of the highest peak plus a Gaussian of equal width for each peak.

    The peaks of a curve, a dozen as a rule, are carried as an array, so the grid is not multiplied.
    """
    sigma = fwhm / 2.3548200450309493
    packed = peaks.groupBy(*curve).agg(F.sort_array(F.collect_list(F.struct(F.col(x).alias("x"), F.col(h).alias("h")))).alias("__peaks"), F.max(h).alias("__top"))
    term = lambda s, p: s + p["h"] * F.exp(F.lit(-0.5) * F.pow((F.col(x) - p["x"]) / F.lit(sigma), F.lit(2.0)))
    return grid.join(packed, list(curve), "left").select(
        *curve, x, F.coalesce(F.aggregate("__peaks", F.col("__top") * F.lit(baseline), term), F.lit(0.0)).alias("y")
    )


def line_breaks(points: DataFrame, curve: Sequence[str], x: str = "x") -> DataFrame:
    """`segment` of each point for drawing: a line breaks where the step is over max(3 x median step, 1)."""
    w = over(curve).orderBy(x)
    steps = points.withColumn("__dx", F.lead(x).over(w) - F.col(x))
    return segment_ids(steps.withColumn("__gap", F.greatest(F.median("__dx").over(over(curve)) * 3, F.lit(1.0))), curve, x, F.col("__gap")).drop("__dx", "__gap")


def compare_curves(truth: DataFrame, other: DataFrame, curve: Sequence[str], shift: float = 0.0, eps: float = 1e-12) -> DataFrame:
    """Divergence of each curve of truth(curve, x, y) from other(curve, x, y), moved by shift and read at truth's x within its range."""
    moved = other.select(*curve, (F.col("x") + shift).alias("x"), "y")
    ends = moved.groupBy(*curve).agg(F.min("x").alias("__a"), F.max("x").alias("__b"))
    inside = truth.join(ends, list(curve)).where("x between __a and __b").select(*curve, "x", F.col("y").alias("p"))
    read = interpolate(inside.select(*curve, "x"), moved, curve)
    return spectral_divergence(inside.join(read.withColumnRenamed("y", "q"), [*curve, "x"]), curve, eps=eps)


def broadcast_if_small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """df with a broadcast hint if it has no more than so many rows, which are counted."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def full_grid(points: DataFrame, curve: Sequence[str], x: str = "x") -> DataFrame:
    """Every curve at every distinct x of all curves."""
    return points.select(*curve).distinct().crossJoin(broadcast_if_small(points.select(x).distinct()))


def overlap_share(members: DataFrame, group: str, item: str, within: Sequence[str] = ()) -> DataFrame:
    """a, b, shared, total, jaccard of the distinct items of every two groups that share one, inside each of `within` (a picture's
    masks, say), whose columns come first.

    Pairs come from a self-join on the item, so groups without a common item are not paired.
    """
    rows = members.select(*within, group, item).distinct()
    sizes = rows.groupBy(*within, group).agg(F.count("*").alias("n"))
    left, right = rows.select(*within, F.col(group).alias("a"), item), rows.select(*within, F.col(group).alias("b"), item)
    both = left.join(right, [*within, item]).where("a < b").groupBy(*within, "a", "b").agg(F.count("*").alias("shared"))
    for side, n in (("a", "na"), ("b", "nb")):
        both = both.join(sizes.select(*within, F.col(group).alias(side), F.col("n").alias(n)), [*within, side])
    total = F.col("na") + F.col("nb") - F.col("shared")
    return both.select(*within, "a", "b", "shared", total.alias("total"), (F.col("shared") / total).alias("jaccard"))


def affine(c: Column, source: tuple[Column, Column], target: tuple[Column, Column]) -> Column:
    """c moved from the source range to the target range; the target's start if the source has no width."""
    (a, b), (t0, t1) = source, target
    return F.when(F.abs(b - a) < 1e-12, t0).otherwise(t0 + (c - a) / (b - a) * (t1 - t0))


def mean_in_order(rows: DataFrame, group: Sequence[str], order: str, y: str = "y") -> DataFrame:
    """The mean of each group with its values added one by one in the given order, so that no bit depends on how rows are dealt to tasks.

    A running sum over sorted rows, of which the last is taken; a group is never held as a list.
    """
    w = over(group).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    running = rows.select(*group, F.row_number().over(over(group).orderBy(order)).alias("__i"), F.sum(y).over(w).alias("__s"), F.count(y).over(w).alias("__n"))
    last = running.groupBy(*group).agg(F.max_by(F.struct("__s", "__n"), "__i").alias("__l"))
    return last.select(*group, (F.col("__l.__s") / F.nullif(F.col("__l.__n"), F.lit(0))).alias(y))


def path_quality(path: DataFrame, curve: Sequence[str], height: Column, y: str = "y") -> DataFrame:
    """coverage (share of columns with a row), span (their range over the height), finite and distinct rows, score and ok."""
    n = F.count(y)
    out = path.groupBy(*curve).agg(
        (n / F.count("*")).alias("coverage"),
        F.coalesce((F.max(y) - F.min(y)) / F.max(height), F.lit(0.0)).alias("span"),
        n.alias("n_finite"),
        F.countDistinct(F.rint(y)).alias("n_rows"),
    )
    score = F.when(F.col("n_finite") < 20, -1.0).otherwise(100 * F.col("coverage") + 80 * F.col("span") + 0.2 * F.least(F.col("n_rows"), F.lit(200)))
    return out.withColumns({"score": score, "ok": (F.col("coverage") >= 0.35) & (F.col("span") >= 0.06) & (F.col("n_finite") >= 20)})


def valid_curves(points: DataFrame, curve: Sequence[str], x: str = "x", y: str = "y") -> DataFrame:
    """Curves of at least 20 points that reach 12, exceed 4 in half a percent of them and have an inner maximum above 8."""
    w = over(curve).orderBy(x)
    peak = F.col(y).__gt__(F.lag(y).over(w)) & (F.col(y) > F.lead(y).over(w)) & (F.col(y) > 8)
    found = points.withColumn("__peak", peak).groupBy(*curve).agg(
        F.count("*").alias("n"), F.max(y).alias("top"), F.avg((F.col(y) > 4).cast("double")).alias("busy"), F.count_if(F.coalesce("__peak", F.lit(False))).alias("peaks")
    )
    return found.withColumn("valid", (F.col("n") >= 20) & (F.col("top") >= 12) & (F.col("busy") >= 0.005) & (F.col("peaks") >= 1))


def attempt_score(points: DataFrame, attempt: Sequence[str], scale: Column, y: str = "y") -> DataFrame:
    """n, unique values, span and the score by which the best of several extractions is chosen."""
    out = points.groupBy(*attempt).agg(
        F.count("*").alias("n"), F.countDistinct(F.bround(F.col(y), 1)).alias("distinct"), (F.max(y) - F.min(y)).alias("span"), F.max(scale).alias("scale")
    )
    full = 100.0 * F.col("distinct") + 0.01 * F.col("n") - 0.5 * F.greatest(F.col("n") - 900, F.lit(0)) + 10.0 * F.col("span")
    score = (
        F.when(F.col("n") < 20, F.col("n").cast("double"))
        .when(F.col("distinct") < 8, F.col("distinct").cast("double"))
        .when(F.col("span") < F.greatest(F.lit(1.0), 0.05 * F.col("scale")), 0.1 * F.col("distinct"))
        .otherwise(full)
    )
    return out.withColumn("score", score)
