"""Axis calibration with three anchors, as Column expressions on one row per picture.

An external digitizer is told two anchors on the x axis and one on the y axis. Its raw output is a linear function of pixels that
follows from the anchors; the operators here build anchors, predict the raw range and map raw points to the true axes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from curveloom.operators.curves import affine

# Height of an axis without labels, the least distance of y anchors, and the shift of the y anchor to the right.
Y_SCALE, LEAST_ROWS, NUDGE = 500.0, 20, 1


def frame_anchors(left: Column, right: Column, top: Column, bottom: Column, height: Column, dx: Column | int = 0, dy: Column | int = 0) -> Column:
    """Origin, right end and top of the axes as (col, row counted from below), in the picture that the frame is cropped from."""
    up = lambda row: (height - (row + dy)).cast("int")
    place = lambda col, row: F.struct(col.cast("int").alias("col"), up(row).alias("row"))
    return F.array(place(left + dx, bottom), place(right + dx, bottom), place(left + dx + NUDGE, top))


def data_anchors(x_min: Column, x_max: Column, y_scale: Column) -> Column:
    """The anchors' values: the axes start at 0, x is at least 1 wide."""
    zero = F.lit(0.0)
    pair = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    return F.array(pair(zero, zero), pair(F.greatest(x_max - x_min, F.lit(1.0)), zero), pair(zero, y_scale))


def _line(xs: list[Column], ys: list[Column]) -> tuple[Column, Column]:
    """intercept and slope of the least-squares line through a few points of one row."""
    n = float(len(xs))
    mx, my = sum(xs[1:], xs[0]) / n, sum(ys[1:], ys[0]) / n
    sxx = sum(((x - mx) * (x - mx) for x in xs), F.lit(0.0))
    sxy = sum(((x - mx) * (y - my) for x, y in zip(xs, ys)), F.lit(0.0))
    slope = sxy / F.nullif(sxx, F.lit(0.0))
    return my - slope * mx, slope


def axis_lines(locations: Column, data: Column) -> Column:
    """intercept and slope of both axes' lines, value over pixel."""
    at = lambda c, k: [F.get(c, F.lit(i))[k].cast("double") for i in range(3)]
    x0, x1 = _line(at(locations, "col"), at(data, "x"))
    y0, y1 = _line(at(locations, "row"), at(data, "y"))
    return F.struct(x0.alias("x_intercept"), x1.alias("x_slope"), y0.alias("y_intercept"), y1.alias("y_slope"))


def raw_output(pixel: Column, intercept: Column, slope: Column) -> Column:
    """What the digitizer writes for a pixel: it takes the intercept for the scale and the slope for the offset; 0 without a scale."""
    return F.when(F.abs(intercept) < 1e-12, F.lit(0.0)).otherwise(-(pixel - slope) / intercept)


def raw_x_range(locations: Column, data: Column) -> Column:
    """The raw output at both x anchors, in ascending order."""
    lines = axis_lines(locations, data)
    a, b = (raw_output(F.get(locations, F.lit(i))["col"].cast("double"), lines["x_intercept"], lines["x_slope"]) for i in (0, 1))
    return F.struct(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))


def y_scale(y_reliable: Column, y_min: Column, y_max: Column, top_label: Column) -> Column:
    """The axis' height: the calibrated span if that is to be trusted, else the highest label, else the default."""
    return F.when(F.coalesce(y_reliable, F.lit(False)), y_max - y_min).otherwise(F.coalesce(F.when(top_label > 0, top_label), F.lit(Y_SCALE)))


def reliable_y(y_min: Column, y_max: Column, ticks: Column, highest: float = 200_000.0, unit: float = 1.5) -> Column:
    """Whether a y calibration is to be trusted: a plausible range, and two rows of different values among its ticks."""
    rows, values = F.array_distinct(F.transform(ticks, lambda t: t["px"])), F.array_distinct(F.transform(ticks, lambda t: t["value"]))
    span = y_max - y_min
    fits = (y_min >= 0) & (span > 0) & (y_max <= highest) & (span >= F.when(y_max <= unit, 0.05).otherwise(1.0)) & (F.size(rows) >= 2) & (F.size(values) >= 2)
    return F.coalesce(fits, F.lit(False))


def build(rows: DataFrame) -> DataFrame:
    """rows(plot_left, plot_right, plot_top, plot_bottom, image_height, x_min, x_max, y_scale) with locations, data_points and x_raw."""
    c = F.col
    made = rows.withColumns(
        {
            "locations": frame_anchors(c("plot_left"), c("plot_right"), c("plot_top"), c("plot_bottom"), c("image_height")),
            "data_points": data_anchors(c("x_min"), c("x_max"), c("y_scale")),
        }
    )
    return made.withColumn("x_raw", raw_x_range(c("locations"), c("data_points")))


def correct(points: DataFrame, calibration: DataFrame, key: str = "figure_id") -> DataFrame:
    """Raw points(key, x, y) on the true axes: x by the predicted raw range, y by its own range, not below 0.

    Heights that are missing stay out of the range and are left out.
    """
    both = points.where("y is not null and not isnan(y)").join(calibration.select(key, "x_raw", "x_min", "x_max", "y_scale"), key)
    w = W.partitionBy(key)
    x = affine(F.col("x"), (F.col("x_raw.lo"), F.col("x_raw.hi")), (F.col("x_min"), F.col("x_max")))
    y = affine(F.col("y"), (F.min("y").over(w), F.max("y").over(w)), (F.lit(0.0), F.col("y_scale")))
    return both.select(key, x.alias("x"), F.greatest(y, F.lit(0.0)).alias("y"))


def panel_axis(figure: DataFrame, panels: DataFrame, key: str = "figure_id") -> DataFrame:
    """panels(key, panel, left, right, dx) with the figure's x axis figure(key, slope, intercept): x_min and x_max of each panel."""
    ends = [F.col("slope") * (F.col(side) + F.col("dx")) + F.col("intercept") for side in ("left", "right")]
    return panels.join(figure.select(key, "slope", "intercept"), key).select(key, "panel", F.least(*ends).alias("x_min"), F.greatest(*ends).alias("x_max"))


def tick_boxes(ticks: Column, axis: str, height: Column, width: Column, reach: int = 14) -> Column:
    """Boxes around the labels of ticks, clipped to the picture: below the x axis' pixels, left of the y axis'."""
    def box(t: Column) -> Column:
        zero = F.lit(0)
        if axis == "x":
            left, right, top, bottom = t["px"] - reach, t["px"] + reach, height - 2 * reach, height
        else:
            left, right, top, bottom = zero, F.lit(3 * reach), t["px"] - reach // 2, t["px"] + reach // 2
        return F.struct(F.greatest(zero, left).alias("left"), F.greatest(zero, top).alias("top"), F.least(width, right).alias("right"), F.least(height, bottom).alias("bottom"))

    return F.filter(F.transform(ticks, box), lambda b: (b["right"] > b["left"]) & (b["bottom"] > b["top"]))


def normalized_y(y_min: Column, y_max: Column, ticks: Column, low: float = -0.05, high: float = 1.5) -> Column:
    """Whether the y axis runs over about 0..1: by its range if that is known, else by its tick labels, one at least."""
    values = F.transform(ticks, lambda t: t["value"])
    by_ticks = (F.size(values) >= 1) & (F.array_min(values) >= low) & (F.array_max(values) <= high)
    return F.coalesce(F.when(y_min.isNotNull() & y_max.isNotNull(), (y_min >= low) & (y_max <= high)).otherwise(by_ticks), F.lit(False))


def has_y(y_min: Column, y_max: Column, method: Column) -> Column:
    """Whether both ends of the y axis are known from read labels."""
    return y_min.isNotNull() & y_max.isNotNull() & F.coalesce(method.startswith("ocr"), F.lit(False))


def acceptable(points: DataFrame, key: Sequence[str], scale: Column, least: int = 20, share: float = 0.08, y: str = "y") -> DataFrame:
    """key, n, span and whether a curve has enough points and reaches over enough of its axis."""
    found = points.groupBy(*key).agg(F.count(y).alias("n"), (F.max(y) - F.min(y)).alias("span"), F.max(scale).alias("scale"))
    return found.withColumn("acceptable", F.coalesce((F.col("n") >= least) & (F.col("span") >= share * F.greatest("scale", F.lit(1e-6))), F.lit(False))).drop("scale")


def label_keys(value: Column) -> Column:
    """What two readings of one label share: three decimals up to 1.5, whole numbers above."""
    return F.when(value <= 1.5, F.bround(value, 3)).otherwise(F.rint(value))


def points_between(points: DataFrame, ends: DataFrame, key: str, x: str = "x") -> DataFrame:
    """The points of a curve that lie within its ends(key, l, r)."""
    return points.join(ends, key).where(F.col(x).between(F.col("l"), F.col("r"))).drop("l", "r")


def height_over_wings(points: DataFrame, key: Sequence[str], near: int, far: int, x: str = "x", y: str = "y") -> DataFrame:
    """points with `above`: the height over the higher of the highest points near..far to the left and to the right, 0 for an empty side."""
    w = W.partitionBy(*key).orderBy(x)
    sides = [F.coalesce(F.max(y).over(w.rangeBetween(*r)), F.lit(0.0)) for r in ((-far, -near), (near, far))]
    return points.withColumn("above", F.col(y) - F.greatest(*sides))


def running_median(points: DataFrame, key: Sequence[str], reach: int = 1, x: str = "x", y: str = "y", name: str = "middle") -> DataFrame:
    """points with the median of y over up to `reach` points on each side."""
    near = F.sort_array(F.collect_list(y).over(W.partitionBy(*key).orderBy(x).rowsBetween(-reach, reach)))
    rows = points.withColumn("__s", near)
    n = F.size("__s")
    return rows.withColumn(name, (F.get("__s", F.floor((n - 1) / 2).cast("int")) + F.get("__s", F.floor(n / 2).cast("int"))) / 2).drop("__s")


def chained_bands(middles: DataFrame, group: Sequence[str], at: str, name: str, gap: float) -> DataFrame:
    """middles with `band`: in order of `at` (ties by name) a new one where the step is over the gap; a group, e.g. the masks of a
    picture, is a window."""
    w = W.partitionBy(*group).orderBy(at, name)
    cut = middles.withColumn("__new", F.coalesce((F.col(at) - F.lag(at).over(w) > gap).cast("int"), F.lit(0)))
    return cut.withColumn("band", F.sum("__new").over(w)).drop("__new")


def drop_left_edge(points: DataFrame, key: Sequence[str], share: float = 0.06, low: float = 0.4, x: str = "x", y: str = "y") -> DataFrame:
    """Points without those under `low` of the highest in the left `share` of the range, unless nothing else is left."""
    w = W.partitionBy(*key)
    ends = points.withColumns({"__a": F.min(x).over(w), "__b": F.max(x).over(w), "__top": F.max(y).over(w)})
    keep = (F.col(x) > F.col("__a") + share * (F.col("__b") - F.col("__a"))) | (F.col(y) >= low * F.col("__top"))
    kept = ends.withColumn("__keep", keep).withColumn("__kept", F.count_if("__keep").over(w))
    return kept.where("__keep or __kept = 0").select(points.columns)
