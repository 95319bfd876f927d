"""Curves from the colour masks of a plot: column tops, profiles, peak heights above their shoulders, and the choice by layout."""

from __future__ import annotations

import sys
from dataclasses import dataclass, field

import numpy as np
from pyspark import cloudpickle

from curveloom.functions import images as I
from curveloom.functions import signal as S

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values.
DARK = 200
AXIS_SHARE = 0.5
FWHM = 0.35
MASK_TOLERANCE = 4.0
MASK_WIDTH = 0.35
WING, WING_WIDTH = 2.0, 0.8
SHOULDER_FROM, SHOULDER_TO, SHOULDERS = 2.5, 3.5, 11
NEIGHBOUR, TALL, BELOW = 10.0, 0.9, 0.98
HEIGHT_TOLERANCE = 0.25
SAME_CURVE = 0.92


@dataclass
class Frame:
    """The axes of a plot in its picture: pixel frame, value ranges and, where known, the line of the y ticks."""

    left: int
    top: int
    right: int
    bottom: int
    x_min: float
    x_max: float
    y_min: float | None = None
    y_max: float | None = None
    y_ticks: list[tuple[float, float]] = field(default_factory=list)

    @property
    def has_y(self) -> bool:
        return self.y_min is not None and self.y_max is not None

    @property
    def axis(self) -> S.Axis:
        return S.Axis(self.x_min, self.x_max, max(self.right - self.left, 1), self.y_max if self.has_y else None)

    def x(self, columns: np.ndarray) -> np.ndarray:
        return self.x_min + (columns - self.left) / max(self.right - self.left, 1) * (self.x_max - self.x_min)

    def y(self, rows: np.ndarray, top: int, bottom: int, stacked: bool = False) -> np.ndarray:
        """Heights of rows by the y ticks' line if there is one, else as share of the band."""
        line = None
        if self.has_y and len(self.y_ticks) >= 2:
            slope, start = np.polyfit(*np.array(self.y_ticks, float).T, 1)
            line = (start, slope)
        return I.rows_to_intensity(rows, top, bottom, line, tuple(sorted((self.y_min or 0.0, self.y_max or 0.0))), stacked)


@dataclass
class Curve:
    x: np.ndarray
    y: np.ndarray
    name: str = "curve_1"
    colour: str | None = None
    peaks: list[tuple[float, float, float]] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)


def is_frame_column(column: np.ndarray, limit: float = DARK) -> bool:
    """Whether a column of grey values is a border or axis line, or shows nothing."""
    dark = np.asarray(column) < limit
    return not len(column) or (float(np.min(column)) <= limit and bool(dark.mean() > AXIS_SHARE))


def tops(set_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Columns with set pixels and the top row of each."""
    cols = np.flatnonzero(set_.any(0))
    return cols.astype(float), set_[:, cols].argmax(0).astype(float)


def gray_profile(img: np.ndarray, frame: Frame, top: int, bottom: int, scaled: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """x and heights of the darkest trace of each column, without columns that a frame line fills."""
    part = I.gray(img)[top:bottom, frame.left : frame.right]
    if not part.size:
        return np.empty(0), np.empty(0)
    skip = min(int(part.shape[0] * 0.05), part.shape[0] - 1)
    dark = part[skip:] < DARK
    cols, rows = tops(dark & (dark.mean(0) <= AXIS_SHARE))
    return _profile(frame, cols, rows + skip, top, bottom, scaled)


def mask_profile(mask: np.ndarray, frame: Frame, top: int, bottom: int) -> tuple[np.ndarray, np.ndarray]:
    """x and heights of the top of a colour mask in each column, without the margins where labels stand."""
    part = mask[top:bottom, frame.left : frame.right]
    if not part.size:
        return np.empty(0), np.empty(0)
    h = part.shape[0]
    skip = min(int(h * 0.12), h - 1)
    cols, rows = tops(part[skip : max(skip + 1, int(h * 0.95))])
    return _profile(frame, cols, rows + skip, top, bottom, True)


def _profile(frame: Frame, cols: np.ndarray, rows: np.ndarray, top: int, bottom: int, scaled: bool) -> tuple[np.ndarray, np.ndarray]:
    y = frame.y(rows + top, top, bottom)
    return frame.x(cols + frame.left), I.percent(y) if scaled and not frame.has_y else y


def raw_profile(mask: np.ndarray, frame: Frame, top: int, bottom: int) -> tuple[np.ndarray, np.ndarray]:
    """The mask's heights as they are, on an even grid and lightly smoothed; empty with fewer than 10 columns."""
    part = mask[top:bottom, frame.left : frame.right]
    cols, rows = tops(part) if part.size else (np.empty(0), np.empty(0))
    if len(cols) < 10:
        return np.empty(0), np.empty(0)
    x = frame.x(cols + frame.left)
    grid = np.linspace(x.min(), x.max(), max(2000, len(cols)))
    y = np.interp(grid, x, frame.y(rows + top, top, bottom))
    window = min(15, max(9, len(grid) // 100 * 2 + 1))
    return grid, S.savgol(y, window, 3) if 5 <= window < len(y) else y


def reliable(img: np.ndarray, mask: np.ndarray, frame: Frame, top: int, bottom: int, tolerance: float = MASK_TOLERANCE) -> bool:
    """Whether a colour mask shows the curve that the grey values show: wide enough, as many peaks, and the same main one.

    Labels printed in the curve's colour turn the heights of a mask's peaks around; this tells them apart.
    """
    of_mask, of_gray = mask_profile(mask, frame, top, bottom), gray_profile(img, frame, top, bottom)
    if min(len(of_mask[0]), len(of_gray[0])) < 10 or len(of_mask[0]) < MASK_WIDTH * max(frame.right - frame.left, 1):
        return False
    a, b = (S.substantial_peaks(*p, frame.axis) for p in (of_mask, of_gray))
    if not a or not b or (len(b) >= 3 and len(a) + 1 < len(b)):
        return False
    main = [max(p, key=lambda peak: peak[1])[0] for p in (a, b)]
    return abs(main[0] - main[1]) <= tolerance


def wing_top(x: np.ndarray, y: np.ndarray, at: float, side: int, offset: float, width: float = WING_WIDTH) -> float:
    """The highest value between offset and offset + width to the left (-1) or right (1) of a place; 0 if there is none."""
    away = side * (x - at)
    inside = (away >= offset) & (away <= offset + width)
    return float(y[inside].max()) if inside.any() else 0.0


def shoulder(x: np.ndarray, y: np.ndarray, at: float, height: float, side: int) -> float:
    """The highest of a peak's wings at growing offsets that stays below the peak itself."""
    found = [wing_top(x, y, at, side, o) for o in np.linspace(SHOULDER_FROM, SHOULDER_TO, SHOULDERS)]
    return max((v for v in found if v < height * BELOW), default=0.0)


def heights_above_shoulders(x: np.ndarray, y: np.ndarray, peaks: list[tuple[float, float, float]]) -> list[float]:
    """Height of each peak, by position, above the floor, its wings and its shoulders towards tall neighbours."""
    floor = float(np.percentile(y, 3)) if len(y) else 0.0
    at = sorted(p[0] for p in peaks)
    tall = [float(v) for v in np.interp(at, x, y)] if at else []
    out = []
    for i, (place, height) in enumerate(zip(at, tall)):
        base = [floor, *(wing_top(x, y, place, side, WING) for side in (-1, 1))]
        for side, j in ((-1, i - 1), (1, i + 1)):
            if 0 <= j < len(at) and abs(at[j] - place) <= NEIGHBOUR and tall[j] > height * TALL:
                base.append(shoulder(x, y, place, height, side))
        out.append(max(height - max(base), 0.0))
    return out


def refined(peaks: list, mask: np.ndarray | None, frame: Frame, top: int, bottom: int) -> list:
    """Peaks with heights in percent of the highest: read anew from the mask, or scaled where there is none."""
    if not peaks:
        return peaks
    if mask is None or not mask.any():
        best = max(p[1] for p in peaks)
        return [(p[0], p[1] / best * 100.0, p[2]) for p in peaks] if best > 0 else peaks
    x, y = raw_profile(mask, frame, top, bottom)
    if len(x) < 10:
        return peaks
    found = heights_above_shoulders(x, y, peaks)
    best = max(found)
    return [(p[0], h / best * 100.0, p[2]) for p, h in zip(peaks, found)] if best > 0 else peaks


def merged_heights(gray: list, mask: list, tolerance: float = HEIGHT_TOLERANCE) -> list:
    """The grey peaks, with the mask's height where the two agree within the tolerance or the grey one is not above 0."""
    if len(gray) != len(mask):
        return gray
    out = []
    for g, m in zip(gray, mask):
        a, b = max(g[1], 0.0), max(m[1], 0.0)
        use = a <= 0 or (b > 0 and abs(a - b) <= tolerance * max(a, b))
        out.append((g[0], m[1] if use else g[1], g[2]))
    return out


def simplified(img: np.ndarray, frame: Frame, top: int, bottom: int, points: int = 2000, mask: np.ndarray | None = None, fwhm: float = FWHM) -> Curve:
    """The curve of a band rebuilt from its major peaks at equal width; the profile itself if it has none."""
    x, y = gray_profile(img, frame, top, bottom)
    if len(x) < 10:
        return Curve(np.empty(0), np.empty(0), warnings=["profile_extraction_failed"])
    notes = ["simplified_constant_width_peaks"]
    peaks = S.substantial_peaks(x, y, frame.axis)
    if not peaks:
        return Curve(x, y, warnings=[*notes, "no_substantial_peaks_detected"])
    coloured = mask is not None and mask.any() and reliable(img, mask, frame, top, bottom)
    if frame.has_y:
        peaks = refined(peaks, mask, frame, top, bottom) if coloured else peaks
    else:
        peaks = S.rescaled(peaks, x, gray_profile(img, frame, top, bottom, scaled=False)[1])
        if coloured:
            peaks = merged_heights(peaks, refined(peaks, mask, frame, top, bottom))
        peaks = S.weak_left_edge(peaks, frame.x_min, frame.x_max)
    grid = np.linspace(x.min(), x.max(), points)
    return Curve(grid, S.gaussians(peaks, grid, fwhm), peaks=peaks, warnings=notes)


def resampled(x: np.ndarray, y: np.ndarray, points: int) -> tuple[np.ndarray, np.ndarray]:
    if len(x) < 2:
        return x, y
    at, first = np.unique(x, return_index=True)
    if len(at) < 2:
        return at, y[first]
    grid = np.linspace(at[0], at[-1], points)
    return grid, np.interp(grid, at, y[first])


def is_curve(y: np.ndarray) -> bool:
    """At least 20 points, a top of 12, half a percent of them above 4 and an inner maximum above 8."""
    if len(y) < 20 or y.max() < 12 or (y > 4).mean() < 0.005:
        return False
    return bool(((y[1:-1] > y[:-2]) & (y[1:-1] > y[2:]) & (y[1:-1] > 8)).any())


def from_mask(mask: np.ndarray, frame: Frame, top: int, bottom: int, name: str, colour: str, stacked: bool, points: int) -> Curve | None:
    """The trace of a mask in a band as a calibrated curve, or None if it shows none."""
    notes = ["black_curve_extraction"] * (colour == "black") + ["stacked_curve_band"] * stacked
    cols, rows = I.trace(mask[top:bottom, frame.left : frame.right], smooth=not stacked, lower=colour == "black" and not stacked)
    if not len(cols):
        return None
    x, y = resampled(frame.x(cols + frame.left), frame.y(rows + top, top, bottom, stacked), points)
    y = y if frame.has_y else I.percent(y)
    if len(x) > 10 and np.ptp(x) / max(frame.x_max - frame.x_min, 1e-6) < 0.5:
        notes.append("partial_curve_coverage")
    if y.max(initial=0.0) <= 0 or not is_curve(y):
        return None
    return Curve(x, y, name, colour if colour != "auto" else None, [], sorted(set(notes)))


def bands_of(masks: list[tuple[str, np.ndarray]], top: int, bottom: int) -> list[tuple[str, np.ndarray, int, int]]:
    """Masks in order of height with a band each: those close together share one, which the biggest of them gets; equal bands."""
    rows = sorted(((I.median_row(m), n, m) for n, m in masks if m.sum() >= 20), key=lambda r: r[0])
    if len(rows) <= 1:
        return [(n, m, top, bottom) for _, n, m in rows]
    near = max(12, (bottom - top) // 20)
    cut = np.flatnonzero(np.diff([r[0] for r in rows]) >= near) + 1
    groups = [rows[a:b] for a, b in zip((0, *cut), (*cut, len(rows)))]
    edge = [int(top + k * (bottom - top) / len(groups)) for k in range(len(groups))] + [bottom]
    best = [max(g, key=lambda r: r[2].sum()) for g in groups]
    return [(n, m, edge[k], edge[k + 1]) for k, (_, n, m) in enumerate(best)]


def best_simple(img: np.ndarray, frame: Frame, masks: list[tuple[str, np.ndarray]], points: int) -> Curve | None:
    """The simplified curve of the whole plot, with the colour of the mask that shows it best."""
    picked = I.preferred_mask([(n, _inside(m, frame)) for n, m in masks], frame.right - frame.left)
    if picked is None:
        return None
    colour, whole = picked[0], dict(masks)
    coloured = [n for n in whole if n not in ("black", "auto")]
    if colour == "auto" and coloured:
        colour = max(coloured, key=lambda n: I.coverage(_inside(whole[n], frame)))
    plain = colour in ("auto", "black")
    found = simplified(img, frame, frame.top, frame.bottom, points, None if plain else whole[colour])
    if not len(found.x):
        return None
    found.colour, found.warnings = None if plain else colour, sorted(set(found.warnings))
    return found


def _inside(mask: np.ndarray, frame: Frame) -> np.ndarray:
    return mask[frame.top : frame.bottom, frame.left : frame.right]


def _placed(img: np.ndarray, frame: Frame, top: int, bottom: int) -> list[tuple[str, np.ndarray]]:
    """The curve masks of a band in the picture's own places."""
    out = []
    for name, part in I.curve_masks(img, (frame.left, top, frame.right, bottom)):
        mask = np.zeros(img.shape[:2], bool)
        mask[top:bottom, frame.left : frame.right] = part
        out.append((name, mask))
    return out


def distinct(curves: list[Curve], limit: float = SAME_CURVE) -> list[Curve]:
    """Curves that correlate above the limit with no earlier one of their length."""
    kept: list[Curve] = []
    for c in curves:
        same = (k for k in kept if len(k.y) == len(c.y) and len(c.y) > 1 and np.std(k.y) > 0 and np.std(c.y) > 0)
        if not any(np.corrcoef(k.y, c.y)[0, 1] > limit for k in same):
            kept.append(c)
    return kept


def digitized(img: np.ndarray, frame: Frame, points: int = 2000) -> list[Curve]:
    """The curves of a plot: one simplified curve of a simple plot, a trace per colour of an overlay, one per band of a stack."""
    masks = _placed(img, frame, frame.top, frame.bottom)
    height, width = frame.bottom - frame.top, frame.right - frame.left
    inner = [(n, _inside(m, frame)) for n, m in masks]
    kind = I.layout(inner, height, width)
    wide = [(n, m) for n, m in masks if n != "black" and I.coverage(_inside(m, frame)) >= max(20, int(width * I.COVERAGE))]
    found: list[Curve | None] = []
    if kind == "stacked":
        for k, (colour, part, top, bottom) in enumerate(bands_of([(n, _inside(m, frame)) for n, m in wide], frame.top, frame.bottom), 1):
            mask = np.zeros(img.shape[:2], bool)
            mask[frame.top : frame.bottom, frame.left : frame.right] = part
            found.append(from_mask(mask, frame, top, bottom, f"curve_{k}_{colour}", colour, True, points))
    elif kind == "overlay":
        found = [from_mask(m, frame, frame.top, frame.bottom, f"curve_{k}_{n}", n, False, points) for k, (n, m) in enumerate(wide or masks, 1)]
    else:
        found = [best_simple(img, frame, masks, points)]
    curves = distinct([c for c in found if c is not None])
    if not any(len(c.x) for c in curves):
        last = best_simple(img, frame, masks, points)
        curves = [last] if last is not None else curves
    return curves or [Curve(np.empty(0), np.empty(0), warnings=["no_curve_pixels_detected"])]


def stacked_by_rows(img: np.ndarray, frame: Frame, points: int = 2000) -> list[Curve]:
    """A curve per band of a stack whose curves share a colour: each band's best mask, traced."""
    out = []
    for k, (top, bottom) in enumerate(I.stacked_bands(img, (frame.left, frame.top, frame.right, frame.bottom)), 1):
        masks = _placed(img, frame, top, bottom)
        picked = I.preferred_mask([(n, m[top:bottom, frame.left : frame.right]) for n, m in masks], frame.right - frame.left)
        if picked is not None:
            out.append(from_mask(dict(masks)[picked[0]], frame, top, bottom, f"curve_{k}", picked[0], True, points))
    return distinct([c for c in out if c is not None])


# Pictures prepared for an outside digitizer: the curve in black on white.


def coloured_on_white(img: np.ndarray, box: tuple[int, int, int, int] | None = None) -> np.ndarray | None:
    """Saturated pixels of the plot area in black on white, or None if there are too few."""
    h = I.hsv(img)
    rows, cols = img.shape[:2]
    mask = (h[..., 1] > 40) & (h[..., 2] > 30) & (h[..., 2] < 250) & I.area_mask(rows, cols, box)
    return _black_on_white(img, mask) if mask.sum() >= max(500, int(rows * cols * 0.001)) else None


def dark_on_white(img: np.ndarray, box: tuple[int, int, int, int] | None = None) -> np.ndarray | None:
    """Dark strokes of the plot area, thickened, without frame lines that touch the border; None if there are too few."""
    rows, cols = img.shape[:2]
    dark = (I.gray(img) < 95) & I.area_mask(rows, cols, box)
    if dark.sum() < max(200, int(rows * cols * 0.0003)):
        return None
    labels, boxes = I.components(dark)
    keep = np.zeros(len(boxes) + 1, bool)
    for k, (x, y, w, h, _) in enumerate(boxes, 1):
        at_border = min(x, y) <= 2 or x + w >= cols - 3 or y + h >= rows - 3
        line = w > 0.85 * cols or h > 0.85 * rows or (h <= 4 and w > 0.4 * cols) or (w <= 4 and h > 0.4 * rows)
        keep[k] = not (at_border and line)
    thick = I.dilate(keep[labels], 5, 5)  # two rounds of 3 x 3
    return _black_on_white(img, thick) if thick.sum() >= max(150, int(rows * cols * 0.0002)) else None


def _black_on_white(img: np.ndarray, mask: np.ndarray) -> np.ndarray:
    out = np.full_like(img, 255)
    out[mask] = 0
    return out


def prepared(img: np.ndarray, box: tuple[int, int, int, int] | None = None) -> list[np.ndarray]:
    """The pictures worth a try, the coloured curve first."""
    return [p for p in (coloured_on_white(img, box), dark_on_white(img, box)) if p is not None]


def attempts(img: np.ndarray, box: tuple[int, int, int, int] | None = None) -> list[tuple[np.ndarray, bool, bool]]:
    """(picture, remove grid, invert) in the order in which an outside digitizer is tried on each prepared picture: as it is
    first, since frame lines are often traced once the grid is removed; a light picture is tried inverted as well."""
    ways = [(grid, True) for grid in (False, True)] if I.is_dark(img) else [(grid, invert) for invert in (False, True) for grid in (False, True)]
    return [(p, *way) for p in (prepared(img, box) or [img]) for way in ways]


def whole_frame(frame: tuple[int, int, int, int], crop: tuple[int, int, int, int]) -> tuple[int, int, int, int]:
    """A frame of a crop in the places of the whole picture."""
    dx, dy = crop[0], crop[1]
    return frame[0] + dx, frame[1] + dy, frame[2] + dx, frame[3] + dy
