"""Drawn plots with axes, ticks and numbers, without a plotting library."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

from curveloom.functions import images as I

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The colours of curve names as blue, green, red.
COLOURS = {
    "blue": (180, 119, 31),
    "red": (40, 39, 214),
    "green": (44, 160, 44),
    "orange": (14, 127, 255),
    "purple": (189, 103, 148),
    "magenta": (194, 119, 227),
    "black": (0, 0, 0),
}
#: Rows of the glyphs, top first; the bits of a row are its three pixels.
GLYPHS = {
    "0": (7, 5, 5, 5, 7), "1": (2, 6, 2, 2, 7), "2": (7, 1, 7, 4, 7), "3": (7, 1, 7, 1, 7), "4": (5, 5, 7, 1, 1), "5": (7, 4, 7, 1, 7),
    "6": (7, 4, 7, 5, 7), "7": (7, 1, 2, 2, 2), "8": (7, 5, 7, 5, 7), "9": (7, 5, 7, 1, 7), "-": (0, 0, 7, 0, 0), ".": (0, 0, 0, 0, 2),
}


def colour_of(name: str | None, index: int) -> tuple[int, int, int]:
    """The colour of a name, or one of the cycle for a curve without a known one."""
    return COLOURS.get(name) or list(COLOURS.values())[index % len(COLOURS)]


def axis_texts(calibrated: bool, y_min: float | None = None, y_max: float | None = None) -> tuple[str, str, float, float | None]:
    """Labels of both axes and the limits of y: the calibrated ones, or from 0 up to the curves' own."""
    if calibrated:
        return "2theta (deg)", "Intensity (cps)", y_min or 0.0, y_max
    return "2theta (deg)", "Relative intensity", 0.0, None


def nice_step(span: float, most: int = 8) -> float:
    """The smallest of 1, 2 and 5 times a power of ten that cuts a span into no more than so many parts."""
    raw = max(span, 1e-12) / most
    scale = 10.0 ** np.floor(np.log10(raw))
    return float(next(k * scale for k in (1, 2, 5, 10) if k * scale >= raw * (1 - 1e-9)))


def ticks(low: float, high: float, most: int = 8) -> list[float]:
    step = nice_step(high - low, most)
    return [float(v) + 0.0 for v in np.arange(np.ceil(low / step - 1e-9), np.floor(high / step + 1e-9) + 1) * step]


def write(img: np.ndarray, text: str, row: int, col: int, size: int = 2) -> None:
    """Digits, minus and point with their upper left corner at a place; what lies outside is left out."""
    for k, ch in enumerate(text):
        glyph = np.array([[bits >> b & 1 for b in (2, 1, 0)] for bits in GLYPHS.get(ch, (0,) * 5)], bool).repeat(size, 0).repeat(size, 1)
        top, left = row, col + k * 4 * size
        part = img[max(top, 0) : top + glyph.shape[0], max(left, 0) : left + glyph.shape[1]]
        part[glyph[max(-top, 0) :, max(-left, 0) :][: part.shape[0], : part.shape[1]]] = 0


def breaks(x: np.ndarray) -> list[tuple[int, int]]:
    """Pieces of a curve: a line breaks where a step is over max(3 x median step, 1)."""
    if len(x) < 2:
        return [(0, len(x))]
    step = np.diff(x)
    cut = np.flatnonzero(step > max(3 * float(np.median(step)), 1.0)) + 1
    return list(zip((0, *cut.tolist()), (*cut.tolist(), len(x))))


def plot(curves: list[tuple[np.ndarray, np.ndarray, str | None]], size: tuple[int, int] = (480, 800), y_limits: tuple[float, float | None] = (0.0, None)) -> np.ndarray:
    """A picture of curves (x, y, colour name) with a frame, ticks and numbers; broken where points are missing."""
    rows, cols = size
    img = np.full((rows, cols, 3), 255, np.uint8)
    left, top, right, bottom = int(cols * 0.1), int(rows * 0.06), int(cols * 0.97), int(rows * 0.9)
    img[[top, bottom], left : right + 1] = 0
    img[top : bottom + 1, [left, right]] = 0
    known = [(np.asarray(x, float), np.asarray(y, float), c) for x, y, c in curves if len(x)]
    if not known:
        return img
    lo, hi = min(x.min() for x, _, _ in known), max(x.max() for x, _, _ in known)
    low, high = y_limits[0], y_limits[1] if y_limits[1] is not None else max(max(y.max() for _, y, _ in known) * 1.05, 1e-9)
    across = lambda x: left + (x - lo) / max(hi - lo, 1e-12) * (right - left)
    down = lambda y: bottom - (y - low) / max(high - low, 1e-12) * (bottom - top)
    for v in ticks(lo, hi):
        c = int(round(across(v)))
        img[bottom : bottom + 5, c] = 0
        write(img, f"{v:g}", bottom + 9, c - 4 * len(f"{v:g}"))
    for v in ticks(low, high, 6):
        r = int(round(down(v)))
        img[r, left - 4 : left] = 0
        write(img, f"{v:g}", r - 5, left - 8 - 8 * len(f"{v:g}"))
    for k, (x, y, name) in enumerate(known):
        order = np.argsort(x, kind="stable")
        x, y = x[order], y[order]
        for a, b in breaks(x):
            at = np.arange(int(np.ceil(across(x[a]))), int(across(x[b - 1])) + 1)
            value = np.interp(lo + (at - left) / max(right - left, 1) * (hi - lo), x[a:b], y[a:b])
            line = np.clip(np.rint(down(value)), top, bottom).astype(int)
            for i, c in enumerate(at):
                near = line[max(i - 1, 0) : i + 1]
                img[near.min() : near.max() + 2, c] = colour_of(name, k)
    return img


def png(curves: list[tuple[np.ndarray, np.ndarray, str | None]], size: tuple[int, int] = (480, 800), y_limits: tuple[float, float | None] = (0.0, None)) -> bytes:
    return I.png(plot(curves, size, y_limits))
