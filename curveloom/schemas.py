"""Schemas of the engine's tables and nested rows, as DDL."""

from __future__ import annotations

from dataclasses import dataclass, field

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"
PAGE_BOX = "struct<page:int,x:double,y:double,w:double,h:double>"
TICKS = "array<struct<px:int,value:double>>"
PEAK = "struct<two_theta:double,relative_intensity:double,prominence:double>"
WARNINGS = "array<string>"

CURVE_POINTS = "curve string, i int, x double, y double"
FIGURE_CONTEXT = f"image_path string, figure_id string, caption string, source_pdf string, page int, crop_bbox {BOX}"
CLASSIFICATION = f"is_fitting boolean, confidence double, caption_score double, image_score double, reasons array<string>, warnings {WARNINGS}"
PLOT_CROP = f"data binary, height int, width int, bbox {BOX}, confidence double, warnings {WARNINGS}"
PANEL = f"index int, bbox {BOX}, label string"
AXIS_CALIBRATION = (
    f"x_min double, x_max double, plot_left int, plot_right int, plot_top int, plot_bottom int, method string, confidence double, "
    f"tick_pairs {TICKS}, y_min double, y_max double, y_tick_pairs {TICKS}, y_method string, warnings {WARNINGS}"
)
CURVE = f"two_theta array<double>, intensity array<double>, curve_id string, color string, label string, warnings {WARNINGS}, peaks array<{PEAK}>"


def struct(ddl: str) -> str:
    """Columns as one struct type."""
    out, depth = [], 0
    part = ""
    for ch in ddl + ",":
        depth += ch in "<(" and 1 or ch in ">)" and -1 or 0
        if ch == "," and not depth:
            name, kind = part.strip().split(" ", 1)
            out.append(f"{name}:{kind}")
            part = ""
        else:
            part += ch
    return f"struct<{','.join(out)}>"


PANEL_RESULT = f"panel {struct(PANEL)}, calibration {struct(AXIS_CALIBRATION)}, curves array<{struct(CURVE)}>, warnings {WARNINGS}, output_stem string"
FIGURE_RESULT = f"context {struct(FIGURE_CONTEXT)}, classification {struct(CLASSIFICATION)}, panels array<{struct(PANEL_RESULT)}>, confidence double, warnings {WARNINGS}, output_stem string"
EXTRACTION = f"path array<double>, coverage double, span double, mode string, ok boolean, warnings {WARNINGS}"
ANCHORS = "data_points array<struct<x:double,y:double>>, locations array<struct<col:int,row:int>>"
ANCHOR_CALIBRATION = (
    f"points {struct(ANCHORS)}, image_height int, x_true struct<lo:double,hi:double>, y_true struct<lo:double,hi:double>, x_raw struct<lo:double,hi:double>, warnings {WARNINGS}"
)
BAND_RESULT = f"band int, csv_path string, plot_path string, success boolean, error string, source string, warnings {WARNINGS}"
FIGURE_BANDS = f"figure_id string, bands array<{struct(BAND_RESULT)}>"
PDF_CANDIDATE = "url string, provider string, license string, version string, host_type string, landing_page_url string"
DOWNLOAD = "requested_url string, resolved_url string, provider string, output_path string, sha256 string, size_bytes bigint, page_count int, content_type string, retrieved_at string"
PAPER = (
    "paper_id string, openalex_id string, doi string, title string, authors array<string>, publication_year int, publication_date string, journal string, cited_by_count bigint, "
    f"language string, material_score int, xrd_score int, relevance_score int, matched_query string, pdf_source string, download {struct(DOWNLOAD)}, parser map<string,string>"
)

ALL = {
    k: v
    for k, v in list(globals().items())
    if k.isupper() and k not in ("BOX", "PAGE_BOX", "TICKS", "PEAK", "WARNINGS", "ALL")
}


@dataclass
class AcquisitionConfig:
    """Settings of an acquisition run; the defaults are the engine's."""

    target_count: int = 50
    queries: list[str] = field(default_factory=list)
    candidates_per_query: int = 40
    min_material_score: int = 7
    min_xrd_score: int = 7
    min_pdf_bytes: int = 50 * 1024
    max_pdf_bytes: int = 100 * 1024 * 1024
    allow_cached_content: bool = False
    parser_command: str | None = None
    from_year: int | None = None
    to_year: int | None = None

    def __post_init__(self):
        if self.target_count < 1:
            raise ValueError("target_count must be positive")
        if self.min_pdf_bytes > self.max_pdf_bytes:
            raise ValueError("min_pdf_bytes exceeds max_pdf_bytes")
        if self.from_year and self.to_year and self.from_year > self.to_year:
            raise ValueError("from_year is after to_year")
