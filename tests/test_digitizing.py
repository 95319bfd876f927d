"""The mask path, drawn plots, the files of a run and the clients of services."""

import json
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from curveloom.functions import images as I
from curveloom.functions import masks as M
from curveloom.functions import plots as P
from curveloom.functions import ticks as T
from curveloom.operators import figures as G
from curveloom.operators import outputs as O
from curveloom.plans.output_queries import DRAWN, drawn_pattern, drawn_pictures
from curveloom.sources import services as V


def framed(img):
    left, top, right, bottom = I.plot_crop(img)["box"]
    inner = img[top:bottom, left:right]
    return inner, M.Frame(*I.axis_frame(inner), 10.0, 80.0)


@pytest.mark.parametrize("name", sorted(DRAWN))
def test_main_peaks_of_drawn_plots(name):
    colour, peaks = DRAWN[name]
    inner, frame = framed(P.plot([(*drawn_pattern(peaks, 3), colour)], (480, 900)))
    (curve,) = M.digitized(inner, frame)
    assert curve.colour == (None if colour == "black" else colour)
    assert [p[0] for p in curve.peaks] == pytest.approx(peaks, abs=1.0) and abs(curve.x[curve.y.argmax()] - peaks[1]) < 1.0


def test_stacks_and_overlays():
    lift = lambda y, by: y + by
    stack = [(x, lift(y, by), c) for (x, y), by, c in ((drawn_pattern((20, 31), 1), 300, "blue"), (drawn_pattern((25, 50), 2), 150, "red"), (drawn_pattern((40, 70), 3), 0, "green"))]
    inner, frame = framed(P.plot(stack, (600, 900)))
    found = M.digitized(inner, frame)
    assert [c.name for c in found] == ["curve_1_blue", "curve_2_red", "curve_3_green"] and all("stacked_curve_band" in c.warnings for c in found)
    for curve, places in zip(found, ((20, 31), (25, 50), (40, 70))):  # steep narrow peaks lose their tips to the rule on leaps
        assert min(abs(curve.x[curve.y.argmax()] - p) for p in places) < 1.0
    bands = M.bands_of([("a", np.eye(90, dtype=bool)), ("b", np.roll(np.eye(90, dtype=bool), 3, 0))], 0, 90)
    assert len(bands) == 1 and bands[0][2:] == (0, 90)


def test_heights_above_shoulders_by_brute_force():
    x, y = drawn_pattern((20, 31, 34, 62), 5)
    peaks = [(20.0, 40.0, 1.0), (31.0, 100.0, 1.0), (34.0, 60.0, 1.0), (62.0, 30.0, 1.0)]
    at = [20.0, 31.0, 34.0, 62.0]
    tall = [np.interp(a, x, y) for a in at]
    want = []
    for i, a in enumerate(at):
        base = [np.percentile(y, 3)]
        for lo, hi in ((a - 2.8, a - 2.0), (a + 2.0, a + 2.8)):
            base.append(max([v for u, v in zip(x, y) if lo <= u <= hi], default=0.0))
        for j, sign in ((i - 1, -1), (i + 1, 1)):
            if 0 <= j < 4 and abs(at[j] - a) <= 10 and tall[j] > 0.9 * tall[i]:
                for o in np.linspace(2.5, 3.5, 11):
                    lo, hi = sorted((a + sign * o, a + sign * (o + 0.8)))
                    v = max([v for u, v in zip(x, y) if lo <= u <= hi], default=0.0)
                    base.append(v if v < 0.98 * tall[i] else 0.0)
        want.append(max(tall[i] - max(base), 0.0))
    assert M.heights_above_shoulders(x, y, peaks) == pytest.approx(want)
    assert M.merged_heights(peaks, [(0, 45.0, 0), (0, 50.0, 0), (0, 0.0, 0), (0, 30.0, 0)]) == [(20.0, 45.0, 1.0), (31.0, 100.0, 1.0), (34.0, 60.0, 1.0), (62.0, 30.0, 1.0)]
    assert M.merged_heights(peaks, peaks[:1]) == peaks


def test_prepared_pictures(spark):
    inner, _ = framed(P.plot([(*drawn_pattern((20, 31)), "blue")], (480, 900)))
    coloured, dark = M.coloured_on_white(inner), M.dark_on_white(P.plot([(*drawn_pattern((20, 31)), "black")], (480, 900)))
    for p in (coloured, dark):
        assert set(np.unique(p)) == {0, 255} and 0.001 < (p == 0).mean() < 0.5
    blank = np.full((100, 200, 3), 255, np.uint8)
    assert M.prepared(blank) == [] and [w for _, *w in M.attempts(blank)] == [[False, False], [True, False], [False, True], [True, True]]
    assert [w for _, *w in M.attempts(255 - blank)] == [[False, True], [True, True]]
    assert M.is_frame_column(np.zeros(50)) and not M.is_frame_column(np.r_[np.zeros(5), np.full(45, 255)]) and not M.is_frame_column(np.full(9, 255))
    images, _ = drawn_pictures(spark)
    made = O.prepared_pictures(images, G.analyse(images)).collect()
    assert {r.figure_id for r in made} == set(DRAWN) and all(bytes(r.content[:4]) == b"\x89PNG" for r in made)
    assert O.debug_pictures(images, G.analyse(images)).count() == 16


def test_plots():
    img = P.plot([(np.array([0.0, 1, 2, 10, 11]), np.array([1.0, 2, 3, 2, 1]), "red")], (200, 300))
    red = (img == P.COLOURS["red"]).all(-1)
    assert red.any() and P.breaks(np.array([0.0, 1, 2, 10, 11])) == [(0, 3), (3, 5)]
    cols = np.flatnonzero(red.any(0))
    assert np.diff(cols).max() > 100  # the line breaks
    assert P.ticks(0, 10) == [0, 2, 4, 6, 8, 10] and P.nice_step(70) == 10 and P.colour_of(None, 8) == P.colour_of(None, 1) and P.colour_of("red", 5) == P.COLOURS["red"]
    assert P.axis_texts(True, None, 7.0) == ("2theta (deg)", "Intensity (cps)", 0.0, 7.0) and P.axis_texts(False)[1:] == ("Relative intensity", 0.0, None)
    data = P.png([])
    assert struct.unpack(">II", data[16:24]) == (800, 480) and zlib.crc32(data[12:29]) == struct.unpack(">I", data[29:33])[0]
    assert T.value_span([(1, 5.0), (2, 10.0), (3, 15.0)]) == (5.0, 20.0) and T.value_span([(1, 5.0)]) is None and T.label_key(0.12345) == 0.123 and T.label_key(12.6) == 13


def test_files_of_a_run(spark, tmp_path):
    images, readings = drawn_pictures(spark)
    made = O.digitize_pictures(images, readings)
    out = f"file://{tmp_path}/run"
    stale = tmp_path / "run" / "pattern_1" / "pattern_1_old.csv"
    stale.parent.mkdir(parents=True)
    stale.write_text("x")
    (stale.parent / "notes.txt").write_text("kept")
    for _ in range(2):  # a second run leaves the same
        written = O.save_run(made["curves"], made["calibration"], out, O.figure_context(images))
    assert written.count() == 20 and not stale.exists() and (stale.parent / "notes.txt").exists()
    folder = tmp_path / "run" / "pattern_2"
    assert sorted(f.name for f in folder.iterdir() if not f.name.startswith(".")) == sorted(f"pattern_2{s}" for s in ("_digitized.xy", "_digitized.png", ".peaks.json", ".json", ".metadata.json"))
    peaks = json.loads((folder / "pattern_2.peaks.json").read_text())
    assert peaks["num_curves"] == 1 and peaks["curves"][0]["num_peaks"] == 4
    table = np.loadtxt(folder / "pattern_2_digitized.xy")
    assert table.shape == (2000, 2) and abs(table[table[:, 1].argmax(), 0] - DRAWN["pattern_2"][1][1]) < 1.0
    assert {r.status: r.n for r in O.outcome_counts(made["curves"]).collect()} == {"success": 4}
    assert O.wide_text([(np.array([1.0, 2]), np.array([3.0, 4])), (np.array([2.0, 3]), np.array([5.0, 6]))]).splitlines()[1:] == ["1 3 nan", "2 4 5", "3 nan 6"]
    assert O.output_folder("/in/a.pdf", True, "a") == "parsed_output" and O.output_folder("/in/set/", False, "a") == "grobid_output/set/a" and O.output_folder("/in", False, "a", "o") == "o/a"


def test_drawn_tables(spark):
    p = spark.createDataFrame([(1, float(x), float(x % 7)) for x in range(50)], "curve int, x double, y double")
    (one,) = O.drawn(p, ["curve"]).collect()
    assert one.name == "1.png" and bytes(one.content[:4]) == b"\x89PNG"
    assert O.overlays(p, p, ["curve"]).first().name == "1_overlay.png"


def test_a_picture_that_fails_keeps_a_row(spark):
    images, readings = drawn_pictures(spark)
    figures = G.analyse(images)
    broken = figures.selectExpr("figure_id", "error", "named_struct('left', 0, 'top', 0, 'right', 0, 'bottom', 0) as box", "frame")
    got = O.mask_curves(images, broken, G.calibrate(figures, readings)).collect()
    assert len(got) == 4 and all(r.error or r.warnings == ["no_curve_pixels_detected"] for r in got)


class Fake:
    """A transport that answers from a list and keeps what it was asked."""

    def __init__(self, *answers):
        self.answers, self.asked = list(answers), []

    def __call__(self, request):
        self.asked.append(request)
        out = self.answers.pop(0)
        if isinstance(out, Exception):
            raise out
        return out


def session(fake, waits, **kw):
    return V.Session(fake, V.RateLimiter(0), sleep=waits.append, **kw)


def test_sessions_try_again():
    waits: list = []
    fake = Fake(V.Response(503), V.Response(429, headers={"Retry-After": "7"}), OSError("gone"), V.Response(200, b'{"a": 1}'))
    assert session(fake, waits).get_json("http://x", {"q": "a b"}) == {"a": 1} and waits == [1.0, 7.0, 4.0] and fake.asked[0].url == "http://x?q=a+b"
    for answer in (V.Response(404, b"no"), V.Response(200, b"<"), V.Response(200, b"[1]")):
        with pytest.raises(V.ServiceError):
            session(Fake(answer), waits).get_json("http://x")
    with pytest.raises(V.ServiceError):
        session(Fake(*[OSError("gone")] * 3), waits, tries=2).get_json("http://x")
    assert session(Fake(V.Response(404)), waits).open_access_record("10.1/a b", "m@x") is None
    assert session(fake := Fake(V.Response(200, b"{}")), waits).open_access_record("10.1/a b", "m@x") == {} and "10.1/a%20b" in fake.asked[0].url
    now = [0.0]
    limiter = V.RateLimiter(0.25, lambda: now[0], waits.append)
    waits.clear()
    limiter.wait(), limiter.wait()
    now[0] = 9.0
    limiter.wait()
    assert waits == [0.25]


def test_parser_client():
    waits: list = []
    fake = Fake(V.Response(503), V.Response(200, b" "), V.Response(200, b"<TEI/>"))
    parser = V.Parser("http://p/", session(fake, waits, tries=0))
    assert parser.full_text("a.pdf", b"%PDF-1") == b"<TEI/>" and waits == [1.0, 2.0]
    assert fake.asked[0].url == "http://p/api/processFulltextDocument" and b'filename="a.pdf"' in fake.asked[0].body and fake.asked[0].body.count(b"teiCoordinates") == 7
    with pytest.raises(V.ServiceError):
        V.Parser("http://p", session(Fake(*[V.Response(500)] * 3), waits, tries=0)).full_text("a.pdf", b"")
    assert V.Parser("http://p", session(Fake(V.Response(200)), waits, tries=0)).is_alive() and not V.Parser("http://p", session(Fake(OSError("x")), waits, tries=0)).is_alive()


PDF = b"%PDF-1.4\n" + b"<< /Type /Page >>\n<< /Type /Pages >>\n<< /Type/Page >>" + b"x" * 60_000 + b"\n%%EOF\n"


def test_pdf_checks():
    assert V.inspect_pdf(PDF) == 2
    for bad in (b"%PDF-1 %%EOF", b"<html>" + PDF[9:], PDF[:-10], PDF * 3):
        with pytest.raises(V.Rejected):
            V.inspect_pdf(bad, most=100_000)
    got = V.fetch_pdf(session(Fake(V.Response(200, PDF, {"Content-Type": "application/pdf"}, "http://y")), []), "http://x?a=1", {"k": "v"})
    assert got["resolved_url"] == "http://y" and got["page_count"] == 2 and got["size_bytes"] == len(PDF)
    with pytest.raises(V.Rejected):
        V.fetch_pdf(session(Fake(V.Response(200, PDF, {"Content-Length": "999999999"})), []), "http://x")


def test_jobs_over_services(spark, tmp_path):
    pdf = PDF

    def answers(request):
        if "bad" in request.url:
            return V.Response(404)
        return V.Response(200, pdf if request.url.endswith(".pdf") else b'{"doi": 1}')

    client = lambda: V.Session(answers, V.RateLimiter(0))
    rows = spark.createDataFrame([("http://x/1.pdf", "1.pdf"), ("http://bad/2.pdf", "2.pdf"), ("http://x/page", "3.pdf")], "url string, name string")
    got = {r.url: r for r in V.download(rows, f"file://{tmp_path}/pdf", client).collect()}
    assert (tmp_path / "pdf" / "1.pdf").read_bytes() == PDF and got["http://x/1.pdf"].page_count == 2 and got["http://bad/2.pdf"].error and got["http://x/page"].error
    assert [f.name for f in (tmp_path / "pdf").iterdir() if not f.name.startswith(".")] == ["1.pdf"]
    keys = spark.createDataFrame([("10.1/a",), ("10.1/bad",), ("10.1/a",), (None,)], "doi string")
    found = {r.doi: r.found for r in V.lookup(keys, "doi", lambda s, k: s.open_access_record(k, "m@x"), client).collect()}
    assert found == {"10.1/a": '{"doi": 1}', "10.1/bad": None}
    record = json.dumps({"best_oa_location": {"url_for_pdf": "http://b"}, "oa_locations": [{"url_for_pdf": "http://b"}, {"url_for_pdf": "http://c"}]})
    places = spark.createDataFrame([(record,), (None,)], "found string").select(V.open_access_locations(F.col("found")).alias("p")).collect()
    assert [x.url_for_pdf for x in places[0].p] == ["http://b", "http://c"]
    assert V.query_filter(2000, 2004).endswith("publication_year:2000-2004") and V.query_filter(2000).endswith(">1999") and V.query_filter(None, 2004).endswith("<2005") and V.query_filter() == "type:article,open_access.is_oa:true"


def test_results_as_columns(spark):
    from curveloom import schemas

    row = {"panels": [{"panel": None, "calibration": {"x_min": 1.0}, "curves": [{"curve_id": "a", "peaks": [{"two_theta": 2.0, "relative_intensity": 1.0, "prominence": 0.0}]}, {"curve_id": "b"}]}, {"curves": [{"curve_id": "c"}]}]}
    df = spark.createDataFrame([json.dumps(row), json.dumps({"panels": []})], "string").selectExpr(f"from_json(value, '{schemas.FIGURE_RESULT}') as r")
    r = F.col("r")
    got = df.select(F.transform(O.all_curves(r), lambda c: c["curve_id"]).alias("ids"), O.first_calibration(r)["x_min"].alias("x"), O.first_curve(r)["curve_id"].alias("c"), F.size(O.first_peaks(r)).alias("n")).collect()
    assert [tuple(x) for x in got] == [(["a", "b", "c"], 1.0, "a", 1), ([], None, None, 0)]
