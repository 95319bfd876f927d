"""Operators whose behaviour SQL does not show."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from curveloom.functions import images as I
from curveloom.functions import signal as S
from curveloom.operators import curves as C
from curveloom.operators import dedup, figures, works
from curveloom.plans.document_queries import sample_works
from curveloom.sources import curves as R
from curveloom.streaming import ingest


def points(spark, ys, curve="a"):
    return spark.createDataFrame([(curve, float(i), float(y)) for i, y in enumerate(ys)], "curve string, x double, y double")


def test_divergence(spark):
    rows = spark.createDataFrame([("same", 1.0, 2.0), ("same", 3.0, 6.0), ("other", 1.0, 3.0), ("other", 3.0, 1.0), ("bad", -1.0, 1.0), ("zero", 0.0, 1.0)], "k string, p double, q double")
    got = {r.k: r for r in C.spectral_divergence(rows, ["k"]).collect()}
    assert got["same"].divergence == pytest.approx(0, abs=1e-12)
    p, q = np.array([0.25, 0.75]), np.array([0.75, 0.25])
    assert got["other"].forward == pytest.approx((p * np.log(p / q)).sum()) and got["other"].divergence == pytest.approx(((p - q) * np.log(p / q)).sum())
    assert got["bad"].divergence is None and got["zero"].divergence is None


def test_interpolation_is_numpys(spark):
    rng = np.random.default_rng(0)
    kx, ky, gx = np.sort(rng.random(20)), rng.random(20), np.concatenate((rng.random(30) * 1.4 - 0.2,))
    knots = spark.createDataFrame([("a", float(x), float(y)) for x, y in zip(kx, ky)], "curve string, x double, y double")
    grid = spark.createDataFrame([("a", float(x)) for x in [*gx, kx[3]]], "curve string, x double")
    got = {r.x: r.y for r in C.interpolate(grid, knots, ["curve"]).collect()}
    assert all(got[x] == pytest.approx(np.interp(x, kx, ky)) for x in got)
    inside = {r.x: r.y for r in C.interpolate(grid, knots, ["curve"], outside="null").collect()}
    assert all((y is None) == (x < kx[0] or x > kx[-1]) for x, y in inside.items())


def test_segments_fall_back_to_the_whole(spark):
    p = spark.createDataFrame([("a", 0.0, 1.0), ("a", 1.0, 1.0), ("a", 50.0, 1.0), ("a", 51.0, 1.0)], "curve string, x double, y double")
    assert {r.segment for r in C.split_segments(p, ["curve"]).collect()} == {0}


def test_constant_curves(spark):
    assert {r.y_norm for r in C.normalize_min_max(points(spark, [2, 2, 2]), ["curve"]).collect()} == {0.0}
    assert {r.y_norm for r in C.normalize_percentile(points(spark, [0, 0, -1]), ["curve"]).collect()} == {0.0, -1.0}


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "s/one.json").write_text('{"two_theta_values": [3, 1, 2], "intensities": [5, 9, 1]}')
    assert [(r.i, r.x, r.y) for r in R.read_spectra(spark, str(tmp_path / "s")).orderBy("i").collect()] == [(0, 3, 5), (1, 1, 9), (2, 2, 1)]
    (tmp_path / "s/bad.json").write_text('{"two_theta_values": [3, 1], "intensities": [5]}')
    assert {r.curve for r in R.read_spectra(spark, str(tmp_path / "s"), strict=False).collect()} == {"one"}
    with pytest.raises(Exception, match="no arrays of finite"):
        R.read_spectra(spark, str(tmp_path / "s")).collect()
    with pytest.raises(KeyError, match="among: a"):
        R.find_key(["a"], None, R.X_NAMES, "x")
    (tmp_path / "c.xy").write_text("# made\n3 4\n1,2\nx y\n2\t nan\n")
    assert sorted((r.x, r.y) for r in R.read_xy(spark, str(tmp_path / "c.xy")).collect()) == [(1, 2), (3, 4)]
    assert R.peak_position(R.read_xy(spark, str(tmp_path / "c.xy"))).first().peak_x == 3
    R.write_xy(points(spark, [0.5, 1234567, 0.00001234]), str(tmp_path / "out"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == ["0 0.5", "1 1.23457e+06", "2 1.234e-05"]
    R.write_wide_xy(points(spark, [1, 2]).unionByName(points(spark, [3, 4, 5], "b")), str(tmp_path / "wide"), ["a", "b"], 3)
    assert [r.value for r in spark.read.text(str(tmp_path / "wide")).collect()] == ["0 1 3", "1 2 4", "2 nan 5"]
    assert R.read_wide_xy(spark, str(tmp_path / "wide")).count() == 5


@pytest.mark.parametrize("v", [0.0, 1.0, 12.5, 0.1, 123456.0, 1234567.0, 0.00012345678, 1e-9, -3.25, 99999.94])
def test_as_g(spark, v):
    assert spark.range(1).select(R.as_g(F.lit(v))).first()[0] == f"{v:g}"


def test_manifest(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('{"id": 1, "download": {"output_path": "/a"}}\n\nnot json\n{"id": 2, "download": {"output_path": "/b"}}\n{"id": 3}\n')
    rows = R.read_manifest(spark, str(tmp_path / "m.jsonl"), spark.createDataFrame([("/b",)], "path string"))
    assert [r.id for r in rows.collect()] == [2]


def test_key_groups(spark):
    rows = spark.createDataFrame([(1, ["a"]), (2, ["a", "b"]), (3, ["b", "c"]), (4, ["d"]), (5, []), (6, ["c"])], "id int, keys array<string>")
    assert {r.id: r.group for r in dedup.key_groups(rows, "id", "keys").collect()} == {1: 1, 2: 1, 3: 1, 6: 1, 4: 4, 5: 5}


def test_sequential_rule_differs_from_groups(spark):
    rows = spark.createDataFrame([("g", 1, ["a"], 5), ("g", 2, ["b"], 6), ("g", 3, ["a", "b"], 9)], "g string, i int, keys array<string>, s int")
    out = dedup.keep_best_in_order(rows, ["g"], "i", "keys", "s", rows.schema)
    assert sorted(r.i for r in out.collect()) == [2, 3]
    assert [r.i for r in dedup.keep_best(rows, "i", F.col("keys"), [F.desc("s")]).collect()] == [3]


def test_similar_curves(spark):
    rows = spark.createDataFrame([("g", 1, [1.0, 2.0, 3.0]), ("g", 2, [2.0, 4.0, 6.1]), ("g", 3, [3.0, 1.0, 2.0]), ("g", 4, [1.0, 1.0, 1.0])], "g string, i int, y array<double>")
    assert sorted(r.i for r in dedup.distinct_curves(rows, ["g"], "i", "y").collect()) == [1, 3, 4]


def test_pictures_from_files(spark, tmp_path):
    x = np.linspace(5, 80, 2000)
    img = I.draw_curves([(x, S.gaussians([(30.0, 100.0, 0), (60.0, 50.0, 0)], x, 1.2))])
    (tmp_path / "figure_1.png").write_bytes(I.png(img))
    (tmp_path / "broken.png").write_bytes(b"no picture")
    images = figures.pictures(spark, str(tmp_path))
    row = images.first()
    assert images.count() == 1 and row.figure_id == "figure_1" and np.array_equal(figures.decode(row.asDict()), img)
    readings = spark.createDataFrame([("figure_1", "x", int(6 + (v - 5) / 75 * 690), float(v)) for v in range(10, 80, 10)], "figure_id string, axis string, px int, value double")
    out = figures.digitize(images, readings)
    assert [p.two_theta for p in out["peaks"].first().peaks] == pytest.approx([30, 60], abs=1.0)
    assert 0 < out["confidence"].first().confidence < 1


def test_acquisition(spark):
    w = works.discover(sample_works(spark))
    c = works.pdf_candidates(w)
    pdf = bytearray(b"%PDF-" + bytes(60_000))
    contents = spark.createDataFrame([("https://b.org/x.PDF?d=1", pdf), ("https://a.org/1.pdf", bytearray(b"<html>")), ("http://d.org/z.pdf", pdf)], "url string, content binary")
    got = works.acquisition(w, c, contents)
    assert [(r.id[-2:], r.url) for r in got.collect()] == [("W1", "https://b.org/x.PDF?d=1")]
    assert works.records(w, got).first().paper_id == "doi:10.1/a"
    assert works.acquisition(w, c, contents, known=got.select("sha256")).count() == 0


def test_streams(spark, tmp_path, small):
    src = spark.read.parquet(f"{small}/events.parquet")
    src.where("event_id % 2 = 0").write.parquet(str(tmp_path / "in"))
    schema = src.schema
    stream = lambda: ingest.event_stream(spark, str(tmp_path / "in"), schema)

    def drain():
        ingest.append_to(ingest.distinct_within(stream(), ["event_id"], "60 days"), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
        return spark.read.parquet(str(tmp_path / "out")).count()

    first = src.where("event_id % 2 = 0").count()
    assert drain() == first
    src.where("event_id % 2 = 1").write.mode("append").parquet(str(tmp_path / "in"))
    assert drain() == src.count()
    for _ in range(2):
        ingest.keep_new(stream().select("event_type"), str(tmp_path / "types"), str(tmp_path / f"ck{_}"), "event_type").awaitTermination()
    assert spark.read.parquet(str(tmp_path / "types")).count() == src.select("event_type").distinct().count()
    query = ingest.windowed(stream()).writeStream.format("memory").queryName("cl_w").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("cl_w").agg(F.sum("n")).first()[0] == src.count()
    query = ingest.sessions(stream()).writeStream.format("memory").queryName("cl_s").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("cl_s").agg(F.sum("n")).first()[0] == src.count()
