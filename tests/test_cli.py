"""The command line, the command hook and the schemas."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curveloom import __main__ as cli
from curveloom import schemas
from curveloom.functions import images as I
from curveloom.functions import signal as S
from curveloom.operators import calibration, hooks
from curveloom.plans.document_queries import TEI, WORKS


def test_sid(spark, tmp_path, capsys):
    (tmp_path / "truth").mkdir(), (tmp_path / "made").mkdir()
    (tmp_path / "truth/a.json").write_text('{"two_theta_values": [1, 2, 3], "intensities": [1, 2, 1]}')
    (tmp_path / "made/a.xy").write_text("1 1\n2 2\n3 1\n")
    assert cli.main(["sid", str(tmp_path / "truth"), str(tmp_path / "made")]) == 0
    assert float(capsys.readouterr().out.split("\t")[-1]) == pytest.approx(0, abs=1e-9)
    assert cli.main(["normalize", str(tmp_path / "truth"), str(tmp_path / "n")]) == 0
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "n")).collect()) == ["1 0", "2 1", "3 0"]


def test_digitize(spark, tmp_path):
    x = np.linspace(5, 80, 2000)
    (tmp_path / "in").mkdir()
    (tmp_path / "in/figure_7.png").write_bytes(I.png(I.draw_curves([(x, S.gaussians([(40.0, 100.0, 0)], x, 1.2))])))
    ticks = [{"figure_id": "figure_7", "axis": "x", "px": int(6 + (v - 5) / 75 * 690), "value": v} for v in range(10, 80, 10)]
    (tmp_path / "t.jsonl").write_text("\n".join(map(json.dumps, ticks)))
    assert cli.main(["digitize", str(tmp_path / "in"), str(tmp_path / "t.jsonl"), str(tmp_path / "out")]) == 0
    peaks = spark.read.json(str(tmp_path / "out/peaks")).first().peaks
    assert [p.two_theta for p in peaks] == pytest.approx([40], abs=1.0) and peaks[0].relative_intensity == 100
    assert spark.read.json(str(tmp_path / "out/manifest")).first().figures[0].figure_id == "figure_7"


def test_parse_and_discover(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x/p.tei.xml").write_text(TEI)
    (tmp_path / "x/q.xml").write_text("<TEI")
    assert cli.main(["parse", str(tmp_path / "x"), str(tmp_path / "o")]) == 0
    assert {r.doc_id for r in spark.read.json(str(tmp_path / "o/records")).collect()} == {"p"}
    (tmp_path / "w.jsonl").write_text("\n".join(map(json.dumps, WORKS)))
    assert cli.main(["discover", str(tmp_path / "w.jsonl"), str(tmp_path / "d"), "--from-year", "2019"]) == 0
    assert [r.id[-2:] for r in spark.read.json(str(tmp_path / "d/works")).collect()] == ["W1"]


def test_commands(spark):
    rows = spark.createDataFrame([(1, "a b; rm"), (2, "x")], "k int, v string")
    got = {r.k: r for r in hooks.run_command(rows, "printf %s {v}", "k", ["v"]).collect()}
    assert got[1].stdout == "a b; rm" and got[1].status == "success"
    assert {r.status for r in hooks.run_command(rows, "no-such-program {v}", "k", ["v"]).collect()} == {"failed"}
    assert {r.return_code for r in hooks.run_command(rows, "false", "k", []).collect()} == {1}
    with pytest.raises(ValueError):
        hooks.run_command(rows, "", "k", [])


@pytest.mark.parametrize("name", sorted(schemas.ALL))
def test_schemas(spark, name):
    assert isinstance(T._parse_datatype_string(schemas.ALL[name]), T.StructType)


def test_config():
    assert schemas.AcquisitionConfig().min_xrd_score == 7
    for bad in ({"target_count": 0}, {"min_pdf_bytes": 9, "max_pdf_bytes": 1}, {"from_year": 2, "to_year": 1}):
        with pytest.raises(ValueError):
            schemas.AcquisitionConfig(**bad)


def test_forward_model(spark):
    """Points that the anchors' own model produces come back to the true axis."""
    frame = spark.createDataFrame([("f", 50, 650, 20, 420, 480, 10.0, 70.0, 200.0)], "figure_id string, plot_left int, plot_right int, plot_top int, plot_bottom int, image_height int, x_min double, x_max double, y_scale double")
    built = calibration.build(frame)
    lines = built.select(calibration.axis_lines(F.col("locations"), F.col("data_points")).alias("l")).first().l
    raw = [("f", -(px - lines.x_slope) / lines.x_intercept, float(i)) for i, px in enumerate((50.0, 350.0, 650.0))]
    got = calibration.correct(spark.createDataFrame([*raw, ("f", 0.0, None)], "figure_id string, x double, y double"), built).orderBy("y").collect()
    assert [r.x for r in got] == pytest.approx([10, 40, 70], abs=1e-3) and [r.y for r in got] == [0, 100, 200]
