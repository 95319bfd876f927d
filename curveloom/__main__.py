"""python -m curveloom COMMAND: the engine's jobs from a shell. Exit code 2 if nothing came of the inputs."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from curveloom.operators import curves, documents, figures, works
from curveloom.sources import curves as io
from curveloom.sources import tei


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="curveloom", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    a = sub.add_parser("sid", help="divergence of digitized curves from true spectra, by file stem")
    a.add_argument("truth"), a.add_argument("digitized"), a.add_argument("--shift", type=float, default=0.0), a.add_argument("--epsilon", type=float, default=1e-12)
    a = sub.add_parser("normalize", help="spectra between 0 and 1, as two-column texts")
    a.add_argument("spectra"), a.add_argument("out"), a.add_argument("--x"), a.add_argument("--y"), a.add_argument("--x-min", type=float), a.add_argument("--x-max", type=float)
    a = sub.add_parser("digitize", help="pictures and tick readings to curves, peaks and a manifest")
    a.add_argument("pictures"), a.add_argument("readings", help="JSON lines: figure_id, axis, px, value"), a.add_argument("out")
    a = sub.add_parser("parse", help="article XML to records and a figure dataset")
    a.add_argument("articles"), a.add_argument("out"), a.add_argument("--only-fitting", action="store_true")
    a = sub.add_parser("discover", help="relevant works of JSON lines, best first, with their PDF candidates")
    a.add_argument("works"), a.add_argument("out"), a.add_argument("--from-year", type=int, default=0), a.add_argument("--to-year", type=int, default=9999)
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    args = _arguments(argv)
    spark = SparkSession.builder.appName(f"curveloom {args.command}").getOrCreate()
    if args.command == "sid":
        out = curves.compare_curves(io.read_spectra(spark, args.truth), io.read_xy(spark, args.digitized), ["curve"], args.shift, args.epsilon)
        n = 0
        for r in out.orderBy("curve").toLocalIterator():
            print(f"{r.curve}\t{r.n}\t{r.forward}\t{r.reverse}\t{r.divergence}")
            n += 1
        return 0 if n else 2
    if args.command == "normalize":
        points = io.read_spectra(spark, args.spectra, args.x, args.y)
        for bound, test in ((args.x_min, ">="), (args.x_max, "<=")):
            points = points if bound is None else points.where(f"x {test} {bound}")
        io.write_xy(curves.normalize_min_max(points, ["curve"]).select("curve", "x", F.col("y_norm").alias("y")), args.out)
        return 0
    if args.command == "digitize":
        readings = spark.read.schema("figure_id string, axis string, px int, value double").json(args.readings)
        made = figures.digitize(figures.pictures(spark, args.pictures), readings)
        io.write_xy(made["points"].select(F.concat_ws("_curve_", "figure_id", F.col("band") + 1).alias("curve"), "x", "y"), f"{args.out}/curves")
        io.write_json(figures.peaks_percent(made["peaks"]), f"{args.out}/peaks")
        io.write_json(made["calibration"], f"{args.out}/calibration")
        io.write_json(io.digitization_manifest(made["curves"].withColumn("paper", F.lit("all"))), f"{args.out}/manifest")
        return 0 if made["curves"].where("ok").limit(1).count() else 2
    if args.command == "parse":
        raw = tei.read(spark, args.articles).checkpoint()
        p = tei.paragraphs(raw).checkpoint()
        f = documents.link_figures(tei.figures(raw), p).checkpoint()
        io.write_json(documents.training_records(f, p, tei.metadata(raw)), f"{args.out}/records", "doc_id")
        io.write_json(documents.figure_dataset(f, p, args.only_fitting), f"{args.out}/figures", "doc_id")
        io.write_json(documents.document_counts(raw, f), f"{args.out}/counts")
        return 0 if raw.where("error is null").limit(1).count() else 2
    found = works.discover(works.by_year(spark.read.schema(works.WORK).json(args.works), args.from_year, args.to_year)).checkpoint()
    io.write_json(works.ranked(found), f"{args.out}/works")
    io.write_json(works.pdf_candidates(found), f"{args.out}/candidates")
    return 0 if found.limit(1).count() else 2


if __name__ == "__main__":
    sys.exit(main())
