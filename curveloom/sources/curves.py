"""Readers and writers of spectra and curves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curveloom.operators import curves as C

# Names under which spectra give their axes, by preference.
X_NAMES = ("two_theta_values", "two_theta", "2theta", "x", "x_values")
Y_NAMES = ("intensities", "intensity", "counts", "y", "y_values")


def stem(path: str | Column = "_metadata.file_path") -> Column:
    return F.regexp_extract(path, r"([^/]+?)\.[^./]*$", 1)


def find_key(columns: Sequence[str], wanted: str | None, candidates: Sequence[str], kind: str) -> str:
    """The wanted column, or the first candidate there is; an error that lists the columns otherwise."""
    for name in (wanted,) if wanted else candidates:
        if name in columns:
            return name
    raise KeyError(f"no {kind} column {wanted or 'of ' + ', '.join(candidates)} among: {', '.join(sorted(columns))}")


def finite_values(values: Column) -> Column:
    """An array as doubles; null if it is empty or holds anything that is no finite number."""
    numbers = F.transform(values, lambda v: v.try_cast("double"))
    fine = F.forall(numbers, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), F.lit(False)))
    return F.when((F.size(numbers) > 0) & fine, numbers)


def read_spectra(spark: SparkSession, path: str, x: str | None = None, y: str | None = None, *, strict: bool = True) -> DataFrame:
    """curve, i, x, y of JSON files that hold one spectrum each as two arrays of equal length, in the file's order.

    strict raises for a file whose arrays differ in length or hold anything but finite numbers; else such files are left out.
    """
    rows = spark.read.option("multiLine", True).json(path)
    kx, ky = find_key(rows.columns, x, X_NAMES, "x"), find_key(rows.columns, y, Y_NAMES, "y")
    pairs = rows.select(stem().alias("curve"), finite_values(F.col(kx)).alias("xs"), finite_values(F.col(ky)).alias("ys"))
    fine = F.coalesce(F.size("xs") == F.size("ys"), F.lit(False))
    if strict:
        message = F.concat(F.lit("spectrum "), "curve", F.lit(": axes are no arrays of finite numbers of one length"))
        pairs = pairs.where(F.coalesce(F.assert_true(fine, message).isNull(), F.lit(True)))
    else:
        pairs = pairs.where(fine)
    return pairs.select("curve", F.posexplode(F.arrays_zip("xs", "ys")).alias("i", "p")).select("curve", "i", F.col("p.xs").alias("x"), F.col("p.ys").alias("y"))


def read_xy(spark: SparkSession, path: str) -> DataFrame:
    """curve, x, y of text files with two columns parted by spaces or commas; comments and other lines are left out."""
    lines = spark.read.text(path).select(stem().alias("curve"), F.trim("value").alias("line")).where("line <> '' and not startswith(line, '#')")
    parts = lines.select("curve", F.split("line", r"\s*,\s*|\s+").alias("p"))
    return C.finite(parts.select("curve", F.get("p", F.lit(0)).try_cast("double").alias("x"), F.get("p", F.lit(1)).try_cast("double").alias("y")), "x", "y")


def read_wide_xy(spark: SparkSession, path: str) -> DataFrame:
    """curve, x, y of text files with x and one column per curve; NaN and missing cells are left out."""
    lines = spark.read.text(path).select(stem().alias("file"), F.trim("value").alias("line")).where("line <> '' and not startswith(line, '#')")
    parts = lines.select("file", F.split("line", r"\s*,\s*|\s+").alias("p"))
    long = parts.select("file", F.get("p", F.lit(0)).try_cast("double").alias("x"), F.posexplode(F.slice("p", 2, 1 << 20)).alias("k", "v"))
    return C.finite(long.select(F.concat("file", F.lit("_curve_"), (F.col("k") + 1).cast("string")).alias("curve"), "x", F.col("v").try_cast("double").alias("y")), "x", "y")


def peak_position(points: DataFrame, curve: Sequence[str] = ("curve",)) -> DataFrame:
    """The x of the highest y of each curve."""
    return points.groupBy(*curve).agg(F.max_by("x", F.struct("y", -F.col("x"))).alias("peak_x"), F.max("y").alias("peak_y"))


def read_manifest(spark: SparkSession, path: str, existing: DataFrame | None = None) -> DataFrame:
    """Rows of a JSON-lines manifest without blank and malformed lines; with existing(path) only those whose output is there."""
    rows = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path)
    if "_bad" in rows.columns:
        rows = rows.where("_bad is null").drop("_bad")
    if "download" not in rows.columns:
        return rows.limit(0)
    rows = rows.where("download.output_path is not null")
    return rows if existing is None else rows.join(existing.select(F.col("path").alias("__p")), F.col("download.output_path") == F.col("__p"), "left_semi")


def list_files(spark: SparkSession, path: str, glob: str = "*.pdf") -> DataFrame:
    """path, length and time of the files under a path that match, without their content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select("path", "length", "modificationTime").dropDuplicates(["path"])


def first_existing(rows: DataFrame, path: str, folders: Sequence[str], files: DataFrame) -> DataFrame:
    """rows with `found`: the first of folder + path, by the order of folders, that files(path) lists; null if none."""
    tries = F.array(*[F.struct(F.lit(i).alias("k"), F.when(F.col(path).startswith("/"), F.col(path)).otherwise(F.concat(F.lit(f), F.col(path))).alias("p")) for i, f in enumerate(folders)])
    known = files.select(F.regexp_replace("path", "^file:/+", "/").alias("__p")).distinct()
    keyed = rows.withColumn("__id", F.monotonically_increasing_id())
    hits = keyed.select("__id", F.explode(tries).alias("t")).join(known, F.col("t.p") == F.col("__p")).groupBy("__id").agg(F.min_by("t.p", "t.k").alias("found"))
    return keyed.join(hits, "__id", "left").drop("__id")


def pending(files: DataFrame, done: DataFrame, key: str = "stem") -> DataFrame:
    """Files whose stem has no output yet."""
    return files.withColumn(key, stem("path")).join(done.select(key).distinct(), key, "left_anti")


def as_g(c: Column) -> Column:
    """A number with six significant digits, halves up, without trailing zeros; very large and small ones with an exponent."""
    rounded = F.format_string("%.5e", c.cast("double"))
    e = F.substring_index(rounded, "e", -1).try_cast("int")
    plain = F.regexp_replace(rounded.try_cast("double").try_cast("decimal(38,12)").cast("string"), r"\.?0+$", "")
    return F.when(c == 0, F.lit("0")).when((e < -4) | (e >= 6), F.regexp_replace(rounded, r"\.?0*e", "e")).otherwise(plain)


def write_xy(points: DataFrame, path: str, curve: str = "curve") -> None:
    """One folder of `x y` lines per curve, in the order of x."""
    lines = points.select(curve, "x", F.concat_ws(" ", as_g(F.col("x")), as_g(F.col("y"))).alias("value"))
    lines.repartition(curve).sortWithinPartitions(curve, "x").select(curve, "value").write.mode("overwrite").partitionBy(curve).text(path)


def write_wide_xy(points: DataFrame, path: str, ids: Sequence[str], n: int = 2000, curve: str = "curve") -> None:
    """One text of x and a column per curve on a common grid, NaN outside a curve; a single curve keeps its points; a comment for none."""
    if not ids:
        points.sparkSession.createDataFrame([("# no curves",)], "value string").coalesce(1).write.mode("overwrite").text(path)
        return
    if len(ids) == 1:
        rows = points.where(F.col(curve) == ids[0]).select("x", F.col("y").alias(ids[0]))
    else:
        rows = C.wide_curves(points.where(F.col(curve).isin(*ids)), curve, ids, n)
    cells = [F.coalesce(as_g(F.col(c)), F.lit("nan")) for c in ids]
    rows.select("x", F.concat_ws(" ", as_g(F.col("x")), *cells).alias("value")).repartitionByRange(1, "x").sortWithinPartitions("x").select("value").write.mode("overwrite").text(path)


def write_json(rows: DataFrame, path: str, partition: str | None = None) -> None:
    """JSON lines, committed as a whole by Spark's protocol."""
    w = rows.write.mode("overwrite")
    (w.partitionBy(partition) if partition else w).json(path)


def append_json(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def digitization_manifest(curves: DataFrame, paper: str = "paper") -> DataFrame:
    """One row per paper: its figures and their bands, in order."""
    bands = curves.groupBy(paper, "figure_id").agg(F.sort_array(F.collect_list(F.struct("band", "mode", "coverage", "span", "ok"))).alias("bands"))
    return bands.groupBy(paper).agg(F.sort_array(F.collect_list(F.struct("figure_id", "bands"))).alias("figures"))
