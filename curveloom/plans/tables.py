"""The tables that the registered queries read, seen as curves, paragraphs and boxes; each with the SQL of its oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day(ts: str):
    """Days since the epoch, as a double."""
    return F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(86400000000.0)


def user_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as one curve per user: curve, x (days), y (value)."""
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("curve"), day("ts").alias("x"), F.col("value").alias("y"))


USER_POINTS = "SELECT user_id AS curve, epoch_us(ts) / 86400000000.0 AS x, value AS y FROM events"


def daily_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as one curve per event type: curve, x (whole day), y (sum of values), n (events)."""
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("curve"), F.floor(day("ts")).cast("double").alias("x"), "value")
    return rows.groupBy("curve", "x").agg(F.sum("value").alias("y"), F.count("*").alias("n"))


DAILY_POINTS = "SELECT event_type AS curve, floor(epoch_us(ts) / 86400000000.0) AS x, sum(value) AS y, count(*) AS n FROM events GROUP BY 1, 2"

#: Paragraphs that exercise the extractors, which the tables' invented prose does not.
SAMPLES = (
    (1, "Results", "Fig. 1 shows the XRD pattern of the perovskite; peaks at 22.5°, 32.1 degrees and 46 deg are indexed to (1 1 0), (2, 0, 0) and (211)."),
    (2, "Results and Discussion", "As seen in Fig. 2, the phase is pure. On the other hand, Figure 3 shows an impurity phase at 2θ = 28.4° vs. 28.4 deg."),
    (3, "Experimental", "Powder diffraction data (Figs. 4 and S2) were collected at 2 theta of 5 to 90 degrees; the lattice parameter is 3.9 Å."),
    (4, "Introduction", "Metal halide perovskite films, e.g. of Smith et al., DOI 10.1021/acs.jpcc.5b01234, absorb light. See https://doi.org/10.1000/182."),
    (5, "2. Summary", "  Rietveld   refinement of the double perovskite gave space group Fm-3m. Bragg reflections shift!  Is the broadening real? Yes."),
    (6, "Acknowledgements", ""),
    (7, "Crystal structure", "(2021) and (-1 0 4) and (1 −1 0), again (-1 0 4). Supplementary Figure S5a. fig 12b"),
    (8, "References", "PXRD and XRD — the “x–ray diffraction” of A2BB'O6. 200° is no angle of 190 degrees, 180° is."),
    (9, None, "figure [3] and Fig(4), etc. are cited; in Fig. 5, the Scherrer equation and FWHM are used; Figure 5 and Fig. 6 differ."),
)


def samples(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SAMPLES), "id bigint, title string, text string")


def _quote(v) -> str:
    return "NULL" if v is None else str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"


def values_sql(rows, names: str) -> str:
    """A FROM item with the rows as literals."""
    body = ", ".join("(" + ", ".join(_quote(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS v({names})"


def paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The samples, the documents and the conversations as id, text."""
    docs = table(spark, sf_dir, "documents").select((F.col("doc_id") + 1000).alias("id"), "text")
    talk = table(spark, sf_dir, "conversations").select((-(F.col("conv_id") * 1000 + F.col("turn")) - 1).alias("id"), "text")
    return samples(spark).select("id", "text").unionByName(docs).unionByName(talk)


PARAGRAPHS = (
    f"SELECT CAST(id AS BIGINT) AS id, text FROM {values_sql(SAMPLES, 'id, title, text')} "
    "UNION ALL SELECT doc_id + 1000, text FROM documents UNION ALL SELECT -(conv_id * 1000 + turn) - 1, text FROM conversations"
)
