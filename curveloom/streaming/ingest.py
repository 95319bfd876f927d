"""Streams of events and files: resumable ingestion, deduplication with a watermark, windows and sessions.

The batch rules hold per trigger; checkpoints make runs resumable, so nothing already taken in is read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def new_files(spark: SparkSession, path: str, glob: str = "*.xml") -> DataFrame:
    """path, time, length and content of files as they arrive; each is seen once per checkpoint."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    return spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)


def event_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    """Parquet events as they arrive, with `ts` as a timestamp."""
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def distinct_within(events: DataFrame, keys: list[str], late: str = "1 day") -> DataFrame:
    """The first row of each key; state is dropped once the watermark passes."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def windowed(events: DataFrame, size: str = "1 day", slide: str | None = None, late: str = "1 day") -> DataFrame:
    """Count and sum of value per window and event type; late rows beyond the watermark are left out."""
    window = F.window("ts", size, slide) if slide else F.window("ts", size)
    rows = events.withWatermark("ts", late).groupBy(window.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return rows.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "1 day", late: str = "1 day") -> DataFrame:
    """Runs of a user's events without a pause of `gap`: the streaming counterpart of splitting curves at gaps."""
    rows = events.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return rows.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "total")


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write all that is there to Parquet and stop; a later call goes on from the checkpoint."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def keep_new(stream: DataFrame, path: str, checkpoint: str, key: str) -> StreamingQuery:
    """Append the rows whose key the table at `path` does not hold yet, one per key."""

    def add(batch: DataFrame, _: int) -> None:
        spark, rows = batch.sparkSession, batch.dropDuplicates([key])
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        if where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
            rows = rows.join(spark.read.parquet(path).select(key), key, "left_anti")
        rows.write.mode("append").parquet(path)

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
