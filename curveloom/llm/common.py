"""Shared pieces: the shared folder, staged tables, global ranks, connected components, word splitting."""

from __future__ import annotations

import atexit
import shutil
import sys
import tempfile
import uuid
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Words are runs of anything but these six ASCII characters (fixed by the data contract).
WORD = r"[^\x20\x09-\x0D]+"

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def shared_base(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or on a local master a private one where it is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    global _own
    if _own is None:
        _own = tempfile.mkdtemp(prefix="curveloom-")
        atexit.register(shutil.rmtree, _own, ignore_errors=True)
    return f"file://{_own}"


_own: str | None = None


#: Bytes of a batch that goes to a Python worker. Spark's own bound of 64 MB is held several times over by each task.
BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's bound on Arrow batches to BATCH_BYTES, so that long texts don't fill the executors' memory."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))
    if now > BATCH_BYTES:
        spark.conf.set(name, f"{BATCH_BYTES}b")


class Workspace:
    """Tables written under the shared folder, which cut lineage and survive the loss of executors."""

    def __init__(self, spark: SparkSession, name: str, root: str | None = None):
        self.spark = spark
        bound_batches(spark)
        self.root = root or f"{shared_base(spark)}/curveloom/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._cl_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Delete staged tables that nothing reads any more."""
        for df in frames:
            self.remove(df._cl_path)

    def _at(self, path: str):
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def remove(self, path: str) -> None:
        fs, where = self._at(path)
        fs.delete(where, True)

    def names(self) -> list[str]:
        """What lies in the folder."""
        fs, where = self._at(self.root)
        return [f.getPath().getName() for f in fs.listStatus(where)] if fs.exists(where) else []

    def write_text(self, name: str, text: str) -> None:
        """A new small file of the folder, in place as a whole."""
        fs, temp = self._at(f"{self.root}/_{name}.{uuid.uuid4().hex}")
        stream = fs.create(temp)
        stream.write(text.encode())
        stream.close()
        if not fs.rename(temp, self._at(f"{self.root}/{name}")[1]):
            raise OSError(f"cannot put {name} in place")

    def read_text(self, name: str) -> str:
        fs, where = self._at(f"{self.root}/{name}")
        stream = fs.open(where)
        text = bytes(stream.readAllBytes()).decode()
        stream.close()
        return text

    def release(self) -> None:
        """Let Spark's cleaner drop the shuffle files of finished stages now, not at the driver's next collection."""
        import gc

        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def global_rank(ws: Workspace, df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """df with a gapless bigint column `rank` from 0 in the given order, without sorting in one task.

    Range partitions are sorted and numbered on their own and the table is staged, so that the numbers hold;
    only one count per partition reaches the driver.
    """
    keyed = df.select("*", *[c.alias(f"__o{i}") for i, c in enumerate(order)])
    keys = [F.col(f"__o{i}").asc() for i in range(len(order))]
    placed = (
        keyed.repartitionByRange(partitions(ws.spark), *keys)
        .sortWithinPartitions(*keys)
        .drop(*[f"__o{i}" for i in range(len(order))])
        .withColumn("__at", F.monotonically_increasing_id())
    )
    placed = ws.stage(placed, name)
    counts = dict(placed.groupBy(F.shiftright("__at", 33).alias("p")).count().collect())
    offsets, total = [], 0
    for p in sorted(counts):
        offsets.append((int(p), total))
        total += counts[p]
    offsets = ws.spark.createDataFrame(offsets, "__p bigint, __offset bigint")
    ranked = placed.join(F.broadcast(offsets), F.shiftright("__at", 33) == F.col("__p"))
    return ranked.withColumn("rank", F.col("__offset") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))).drop("__p", "__offset", "__at")


def _is_stars(edges: DataFrame) -> bool:
    """Whether every u of edges(u > v) has one v, which is no u itself, i.e. v is the smallest of its component."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("up")).unionByName(edges.select(F.col("v").alias("n"), F.lit(0).alias("up")))
    seen = ends.groupBy("n").agg(F.min("up").alias("low"), F.max("up").alias("high"), F.sum("up").alias("times"))
    return not seen.where("high = 1 and (low = 0 or times > 1)").limit(1).count()


def connected_components(ws: Workspace, edges: DataFrame, *, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node that stands in an edge (u, v); component is the smallest node it reaches.

    Alternates the large-star and small-star steps. Every step is a grouped minimum with map-side combination
    and an equi-join whose heavy keys Spark can split; each round is staged in the shared folder. It ends once all is stars.
    Self-loops and null ends are ignored. An empty edge table gives an empty result.
    """
    kind = dict(edges.dtypes)["u"]
    now = ws.stage(
        edges.where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "edges",
    )

    for _ in range(max_rounds):
        if _is_stars(now):
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = ws.stage(large, "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = ws.stage(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small")
        ws.drop(now, large)
        now = small
    else:
        raise RuntimeError("connected components did not settle")
    return (
        now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        .select(F.col("node").cast(kind).alias("node"), F.col("component").cast(kind).alias("component"))
    )


def unit_hash(*parts: Column) -> Column:
    """A double in [0, 1) that depends on the parts only: 52 bits of the MD5 of the parts joined by ':'. Null parts count as 'null'."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def n_words(text: Column) -> Column:
    """Number of words in a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
