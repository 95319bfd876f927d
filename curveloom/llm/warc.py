"""A deterministic sharded WARC writer and its reader."""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import sys
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from curveloom.llm.common import Workspace, partitions

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of payloads and headers that a writer takes on, and the compressed size at which it goes on in another file.
SHARD_BYTES, ROLL_BYTES = 64 << 20, 16 << 20
#: What a record's headers are reckoned at when records are dealt to writers.
HEAD_BYTES = 512
#: Payloads of fewer bytes are never deduplicated.
LEAST_REVISIT = 0
#: Every record carries this date, so that a rerun writes the same bytes.
DATE = "2024-01-01T00:00:00Z"
SPEC = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload(html: Column) -> Column:
    return F.coalesce(F.encode(html.cast("string"), "UTF-8"), F.lit(b""))


def record_id(page_id, place: int) -> str:
    """Named by the page and the record's place in the order of all records."""
    return f"<urn:curveloom:page:{'null' if page_id is None else page_id}:{place}>"


def record(page_id, place: int, url: str | None, body: bytes, refers_to, refers_place: int | None = None) -> bytes:
    """One gzip member with the record's regenerated headers; a revisit keeps the length but not the payload."""
    digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + body
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or f"urn:curveloom:page:{page_id}")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, place)}",
        f"WARC-Target-URI: {target}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Profile: {SPEC}", f"WARC-Refers-To: {record_id(refers_to, refers_place or 0)}"]
    whole = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(whole, 6, mtime=0)


def packed(pages: DataFrame) -> DataFrame:
    """page_id, url, sha, n, body: payloads compressed for the way to their writers, where they are most of what is moved."""
    kind = dict(pages.dtypes)["page_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = [b or b"" for b in batch.column(2).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([hashlib.sha1(b).hexdigest() for b in bodies], pa.string()),
                    pa.array([len(b) for b in bodies], pa.int64()),
                    pa.array([pa.compress(b, codec="zstd", asbytes=True) for b in bodies], pa.binary()),
                ],
                ["page_id", "url", "sha", "n", "body"],
            )

    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, f"page_id {kind}, url string, sha string, n bigint, body binary")


def running_totals(ws: Workspace, df: DataFrame, order: list[Column], amounts: dict[str, str], name: str) -> DataFrame:
    """df with, for each new column of amounts, the sum of the amount named over all rows before this one in the given order.

    Range partitions are sorted and summed on their own; one row of totals per partition reaches the driver.
    """
    keyed = df.select("*", *[c.alias(f"__o{i}") for i, c in enumerate(order)])
    keys = [F.col(f"__o{i}").asc() for i in range(len(order))]
    placed = keyed.repartitionByRange(partitions(ws.spark), *keys).sortWithinPartitions(*keys).drop(*[f"__o{i}" for i in range(len(order))])
    placed = ws.stage(placed.withColumn("__at", F.monotonically_increasing_id()).withColumn("__p", F.shiftright("__at", 33)), name)
    done, offsets = [0] * len(amounts), []
    for p, *sums in sorted(placed.groupBy("__p").agg(*[F.sum(a).cast("bigint") for a in amounts.values()]).collect()):
        offsets.append((p, *done))
        done = [x + (y or 0) for x, y in zip(done, sums)]
    offsets = ws.spark.createDataFrame(offsets, ", ".join(["__q bigint", *(f"__b_{n} bigint" for n in amounts)]))
    before = W.partitionBy("__p").orderBy("__at").rowsBetween(W.unboundedPreceding, -1)
    summed = placed.select("*", *[F.coalesce(F.sum(a).over(before), F.lit(0)).alias(f"__s_{n}") for n, a in amounts.items()])
    found = summed.join(F.broadcast(offsets), F.col("__p") == F.col("__q"))
    return found.select(*df.columns, *[(F.col(f"__s_{n}") + F.col(f"__b_{n}")).cast("bigint").alias(n) for n in amounts])


def plan(ws: Workspace, pages: DataFrame, least: int = LEAST_REVISIT, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(id, hash of the url, sha, refers_to, refers_place, shard, place, copies) of the equal rows of each page id, url and payload.

    Records are ordered by page id (null last), payload digest and url. Shards are runs of this order of about shard_bytes; equal
    rows that go past a shard's end are dealt to the next, so that they have a row for each shard they are in.
    """
    small = pages.groupBy("page_id", "link", "sha", "n").agg(F.count("*").alias("copies"))
    small = small.withColumn("bytes", (F.col("n") + HEAD_BYTES) * F.col("copies"))
    order = [F.col("page_id").isNull(), F.col("page_id"), F.col("sha"), F.col("link")]
    placed = ws.stage(running_totals(ws, small, order, {"place": "copies", "start": "bytes"}, "order"), "places")
    # The record with the smallest page id (null last) of a payload is the first of it in the order.
    first = placed.where(f"n >= {least}").groupBy(F.col("sha").alias("__sha"))
    first = first.agg(F.min_by(F.struct("page_id", "place"), "place").alias("__first"), F.count("*").alias("__rows")).where("__rows > 1").drop("__rows")
    size = F.col("n") + HEAD_BYTES
    shards = F.sequence(F.floor(F.col("start") / shard_bytes), F.floor((F.col("start") + F.col("bytes") - size) / shard_bytes))
    out = placed.join(first, F.col("sha") == F.col("__sha"), "left").select("*", F.explode(shards).alias("shard"))
    edge = lambda s: F.least(F.col("copies"), F.greatest(F.lit(0), F.ceil((s * shard_bytes - F.col("start")) / size)))
    out = out.withColumn("__from", edge(F.col("shard"))).withColumn("__to", edge(F.col("shard") + 1)).where("__to > __from")
    revisit = F.col("__first").isNotNull() & F.col("__first.page_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("__first.page_id"))
    return ws.stage(
        out.select(
            F.col("page_id").alias("__id"),
            F.col("link").alias("__link"),
            F.col("sha").alias("__sha"),
            F.when(revisit, F.col("__first.page_id")).alias("refers_to"),
            F.when(revisit, F.col("__first.place")).alias("refers_place"),
            F.col("shard").cast("bigint").alias("shard"),
            (F.col("place") + F.col("__from")).alias("place"),
            (F.col("__to") - F.col("__from")).alias("copies"),
        ),
        "plan",
    )


def write_warc(pages: DataFrame, out: str, *, roll: int = ROLL_BYTES, least: int = LEAST_REVISIT, shard_bytes: int = SHARD_BYTES) -> list[dict]:
    """Write pages(page_id, url, html) as gzipped WARC files under `out`; returns the manifest's entries.

    Records are range-sorted by page id, payload digest and url. A writer takes a run of about shard_bytes of them, cut by the
    sizes of the rows alone, and rolls to the next file at `roll` compressed bytes; headers and digests are made anew, and files
    are named by their content: the same rows give the same files, however many tasks write them. A task writes under temporary
    names of its own; only files that a finished task reports are renamed, and a new manifest is put in place last, upon which
    what it does not name is removed. Of the pages with equal payloads those with the smallest page id are responses and the
    others revisit it. Null html is an empty payload, null urls name the page, null page ids come last, repeated rows are
    written each and may be dealt to several writers; an empty table gives an empty manifest.
    """
    spark = pages.sparkSession
    ws = Workspace(spark, "warc-plan")
    link = F.xxhash64(F.coalesce(F.concat(F.lit("u"), F.col("url").cast("string")), F.lit("")))
    body = payload(F.col("html"))
    chosen = plan(ws, pages.select("page_id", link.alias("link"), F.sha1(body).alias("sha"), F.length(body).cast("bigint").alias("n")), least, shard_bytes)
    shards = (chosen.agg(F.max("shard")).first()[0] or 0) + 1
    # Equal rows travel as one. The keys have no nulls, so that the join takes the groups where they lie.
    key = lambda c: F.coalesce(F.concat(F.lit("p"), F.col(c).cast("string")), F.lit(""))
    rows = packed(pages).withColumn("link", link).groupBy(key("page_id").alias("key"), "link", "sha")
    rows = rows.agg(*[F.any_value(c).alias(c) for c in ("page_id", "url", "body", "n")])
    chosen = chosen.withColumn("__key", key("__id"))
    rows = rows.join(chosen, (F.col("key") == F.col("__key")) & (F.col("link") == F.col("__link")) & (F.col("sha") == F.col("__sha")))
    rows = rows.select("shard", "page_id", "place", "copies", "refers_to", "refers_place", "url", "body", "n")
    rows = rows.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pyarrow.fs.FileSystem.from_uri(out)
        fs.create_dir(f"{root}/_temporary", recursive=True)
        now, seq, file, done = None, 0, None, []

        def close():
            nonlocal file
            if file:
                sink, temp, size, count, sha = file
                sink.close()
                done.append((f"part-{now:08d}-{seq:04d}-{sha.hexdigest()[:16]}.warc.gz", temp, size, count, sha.hexdigest()))
                file = None

        for batch in batches:
            for i in range(batch.num_rows):
                shard, page, place, copies, refers, refers_place, url, body, size = (column[i].as_py() for column in batch.columns)
                body = pa.decompress(body, size, codec="zstd", asbytes=True)
                if shard != now:
                    close()
                    now, seq = shard, 0
                for k in range(copies):
                    data = record(page, place + k, url, body, refers, refers_place)
                    if file and file[2] + len(data) > roll:
                        close()
                        seq += 1
                    if not file:
                        temp = f"{root}/_temporary/{uuid.uuid4().hex}"
                        file = [fs.open_output_stream(temp), temp, 0, 0, hashlib.sha256()]
                    file[0].write(data)
                    file[4].update(data)
                    file[2] += len(data)
                    file[3] += 1
        close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], ["name", "temp", "bytes", "records", "sha256"])

    entries = ws.stage(rows.mapInArrow(run, "name string, temp string, bytes bigint, records bigint, sha256 string"), "written")
    found = [r.asDict() for r in entries.orderBy("name").collect()]
    _commit(spark, out, found)
    return found


def _folder(spark: SparkSession, out: str):
    """Hadoop's Path class, the file system of `out`, and the numbers of its manifests, newest last."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(out).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(path(out))] if fs.exists(path(out)) else []
    return path, fs, sorted(int(m[1]) for n in names if (m := MANIFEST.fullmatch(n))), names


MANIFEST = re.compile(r"_manifest-(\d{8})\.json")


def _commit(spark: SparkSession, out: str, entries: list[dict]) -> None:
    """Rename the reported files, put the next manifest in place, then drop the former one, its files and what attempts have left.

    A file's name tells its content, so a file that is there already need not be written again, and until the new manifest is in
    place a reader finds the former one and all its files.
    """
    path, fs, numbers, names = _folder(spark, out)
    fs.mkdirs(path(out))
    for e in entries:
        temp, final = path(f"{out}/_temporary/{e.pop('temp').rsplit('/', 1)[1]}"), path(f"{out}/{e['name']}")
        if e["name"] in names and fs.getFileStatus(final).getLen() == e["bytes"]:
            fs.delete(temp, False)
        elif not fs.rename(temp, final):
            raise OSError(f"cannot rename {temp} to {final}")
    temp, final = path(f"{out}/_temporary/{uuid.uuid4().hex}"), path(f"{out}/_manifest-{(numbers or [0])[-1] + 1:08d}.json")
    stream = fs.create(temp)
    stream.write(json.dumps(entries, indent=1).encode())
    stream.close()
    if not fs.rename(temp, final):
        raise OSError(f"cannot rename {temp} to {final}")
    named = {e["name"] for e in entries}
    for name in names:
        if MANIFEST.fullmatch(name) or PART.fullmatch(name) and name not in named:
            fs.delete(path(f"{out}/{name}"), False)
    fs.delete(path(f"{out}/_temporary"), True)


PART = re.compile(r"part-\d{8,}-\d{4,}-[0-9a-f]{16}\.warc\.gz")


def parse(data: bytes, step: int = 1 << 16) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of one gzipped WARC file, member by member; the work grows with the file's size."""
    at = 0
    while at < len(data):
        member, parts = zlib.decompressobj(31), []
        while not member.eof:
            if at >= len(data):
                raise ValueError("a record is cut off")
            parts.append(member.decompress(data[at : at + step]))
            at += step
        at = min(at, len(data)) - len(member.unused_data)
        whole = b"".join(parts)
        head, _, tail = whole.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        size = int(fields["Content-Length"])
        if tail[size:] != b"\r\n\r\n":
            raise ValueError("a record's length is wrong")
        yield fields, tail[:size]


def read_manifest(spark: SparkSession, out: str) -> list[dict]:
    """The entries of the newest manifest under `out`."""
    path, fs, numbers, _ = _folder(spark, out)
    if not numbers:
        raise FileNotFoundError(f"no manifest in {out}")
    stream = fs.open(path(f"{out}/_manifest-{numbers[-1]:08d}.json"))
    entries = json.loads(bytes(stream.readAllBytes()))
    stream.close()
    return entries


def read_warc(spark: SparkSession, out: str, kind: str = "bigint") -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, url of the records in the files that the newest manifest names.

    Other files in the folder are not read. Digests of blocks and of responses' payloads are recomputed; a mismatch is an error.
    """
    schema = f"page_id {kind}, payload_bytes bigint, payload_digest string, record_type string, refers_to {kind}, url string"
    entries = read_manifest(spark, out)
    if not entries:
        return spark.createDataFrame([], schema)
    number = int if kind in ("bigint", "int") else str

    def page(name: str | None):
        value = re.fullmatch(r"<urn:curveloom:page:(.*):\d+>", name or "")
        return None if value is None or value[1] == "null" else number(value[1])

    def b32(x: bytes) -> str:
        return base64.b32encode(hashlib.sha1(x).digest()).decode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = pa.int64() if number is int else pa.string()
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for fields, block in parse(content.as_py()):
                    head, _, body = block.partition(b"\r\n\r\n")
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if fields["WARC-Block-Digest"] != f"sha1:{b32(block)}" or fields["WARC-Type"] == "response" and digest != b32(body):
                        raise ValueError(f"digest of {fields['WARC-Record-ID']} is wrong")
                    size = int(re.search(rb"(?i)\r\nContent-Length: (\d+)", head)[1])
                    rows.append((page(fields["WARC-Record-ID"]), size, digest, fields["WARC-Type"], page(fields.get("WARC-Refers-To")), fields["WARC-Target-URI"]))
                if rows:
                    kinds = (ids, pa.int64(), pa.string(), pa.string(), ids, pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], [x.split()[0] for x in schema.split(", ")])

    return spark.read.format("binaryFile").load([f"{out}/{e['name']}" for e in entries]).select("content").mapInArrow(run, schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes pages and reads them back: page_id, payload_bytes, payload_digest, record_type, refers_to per row."""
    ws = Workspace(pages.sparkSession, "warc")
    out = ws.path("archive")
    write_warc(pages, out)
    return read_warc(pages.sparkSession, out, dict(pages.dtypes)["page_id"]).drop("url")
