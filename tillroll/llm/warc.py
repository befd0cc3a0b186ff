"""Deterministic sharded WARC writer and reader.

Writing: one small aggregation finds equal payloads (by digest) and names each
copy's first record; pages and these marks are range-sorted by id in a single
shuffle; every task streams its range into gzip-per-record archives and starts
the next file once the compressed size passes ``roll_bytes``. Files appear
under temporary names and are renamed when complete; the manifest, written
last by Spark, lists name, records, id range, size and digest of each file,
and a reader trusts only what it lists. Names, order and bytes depend on the
rows alone, so a repeated or speculative task replaces equal files.
"""

from __future__ import annotations

import base64
import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.storage import written

ROLL_BYTES = 8 << 20
#: Rows of an Arrow batch that become Python objects at once.
SLICE = 128
#: Payload bytes that one writing task gets, about.
TASK_BYTES = 64 << 20
#: All records carry this date, so that the same pages give the same bytes.
DATE = "2000-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("records", T.LongType()),
    T.StructField("first_key", T.StringType()), T.StructField("last_key", T.StringType()),
    T.StructField("bytes", T.LongType()), T.StructField("sha256", T.StringType())])

RECORDS = T.StructType([
    T.StructField("page_id", T.StringType()), T.StructField("url", T.StringType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.StringType()),
    T.StructField("payload", T.BinaryType())])


def filesystem(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder URI (plain paths, file:, hdfs:, s3: ...) and the path in it."""
    if "://" in folder or folder.startswith("file:"):
        return fs.FileSystem.from_uri(folder if "://" in folder else "file://" + folder[5:])
    return fs.LocalFileSystem(), folder


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(value: str) -> str:
    """A header value on one line."""
    return " ".join(value.split())


def record(key: str, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One WARC/1.1 record, gzipped by itself. Revisits carry no payload but its digest and length."""
    own = digest(payload)
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{key}\n{url or ''}\n{own}")
    body = payload if refers_to is None else b""
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:uuid:{name}>",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {_line(url or 'urn:none')}", f"X-Key: {_line(key)}",
        f"WARC-Payload-Digest: sha1:{own}", f"X-Payload-Length: {len(payload)}", f"WARC-Block-Digest: sha1:{digest(body)}",
        "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"X-Refers-To-Key: {_line(refers_to)}"]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join([*head, "", ""]).encode() + body + b"\r\n\r\n") + pack.flush()


class Shard:
    """Files of one writing task, each under a temporary name until it is complete."""

    def __init__(self, folder: str, number: int, roll_bytes: int):
        self.fs, self.path = filesystem(folder)
        self.number, self.roll_bytes = number, roll_bytes
        self.files = 0
        self.out = None

    def add(self, key: str, data: bytes) -> Iterator[tuple]:
        if self.out is None:
            self.temporary = f"{self.path}/_tmp-{self.number:05d}-{uuid.uuid4().hex}"
            self.out = self.fs.open_output_stream(self.temporary, compression=None)
            self.sha, self.size, self.records, self.first = hashlib.sha256(), 0, 0, key
        self.out.write(data)
        self.sha.update(data)
        self.size, self.records, self.last = self.size + len(data), self.records + 1, key
        if self.size >= self.roll_bytes:
            yield self.close()

    def close(self) -> tuple:
        self.out.close()
        self.out = None
        name = f"part-{self.number:05d}-{self.files:05d}.warc.gz"
        if self.fs.type_name == "local":
            os.replace(self.temporary, f"{self.path}/{name}")
        else:
            self.fs.move(self.temporary, f"{self.path}/{name}")
        self.files += 1
        return name, self.records, self.first, self.last, self.size, self.sha.hexdigest()


def write(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html",
          least_bytes: int = 0, roll_bytes: int = ROLL_BYTES, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Write one record per row of ``pages`` below ``folder``; returns the manifest.

    Of records with equal payloads of at least ``least_bytes`` bytes the one
    with the smallest key is the response and the others revisit it; shorter
    payloads are all responses. Null html is an empty payload. A null key
    sorts first, is written as an empty one and counts as the smallest; of
    rows with the same key and payload one (any: they are alike) is the
    response. Other columns are not read. ``folder`` must be shared by all
    executors and new. An empty table gives an empty manifest.
    """
    spark = pages.sparkSession
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    rows = pages.select(F.col(key).alias("k"), F.col(url).cast("string").alias("u"), payload.alias("p"))
    light = (pages.select(F.col(key).alias("k"), F.sha1(payload).alias("d"), F.length(payload).alias("n"))
             .filter(F.col("n") >= least_bytes))
    # copies: every distinct (key, payload) that is not its payload's smallest key, and how often the smallest occurs
    keyed = light.groupBy("d", "k").agg(F.count("*").alias("c"))
    # (a written table, so that the join shuffles both sides and a payload of very many pages can be split)
    first = written(keyed.groupBy("d").agg(F.min(F.struct(F.col("k").isNotNull().alias("t"), F.col("k"))).getField("k").alias("f"),
                                           F.sum("c").alias("c")).filter("c > 1").drop("c"), "warc-copies")
    marks = (keyed.join(first, "d")
             .select("k", F.lit(None).cast("string").alias("u"), F.lit(None).cast("binary").alias("p"), "d",
                     F.coalesce(F.col("f").cast("string"), F.lit("")).alias("f"), F.col("k").eqNullSafe(F.col("f")).alias("own")))
    every = rows.select("k", "u", "p", F.lit(None).cast("string").alias("d"), F.lit(None).cast("string").alias("f"),
                        F.lit(None).cast("boolean").alias("own")).unionByName(marks)
    total = pages.agg(F.sum(F.octet_length(F.col(html)))).first()[0] or 0
    tasks = max(1, -(-total // task_bytes), min(spark.sparkContext.defaultParallelism, total >> 20))
    # a key's marks come before its rows; rows with equal keys are ordered by what they hold
    spread = every.repartitionByRange(tasks, "k").sortWithinPartitions("k", F.col("p").isNotNull(), "u", "p", "d")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = Shard(folder, TaskContext.get().partitionId(), roll_bytes)
        done: list[tuple] = []
        at, marked, answered = None, {}, set()
        for b in batches:
            slices = (b.slice(i, SLICE) for i in range(0, b.num_rows, SLICE))
            for k, u, p, d, f, own in (row for x in slices for row in zip(*(c.to_pylist() for c in x.columns), strict=True)):
                if k != at:
                    at, marked, answered = k, {}, set()
                if p is None:
                    marked[d] = (f, own)
                    continue
                sha = hashlib.sha1(p).hexdigest() if marked else ""
                refers, first_key = marked.get(sha, (None, False))
                if first_key and sha not in answered:
                    answered.add(sha)
                    refers = None
                name = "" if k is None else str(k)
                done += shard.add(name, record(name, u, p, refers))
        if shard.out is not None:
            done.append(shard.close())
        yield pa.RecordBatch.from_pylist([dict(zip(MANIFEST.names, x, strict=True)) for x in done],
                                         pa.schema([("file", pa.string()), ("records", pa.int64()), ("first_key", pa.string()),
                                                    ("last_key", pa.string()), ("bytes", pa.int64()), ("sha256", pa.string())]))

    filesystem(folder)[0].create_dir(filesystem(folder)[1], recursive=True)
    spread.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/_manifest")
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """What :func:`write` committed below ``folder``."""
    return spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")


def parse(data: bytes) -> Iterator[dict]:
    """Records of one archive, member by member; each is fed in blocks, so that no rest of the archive is copied."""
    at, block = 0, 1 << 14
    view = memoryview(data)
    while at < len(data):
        unpack = zlib.decompressobj(31)
        pieces = []
        while not unpack.eof:
            if at >= len(data):
                raise ValueError("archive ends within a record")
            pieces.append(unpack.decompress(view[at:at + block]))
            at = min(at + block, len(data)) - len(unpack.unused_data)
        raw = b"".join(pieces)
        head, _, rest = raw.partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in head.decode().split("\r\n")[1:])
        body = rest[:int(fields["Content-Length"])]
        if digest(body) != fields["WARC-Block-Digest"].removeprefix("sha1:"):
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
        kind = fields["WARC-Type"]
        yield {"page_id": fields["X-Key"], "url": fields["WARC-Target-URI"], "payload_bytes": int(fields["X-Payload-Length"]),
               "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"), "record_type": kind,
               "refers_to": fields.get("X-Refers-To-Key"), "payload": body if kind == "response" else None}


def read(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Records of the archives that the manifest below ``folder`` lists (keys as text).

    Spark reads the files, so any store it reads will do; a listed file whose
    size or digest differs from the manifest's, or that is missing, is an
    error. A task holds one file (about ``roll_bytes``).
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*.warc.gz").load(folder)
             .select(F.element_at(F.split("path", "/"), -1).alias("__file"), "content"))
    listed = manifest(spark, folder).select("file", "bytes", "sha256")
    if lost := listed.join(files.select("__file"), listed["file"] == F.col("__file"), "left_anti").head(5):
        raise ValueError(f"archives that the manifest lists are missing: {[x['file'] for x in lost]}")
    both = files.join(listed, listed["file"] == files["__file"]).select("file", "bytes", "sha256", "content")
    schema = T.StructType([f for f in RECORDS if payloads or f.name != "payload"])
    arrow = pa.schema([(f.name, pa.int64() if f.name == "payload_bytes" else pa.binary() if f.name == "payload" else pa.string())
                       for f in schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                name, size, sha, content = (b.column(j)[i].as_py() for j in range(4))
                if len(content) != size or hashlib.sha256(content).hexdigest() != sha:
                    raise ValueError(f"archive {name} differs from the manifest")
                held: list[dict] = []
                for r in parse(content):
                    held.append(r if payloads else {k: r[k] for k in arrow.names})
                    if len(held) == SLICE:
                        yield pa.RecordBatch.from_pylist(held, arrow)
                        held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held, arrow)

    return both.mapInArrow(run, schema)
