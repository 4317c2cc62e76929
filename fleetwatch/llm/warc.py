"""Sharded WARC archives: a deterministic writer and a reader.

Records are ordered by key. A first pass over keys, digests and sizes cuts the keys into shards: a key's shard number is the
sum of all payload sizes before it divided by the shard size, so it depends on the table alone and not on how Spark cut
it. Pages and the plan of their record types then meet in one shuffle by shard. One task writes the records of a shard in order, one gzip member a record, and starts a further file when the
compressed size is reached. A file gets a name of its own attempt, and its final name when it is whole; the manifest,
written last by Spark's committer, lists the files that count. A task that runs again makes the same bytes.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetwatch.session import settled, work_path

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the public namespace for URLs
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ = 1 << 20


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base32: each 5 hexadecimal digits are 4 base32 digits."""
    digest = F.sha1(payload)
    quads = [F.lpad(F.lower(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32)), 4, "0") for i in range(8)]
    return F.translate(F.concat(*quads), "0123456789abcdefghijklmnopqrstuv", BASE32)


def plan_records(
    pages: DataFrame, key: str = "page_id", payload: str = "html", shard_bytes: int = 64 << 20, min_revisit_bytes: int = 0
) -> tuple[DataFrame, list]:
    """A table with one row per (key, digest): payload_bytes, record_type, refers_to; and the first key of each shard.

    Among records of equal payload the one with the largest key is the response and the others revisit it; rows that
    repeat that key and payload are responses too. Payloads below ``min_revisit_bytes`` are responses all. Null payload
    is empty; null keys come first, and a payload with null keys only is a response. The list of shards is what reaches
    the driver.
    """
    spark = pages.sparkSession
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(key).alias("key"), base32_sha1(body).alias("digest"), F.length(body).cast("long").alias("bytes")
    )
    rows = settled(rows.groupBy("key", "digest", "bytes").agg(F.count(F.lit(1)).alias("rows")), "warc-keys")
    # Range partitions give the order; sums per partition reach the driver, sums inside one come from a window.
    path = work_path(spark, "warc-order")
    sizes = rows.where("key IS NOT NULL").groupBy("key").agg(F.sum(F.col("bytes") * F.col("rows")).alias("bytes"))
    sizes.repartitionByRange("key").withColumn("part", F.spark_partition_id()).write.parquet(path)
    cut = spark.read.parquet(path)
    starts, before = [], 0
    for r in cut.groupBy("part").agg(F.sum("bytes").alias("n")).orderBy("part").collect():
        starts += [F.lit(r["part"]), F.lit(before)]
        before += r["n"]
    order = Window.partitionBy("part").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("bytes").over(order), F.lit(0))
    offset = F.create_map(*starts)[F.col("part")] if starts else F.lit(0)
    shard = F.floor((earlier + offset) / F.lit(shard_bytes)).cast("long")
    bounds = cut.select("key", shard.alias("shard")).groupBy("shard").agg(F.min("key").alias("key")).orderBy("shard").collect()
    first = rows.groupBy(F.col("digest").alias("_digest"), F.col("bytes").alias("_bytes")).agg(F.max("key").alias("_first"))
    joined = rows.join(first, (F.col("digest") == F.col("_digest")) & (F.col("bytes") == F.col("_bytes")))
    revisit = (F.col("bytes") >= min_revisit_bytes) & ~F.col("key").eqNullSafe(F.col("_first"))
    plan = joined.select(
        "key", "digest", F.col("bytes").alias("payload_bytes"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("_first")).cast("string").alias("refers_to"),
    )
    return plan, [r["key"] for r in bounds]


def _record_id(key, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{key}/{digest}')}>"


def _header_text(value: str) -> str:
    """A header value on one line: control characters become percent escapes."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def _record(row) -> bytes:
    """One record; all headers are made anew from the row."""
    payload = (row.payload or "").encode() if isinstance(row.payload, str) else b""
    if len(payload) != row.payload_bytes:
        raise ValueError(f"payload of {row.key} changed while it was archived")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if row.record_type == "revisit" else http + payload
    headers = [
        ("WARC-Type", row.record_type),
        ("WARC-Record-ID", _record_id(row.key, row.digest)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _header_text(row.url) if isinstance(row.url, str) else "urn:none"),
        ("WARC-Payload-Digest", f"sha1:{row.digest}"),
        ("WARC-Block-Digest", f"sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if row.key is not None:
        headers.append(("X-Key", _header_text(row.key)))
    if row.record_type == "revisit":
        headers.append(("WARC-Profile", PROFILE))
        headers.append(("WARC-Refers-To", _record_id(row.refers_to, row.digest)))
        headers.append(("X-Refers-To-Key", _header_text(row.refers_to)))
    headers.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _gzip(data: bytes, level: int) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class _Shard:
    """The files of one shard while its records come."""

    def __init__(self, folder: str, shard: int, roll_bytes: int) -> None:
        from pyarrow import fs

        self.fs, self.path = fs.FileSystem.from_uri(folder)
        self.shard, self.roll_bytes, self.number, self.out = shard, roll_bytes, 0, None

    def _open(self) -> None:
        self.name = f"shard-{self.shard:08d}-{self.number:05d}.warc.gz"
        self.temp = posixpath.join(self.path, f"_temporary-{uuid.uuid4().hex}-{self.name}")
        self.fs.create_dir(self.path, recursive=True)
        self.out = self.fs.open_output_stream(self.temp, compression=None)
        self.size = self.records = 0
        self.sha = hashlib.sha256()
        info = f"software: fleetwatch\r\nformat: WARC File Format 1.1\r\nfile: {self.name}\r\n".encode()
        head = (
            f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: {_record_id('file', self.name)}\r\nWARC-Date: {DATE}\r\n"
            f"WARC-Filename: {self.name}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n"
        )
        self._put(head.encode() + info + b"\r\n\r\n")

    def _put(self, data: bytes) -> None:
        packed = _gzip(data, 4)
        self.out.write(packed)
        self.sha.update(packed)
        self.size += len(packed)

    def add(self, data: bytes) -> Iterator[dict]:
        if self.out is None:
            self._open()
        self._put(data)
        self.records += 1
        if self.size >= self.roll_bytes:
            yield self.close()

    def close(self) -> dict:
        self.out.close()
        self.fs.move(self.temp, posixpath.join(self.path, self.name))
        self.out = None
        self.number += 1
        return {"file": self.name, "records": self.records, "bytes": self.size, "sha256": self.sha.hexdigest()}


def write_warc(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html",
    shard_bytes: int = 64 << 20, roll_bytes: int = 16 << 20, min_revisit_bytes: int = 0,
) -> DataFrame:
    """Writes the archive to ``folder`` (any address pyarrow and Spark both know) and returns its manifest.

    Null keys, urls and payloads, repeated rows and empty tables are all archived; an empty table gives an empty
    manifest.
    """
    spark = pages.sparkSession
    plan, bounds = plan_records(pages, key, payload, shard_bytes, min_revisit_bytes)
    tasks = max(1, min(len(bounds), 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    none = F.lit(None).cast("string")
    rows = pages.select(
        F.col(key).alias("key"), base32_sha1(body).alias("digest"), F.col(url).alias("url"), F.col(payload).alias("payload"),
        F.lit(None).cast("long").alias("payload_bytes"), none.alias("record_type"), none.alias("refers_to"), F.lit(True).alias("page"),
    )
    plan = plan.select("key", "digest", none.alias("url"), none.alias("payload"), "payload_bytes", "record_type", "refers_to",
                       F.lit(False).alias("page"))
    fields = "digest string, url string, payload string, payload_bytes long, record_type string, refers_to string, page boolean"
    kind = pages.schema[key].dataType.simpleString()
    sent = spark.sparkContext.broadcast(bounds)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds the shard, the last one that begins at or before the key."""
        for batch in batches:
            shards = [max(0, bisect_right(sent.value, k) - 1) if k is not None else 0 for k in batch.column("key").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int64()), *batch.columns], ["shard", *batch.schema.names])

    placed = rows.unionByName(plan).mapInArrow(place, f"shard long, key {kind}, {fields}")
    ordered = (
        placed.repartition(tasks, "shard")
        .sortWithinPartitions("shard", F.col("key").asc_nulls_first(), "digest", "page", "url")
        .withColumn("key", F.col("key").cast("string"))
    )
    target = folder if "://" in folder or folder.startswith("/") else folder.replace("file:", "", 1)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, shard, plan = [], None, None
        for batch in batches:
            for row in batch.itertuples(index=False):
                if not row.page:  # what is planned for the pages that follow
                    plan = row
                    continue
                if plan is None or plan.digest != row.digest or not (plan.key == row.key or pd.isna(plan.key) and pd.isna(row.key)):
                    raise ValueError(f"no plan for page {row.key}")
                row = row._replace(payload_bytes=int(plan.payload_bytes), record_type=plan.record_type, refers_to=plan.refers_to)
                if shard is None or shard.shard != row.shard:
                    files += [shard.close()] if shard is not None and shard.out else []
                    shard = _Shard(target, row.shard, roll_bytes)
                files += shard.add(_record(row))
        files += [shard.close()] if shard is not None and shard.out else []
        yield pd.DataFrame(files, columns=["file", "records", "bytes", "sha256"])

    manifest = f"{folder.rstrip('/')}/manifest"
    ordered.mapInPandas(write, "file string, records long, bytes long, sha256 string").write.parquet(manifest)
    return spark.read.schema("file string, records long, bytes long, sha256 string").parquet(manifest)


def _members(stream) -> Iterator[bytes]:
    """The gzip members of a stream, one at a time."""
    data = stream.read(READ)
    while data:
        z, parts = zlib.decompressobj(31), []
        while not z.eof:
            if not data:
                raise ValueError("an archive ends inside a record")
            parts.append(z.decompress(data))
            data = z.unused_data if z.eof else stream.read(READ)
        data = data or stream.read(READ)
        yield b"".join(parts)


def _parse(record: bytes) -> dict[str, str | bytes]:
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    out: dict = dict(line.split(": ", 1) for line in lines[1:])
    length = int(out["Content-Length"])
    if rest[length:] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    return out | {"block": rest[:length]}


def read_warc(spark: SparkSession, folder: str, key_type: str = "long") -> DataFrame:
    """Records of the files that the manifest lists: key, url, record_type, payload_bytes, payload_digest, refers_to, payload.

    Digests of blocks and payloads are made anew and must agree. A revisit has no payload of its own (null).
    """
    manifest = spark.read.schema("file string, records long, bytes long, sha256 string").parquet(
        f"{folder.rstrip('/')}/manifest"
    )
    source = folder if "://" in folder or folder.startswith("/") else folder.replace("file:", "", 1)
    columns = ["key", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(source)
        for batch in batches:
            for name, records in zip(batch["file"], batch["records"], strict=True):
                found, rows, size = 0, [], 0
                with store.open_input_stream(posixpath.join(path, name), compression=None) as stream:
                    for member in _members(stream):
                        r = _parse(member)
                        if r["WARC-Type"] == "warcinfo":
                            continue
                        found += 1
                        http, _, payload = r["block"].partition(b"\r\n\r\n")
                        block = base64.b32encode(hashlib.sha1(r["block"]).digest()).decode()
                        digest = r["WARC-Payload-Digest"].removeprefix("sha1:")
                        whole = r["WARC-Type"] == "response"
                        if f"sha1:{block}" != r["WARC-Block-Digest"] or (
                            whole and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest
                        ):
                            raise ValueError(f"a digest in {name} is wrong")
                        length = int(http.decode().rpartition("Content-Length: ")[2])
                        url = None if r["WARC-Target-URI"] == "urn:none" else r["WARC-Target-URI"]
                        rows.append((r.get("X-Key"), url, r["WARC-Type"], length, digest, r.get("X-Refers-To-Key"),
                                     payload if whole else None))
                        size += len(payload)
                        if size > 8 << 20:
                            yield pd.DataFrame(rows, columns=columns)
                            rows, size = [], 0
                if found != records:
                    raise ValueError(f"{name} has {found} records, its manifest says {records}")
                yield pd.DataFrame(rows, columns=columns)

    schema = "key string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string, payload binary"
    files = manifest.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "file")
    out = files.mapInPandas(read, schema)
    return out.withColumns({"key": F.col("key").cast(key_type), "refers_to": F.col("refers_to").cast(key_type)})
