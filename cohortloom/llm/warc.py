"""Deterministic, sharded WARC archives.

Records are range-sorted by page id over splitters that follow from exact byte counts, so the
files depend on the pages and the parameters only. Every shard is written by one task: it
regenerates headers and digests, compresses each record by itself and begins another file when
the compressed size reaches a limit. Tasks write under temporary names that carry the attempt;
the driver renames the files of the attempts that Spark accepted and then publishes the
manifest, the only list of files that readers trust. A lost executor leaves temporary files at most.

Of pages with equal payloads that with the largest id is the response, the others are revisits.

Rows of one page id, or without one, are parted by their payloads, so they are not all one task's.

Nulls: a null payload is empty, a null id sorts first and is never preferred as response, a null
url is written as empty. Of repeated rows one can be the response, the others revisit it. Empty
tables give a manifest without files. Only the id, the url and the payload are read, so further
columns cannot clash.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.sharding import split
from cohortloom.llm.staging import stage

WARC_DATE = "2024-01-01T00:00:00Z"
SHARD_BYTES = 32 << 20
ROLL_BYTES = 16 << 20
READ_BYTES = 1 << 20
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "manifest.json"
# Schemes by which Spark names stores that Arrow knows by another.
SCHEMES = {"s3a": "s3", "s3n": "s3"}
# Files that are given their names at the same time.
RENAMES = 16
FILE = "shard int, roll int, temporary string, name string, bytes long, records long, sha256 string"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _fields(pairs) -> bytes:
    return "".join(f"{k}: {v}\r\n" for k, v in pairs if v is not None).encode()


def _record_id(page_id, digest: str, n: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}/{n}')}>"


def record(page_id, url: str, payload: bytes, revisit: bool, refers_to, n: int, date: str) -> bytes:
    """One WARC record; ``n`` numbers rows of the same page and payload."""
    digest = base32_sha1(payload)
    http = b"HTTP/1.1 200 OK\r\n" + _fields(
        [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))]
    )
    block = http + b"\r\n" + (b"" if revisit else payload)
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(page_id, digest, n)),
        ("WARC-Date", date),
        ("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("WARC-Profile", REVISIT_PROFILE if revisit else None),
        ("WARC-Refers-To", _record_id(refers_to, digest, 0) if revisit else None),
        ("X-Page-ID", page_id),
        ("X-Refers-To-Page-ID", refers_to if revisit else None),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
    ]
    return b"WARC/1.1\r\n" + _fields(head) + b"\r\n" + block + b"\r\n\r\n"


def _info(name: str, date: str) -> bytes:
    body = _fields([("software", "cohortloom"), ("format", "WARC File Format 1.1")])
    head = [
        ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"),
        ("WARC-Date", date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields"),
        ("Content-Length", len(body)),
    ]
    return b"WARC/1.1\r\n" + _fields(head) + b"\r\n" + body + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    """A gzip member without a time stamp."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _opened(folder: str):
    """(file system, path) for Arrow, which knows the stores of Spark under other schemes."""
    scheme, _, rest = folder.partition("://")
    try:
        return arrow_fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}://{rest}" if rest else folder)
    except (ValueError, NotImplementedError, pa.ArrowException) as error:
        raise ValueError(f"archives cannot be written to {folder}: no file system of Arrow opens it ({error})") from error


class _Roller:
    """Files of one shard, each closed before it would exceed the limit."""

    def __init__(self, folder: str, shard: int, limit: int, date: str):
        self.fs, self.path = _opened(folder)
        self.fs.create_dir(f"{self.path}/_temporary")
        self.shard, self.limit, self.date = shard, limit, date
        self.roll, self.out, self.files = 0, None, []

    def _open(self) -> None:
        self.name = f"part-{self.shard:06d}-{self.roll:05d}.warc.gz"
        self.temporary = f"_temporary/{self.name}.{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(f"{self.path}/{self.temporary}", compression=None)
        self.size, self.records, self.sha = 0, 0, hashlib.sha256()
        self._put(_member(_info(self.name, self.date)))

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)
        self.sha.update(data)

    def add(self, data: bytes) -> None:
        packed = _member(data)
        if self.out is not None and self.records and self.size + len(packed) > self.limit:
            self.close()
        if self.out is None:
            self._open()
        self._put(packed)
        self.records += 1

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.files.append(
                (self.shard, self.roll, self.temporary, self.name, self.size, self.records, self.sha.hexdigest())
            )
            self.out, self.roll = None, self.roll + 1


def _write_shards(folder: str, roll_bytes: int, date: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, previous, repeats, decision = None, None, 0, None
        for batch in batches:
            for row in batch.to_pylist():
                key = (row["page_id"], row["digest"])
                if row["kind"] == 0:
                    decision = (*key, row["refers_to"])
                    continue
                if roller is None:
                    roller = _Roller(folder, row["part"], roll_bytes, date)
                repeats = repeats + 1 if key == previous else 0
                previous = key
                revisit, target = False, None
                if decision is not None and decision[:2] == key:
                    revisit, target = True, decision[2]
                elif repeats:
                    revisit, target = True, row["page_id"]
                payload = (row["html"] or "").encode()
                roller.add(record(row["page_id"], row["url"] or "", payload, revisit, target, repeats, date))
        if roller is not None:
            roller.close()
            columns = list(zip(*roller.files))
            types = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                ["shard", "roll", "temporary", "name", "bytes", "records", "sha256"],
            )

    return write


def write_archives(
    pages: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES, date: str = WARC_DATE
) -> DataFrame:
    """Write all pages (page_id, url, html) below ``folder``; returns the manifest's rows."""
    html = F.coalesce("html", F.lit(""))
    narrow = stage(
        pages.select(
            "page_id",
            F.sha1(html.cast("binary")).alias("digest"),
            F.coalesce("page_id", F.lit(-(1 << 63))).alias("key_a"),
            F.xxhash64(F.sha1(html.cast("binary"))).alias("key_b"),
            (F.octet_length(html) + 512).cast("long").alias("size"),
        ),
        "payloads",
    )
    total = narrow.agg(F.sum("size")).first()[0] or 0
    shards = max(1, -(-int(total) // shard_bytes))
    ranges, _ = split(narrow, shards, shard_bytes * 4)
    # The largest page of each payload that occurs more than once, and the rows that revisit it.
    largest = stage(
        narrow.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n"),
        "largest",
    )
    revisits = narrow.join(largest, "digest").where("page_id IS NULL OR page_id < refers_to")
    revisits = revisits.where("refers_to IS NOT NULL").select("page_id", "digest", "refers_to").distinct()
    # The payload's hash parts the rows of one page, and those without a page, over shards.
    part = ranges.part(F.coalesce("page_id", F.lit(-(1 << 63))), F.xxhash64("digest"))
    rows = pages.select(
        "page_id", F.sha1(html.cast("binary")).alias("digest"), F.lit(1).alias("kind"),
        F.lit(None).cast("long").alias("refers_to"), "url", "html",
    )
    decided = revisits.select(
        "page_id", "digest", F.lit(0).alias("kind"), "refers_to",
        F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"),
    )
    sorted_rows = (
        rows.unionByName(decided)
        .withColumn("part", part)
        .repartitionById(len(ranges.rows_below), F.col("part"))
        .sortWithinPartitions("page_id", "digest", "kind", "url")
    )
    manifest = stage(sorted_rows.mapInArrow(_write_shards(folder, roll_bytes, date), FILE), "manifest")
    _commit(manifest, folder)
    return manifest


def _commit(manifest: DataFrame, folder: str) -> None:
    """Give the accepted files their names, then publish the manifest by a rename."""
    store, path = _opened(folder)
    store.create_dir(f"{path}/_temporary")
    files = sorted(manifest.collect(), key=lambda r: r["name"])
    with ThreadPoolExecutor(RENAMES) as pool:
        list(pool.map(lambda f: store.move(f"{path}/{f['temporary']}", f"{path}/{f['name']}"), files))
    temporary = f"{path}/_temporary/{MANIFEST}.{uuid.uuid4().hex}"
    with store.open_output_stream(temporary) as out:
        for f in files:
            entry = {k: f[k] for k in ("name", "shard", "roll", "bytes", "records", "sha256")}
            out.write((json.dumps(entry) + "\n").encode())
    store.move(temporary, f"{path}/{MANIFEST}")
    store.delete_dir(f"{path}/_temporary")


def members(stream) -> Iterator[bytes]:
    """The gzip members of a stream, read in pieces."""
    unpack, pieces = zlib.decompressobj(31), []
    while data := stream.read(READ_BYTES):
        while data:
            pieces.append(unpack.decompress(data))
            data = unpack.unused_data
            if unpack.eof:
                yield b"".join(pieces)
                unpack, pieces = zlib.decompressobj(31), []
    if any(pieces):
        raise ValueError("the last record is cut off")


def _head(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")[1:]
    return dict(line.split(": ", 1) for line in lines), rest


def parse(data: bytes):
    """(page_id, url, payload_bytes, digest, type, refers_to, payload) of a record, None for file info."""
    head, rest = _head(data)
    if head["WARC-Type"] == "warcinfo":
        return None
    block = rest[: int(head["Content-Length"])]
    if f"sha1:{base32_sha1(block)}" != head["WARC-Block-Digest"]:
        raise ValueError(f"{head['WARC-Record-ID']}: the block does not have its digest")
    http, payload = _head(block)
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
    if head["WARC-Type"] == "response" and base32_sha1(payload) != digest:
        raise ValueError(f"{head['WARC-Record-ID']}: the payload does not have its digest")
    number = lambda name: int(head[name]) if name in head else None
    return (
        number("X-Page-ID"), head["WARC-Target-URI"], int(http["Content-Length"]), digest,
        head["WARC-Type"], number("X-Refers-To-Page-ID"), payload,
    )


def read_archives(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """The records of the files that the manifest lists, payload bytes on demand."""
    store, path = _opened(folder)
    with store.open_input_stream(f"{path}/{MANIFEST}") as lines:
        names = [(json.loads(x)["name"],) for x in lines.read().splitlines()]
    schema = RECORD + (", payload binary" if payloads else "")
    if not names:
        return spark.createDataFrame([], schema)
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary()] * payloads

    def batch(rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows))[: len(types)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [f.split()[0] for f in schema.split(", ")])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _opened(folder)
        for names in batches:
            for name in names.column(0).to_pylist():
                rows, size = [], 0
                with store.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for data in members(stream):
                        if (row := parse(data)) is not None:
                            rows.append(row if payloads else row[:6])
                            size += len(row[6]) * payloads + 100
                        if size >= READ_BYTES:
                            yield batch(rows)
                            rows, size = [], 0
                if rows:
                    yield batch(rows)

    listed = spark.createDataFrame(names, "name string").repartition(len(names))
    return listed.mapInArrow(read, schema)
