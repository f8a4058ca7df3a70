"""Web archives written in parallel: sorted shards, rolled files, deterministic bytes, atomic commit.

Where things go. Shard borders come from exact counts over ranges of page ids, refined where ids
crowd, so they depend on the data alone. Rows are dealt to shards by id, sorted, and streamed by one task per
shard into files that roll over once they hold ``file_bytes`` compressed bytes. Records are gzip
members of their own, with headers and digests made anew from the payload; nothing in a file
depends on when or where it was written, so a repeated run writes the same bytes.

Commit. A task writes under names of its own attempt and reports its files; the report of the
attempts that count is itself a table. Files on it are then renamed, and the manifest that lists
them is written last. Readers go by the manifest, so what a lost executor or a second attempt left
behind is never read.

Payloads that occur again (same digest, ``revisit_bytes`` or more) are stored once: the record
with the smallest id is the response and the others revisit it.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgecurve.llm.common import balanced_borders, many, quoted, rows_of
from lodgecurve.operators.scale import materialise, shared_folder

REVISIT_BYTES = 100
FILE_BYTES = 64 << 20
SHARD_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REPORT = "shard long, number long, temporary string, name string, records long, bytes long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def payloads(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, url, payload, size, digest``: null html is an empty payload."""
    body = F.coalesce(F.col(quoted(html)).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(quoted(key)).cast("long").alias("page_id"), F.col(quoted(url)).cast("string").alias("url"), body.alias("payload"))
    return rows.withColumn("size", F.octet_length("payload").cast("long")).withColumn("digest", F.sha2("payload", 256))


def references(rows: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``page_id, digest, refers_to``: pages whose payload a page with a smaller id has too."""
    large = rows.where(F.col("size") >= revisit_bytes).select("page_id", "digest").distinct()
    first = large.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    several = materialise(first.select("digest", "refers_to"))  # a table of its own, so that a popular digest's join can be split
    return large.join(several, "digest").where(F.col("page_id") > F.col("refers_to")).select("page_id", "digest", "refers_to")


def clean(value: str) -> str:
    """A header value on one line; line ends and other controls are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)


def record_id(page_id: int | None, number: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{number}')}>"


def record(page_id, url, payload: bytes, digest: str, refers_to, number: int) -> bytes:
    """One gzip member. ``number`` tells apart records of one page id."""
    body = b"" if refers_to is not None else payload
    lines = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id, number)),
        ("WARC-Date", DATE),
        *([("WARC-Target-URI", clean(url))] if url is not None else []),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(body).hexdigest()}"),
        *([("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to, 0)), ("X-Refers-To-Page", str(refers_to))] if refers_to is not None else []),
        *([("X-Page", str(page_id))] if page_id is not None else []),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "text/html; charset=utf-8"),
        ("Content-Length", str(len(body))),
    ]
    head = VERSION + b"".join(f"{k}: {v}\r\n".encode() for k, v in lines)
    return gzip.compress(head + b"\r\n" + body + b"\r\n\r\n", compresslevel=6, mtime=0)


class Shard:
    """The files of one shard, open one at a time."""

    def __init__(self, folder: str, shard: int, file_bytes: int) -> None:
        self.store, self.root = fs.FileSystem.from_uri(folder)
        self.shard, self.limit, self.out, self.files = shard, file_bytes, None, []
        context = TaskContext.get()
        self.attempt = f"{context.stageId()}-{context.taskAttemptId()}" if context else "0"

    def write(self, member: bytes) -> None:
        if self.out is not None and self.files[-1][4] and self.files[-1][5] + len(member) > self.limit:
            self.close()
        if self.out is None:
            name = f"part-{self.shard:06d}-{len(self.files):05d}.warc.gz"
            temporary = f"_temporary/{self.attempt}/{name}"
            self.store.create_dir(f"{self.root}/_temporary/{self.attempt}", recursive=True)
            self.out = self.store.open_output_stream(f"{self.root}/{temporary}", compression=None)
            self.files.append([self.shard, len(self.files), temporary, name, 0, 0])
        self.out.write(member)
        self.files[-1][4] += 1
        self.files[-1][5] += len(member)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def report_batch(files: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.array([f[i] for f in files], k) for i, k in enumerate(kinds)], ["shard", "number", "temporary", "name", "records", "bytes"]
    )


def write_archives(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    revisit_bytes: int = REVISIT_BYTES,
    file_bytes: int = FILE_BYTES,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Write a record per row of ``pages`` below ``folder`` (a URI all executors reach); returns the manifest.

    Null urls leave the target out, null html is empty. Of repeated rows (same id, same payload)
    the first is the response and the others revisit it; rows that share an id but differ in
    payload are records of their own. Null ids come first and are never referred to. An empty
    table writes no file and an empty manifest.
    """
    rows = payloads(pages, key, url, html)
    sizes = materialise(rows.select("page_id", "size", "digest"))
    edges = balanced_borders(sizes, "page_id", "size", shard_bytes)
    shard = searched(edges)
    # a page's reference travels to the page's shard as a row of its own, just ahead of the page
    ahead = references(sizes, revisit_bytes).select("page_id", "digest", F.lit(0).alias("kind"), "refers_to", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"))
    own = rows.select("page_id", "digest", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("refers_to"), "url", "payload")
    order = ["shard", "page_id", "digest", "kind", "url"]
    dealt = ahead.unionByName(own).withColumn("shard", shard)
    dealt = dealt.repartitionById(len(edges) + 1, F.col("shard").cast("int")).sortWithinPartitions(*order)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, refers, last, number = None, None, None, 0
        for at, page_id, digest, kind, refers_to, link, payload in rows_of(batches, "shard", "page_id", "digest", "kind", "refers_to", "url", "payload"):
            if now is None or now.shard != at:
                if now is not None:
                    now.close()
                    yield report_batch(now.files)
                now = Shard(folder, at, file_bytes)
            if kind == 0:
                refers = (page_id, digest, refers_to)
                continue
            number = number + 1 if last is not None and last[0] == page_id else 0
            to = refers[2] if refers is not None and refers[:2] == (page_id, digest) else None
            if to is None and page_id is not None and last == (page_id, digest) and len(payload) >= revisit_bytes:
                to = page_id
            last = (page_id, digest)
            now.write(record(page_id, link, payload, digest, to, number))
        if now is not None:
            now.close()
            yield report_batch(now.files)

    written = materialise(dealt.mapInArrow(work, REPORT))

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for temporary, name in rows_of([batch], "temporary", "name"):
                there = store.get_file_info([f"{root}/{temporary}", f"{root}/{name}"])
                if there[0].type != fs.FileType.NotFound:
                    store.move(f"{root}/{temporary}", f"{root}/{name}")
                elif there[1].type == fs.FileType.NotFound:
                    raise FileNotFoundError(f"{root}/{temporary}")
            yield batch

    renamed = written.mapInArrow(rename, REPORT).select("shard", "number", "name", "records", "bytes")
    renamed.write.mode("overwrite").json(f"{folder}/_manifest")
    return manifest(pages.sparkSession, folder)


def searched(edges: list[int]):
    """Shard number of ``page_id`` by nested halves, so that an expression of n borders takes log n steps."""
    def half(lo: int, hi: int):
        if lo == hi:
            return F.lit(lo).cast("long")
        mid = (lo + hi) // 2
        return F.when(F.col("page_id") < edges[mid], half(lo, mid)).otherwise(half(mid + 1, hi))

    return F.when(F.col("page_id").isNull(), F.lit(0).cast("long")).otherwise(half(0, len(edges)))


def manifest(spark, folder: str) -> DataFrame:
    """The committed files: ``shard, number, name, records, bytes``."""
    return spark.read.schema("shard long, number long, name string, records long, bytes long").json(f"{folder}/_manifest")


def members(source) -> Iterator[bytes]:
    """Contents of the gzip members of a stream, one at a time."""
    inflate, parts = zlib.decompressobj(31), []
    while block := source.read(1 << 20):
        while block:
            parts.append(inflate.decompress(block))
            block = inflate.unused_data if inflate.eof else b""
            if inflate.eof:
                yield b"".join(parts)
                inflate, parts = zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("the last record is cut off")


def parsed(member: bytes) -> tuple:
    """``page_id, url, size, digest, type, refers_to, payload`` of one record, checked against its digests."""
    head, _, rest = member.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    named = dict(line.split(": ", 1) for line in lines[1:])
    size = int(named["Content-Length"])
    body, tail = rest[:size], rest[size:]
    digest = named["WARC-Payload-Digest"].removeprefix("sha256:")
    full = named["WARC-Type"] == "response"
    found = hashlib.sha256(body).hexdigest()
    if not lines[0].startswith("WARC/") or tail != b"\r\n\r\n" or found != named["WARC-Block-Digest"].removeprefix("sha256:") or full and found != digest:
        raise ValueError(f"damaged record {named.get('WARC-Record-ID')}")
    number = lambda k: int(named[k]) if k in named else None
    return number("X-Page"), named.get("WARC-Target-URI"), len(body) if full else number("X-Payload-Length"), digest, named["WARC-Type"], number("X-Refers-To-Page"), body if full else None


def read_archives(files: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """Records of the files of a manifest; revisits have a null payload."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

        for name, count in rows_of(batches, "name", "records"):
            seen, held, size = 0, [], 0
            with store.open_input_stream(f"{root}/{name}", compression=None) as source:
                for member in members(source):
                    held.append(parsed(member) if with_payload else (*parsed(member)[:6], None))
                    seen, size = seen + 1, size + len(member)
                    if size > 8 << 20 or len(held) >= 2000:
                        yield batch_of(held)
                        held, size = [], 0
            yield batch_of(held)
            if seen != count:
                raise ValueError(f"{name} has {seen} records, the manifest says {count}")

    return files.repartition(many(files), "name").mapInArrow(work, RECORD)


def op9_warc(spark, sf_dir: str) -> DataFrame:
    """Write all pages as archives, then read the archives back."""
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    folder = re.sub(r"^(file:)?(?=/[^/])", "file://", folder)  # as a URI that the file system library reads
    files = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder, file_bytes=8 << 20, shard_bytes=16 << 20)
    return read_archives(files, folder, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS body FROM pages
), d AS (
    SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes, sha256(body) AS payload_digest FROM p
), f AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 100 AND first_id < page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 100 AND first_id < page_id THEN first_id END AS refers_to
FROM f
"""
