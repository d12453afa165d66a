"""WARC archives with a two-level capture index.

Captures are range-sorted by reversed-host URL key.  Each range becomes one archive of gzipped records
in key order, one file of compressed index blocks over it, and a few rows of a sparse directory that
name each block's first key.  A lookup searches the directory, then one block, then reads one range.
"""

from __future__ import annotations

import gzip
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from functools import reduce
from hashlib import sha1
from itertools import accumulate

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemart.llm.text import stored
from tidemart.llm.url_filter import host_of
from tidemart.session import scratch_dir

#: Payloads shorter than this are written in full each time.
REVISIT_BYTES = 1000
#: Captures per compressed index block.
BLOCK_CAPTURES = 300
#: An archive is closed beyond this size.
ARCHIVE_BYTES = 256 << 20
#: Key ranges of archives that are broadcast at once.
CHUNK_BYTES = 8 << 20
WARC_DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_DIRECTORY = T.StructType([
    T.StructField("first_key", T.StringType()), T.StructField("last_key", T.StringType()),
    T.StructField("archive", T.StringType()), T.StructField("index", T.StringType()),
    T.StructField("offset", T.LongType()), T.StructField("length", T.LongType()), T.StructField("captures", T.LongType()),
])
_PLACE = ("archive", "index", "offset", "length")
_READ = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("payload", T.BinaryType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("refers_to", T.LongType()),
])


def url_key(url: Column) -> Column:
    """Host labels in reverse, a bracket, then all that follows the host: `org,example,www)/a?b`.

    White space that would break an index line is percent-encoded.
    """
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(.*)$", 1), F.lit(""))
    reversed_host = F.array_join(F.reverse(F.split(host_of(url), r"\.")), ",")
    key = F.concat(reversed_host, F.lit(")"), rest)
    for char, escape in ((" ", "%20"), ("\t", "%09"), ("\n", "%0A"), ("\r", "%0D")):
        key = F.replace(key, F.lit(char), F.lit(escape))
    return key


# ---- records -----------------------------------------------------------------------------

def _record(kind: str, page_id: int | None, url: str, date: str, digest: str, size: int, body: bytes, refers_to: int | None) -> bytes:
    """One gzipped record; the page's id is part of the record's."""
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}", f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Payload-Length: {size}",
    ]
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + len(body)}"]
    # a URL must stay on its header line
    head = "\r\n".join(x.replace("\r", "%0D").replace("\n", "%0A") for x in lines).encode() + b"\r\n\r\n"
    return gzip.compress(head + http + body + b"\r\n\r\n", 6, mtime=0)


def _page(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _parse(member: bytes) -> dict:
    """Headers and payload of one record; the payload's digest is made anew and compared."""
    data = gzip.decompress(member)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[:int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == "response" and sha1(body).hexdigest() != digest:
        raise ValueError(f"record {fields['WARC-Record-ID']} does not hold the payload of its digest")
    return {
        "page_id": _page(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"],
        "payload": body if kind == "response" else None, "payload_bytes": int(fields["WARC-Payload-Length"]),
        "payload_digest": digest, "record_type": kind,
        "refers_to": _page(fields["WARC-Refers-To"]) if kind == "revisit" else None,
    }


# ---- writing -------------------------------------------------------------------------------

def _responses(pages: DataFrame, date: str) -> DataFrame:
    """Each page with its key, digest and its record as a response, compressed before any shuffle."""
    schema = T.StructType([
        T.StructField("key", T.StringType()), T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
        T.StructField("digest", T.StringType()), T.StructField("size", T.LongType()), T.StructField("record", T.BinaryType()),
    ])

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                rows = {name: [] for name in schema.names}
                for key, page_id, url, body in zip(*(part.column(c).to_pylist() for c in ("key", "page_id", "url", "body"))):
                    digest = sha1(body).hexdigest()
                    record = _record("response", page_id, url, date, digest, len(body), body, None)
                    for name, value in zip(schema.names, (key, page_id, url, digest, len(body), record)):
                        rows[name].append(value)
                yield pa.RecordBatch.from_pydict(rows, schema=_arrow(schema))

    return pages.mapInArrow(encode, schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    kinds = {T.StringType: pa.string(), T.LongType: pa.int64(), T.BinaryType: pa.binary()}
    return pa.schema([(f.name, kinds[type(f.dataType)]) for f in schema.fields])


class _Archive:
    """One archive and its index file being written; both have names no other attempt uses."""

    def __init__(self, folder: str):
        self.name = uuid.uuid4().hex
        self.files, path = fs.FileSystem.from_uri(folder)
        self.files.create_dir(path, recursive=True)
        self.warc = self.files.open_output_stream(f"{path}/{self.name}.warc.gz", compression=None)
        self.index = self.files.open_output_stream(f"{path}/{self.name}.cdx.gz", compression=None)
        self.size = self.index_size = 0
        self.lines: list[str] = []
        self.directory: list[dict] = []

    def add(self, key: str, record: bytes) -> None:
        self.warc.write(record)
        self.lines.append(f"{key} {self.size} {len(record)}")
        self.size += len(record)
        if len(self.lines) >= BLOCK_CAPTURES:
            self.close_block()

    def close_block(self) -> None:
        if self.lines:
            block = zlib.compress("\n".join(self.lines).encode())
            self.index.write(block)
            self.directory.append({
                "first_key": self.lines[0].split(" ")[0], "last_key": self.lines[-1].split(" ")[0],
                "archive": f"{self.name}.warc.gz", "index": f"{self.name}.cdx.gz",
                "offset": self.index_size, "length": len(block), "captures": len(self.lines)})
            self.index_size += len(block)
            self.lines = []

    def close(self) -> list[dict]:
        self.close_block()
        self.warc.close()
        self.index.close()
        return self.directory


def write_archives(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", date: str = WARC_DATE,
    revisit_bytes: int = REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write one WARC record per page into `folder` and return the sparse directory of the index.

    Of pages with equal payloads of at least `revisit_bytes`, the one with the largest id becomes a
    response and the others revisit records that refer to it; shorter payloads are all responses.
    A null html is an empty payload, a null URL an empty one.  Rows that repeat the largest id are
    all responses.  A page with a null id can be a revisit but is only referred to if no copy has
    an id, in which case all copies are responses.  Line ends in URLs are percent-encoded.  An empty table writes no file and
    gives an empty directory.  Other columns are ignored.

    `folder` must be one that all executors reach.  A task that is run again writes files of new
    names; the directory, which is stored once, names only those of the attempt that counted, so a
    lost executor leaves unused files at worst.
    """
    rows = pages.select(
        url_key(F.coalesce(F.col(url), F.lit(""))).alias("key"), F.col(key).cast("long").alias("page_id"),
        F.coalesce(F.col(url), F.lit("")).alias("url"),
        F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8").alias("body"))
    long_ = rows.where(F.length("body") >= revisit_bytes)
    first = long_.groupBy(F.sha1("body").alias("copies")).agg(
        F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).drop("n")
    joined = _responses(rows, date).join(first, F.col("digest") == F.col("copies"), "left")
    revisit = F.coalesce(
        (F.col("size") >= revisit_bytes) & (F.col("page_id").isNull() | (F.col("page_id") != F.col("refers_to")))
        & F.col("refers_to").isNotNull(), F.lit(False))
    planned = joined.select(
        "key", "page_id", "url", "digest", "size", F.when(revisit, F.col("refers_to")).alias("refers_to"),
        F.when(~revisit, F.col("record")).alias("record"))

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, directory = None, []
        for batch in batches:
            for r in batch.to_pylist():
                if archive is None or archive.size >= archive_bytes:
                    directory += archive.close() if archive else []
                    archive = _Archive(folder)
                record = r["record"]
                if record is None:
                    record = _record("revisit", r["page_id"], r["url"], date, r["digest"], r["size"], b"", r["refers_to"])
                archive.add(r["key"], record)
        directory += archive.close() if archive else []
        yield pa.RecordBatch.from_pylist(directory, schema=_arrow(_DIRECTORY))

    sorted_ = planned.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id")
    return stored(sorted_.mapInArrow(write, _DIRECTORY), "directory")


# ---- reading -------------------------------------------------------------------------------

def _range(files, path: str, offset: int, length: int) -> bytes:
    with files.open_input_file(path) as f:
        return f.read_at(length, offset)


def _block(files, folder: str, entry: dict) -> list[tuple[str, int, int]]:
    text = zlib.decompress(_range(files, f"{folder}/{entry['index']}", entry["offset"], entry["length"])).decode()
    return [(k, int(o), int(n)) for k, o, n in (line.rsplit(" ", 2) for line in text.split("\n"))]


def _spans(directory: DataFrame, limit: int) -> Iterator[list[tuple[str, str, str]]]:
    """First key, last key and name of each archive, in order, in chunks of about `limit` bytes."""
    ranges = directory.groupBy("archive").agg(F.min("first_key").alias("a"), F.max("last_key").alias("b"))
    chunk, size = [], 0
    for r in ranges.orderBy("a", "b", "archive").toLocalIterator():
        chunk.append((r.a, r.b, r.archive))
        size += len(r.a) + len(r.b) + 100
        if size > limit:
            yield chunk
            chunk, size = [], 0
    yield chunk


def look_up(
    directory: DataFrame, folder: str, urls: DataFrame, url: str = "url", payloads: bool = True,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """The captures of each distinct given URL, each once, through the index.

    A key is searched among the archives' key ranges, then among its archive's directory rows, then
    inside a decompressed block; captures found there lie side by side and take one range read.
    Payloads are checked against their digests.  Unknown URLs give no row, a null URL asks for the empty
    one, an empty directory gives nothing.

    The archives' ranges, a line per archive, are broadcast in chunks of at most `chunk_bytes`, with one
    pass over the keys per chunk.  The keys of one archive are searched in one task, as many as an archive
    of limited size holds; blocks found are dealt out anew, so a URL with captures in many blocks is
    read by many tasks.
    """
    spark = directory.sparkSession
    asked = urls.select(url_key(F.coalesce(F.col(url), F.lit(""))).alias("asked")).distinct()
    found = []
    for chunk in _spans(directory, chunk_bytes):
        shared = spark.sparkContext.broadcast(chunk)

        def to_archive(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            spans = shared.value
            firsts = [a for a, _, _ in spans]
            lasts = list(accumulate((b for _, b, _ in spans), max))
            for batch in batches:
                keys, archives = [], []
                for key in batch.column("asked").to_pylist():
                    # ranges that begin at or before the key and end at or after it
                    for a, b, name in spans[bisect_left(lasts, key):bisect_right(firsts, key)]:
                        if a <= key <= b:
                            keys.append(key)
                            archives.append(name)
                yield pa.RecordBatch.from_pydict({"asked": pa.array(keys, pa.string()), "in_archive": pa.array(archives, pa.string())})

        found.append(asked.mapInArrow(to_archive, "asked string, in_archive string"))
    located = reduce(DataFrame.union, found)
    pair = T.StructType([T.StructField("asked", T.StringType()), *(f for f in _DIRECTORY.fields if f.name in _PLACE)])
    pair_arrow = _arrow(pair)

    def to_block(keys: pa.Table, blocks: pa.Table) -> pa.Table:
        entries = sorted(blocks.to_pylist(), key=lambda e: e["offset"])
        firsts, lasts = [e["first_key"] for e in entries], [e["last_key"] for e in entries]
        rows = [{"asked": key} | {c: e[c] for c in _PLACE} for key in keys.column("asked").to_pylist()
                for e in entries[bisect_left(lasts, key):bisect_right(firsts, key)]]
        return pa.Table.from_pylist(rows, schema=pair_arrow)

    pairs = located.groupBy("in_archive").cogroup(directory.groupBy("archive")).applyInArrow(to_block, pair)
    read_schema = _arrow(_READ)

    def fetch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = fs.FileSystem.from_uri(folder)
        place, captures, keys = None, [], []
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if place != (r["archive"], r["offset"]):
                    place, captures = (r["archive"], r["offset"]), _block(files, path, r)
                    keys = [c[0] for c in captures]
                hits = captures[bisect_left(keys, r["asked"]):bisect_right(keys, r["asked"])]
                if hits:
                    start, (_, offset, length) = hits[0][1], hits[-1]
                    data = _range(files, f"{path}/{r['archive']}", start, offset + length - start)
                    for key, o, n in hits:
                        row = {"key": key} | _parse(data[o - start:o - start + n])
                        rows.append(row if payloads else row | {"payload": None})
            yield pa.RecordBatch.from_pylist(rows, schema=read_schema)

    # by number: pairs are few bytes, but each stands for a read of an archive
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return pairs.repartition(slots, "archive", "offset").sortWithinPartitions("archive", "offset", "asked").mapInArrow(fetch, _READ)


def archive_folder(spark: SparkSession) -> str:
    """A fresh folder for archives below the shared one, as a URI."""
    path = scratch_dir(spark, "warc")
    return path if "://" in path or path.startswith("file:") else f"file://{path}"
