"""WARC archives with a two-level capture index.

:func:`write` stores one gzip member per record.  Of records with equal
payloads of ``MIN_REVISIT`` bytes or more the one with the smallest page_id is
a response and the others are revisits without payload.

:func:`build_index` sorts the captures by reversed-host url key into shards.  A
shard is a file of zlib-packed blocks of ``BLOCK_LINES`` lines, then its sparse
directory (first key and byte range of every block).  :func:`find` bisects the
shards' key ranges (one row per shard, so bounded by the number of partitions),
then a shard's directory, then the lines of one block; the records are then
range-read.  The query looks up every page's key so; :func:`read_all` walks
every block of every shard instead.

Archives and shards are written and read through pyarrow's file systems, in the
one Spark uses for the folder (:func:`podium.llm.common.task_uri`).

Tasks write under names of their own attempt and report them; only reported
files are ever read, so a lost executor leaves nothing but an unread file.

Defined results: null html is an empty payload; a null url has an empty key and
no target header; a null page_id counts as larger than any other; rows that
repeat the smallest page_id are all responses; an empty table writes nothing
and reads back no row; extra columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.llm.common import in_order_by, mapped, salted_join, scratch_path, staged, table, task_uri, unstage
from podium.llm.url_filters import host

MIN_REVISIT = 100
BLOCK_LINES = 512
#: archives and shards are closed at about these sizes
ARCHIVE_BYTES, SHARD_LINES = 1 << 28, 1 << 20
DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def url_key(url: Column) -> Column:
    """``com,example,www)/path?query``: labels of the host reversed, no scheme, no fragment; control characters escaped."""
    rest = F.regexp_extract(url, r"://([^#]*)", 1)
    labels = F.array_join(F.reverse(F.split(host(url), r"\.")), ",")
    key = F.concat(labels, F.lit(")"), F.regexp_extract(rest, r"^[^/?]*(.*)$", 1))
    return F.coalesce(F.regexp_replace(key, r"[\x00-\x20\x7F]", "%20"), F.lit(""))


def records(pages: DataFrame) -> DataFrame:
    """page_id, url, key, payload, bytes, digest and first (the response's page_id for a revisit, else null)."""
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    p = p.withColumns({"bytes": F.octet_length("payload").cast("long"), "digest": F.sha2("payload", 256)})
    many = p.where(F.col("bytes") >= MIN_REVISIT).groupBy("digest").agg(F.min("page_id").alias("least"), F.count("*").alias("n"))
    known = salted_join(p, many.where("n > 1").drop("n"), ["digest"], F.coalesce("page_id", F.lit(0)))
    first = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("least")), F.col("least"))
    return known.select("page_id", "url", url_key(F.col("url")).alias("key"), "payload", "bytes", "digest", first.alias("first"))


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def _record(page_id: int | None, url: str | None, payload: str, size: int, digest: str, first: int | None) -> bytes:
    body = payload.encode() if first is None else b""
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page_id, digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Payload-Length: {size}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if page_id is not None:
        head.append(f"WARC-Page-ID: {page_id}")
    if first is not None:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_record_id(first, digest)}", f"WARC-Refers-To-Page-ID: {first}"]
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Writes the archives and returns their captures: key, path, offset, length."""
    folder = task_uri(pages.sparkSession, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        sink, name, offset = None, "", 0
        for b in batches:
            rows = []
            for lo in range(0, len(b), 256):
                for row in zip(*(c.to_pylist() for c in b.slice(lo, 256).columns)):
                    if sink is None or offset >= ARCHIVE_BYTES:
                        if sink is not None:
                            sink.close()
                        name, offset = f"pages-{uuid.uuid4().hex}.warc.gz", 0
                        sink = fs.open_output_stream(f"{base}/{name}", compression=None)
                    page_id, url, key, payload, size, digest, first = row
                    packed = gzip.compress(_record(page_id, url, payload, size, digest, first), 6, mtime=0)
                    sink.write(packed)
                    rows.append((key, f"{folder}/{name}", offset, len(packed)))
                    offset += len(packed)
            cols = list(zip(*rows)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int64(), pa.int64()))], ["key", "path", "offset", "length"]
            )
        if sink is not None:
            sink.close()

    rows = records(pages).select("page_id", "url", "key", "payload", "bytes", "digest", "first")
    return staged(mapped(rows, run, "key string, path string, offset long, length long"), "captures")


def build_index(captures: DataFrame, folder: str) -> DataFrame:
    """Writes the index shards and returns them: path, first_key, last_key, n_blocks, n_lines, n_bytes (of their records)."""
    folder = task_uri(captures.sparkSession, folder)
    # offsets make the order total, so captures of one hot key are cut into several ranges
    ordered = in_order_by(captures, [F.col("key"), F.col("path"), F.col("offset")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        done, lines, directory = [], [], []
        sink, name, offset, n_lines, n_bytes, first = None, "", 0, 0, 0, ""

        def block():
            nonlocal lines, offset, n_lines
            packed = zlib.compress("\n".join(lines).encode())
            directory.append((lines[0].split("\t", 1)[0], offset, len(packed)))
            sink.write(packed)
            offset += len(packed)
            n_lines += len(lines)
            lines = []

        def close(last: str):
            nonlocal sink, directory
            packed = zlib.compress("\n".join(f"{k}\t{o}\t{n}" for k, o, n in directory).encode())
            sink.write(packed + struct.pack("<QQ", offset, len(packed)))
            sink.close()
            done.append((f"{folder}/{name}", first, last, len(directory), n_lines, n_bytes))
            sink, directory = None, []

        last = ""
        for b in batches:
            for key, path, at, size in zip(*(c.to_pylist() for c in b.columns)):
                if sink is None:
                    name, offset, n_lines, n_bytes, first = f"index-{uuid.uuid4().hex}.cdx", 0, 0, 0, key
                    sink = fs.open_output_stream(f"{base}/{name}")
                lines.append(f"{key}\t{path}\t{at}\t{size}")
                n_bytes += size
                last = key
                if len(lines) == BLOCK_LINES:
                    block()
                    if n_lines >= SHARD_LINES:
                        close(last)
        if lines:
            block()
        if sink is not None:
            close(last)
        cols = list(zip(*done)) or [()] * 6
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()))],
            ["path", "first_key", "last_key", "n_blocks", "n_lines", "n_bytes"],
        )

    schema = "path string, first_key string, last_key string, n_blocks long, n_lines long, n_bytes long"
    return staged(mapped(ordered, run, schema), "shards")


class Files:
    """Input files kept open while a task reads ranges of them."""

    def __init__(self):
        self.open: dict[str, pa.NativeFile] = {}

    def read(self, uri: str, offset: int, size: int) -> bytes:
        if uri not in self.open:
            if len(self.open) >= 64:
                self.open.popitem()[1].close()
            fs, path = pafs.FileSystem.from_uri(uri)
            self.open[uri] = fs.open_input_file(path)
        return self.open[uri].read_at(size, offset)

    def directory(self, uri: str) -> list[tuple[bytes, int, int]]:
        """First key, offset and size of every block of a shard."""
        self.read(uri, 0, 0)
        end = self.open[uri].size()
        at, size = struct.unpack("<QQ", self.read(uri, end - 16, 16))
        lines = zlib.decompress(self.read(uri, at, size)).split(b"\n")
        return [(k, int(o), int(n)) for k, o, n in (x.split(b"\t") for x in lines)]

    def lines(self, uri: str, offset: int, size: int) -> list[bytes]:
        return zlib.decompress(self.read(uri, offset, size)).split(b"\n")


_OUT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload string"


def _fields(raw: bytes) -> tuple:
    fields, payload = parse_record(gzip.GzipFile(fileobj=io.BytesIO(raw)).read())
    kind = fields["WARC-Type"]
    digest, size = fields["WARC-Payload-Digest"].removeprefix("sha256:"), int(fields["WARC-Payload-Length"])
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    page, refers = fields.get("WARC-Page-ID"), fields.get("WARC-Refers-To-Page-ID")
    return (
        None if page is None else int(page), size, digest, kind, None if refers is None else int(refers),
        fields.get("WARC-Target-URI"), payload.decode() if kind == "response" else None,
    )


def _out(rows: list[tuple], payload: bool) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
    names = [x.split()[0] for x in _OUT.split(", ")]
    cols = list(zip(*rows)) or [()] * 7
    n = 7 if payload else 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols[:n], types[:n])], names[:n])


def entries(shards: DataFrame) -> DataFrame:
    """key, path, offset, length of every capture, read block by block through the shards' directories."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri in b.column(0).to_pylist():
                d = Files().directory(uri)
                yield pa.RecordBatch.from_arrays([pa.array([uri] * len(d)), pa.array([x[1] for x in d]), pa.array([x[2] for x in d])], ["shard", "at", "size"])

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = Files()
        for b in batches:
            for shard, at, size in zip(*(c.to_pylist() for c in b.columns)):
                got = [x.decode().split("\t") for x in files.lines(shard, at, size)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in got]), pa.array([x[1] for x in got]), pa.array([int(x[2]) for x in got]), pa.array([int(x[3]) for x in got])],
                    ["key", "path", "offset", "length"],
                )

    n_shards, n_tasks = _tasks(shards)
    listed = mapped(shards.select("path").repartition(n_shards), blocks, "shard string, at long, size long")
    return mapped(listed.repartition(n_tasks, "shard", "at"), lines, _ENTRY)


_ENTRY = "key string, path string, offset long, length long"
#: bytes of records that a task reads
TASK_BYTES = 8 << 20


def _tasks(shards: DataFrame) -> tuple[int, int]:
    """Tasks for the shards, and for the records they name.

    A row stands for a whole file, block or record, so tasks are counted by the
    bytes behind the rows; partitions of a given number are not merged by the
    few bytes of the rows themselves.
    """
    got = shards.agg(F.count("*").alias("n"), F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("bytes")).first()
    return max(2, got["n"]), max(2, got["n"], -(-got["bytes"] // TASK_BYTES))


def _records(shards: DataFrame, found: DataFrame, payload: bool, asked: bool = False) -> DataFrame:
    """The records of entries (path, offset, length, with ``asked`` also asked), archives in order of offsets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = Files()
        for b in batches:
            for lo in range(0, len(b), 512):
                c = b.slice(lo, 512)
                got = _out([_fields(files.read(*x)) for x in zip(*(c.column(i).to_pylist() for i in range(3)))], payload)
                yield pa.RecordBatch.from_arrays([c.column(3), *got.columns], ["asked", *got.schema.names]) if asked else got

    columns = ["path", "offset", "length", *(["asked"] if asked else [])]
    ordered = in_order_by(found.select(*columns), [F.col("path"), F.col("offset")], _tasks(shards)[1])
    return mapped(ordered, run, ("asked string, " if asked else "") + (_OUT if payload else ", ".join(_OUT.split(", ")[:5])))


def read_all(shards: DataFrame, payload: bool = False) -> DataFrame:
    """Every record, by a walk through all blocks of the index."""
    return _records(shards, entries(shards), payload)


def find(shards: DataFrame, keys: DataFrame) -> DataFrame:
    """key, path, offset, length of the captures of the given distinct keys (column ``key``), by binary search.

    The shards' key ranges (one row per shard, told to every task) say which
    shards may hold a key; there the sparse directory says which blocks, and a
    block's sorted lines are bisected.  A key that fills several shards is
    looked up in each of them by a task of its own.
    """
    tops = sorted((r["first_key"].encode(), r["last_key"].encode(), r["path"]) for r in shards.select("first_key", "last_key", "path").collect())
    last_keys = [t[1] for t in tops]

    def first_level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for key in b.column(0).to_pylist():
                raw = key.encode()
                # shards are in key order; a key may go on in the next ones
                i = bisect_left(last_keys, raw)
                while i < len(tops) and tops[i][0] <= raw:
                    rows.append((tops[i][2], key))
                    i += 1
            cols = list(zip(*rows)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], ["shard", "key"])

    def second_level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, now, starts, directory = Files(), None, [], []
        block, keys, lines = -1, [], []
        for b in batches:
            rows = []
            for shard, key in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                raw = key.encode()
                if shard != now:
                    now, block, directory = shard, -1, files.directory(shard)
                    starts = [x[0] for x in directory]
                j = max(0, bisect_left(starts, raw) - 1)
                while j < len(directory) and starts[j] <= raw:
                    if j != block:
                        block, lines = j, files.lines(shard, *directory[j][1:])
                        keys = [x.split(b"\t", 1)[0] for x in lines]
                    for line in lines[bisect_left(keys, raw) : bisect_right(keys, raw)]:
                        _, path, at, size = line.decode().split("\t")
                        rows.append((key, path, int(at), int(size)))
                    j += 1
                if len(rows) >= 8192:
                    yield _entries(rows)
                    rows = []
            yield _entries(rows)

    wanted = mapped(keys.select(F.col("key").cast("string").alias("key")).where("key IS NOT NULL"), first_level, "shard string, key string")
    by_shard = wanted.repartition(_tasks(shards)[0], "shard").sortWithinPartitions("shard", "key")
    return mapped(by_shard, second_level, _ENTRY)


def _entries(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int64(), pa.int64()))], ["key", "path", "offset", "length"])


def lookup(shards: DataFrame, urls: DataFrame) -> DataFrame:
    """The records of the given urls (column ``url``), with their payloads; ``asked`` is the url asked for."""
    keyed = urls.select(F.col("url").alias("asked"), url_key(F.col("url")).alias("key"))
    found = find(shards, keyed.select("key").distinct()).join(keyed, "key")
    return _records(shards, found, payload=True, asked=True)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    pages = table(spark, sf_dir, "pages")
    captures = write(pages, folder)
    shards = build_index(captures, folder)
    unstage(captures)
    # each key once; captures without a url lie under the empty key
    return _records(shards, find(shards, pages.select(url_key(F.col("url")).alias("key")).distinct()), payload=False)


ORACLE = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p
), f AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS least FROM d
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN least IS NULL OR page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> least THEN least END AS refers_to
FROM f
"""
