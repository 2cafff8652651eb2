"""WARC archives of pages, with a two-level capture index.

Writing: a page's record is a response if its payload is first seen with the smallest page_id among equal
payloads, else a revisit that names it. Each task writes archive files of bounded size, one gzip member per
record, and reports a capture for each: key, file, offset, length. Files have names of their own for each
attempt, and only the captures of attempts that Spark accepts are read, so a lost executor leaves no trace
but an unused file.

Index: captures are ordered by key, the URL with its host reversed (com,example)/path. Level one holds
compressed blocks of consecutive captures in block files; level two is a sparse directory, a row per block
with its first and last key. A lookup is range-partitioned like the directory, finds its blocks by
bisection, its captures by bisection inside a block, and reads just their byte ranges.

Files are written and read by tasks through Arrow's file systems, below the folder shared by all executors.
A null html has an empty payload; a null URL has the key of an empty one; a null page_id is larger than all
others and is written as an empty id. A row repeated with equal id and payload is a capture of its own of the same type as the first.
An empty table gives no archives and an empty result. Other columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from locusframe.scratch import materialize, scratch_path

#: Bytes after which a task begins another archive; captures in a block of the index.
ARCHIVE_BYTES, BLOCK_CAPTURES = 128 << 20, 1000
#: Byte ranges of one archive that lie this close are read at once.
GAP_BYTES, READ_BYTES = 64 << 10, 8 << 20

#: Bytes of the directory broadcast at once, blocks that a task writes.
DIRECTORY_BYTES, BLOCKS_OF_TASK = 32 << 20, 64
PLACED = "url_key string, block_file string, block_at long, block_size long"
CAPTURE = "page_id long, url_key string, archive string, at long, size long"
DIRECTORY = "first_key string, last_key string, block_file string, at long, size long, captures long"
RECORD = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
          "payload binary")


def url_key(url: str | None) -> str:
    """Reversed host, port, path and query: what sorts pages of a host and its subdomains together."""
    url = url or ""
    try:
        parts = urlsplit(url)
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url.lower()
    tail = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + tail


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _file_system(uri: str):
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    uri = uri.replace("s3a://", "s3://", 1)
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri.replace(" ", "%20"))


def _open_output(uri: str):
    system, path = _file_system(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path, compression=None)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One gzip member: a WARC/1.1 response or revisit record; both keep size and digest of the full payload."""
    revisit = refers_to is not None
    number = "" if page_id is None else str(page_id)
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{number}')}>",
        "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {json.dumps(url or '', ensure_ascii=True)[1:-1]}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}", f"X-Page-Id: {number}", f"X-Payload-Length: {len(payload)}",
        "Content-Type: text/html"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{refers_to}')}>",
                 f"X-Refers-To-Page: {refers_to}"]
    body = b"" if revisit else payload
    head.append(f"Content-Length: {len(body)}")
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n", 6, mtime=0)


def parse_record(member: bytes) -> dict:
    """Fields of a record; raises ValueError if a response does not hold what its digest says."""
    head, _, rest = gzip.decompress(member).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[:int(fields["Content-Length"])]
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (payload_digest(body) != digest or len(body) != int(fields["X-Payload-Length"])):
        raise ValueError(f"payload of page {fields['X-Page-Id']} is damaged")
    number = lambda x: int(x) if x else None
    return {"page_id": number(fields["X-Page-Id"]), "url": json.loads(f'"{fields["WARC-Target-URI"]}"'),
            "payload_bytes": int(fields["X-Payload-Length"]), "payload_digest": digest, "record_type": kind,
            "refers_to": number(fields.get("X-Refers-To-Page")), "payload": body if kind == "response" else None}


def revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, digest, refers_to) of the pages whose payload, of at least ``least_bytes``, has a smaller page_id."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    narrow = materialize(pages.select("page_id", F.sha1(payload).alias("digest"), F.length(payload).alias("n")).where(
        F.col("n") >= least_bytes).select("page_id", "digest"), "payload-digests")
    firsts = materialize(narrow.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where(
        "n > 1 AND refers_to IS NOT NULL").select("digest", "refers_to"), "payload-firsts")
    # Both sides are written tables, so that a payload that many pages share is a skewed join Spark can split.
    return narrow.join(firsts, "digest").where("NOT page_id <=> refers_to").select("page_id", "digest", "refers_to").distinct()


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write all pages below ``folder``; the result, itself written, has a row per capture."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    known = materialize(revisits(rows, least_bytes), "revisits")
    digest = F.sha1(F.encode("html", "UTF-8"))
    joined = rows.withColumn("digest", digest).join(
        known.withColumnsRenamed({"page_id": "known_id", "digest": "known_digest"}),
        F.col("page_id").eqNullSafe(F.col("known_id")) & (F.col("digest") == F.col("known_digest")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, name, at = None, "", 0
        try:
            for batch in batches:
                out: tuple[list, ...] = ([], [], [], [], [])
                for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                    if stream is None or at >= ARCHIVE_BYTES:
                        if stream is not None:
                            stream.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        stream = _open_output(f"{folder}/{name}")
                    member = record_bytes(page_id, url, html.encode(), refers_to)
                    stream.write(member)
                    for values, value in zip(out, (page_id, url_key(url), name, at, len(member))):
                        values.append(value)
                    at += len(member)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string()),
                     pa.array(out[3], pa.int64()), pa.array(out[4], pa.int64())],
                    ["page_id", "url_key", "archive", "at", "size"])
        finally:
            if stream is not None:
                stream.close()

    return materialize(joined.select("page_id", "url", "html", "refers_to").mapInArrow(run, CAPTURE), "captures")


def build_index(captures: DataFrame, folder: str, block_captures: int = BLOCK_CAPTURES) -> DataFrame:
    """Write the blocks below ``folder``; the result, itself written, is the directory, a row per block.

    A key with very many captures may fill several blocks and several tasks: captures are ordered by key,
    archive and offset, and the range partitioning cuts between any two of them.
    """
    names = ["url_key", "archive", "at", "size", "page_id"]
    parts = max(captures.sparkSession.sparkContext.defaultParallelism, -(-captures.count() // (BLOCKS_OF_TASK * block_captures)))
    ordered = captures.select(*names).repartitionByRange(parts, "url_key", "archive", "at").sortWithinPartitions(
        "url_key", "archive", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, name, at, lines = None, "", 0, []
        fields = ["first_key", "last_key", "block_file", "at", "size", "captures"]
        schema = pa.schema([(f, pa.string() if k < 3 else pa.int64()) for k, f in enumerate(fields)])

        def block() -> pa.RecordBatch:
            nonlocal stream, name, at, lines
            if stream is None:
                name = f"{uuid.uuid4().hex}.blocks"
                stream = _open_output(f"{folder}/{name}")
            data = zlib.compress("\n".join(map(json.dumps, lines)).encode(), 6)
            stream.write(data)
            row = [lines[0][0], lines[-1][0], name, at, len(data), len(lines)]
            at, lines = at + len(data), []
            return pa.RecordBatch.from_pylist([dict(zip(fields, row))], schema)

        try:
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns)):
                    lines.append(row)
                    if len(lines) == block_captures:
                        yield block()
            if lines:
                yield block()
        finally:
            if stream is not None:
                stream.close()

    return materialize(ordered.mapInArrow(run, DIRECTORY), "directory")


def lookup(directory: DataFrame, keys: DataFrame, folder: str) -> DataFrame:
    """Captures (page_id, url_key, archive, at, size) of the distinct keys in column ``url_key``.

    The directory is sparse, a thousandth of the captures, and the blocks of a file are neighbours. Files are put
    together in the order of their keys to slices of about ``DIRECTORY_BYTES``; one slice after the other is
    broadcast, and the keys in its range are placed by bisection, each in every block that may hold it. The driver
    sees a row for each block file.
    """
    wanted = materialize(keys.select(F.coalesce("url_key", F.lit("")).alias("url_key")).distinct(), "wanted-keys")
    files = directory.groupBy("block_file").agg(F.min("first_key").alias("low"), F.max("last_key").alias("high"), F.sum(
        F.length("first_key") + F.length("last_key") + 80).alias("bytes")).collect()
    slices: list[list] = []
    room = 0
    for file in sorted(files, key=lambda r: (r.low, r.high)):
        if file.bytes > room:
            slices.append([])
            room = DIRECTORY_BYTES
        slices[-1].append(file)
        room -= file.bytes
    found = wanted.sparkSession.createDataFrame([], PLACED)
    for some in slices:
        within = wanted.where(F.col("url_key").between(some[0].low, max(r.high for r in some)))
        found = found.unionByName(_assign_by_bisection(within, directory.where(F.col("block_file").isin([r.block_file for r in some]))))
    # One row per block, so that a block is read once; a task never has more keys of a block than it has captures.
    asked = found.groupBy("block_file", "block_at", "block_size").agg(F.collect_list("url_key").alias("url_keys"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url_key", pa.string()), ("archive", pa.string()),
                            ("at", pa.int64()), ("size", pa.int64())])
        for batch in batches:
            for name, at, size, wanted_keys in zip(*(c.to_pylist() for c in batch.columns)):
                system, path = _file_system(f"{folder}/{name}")
                with system.open_input_file(path) as f:
                    lines = list(map(json.loads, zlib.decompress(f.read_at(size, at)).decode().split("\n")))
                in_block, rows = [x[0] for x in lines], []
                for key in wanted_keys:
                    k = bisect_left(in_block, key)
                    while k < len(lines) and in_block[k] == key:
                        rows.append({"page_id": lines[k][4], "url_key": key, "archive": lines[k][1], "at": lines[k][2], "size": lines[k][3]})
                        k += 1
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return asked.select("block_file", "block_at", "block_size", "url_keys").mapInArrow(run, CAPTURE)


def _assign_by_bisection(wanted: DataFrame, blocks: DataFrame) -> DataFrame:
    """Written (url_key, block_file, block_at, block_size) for each key and each block that may hold it."""
    rows = sorted(tuple(r) for r in blocks.select("first_key", "last_key", "block_file", "at", "size").collect())
    shared = wanted.sparkSession.sparkContext.broadcast(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = shared.value
        lasts = [r[1] for r in rows]  # blocks do not overlap, so these are in order as well
        schema = pa.schema([("url_key", pa.string()), ("block_file", pa.string()), ("block_at", pa.int64()), ("block_size", pa.int64())])
        for batch in batches:
            out = []
            for key in batch.column(0).to_pylist():
                k = bisect_left(lasts, key)
                while k < len(rows) and rows[k][0] <= key:
                    out.append({"url_key": key, "block_file": rows[k][2], "block_at": rows[k][3], "block_size": rows[k][4]})
                    k += 1
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)

    placed = materialize(wanted.mapInArrow(run, PLACED), "placed-keys")
    shared.destroy()
    return placed


def read_records(captures: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of captures, a written table. Ranges of an archive are read in order, close ones together.

    The rows are narrow and what they stand for is not, so the number of tasks follows from the bytes to read.
    """
    spread = captures.select("archive", "at", "size", F.floor(F.col("at") / READ_BYTES).alias("slice"))
    total = captures.agg(F.sum("size")).first()[0] or 0
    parts = max(captures.sparkSession.sparkContext.defaultParallelism, -(-total // READ_BYTES))
    ordered = spread.repartition(parts, "archive", "slice").sortWithinPartitions("archive", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
            ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
        name, file = "", None
        for batch in batches:
            ranges, rows, held = list(zip(*(c.to_pylist() for c in batch.columns[:3]))), [], 0
            k = 0
            while k < len(ranges):
                archive, begin, size = ranges[k]
                end, more = begin + size, k + 1
                while (more < len(ranges) and ranges[more][0] == archive and ranges[more][1] - end <= GAP_BYTES
                       and ranges[more][1] + ranges[more][2] - begin <= READ_BYTES):
                    end, more = max(end, ranges[more][1] + ranges[more][2]), more + 1
                if archive != name:
                    system, path = _file_system(f"{folder}/{archive}")
                    name, file = archive, system.open_input_file(path)
                data = file.read_at(end - begin, begin)
                for _, at, length in ranges[k:more]:
                    record = parse_record(data[at - begin:at - begin + length])
                    held += record["payload_bytes"]
                    rows.append(record if with_payload else record | {"payload": None})
                k = more
                if held > READ_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)

    return ordered.select("archive", "at", "size").mapInArrow(run, RECORD)


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write all pages to archives, index them, and read every record back through the index."""
    folder = scratch_path(pages.sparkSession, "warc")
    captures = write_archives(pages, folder, least_bytes)
    directory = build_index(captures, folder)
    found = materialize(lookup(directory, captures.select("url_key"), folder), "found-captures")
    return read_records(found, folder, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
