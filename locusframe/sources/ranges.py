"""Read text files by ranges in tasks, in the order of their lines.

Spark's text source reads a gzip file in one task and leaves out some names. Here a blocked gzip file (members of at
most 64 KB that state their size in an extra field) is cut into ranges of compressed bytes, and each range is a task:
it looks for the first block that begins in it, unpacks blocks up to its end, and repairs the lines that ranges
share. The line that a range begins with belongs to the range before, which reads on until that line ends. Ordinary
gzip is unpacked by one task, its lines numbered in slices, and the slices are spread.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

#: Lines with their place: slices of a file, and lines of a slice, count from zero.
LINES = "source_file string, slice long, line_number long, line string"
#: The columns that say where a line stood.
ORDER = ("slice", "line_number")
#: Bytes of a file that a task reads.
RANGE_BYTES = 64 << 20
#: Text of a packed file that one task takes at least, however small its slices are.
SPREAD_BYTES = 16 << 20


def _reader(slice_bytes: int):
    """The task that reads (path, kind, number, begin, end) as numbered lines.

    It is a nested function so that it travels to the workers with its body.
    """
    def run(batches: Iterator) -> Iterator:
        import gzip
        import zlib

        from urllib.parse import quote

        import pyarrow as pa
        from pyarrow import fs

        schema = pa.schema([("source_file", pa.string()), ("slice", pa.int64()), ("line_number", pa.int64()), ("line", pa.string())])
        magic, most = b"\x1f\x8b\x08\x04", 1 << 16

        def block_size(data: bytes, at: int) -> int | None:
            """Bytes of the block that begins there; None if none does."""
            if data[at:at + 4] != magic or len(data) < at + 18:
                return None
            end = at + 12 + int.from_bytes(data[at + 10:at + 12], "little")
            at += 12
            while at + 4 <= min(end, len(data)):
                size = int.from_bytes(data[at + 2:at + 4], "little")
                if data[at:at + 2] == b"BC" and size == 2 and at + 6 <= len(data):
                    return int.from_bytes(data[at + 4:at + 6], "little") + 1
                at += 4 + size
            return None

        def first_block(file, begin: int, length: int) -> int:
            """The first place from ``begin`` on where a block begins that another one or the end follows."""
            while begin < length:
                file.seek(begin)
                data = file.read(3 * most)
                at = data.find(magic)
                while 0 <= at < most:
                    size = block_size(data, at)
                    if size and (begin + at + size == length or block_size(data, at + size)):
                        return begin + at
                    at = data.find(magic, at + 1)
                begin += most
            return length

        def blocks(file, begin: int, length: int):
            """(place, text) of the blocks from one on."""
            data, at, used = b"", begin, 0
            file.seek(begin)
            while True:
                if len(data) - used < 2 * most:
                    more = file.read(1 << 20)
                    data, at, used = data[used:] + more, at + used, 0
                if used == len(data):
                    return
                size = block_size(data, used)
                if not size or used + size > len(data):
                    raise ValueError(f"damaged block at byte {at + used}")
                yield at + used, zlib.decompress(data[used:used + size], 31)
                used += size

        def bytes_of(file, begin: int, end: int, length: int):
            file.seek(begin)
            while begin < length:
                data = file.read(min(1 << 20, end - begin if begin < end else length - begin))
                yield begin, data
                begin += len(data)

        def unpacked(file):
            with gzip.GzipFile(fileobj=file) as text:
                while data := text.read(1 << 20):
                    yield 0, data

        def lines_of(pieces, first: bool, end: int):
            """Lists of the lines that belong to a range; ``held`` is None before the first line feed."""
            held = [] if first else None
            for place, data in pieces:
                past = place >= end
                if held is None:
                    cut = data.find(b"\n")
                    if past or cut < 0:
                        if past:
                            return
                        continue
                    data, held = data[cut + 1:], []
                cut = data.find(b"\n") if past else data.rfind(b"\n")
                if cut < 0:
                    held.append(data)
                    continue
                yield b"".join([*held, data[:cut]]).split(b"\n")
                if past:
                    return
                held = [data[cut + 1:]]
            rest = b"".join(held or [])
            if rest:
                yield [rest]

        for batch in batches:
            for row in batch.to_pylist():
                uri = quote(row["path"].replace("s3a://", "s3://", 1), safe="/:@!$&'()*+,;=~")
                system, inner = fs.FileSystem.from_uri(uri)
                with system.open_input_file(inner) as file:
                    length, begin, end = file.size(), row["begin"], row["end"]
                    if row["kind"] == "blocked":
                        pieces = blocks(file, first_block(file, begin, length), length)
                    elif row["kind"] == "packed":
                        pieces = unpacked(file)
                    else:
                        pieces = bytes_of(file, begin, end, length)
                    number, nth, size, texts = row["number"], 0, 0, []

                    def done(texts=texts):
                        n = len(texts)
                        return pa.RecordBatch.from_pydict(
                            {"source_file": [row["path"]] * n, "slice": [number] * n, "line_number": list(range(nth - n, nth)), "line": texts}, schema)

                    in_slice = 0
                    for lines in lines_of(pieces, begin == 0, end):
                        for line in lines:
                            texts.append(line.decode("utf-8", "replace").removesuffix("\r"))
                            nth += 1
                            size += len(line) + 1
                            if size >= 1 << 20:
                                yield done(texts)
                                in_slice, size, texts = in_slice + size, 0, []
                            if row["kind"] == "packed" and in_slice + size >= slice_bytes:
                                yield done(texts)
                                number, nth, size, in_slice, texts = number + 1, 0, 0, 0, []
                    yield done(texts)

    return run


def _kinds():
    """The task that says of gzip files whether they are blocked."""
    def run(batches: Iterator) -> Iterator:
        from urllib.parse import quote

        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            kinds = []
            for path in batch.column(0).to_pylist():
                if not path.lower().endswith(".gz"):
                    kinds.append("plain")
                    continue
                system, inner = fs.FileSystem.from_uri(quote(path.replace("s3a://", "s3://", 1), safe="/:@!$&'()*+,;=~"))
                with system.open_input_stream(inner, compression=None) as stream:
                    head = stream.read(18)
                kinds.append("blocked" if head[:4] == b"\x1f\x8b\x08\x04" and head[12:14] == b"BC" else "packed")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(kinds, pa.string())], ["path", "length", "kind"])

    return run


def file_kinds(files: DataFrame) -> DataFrame:
    """path, length and kind: plain text, blocked or packed gzip; each gzip file is opened for its first bytes."""
    spark = files.sparkSession
    tasks = spark.sparkContext.defaultParallelism * 4
    return files.select("path", "length").repartition(tasks, "path").mapInArrow(_kinds(), "path string, length long, kind string")


def read_ranges(files: DataFrame, slice_bytes: int, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Lines (source_file, slice, line_number, line) of files of known kind; ``files`` is a written table.

    Plain and blocked files are read by as many tasks as they have ranges, and a slice is a range. A packed file
    is one task, whose slices of about ``slice_bytes`` of text are then spread over tasks, each in its order.
    """
    spark = files.sparkSession
    last = F.greatest(F.ceil(F.col("length") / range_bytes) - 1, F.lit(0)).cast("long")
    number = F.when(F.col("kind") == "packed", F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), last))
    cut = files.withColumn("number", F.explode(number)).select(
        "path", "kind", "number", (F.col("number") * range_bytes).alias("begin"),
        F.when(F.col("kind") == "packed", F.col("length") + 1).otherwise((F.col("number") + 1) * range_bytes).alias("end"))
    totals = cut.groupBy("kind").agg(F.count(F.lit(1)).alias("ranges"), F.sum(F.col("end") - F.col("begin")).alias("bytes")).collect()
    ranges = {r.kind == "packed": 0 for r in totals}
    for r in totals:
        ranges[r.kind == "packed"] += r.ranges
    read = None
    for packed, count in ranges.items():
        own = cut.where((F.col("kind") == "packed") == packed).repartition(count, "path", "number").mapInArrow(_reader(slice_bytes), LINES)
        if packed:
            size = next(r.bytes for r in totals if r.kind == "packed")
            parts = max(spark.sparkContext.defaultParallelism, -(-size * 8 // max(slice_bytes, SPREAD_BYTES)))
            own = in_order(own, parts)
        read = own if read is None else read.unionByName(own)
    return read if read is not None else spark.createDataFrame([], LINES)


def in_order(rows: DataFrame, parts: int | None = None) -> DataFrame:
    """Bring the lines of a slice together again, in their order, and slices of a file next to each other."""
    keys = ["source_file", "slice"]
    dealt = rows.repartition(parts, *keys) if parts else rows.repartition(*keys)
    return dealt.sortWithinPartitions(*keys, "line_number")
