"""Find what repeats over a corpus without shuffling its texts.

A corpus is written once with a number for each row (``stable_copy``); 4096 rows in a file are a batch.
Tasks that scan it hash substrings into keys. Distinct keys of a batch, sorted, cut into buckets by their
upper bits and stored as differences, are the only thing that is shuffled: a key that a third of all rows
hold counts once per batch. A bucket is sorted alone, so memory is bounded by the number of buckets, which
grows with the corpus. Answers are keys, again by batch, written to files in the shared folder; the next
scan reads those of the batches it meets. Scans can be repeated, so a lost executor costs its tasks alone.
"""

from __future__ import annotations

import gc
import time
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from locusframe.llm import hashing
from locusframe.scratch import materialize, scratch_path

#: Rows of a batch as a power of two; keys of a bucket, about; files that answers are written to.
BATCH_BITS, BUCKET_KEYS, ANSWER_PARTS = 12, 2_000_000, 64

KeysOf = Callable[[str], np.ndarray]


def stable_copy(df: DataFrame, id_col: str, text_col: str, others: tuple[str, ...] = ()) -> DataFrame:
    """Written rows (batch, row, doc_id, digest, n_bytes, was_null, text, other_0...); a null text is empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    numbered = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
                         F.sha2(text, 256).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"),
                         F.col(text_col).isNull().alias("was_null"), text.alias("text"), *(F.col(f"`{c}`").alias(f"other_{k}") for k, c in enumerate(others)))
    path = scratch_path(df.sparkSession, "corpus")
    numbered.select(F.shiftright("row", BATCH_BITS).alias("batch"), "*").write.option("compression", "zstd").option(
        "maxRecordsPerFile", 1 << BATCH_BITS).parquet(path)
    return df.sparkSession.read.parquet(path)


def copies(copy: DataFrame) -> DataFrame:
    """Written rows (batch, row, doc_id, first_doc, first_row) of texts that occur more than once.

    The first of equal texts has the smallest id, null ids last, then the smallest row.
    """
    narrow = copy.select("batch", "row", "doc_id", "digest")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("is_null"), "doc_id", "row")).alias("first")
    firsts = materialize(narrow.groupBy("digest").agg(first, F.count(F.lit(1)).alias("n")).where("n > 1").select(
        "digest", F.col("first.doc_id").alias("first_doc"), F.col("first.row").alias("first_row")), "firsts")
    # Both sides are plain tables, so that a text with very many copies is a skewed join that Spark can split.
    return materialize(narrow.join(firsts, "digest").drop("digest"), "copies")


def bucket_bits(copy: DataFrame, keys_per_byte: float) -> int:
    total = copy.agg(F.sum("n_bytes")).first()[0] or 0
    return min(20, max(6, int(np.ceil(np.log2(max(1.0, total * keys_per_byte / BUCKET_KEYS))))))


def pack(numbers: np.ndarray) -> bytes:
    """Unsigned numbers byte plane by byte plane, without the upper planes that are empty; the top one is compressed."""
    planes = numbers.astype("<u8").view(np.uint8).reshape(-1, 8)
    used = 8
    while used > 1 and not planes[:, used - 1].any():
        used -= 1
    top = zlib.compress(planes[:, used - 1].tobytes(), 1)
    return bytes([used]) + len(top).to_bytes(4, "little") + top + planes[:, :used - 1].T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    used, size = data[0], int.from_bytes(data[1:5], "little")
    top = np.frombuffer(zlib.decompress(data[5:5 + size]), np.uint8)
    whole = np.zeros((len(top), 8), np.uint8)
    whole[:, used - 1] = top
    if used > 1:
        whole[:, :used - 1] = np.frombuffer(data, np.uint8, offset=5 + size).reshape(used - 1, -1).T
    return whole.view("<u8").ravel()


def squeeze(numbers: np.ndarray) -> bytes:
    """Sorted unsigned numbers, as their differences."""
    return pack(np.diff(numbers, prepend=np.uint64(0)))


def unsqueeze(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that are gone; it does so once the driver collects its garbage.

    Call it where no variable holds such a frame any more.
    """
    for _ in range(2):  # the first round lets go of what Python still named, the second finds it gone
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def segments(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Runs of rows of one batch number, which is the first column."""
    numbers = batch.column(0).to_numpy()
    cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
    for begin, end in zip(cuts, cuts[1:]):
        if end > begin:
            yield int(numbers[begin]), batch.slice(begin, end - begin)


class Answers:
    """What was found about a batch, read from the shared folder; ``None`` as folder stands for nothing."""

    def __init__(self, folder: str | None):
        self.folder, self.batch, self.table = folder, None, None

    def of(self, batch: int) -> pa.Table | None:
        if self.folder is None:
            return None
        if batch != self.batch:
            import pyarrow.dataset as ds

            from locusframe.llm.warc import _file_system

            system, path = _file_system(f"{self.folder}/part={batch % ANSWER_PARTS}")
            self.batch, self.table = batch, None
            if system.get_file_info(path).type.name == "Directory":
                self.table = ds.dataset(path, filesystem=system, format="parquet").to_table(filter=ds.field("batch") == batch)
        return self.table

    def keys(self, batch: int, column: str) -> np.ndarray:
        """Sorted distinct keys of all rows of the batch."""
        table = self.of(batch)
        found = [unsqueeze(x) for x in table.column(column).to_pylist() if x] if table is not None else []
        return hashing.distinct(np.concatenate(found)) if found else np.zeros(0, np.uint64)

    def values(self, batch: int, column: str) -> np.ndarray:
        table = self.of(batch)
        return table.column(column).to_numpy() if table is not None else np.zeros(0, np.int64)


def write_answers(df: DataFrame, label: str) -> str:
    """Write rows with a column ``batch`` where ``Answers`` looks for them; the folder."""
    path = scratch_path(df.sparkSession, label)
    parted = df.withColumn("part", F.pmod("batch", F.lit(ANSWER_PARTS)).cast("int"))
    parted.repartition("part").sortWithinPartitions("part", "batch").write.option(
        "compression", "zstd").partitionBy("part").parquet(path)
    return path


class Members:
    """Sorted distinct keys, found by two tables instead of a search through all of them.

    One has 8 to 16 places a key by the lowest bits and settles most keys that are not among them; the other says
    where keys with the same highest bits begin. Both grow with the keys, so that small sets stay in a processor's cache.
    """

    MOST_BITS = 24

    def __init__(self, keys: np.ndarray):
        self.keys, size = keys, len(keys).bit_length()
        self.table = np.zeros(1 << min(self.MOST_BITS, size + 3) if len(keys) else 1, bool)
        self.mask = np.uint64(len(self.table) - 1)
        self.table[keys & self.mask] = len(keys) > 0
        bits = min(self.MOST_BITS, size)
        self.shift = np.uint64(max(0, int(keys[-1]).bit_length() - bits if len(keys) else 0))
        counts = np.bincount((keys >> self.shift).view(np.int64), minlength=1 << bits)
        self.begins = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(counts, out=self.begins[1:])

    def __len__(self) -> int:
        return len(self.keys)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Where each key stands among the members; -1 if it is none."""
        found = np.full(len(keys), -1, np.int64)
        maybe = self.table.take((keys & self.mask).view(np.int64)).nonzero()[0]
        wanted = keys[maybe]
        top = np.minimum(wanted >> self.shift, np.uint64(len(self.begins) - 2)).view(np.int64)
        at, end = self.begins.take(top), self.begins.take(top + 1)
        left = (at < end).nonzero()[0]
        while len(left):
            here = at[left]
            same = self.keys.take(here) == wanted[left]
            found[maybe[left[same]]] = here[same]
            at[left] += 1
            left = left[~same & (here + 1 < end[left])]
        return found


def contains(sorted_keys: np.ndarray | Members, keys: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(len(keys), bool)
    if isinstance(sorted_keys, Members):
        return sorted_keys.places(keys) >= 0
    at = np.searchsorted(sorted_keys, keys)
    at[at == len(sorted_keys)] = 0
    return sorted_keys[at] == keys


def shared_keys(copy: DataFrame, keys_of: KeysOf, bits: int, skip: str | None, label: str, within: bool = False) -> str:
    """Keys that more than one row holds (``within``: or one row more than once), as answers in column ``keys``.

    Only the upper ``bits`` + 32 bits of a key are told apart, so a few keys may be given that are not shared;
    callers decide on whole strings or full hashes later. ``skip`` names answers whose column ``row`` lists
    rows to leave out. Keys in answers are cut to those upper bits; compare with ``coarse``.
    """
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        skipped = Answers(skip)
        for whole in batches:
            for number, part in segments(whole):
                out = set(skipped.values(number, "row").tolist())
                held, size = [], 0
                for row, text in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    if row in out:
                        continue
                    keys = coarse(keys_of(text), bits)
                    held.append(keys if within else hashing.distinct(keys))
                    size += len(held[-1])
                    if size >= 4_000_000:
                        yield from blobs(number, held)
                        held, size = [], 0
                if size:
                    yield from blobs(number, held)

    def blobs(number: int, held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        cuts = np.searchsorted(keys, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(32))
        rows = [(k, a, b) for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
        low = keys & np.uint64(0xFFFFFFFF)
        yield pa.RecordBatch.from_arrays([
            pa.array([k for k, _, _ in rows], pa.int32()), pa.array([number] * len(rows), pa.int64()),
            pa.array([squeeze(low[a:b]) for _, a, b in rows], pa.binary()),
            pa.array([np.packbits(counts[a:b] > 1).tobytes() for _, a, b in rows], pa.binary())],
            ["bucket", "batch", "keys", "repeated"])

    def settle(table: pa.Table) -> pa.Table:
        bucket = np.uint64(table.column("bucket")[0].as_py())
        parts = [unsqueeze(x) for x in table.column("keys").to_pylist()]
        again = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=len(p)).astype(bool)
                                for x, p in zip(table.column("repeated").to_pylist(), parts)])
        keys = np.concatenate(parts)
        owner = np.repeat(np.arange(len(parts)), list(map(len, parts)))
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        first = np.r_[True, ordered[1:] != ordered[:-1]]
        group = np.cumsum(first) - 1
        shared = np.empty(len(keys), bool)
        shared[order] = ((np.bincount(group) > 1) | (np.bincount(group, again[order]) > 0))[group]
        numbers = table.column("batch").to_numpy()
        rows = []
        for k, part in enumerate(parts):
            chosen = part[shared[owner == k]]
            if len(chosen):
                rows.append({"batch": int(numbers[k]), "keys": squeeze(chosen | (bucket << np.uint64(32)))})
        return pa.Table.from_pylist(rows, pa.schema([("batch", pa.int64()), ("keys", pa.binary())]))

    sent = copy.select("batch", "row", "text").mapInArrow(
        emit, "bucket int, batch long, keys binary, repeated binary")
    return write_answers(sent.groupBy("bucket").applyInArrow(settle, "batch long, keys binary"), label)


def coarse(keys: np.ndarray, bits: int) -> np.ndarray:
    return keys >> np.uint64(32 - bits)
