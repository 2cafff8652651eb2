"""Substring dedup by blockwise suffix sorting with a difference cover.

Of each text the bytes go that lie in a string of 50 bytes which also starts in a document of smaller id.
Suffixes need to be told apart to 50 bytes only, and are sorted one bucket at a time, never all together.

The positions whose remainder modulo 13 is in ``COVER`` are the sample: any two positions have a common
shift below 13 that takes both into it, so two equal strings of 50 bytes hold, at one shift, equal sample
strings of 38 bytes. Sample strings are ranked first (``exchange.shared_keys``; a rank is a hash, as only
ties matter). Where no sample string of a window is tied with another text the suffix is settled; only
suffixes with a tie go on to a bucket, cut by the upper bits of their key. A bucket is sorted alone, the
first document of every group of equal keys is found, and batches learn which of their keys start earlier.

Keys are 64-bit hashes of all 50 bytes; a false match among n suffixes has a chance of about n^2 / 2^65.
A null text is empty. Null ids come after all others; rows of equal id do not count as earlier than each
other, so repeated rows get equal results. Texts of fewer than 50 bytes stay whole. An empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from locusframe.llm import exchange, hashing

WIDTH, PERIOD = 50, 13
#: A difference cover: every remainder modulo 13 is a difference of two of these.
COVER = (0, 1, 3, 9)
SAMPLE_WIDTH = WIDTH - PERIOD + 1
#: Bytes hashed at a time, and keys of a batch sent at a time.
SLICE, SENT = 1 << 20, 4_000_000

_LAST = np.iinfo(np.int64).max


def _cover(count: int) -> np.ndarray:
    """Positions of the cover among the first ``count``."""
    whole, rest = divmod(max(count, 0), PERIOD)
    every = (np.arange(whole + 1)[:, None] * PERIOD + np.array(COVER)).ravel()
    return every[:len(COVER) * whole + sum(c < rest for c in COVER)]


_COVER_OF_MOST = _cover(1 << 16)
_COVER_OF_MOST.flags.writeable = False


def cover_positions(n: int) -> np.ndarray:
    """Sample positions of a text of n bytes from which a sample string fits."""
    count = n - SAMPLE_WIDTH + 1
    return _cover(count) if count > 1 << 16 else _COVER_OF_MOST[:np.searchsorted(_COVER_OF_MOST, count)]


def _slices(n: int, width: int) -> Iterator[tuple[int, int]]:
    """Ranges of positions, and so much text that each position has its string."""
    for begin in range(0, max(n - width + 1, 0), SLICE):
        yield begin, min(begin + SLICE, n - width + 1)


def sample_keys(data: np.ndarray) -> np.ndarray:
    """Keys of the sample strings, in order of position."""
    at = cover_positions(len(data))
    if len(data) <= SLICE:
        return hashing.runs_at(*hashing.running(hashing.byte_values(data)), SAMPLE_WIDTH, at)
    found = []
    for begin, end in _slices(len(data), SAMPLE_WIDTH):
        own = at[(at >= begin) & (at < end)] - begin
        found.append(hashing.runs(hashing.byte_values(data[begin:end + SAMPLE_WIDTH - 1]), SAMPLE_WIDTH, own))
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def tied_windows(data: np.ndarray, ties: np.ndarray | exchange.Members, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and keys of the windows that hold a sample string which is tied."""
    n = len(data) - WIDTH + 1
    if n <= 0 or not len(ties):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    cover, whole = cover_positions(len(data)), len(data) <= SLICE
    sums, down = hashing.running(hashing.byte_values(data)) if whole else (None, None)
    samples = hashing.runs_at(sums, down, SAMPLE_WIDTH, cover) if whole else sample_keys(data)
    tied = cover[exchange.contains(ties, exchange.coarse(samples, bits))]
    if not len(tied):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    change = np.zeros(len(data) + 1, np.int8)  # fewer than 2 * PERIOD are open at a time
    begin = tied - PERIOD + 1  # positions are distinct, but for those before the text
    change[0] = np.count_nonzero(begin <= 0)
    change[begin[begin > 0]] += 1
    change[tied + 1] -= 1
    at = np.flatnonzero(np.cumsum(change[:n], dtype=np.int8) > 0)
    if whole:
        return at, hashing.runs_at(sums, down, WIDTH, at)
    keys = []
    for begin, end in _slices(len(data), WIDTH):
        own = at[np.searchsorted(at, begin):np.searchsorted(at, end)] - begin
        if len(own):
            keys.append(hashing.runs(hashing.byte_values(data[begin:end + WIDTH - 1]), WIDTH, own))
    return at, np.concatenate(keys) if keys else np.zeros(0, np.uint64)


def _first_owners(keys: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, the smallest owner of each, and whether there is a larger one."""
    order = np.lexsort((owners, keys))
    keys, owners = keys[order], owners[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    last = np.r_[first[1:], len(keys)] - 1
    return keys[first], owners[first], owners[last] > owners[first]


def _earlier_keys(copy: DataFrame, ties: str, bits: int, skip: str) -> str:
    """Answers: ``before``, keys that start in a document before all of the batch that have them; ``inside``,
    keys whose first document is in the batch and others too, with that document in ``first``."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers, skipped = exchange.Answers(ties), exchange.Answers(skip)
        for whole in batches:
            for number, part in exchange.segments(whole):
                out, tied, keys, owners, size = set(skipped.values(number, "row").tolist()), exchange.Members(answers.keys(number, "keys")), [], [], 0
                for row, text, doc in zip(*(part.column(k).to_pylist() for k in (1, 2, 3))):
                    if row in out:
                        continue
                    own = hashing.distinct(tied_windows(hashing.to_bytes(text), tied, bits)[1])
                    keys.append(own)
                    owners.append(np.full(len(own), _LAST if doc is None else doc, np.int64))
                    size += len(own)
                    if size >= SENT:
                        yield blobs(number, keys, owners)
                        keys, owners, size = [], [], 0
                if size:
                    yield blobs(number, keys, owners)

    def blobs(number: int, held: list[np.ndarray], owned: list[np.ndarray]) -> pa.RecordBatch:
        keys, owners, more = _first_owners(np.concatenate(held), np.concatenate(owned))
        names, places = np.unique(owners, return_inverse=True)
        cuts = np.r_[np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)), len(keys)]
        low = keys & np.uint64((1 << (64 - bits)) - 1)
        rows = [(k, a, b) for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
        return pa.RecordBatch.from_arrays([
            pa.array([k for k, _, _ in rows], pa.int32()), pa.array([number] * len(rows), pa.int64()),
            pa.array([exchange.squeeze(low[a:b]) for _, a, b in rows], pa.binary()),
            pa.array([np.packbits(more[a:b]).tobytes() for _, a, b in rows], pa.binary()),
            pa.array([exchange.pack(places[a:b]) for _, a, b in rows], pa.binary()),
            pa.array([exchange.squeeze(names.view(np.uint64))] * len(rows), pa.binary())],
            ["bucket", "batch", "keys", "more", "places", "names"])

    def settle(table: pa.Table) -> pa.Table:
        parts = [exchange.unsqueeze(x) for x in table.column("keys").to_pylist()]
        keys, owners, more = np.concatenate(parts), [], []
        for part, flags, places, names in zip(parts, *(table.column(c).to_pylist() for c in ("more", "places", "names"))):
            table_of = exchange.unsqueeze(names).view(np.int64)
            owners.append(table_of[exchange.unpack(places).astype(np.int64)])
            more.append(np.unpackbits(np.frombuffer(flags, np.uint8), count=len(part)).astype(bool))
        batches = np.repeat(table.column("batch").to_numpy(), list(map(len, parts)))
        owners, more = np.concatenate(owners), np.concatenate(more)
        order = np.lexsort((owners, batches, keys))  # one bucket of suffixes, sorted alone
        keys, batches, owners, more = keys[order], batches[order], owners[order], more[order]
        new_key = np.r_[True, keys[1:] != keys[:-1]]
        new = np.flatnonzero(new_key | np.r_[True, batches[1:] != batches[:-1]])  # a key in a batch
        last = np.r_[new[1:], len(keys)] - 1
        starts = np.flatnonzero(new_key)
        first = np.minimum.reduceat(owners, starts)[np.cumsum(new_key) - 1]
        inner = np.logical_or.reduceat(more, new) | (owners[last] > owners[new])
        before, inside = first[new] < owners[new], (first[new] == owners[new]) & inner
        bucket = np.uint64(table.column("bucket")[0].as_py()) << np.uint64(64 - bits)
        rows = []
        by_batch = np.argsort(batches[new], kind="stable")
        numbers, begins = np.unique(batches[new][by_batch], return_index=True)
        for number, chosen in zip(numbers.tolist(), np.split(by_batch, begins[1:])):
            own = new[chosen]
            b, i = own[before[chosen]], own[inside[chosen]]
            if len(b) or len(i):
                rows.append({"batch": number, "before": exchange.squeeze(keys[b] | bucket) if len(b) else None,
                             "inside": exchange.squeeze(keys[i] | bucket) if len(i) else None, "first": exchange.pack(owners[i].view(np.uint64)) if len(i) else None})
        return pa.Table.from_pylist(rows, pa.schema([
            ("batch", pa.int64()), ("before", pa.binary()), ("inside", pa.binary()), ("first", pa.binary())]))

    sent = copy.select("batch", "row", "text", F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(
        emit, "bucket int, batch long, keys binary, more binary, places binary, names binary")
    found = sent.groupBy("bucket").applyInArrow(settle, "batch long, before binary, inside binary, first binary")
    return exchange.write_answers(found, "earlier-suffixes")


def _kept_bytes(copy: DataFrame, columns: list[str], schema: T.StructType, finish) -> DataFrame:
    """Run ``finish(kept bytes, n_bytes, n_removed, n_spans)`` on every row; it gives the values of the last columns."""
    seen = exchange.copies(copy)
    later = F.col("first_doc").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") > F.col("first_doc")))
    skip = exchange.write_answers(seen.where(later).select("batch", "row"), "copied-rows")
    bits = exchange.bucket_bits(copy, len(COVER) / PERIOD)
    ties = exchange.shared_keys(
        copy, lambda text: sample_keys(hashing.to_bytes(text)), bits, skip, "tied-samples")
    exchange.release(copy.sparkSession)
    earlier = _earlier_keys(copy, ties, bits, skip)
    exchange.release(copy.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tie_answers, skipped, answers = exchange.Answers(ties), exchange.Answers(skip), exchange.Answers(earlier)
        for whole in batches:
            for number, part in exchange.segments(whole):
                out, tied = set(skipped.values(number, "row").tolist()), exchange.Members(tie_answers.keys(number, "keys"))
                before, inside, first = exchange.Members(answers.keys(number, "before")), np.zeros(0, np.uint64), np.zeros(0, np.int64)
                if (table := answers.of(number)) is not None:
                    pairs = [(exchange.unsqueeze(k), exchange.unpack(f).view(np.int64)) for k, f in zip(
                        table.column("inside").to_pylist(), table.column("first").to_pylist()) if k]
                    if pairs:
                        inside, first = (np.concatenate(x) for x in zip(*pairs))
                        order = np.argsort(inside)
                        inside, first = inside[order], first[order]
                inside = exchange.Members(inside)

                def settle(waiting: list[tuple]) -> Iterator:
                    """Results of rows (bytes, id, positions and keys of tied windows); all keys are looked up at once."""
                    every = np.concatenate([keys for *_, keys in waiting])
                    starts = exchange.contains(before, every)
                    if len(inside):
                        owners = np.repeat(np.array([doc for _, doc, _, _ in waiting], np.int64), [len(keys) for *_, keys in waiting])
                        own = inside.places(every)
                        starts |= (own >= 0) & (first[own] < owners)
                    end = 0
                    for data, _, at, keys in waiting:
                        n, begin, end = len(data), end, end + len(keys)
                        gone = at[starts[begin:end]]
                        if not len(gone):
                            yield finish(data.tobytes(), n, 0, 0)
                            continue
                        change = np.zeros(n + 1, np.int32)
                        change[gone] += 1
                        change[gone + WIDTH] -= 1
                        removed = np.cumsum(change[:n]) > 0
                        spans = int(np.count_nonzero(removed[1:] & ~removed[:-1])) + int(removed[0])
                        yield finish(data[~removed].tobytes(), n, int(removed.sum()), spans)

                results, waiting, size = [], [], 0
                for row, text, doc in zip(*(part.column(k).to_pylist() for k in (1, 2, 3))):
                    data = hashing.to_bytes(text)
                    if row in out and len(data) >= WIDTH:
                        results.extend(settle(waiting) if waiting else ())
                        results.append(finish(b"", len(data), len(data), 1))
                        waiting, size = [], 0
                        continue
                    waiting.append((data, _LAST if doc is None else doc, *tied_windows(data, tied, bits)))
                    size += len(data)
                    if size >= SLICE:
                        results.extend(settle(waiting))
                        waiting, size = [], 0
                results.extend(settle(waiting) if waiting else ())
                made = [pa.array(x, f.dataType.simpleString().replace("bigint", "int64")) for x, f in zip(
                    zip(*results), schema.fields[len(columns):])]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(4 + k) for k in range(len(columns))), *made], schema.names)

    own = copy.select("batch", "row", "text", F.col("doc_id").cast("long").alias("__id"), *columns)
    return own.mapInArrow(run, schema)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256."""
    copy = exchange.stable_copy(docs, id_col, text_col)
    schema = T.StructType([copy.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")),
                           T.StructField("kept_sha256", T.StringType())])
    return _kept_bytes(copy, ["doc_id"], schema, lambda kept, n, removed, spans: (
        n, removed, spans, hashlib.sha256(kept).hexdigest()))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with what repeats cut out of ``text_col``; a character that is cut in part goes whole.

    Rows stay, also those with no text left, and other columns are as they were; a null text becomes empty.
    """
    names = [c for c in docs.columns if c != text_col]
    copy = exchange.stable_copy(docs, id_col, text_col, tuple(names))
    others = [f"other_{k}" for k in range(len(names))]
    schema = T.StructType([*(copy.schema[c] for c in others), T.StructField("kept_text", T.StringType())])
    made = _kept_bytes(copy, others, schema, lambda kept, n, removed, spans: (kept.decode(errors="ignore"),))
    place = dict(zip(names, others)) | {text_col: "kept_text"}
    return made.select(*(F.col(place[c]).alias(c) for c in docs.columns))
