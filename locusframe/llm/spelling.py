"""Spelling variants of the words of a corpus, grouped under their most frequent form.

Words are counted in the JVM. Two words are near if they differ by one inserted, deleted or replaced code
point. Every near pair shows as a deletion in the longer word or as a replacement in the smaller one, so only
those edits are generated, by tasks that hold some words each. An edit is first looked up in a blocked Bloom
filter of the words of its length. Filters are cut into pieces of at most ``PIECE_BITS`` and broadcast in
rounds of at most ``ROUND_BYTES``, so what is broadcast never grows with the vocabulary; what grows is the
number of rounds. Only positives are shuffled, to a join with the vocabulary that removes the false ones.

A word's form is its near word of largest count (ties: the smallest in code-point order) where that count is
at least ``ratio`` times its own. Counts rise along forms, so following them ends; roots are found by pointer
doubling over written tables, in as many rounds as the logarithm of the longest chain.

Null and empty texts hold no words, and an empty table gives an empty result. A null id counts as an empty
one where ids enter the fault rule. Repeated rows count each time. Other columns are not read, whatever their
names. A very long text is one array of words in its task; a very long word is edited in blocks, and only
where words of the lengths in question exist.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from locusframe.llm.hashing import mix
from locusframe.scratch import materialize, scratch_path, scratch_run

U64 = np.uint64
#: Runs of letters after lower-casing, a fixed value; all their code points fit one byte.
RUN = r"[a-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bits a word takes in its filter, bits set for it, bits of a block, of the largest piece, of the smallest.
WORD_BITS, PROBES, BLOCK_BITS, PIECE_BITS, LEAST_BITS = 16, 6, 512, 1 << 25, 1 << 15
#: Filters broadcast at once; edits generated at once in a task; letters of the words of a task.
ROUND_BYTES, EDITS_AT_ONCE, TASK_LETTERS = 32 << 20, 1 << 21, 1 << 20


@dataclass(frozen=True)
class Shape:
    """How the filter of one word length is cut: ``parts`` pieces of ``blocks`` blocks."""

    parts: int
    blocks: int

    @property
    def bytes(self) -> int:
        return self.blocks * BLOCK_BITS // 8


def shape_of(words: int) -> Shape:
    bits = max(words * WORD_BITS, LEAST_BITS)
    parts = -(-bits // PIECE_BITS)
    return Shape(parts, -(-bits // (parts * BLOCK_BITS)))


def spelled_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fault_every: int | None = None) -> DataFrame:
    """All words of the texts, one row each, in a column ``word``.

    With ``fault_every`` a run loses the code point crc32 % length where that number divides the crc32 of
    "id:run"; so spelling faults come into a clean corpus in a way that can be repeated.
    """
    text = F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER)
    owner = F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("owner")
    runs = docs.select(owner, F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("run"))
    if fault_every is None:
        return runs.select(F.col("run").alias("word"))
    crc = F.crc32(F.concat("owner", F.lit(":"), "run").cast("binary"))
    at = F.pmod(F.col("crc"), F.length("run").cast("long")).cast("int")
    without = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return runs.withColumn("crc", crc).select(
        F.when(F.col("crc") % fault_every == 0, without).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least_length: int = 5, least_count: int = 3) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    return words.where(F.length("word") >= least_length).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def letter_hash(places: np.ndarray, letters: np.ndarray) -> np.ndarray:
    return mix((places.astype(U64) << U64(8)) + letters.astype(U64) + U64(1))


def finish(sums: np.ndarray, length: int) -> np.ndarray:
    """A word's hash from the sum of its letters' hashes."""
    return mix(sums + U64(length) * U64(0x9E3779B97F4A7C15))


def codes(words: list[str]) -> np.ndarray:
    """Words of one length as a matrix of code points."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def word_hashes(matrix: np.ndarray) -> np.ndarray:
    length = matrix.shape[1]
    return finish(letter_hash(np.arange(length), matrix).sum(1, dtype=U64), length)


def part_of(hashes: np.ndarray, shape: Shape) -> np.ndarray:
    return ((hashes >> U64(40)) % U64(shape.parts)).astype(np.int32)


def spots_of(hashes: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """First 64-bit word of each hash's block, and the bits that choose places in the block."""
    block = ((hashes & U64(0xFFFFFFFF)) * U64(shape.blocks)) >> U64(32)
    return block.astype(np.int64) * (BLOCK_BITS // 64), mix(hashes ^ U64(0x5851F42D4C957F2D))


def bit_of(begin: np.ndarray, spots: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of the 64-bit word and mask of the k-th bit."""
    place = (spots >> U64(9 * k)) & U64(BLOCK_BITS - 1)
    return begin + (place >> U64(6)).astype(np.int64), U64(1) << (place & U64(63))


def fill(hashes: np.ndarray, shape: Shape) -> np.ndarray:
    piece = np.zeros(shape.blocks * (BLOCK_BITS // 64), U64)
    begin, spots = spots_of(hashes, shape)
    for k in range(PROBES):
        np.bitwise_or.at(piece, *bit_of(begin, spots, k))
    return piece


def holds(piece: np.ndarray, hashes: np.ndarray, shape: Shape) -> np.ndarray:
    """Positions of the hashes that may be in a piece; each probe looks at those alone that are left."""
    left = np.arange(len(hashes))
    begin, spots = spots_of(hashes, shape)
    for k in range(PROBES):
        at, mask = bit_of(begin, spots, k)
        hit = (piece[at] & mask) != 0
        left, begin, spots = left[hit], begin[hit], spots[hit]
    return left


def _hash_words(shapes: dict[int, Shape]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_length: dict[int, list[str]] = {}
            for word in batch.column(0).to_pylist():
                by_length.setdefault(len(word), []).append(word)
            for length, words in by_length.items():
                hashes = word_hashes(codes(words))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(words), length, np.int32)), pa.array(part_of(hashes, shapes[length])),
                     pa.array(hashes.view(np.int64))], ["length", "part", "hash"])

    return run


def _fill_piece(shapes: dict[int, Shape]):
    def run(table: pa.Table) -> pa.Table:
        length = table.column("length")[0].as_py()
        piece = fill(table.column("hash").to_numpy().view(U64), shapes[length])
        return pa.table({"length": pa.array([length], pa.int32()), "part": table.column("part").slice(0, 1),
                         "bits": pa.array([piece.tobytes()], pa.binary())})

    return run


def deletions(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, hash) of each word without one letter; of equal neighbours only the first is left out."""
    length = matrix.shape[1]
    places = np.arange(length)
    before = letter_hash(places, matrix)
    after = letter_hash(np.maximum(places - 1, 0), matrix)
    head = np.cumsum(before, axis=1, dtype=U64) - before
    tail = after.sum(1, dtype=U64)[:, None] - np.cumsum(after, axis=1, dtype=U64)
    new = np.ones(matrix.shape, bool)
    new[:, 1:] = matrix[:, 1:] != matrix[:, :-1]
    rows, at = np.nonzero(new)
    return rows, at, finish((head + tail)[rows, at], length - 1)


def replacements(matrix: np.ndarray, alphabet: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, place, letter, hash) of each word with one letter replaced by a larger one, in blocks of places."""
    length = matrix.shape[1]
    whole = letter_hash(np.arange(length), matrix).sum(1, dtype=U64)
    step = max(1, EDITS_AT_ONCE // max(1, len(matrix) * len(alphabet)))
    for begin in range(0, length, step):
        places = np.arange(begin, min(begin + step, length))
        own = matrix[:, places]
        rest = whole[:, None] - letter_hash(places, own)
        rows, at, letter = np.nonzero(own[:, :, None] < alphabet[None, None, :])
        hashes = rest[rows, at] + letter_hash(places[:, None], alphabet[None, :])[at, letter]
        yield rows, places[at], alphabet[letter], finish(hashes, length)


def _candidates(alphabet: np.ndarray, shapes: dict[int, Shape], pieces):
    """The task that edits words and yields (word, n, near) for edits that a broadcast piece may hold."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("near", pa.string())])

    def positives(hashes: np.ndarray, length: int, parts: dict[int, np.ndarray]) -> np.ndarray:
        shape = shapes[length]
        part = part_of(hashes, shape)
        found = []
        for number, piece in parts.items():
            own = np.flatnonzero(part == number) if shape.parts > 1 else np.arange(len(hashes))
            found.append(own[holds(piece, hashes[own], shape)])
        return np.concatenate(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters: dict[int, dict[int, np.ndarray]] = {}
        for (length, part), bits in pieces.value.items():
            filters.setdefault(length, {})[part] = np.frombuffer(bits, U64)

        def rows(words, counts, at, edited):
            return pa.RecordBatch.from_arrays(
                [pa.array([words[i] for i in at], pa.string()), pa.array([counts[i] for i in at], pa.int64()),
                 pa.array(edited, pa.string())], schema=schema)

        for batch in batches:
            by_length: dict[int, list[int]] = {}
            all_words, all_counts = (c.to_pylist() for c in batch.columns[:2])
            for i, word in enumerate(all_words):
                by_length.setdefault(len(word), []).append(i)
            for length, numbers in by_length.items():
                if length not in filters and length - 1 not in filters:
                    continue
                step = max(1, EDITS_AT_ONCE // (length * max(8, len(alphabet))))
                for begin in range(0, len(numbers), step):
                    words = [all_words[i] for i in numbers[begin:begin + step]]
                    counts = [all_counts[i] for i in numbers[begin:begin + step]]
                    matrix = codes(words)
                    if length - 1 in filters:
                        row, place, hashes = deletions(matrix)
                        hit = positives(hashes, length - 1, filters[length - 1])
                        if len(hit):
                            edited = [words[r][:p] + words[r][p + 1:] for r, p in zip(row[hit].tolist(), place[hit].tolist())]
                            yield rows(words, counts, row[hit].tolist(), edited)
                    if length in filters:
                        for row, place, letter, hashes in replacements(matrix, alphabet):
                            hit = positives(hashes, length, filters[length])
                            if len(hit):
                                edited = [words[r][:p] + chr(c) + words[r][p + 1:] for r, p, c in zip(
                                    row[hit].tolist(), place[hit].tolist(), letter[hit].tolist())]
                                yield rows(words, counts, row[hit].tolist(), edited)

    return run


def rounds_of(shapes: dict[int, Shape], most: int | None = None) -> list[list[tuple[int, int]]]:
    """The pieces (length, part) of each round; a round is at most ``most`` bytes, or one piece."""
    out: list[list[tuple[int, int]]] = []
    left = 0
    for length, shape in sorted(shapes.items()):
        for part in range(shape.parts):
            if not out or left < shape.bytes:
                out.append([])
                left = ROUND_BYTES if most is None else most
            out[-1].append((length, part))
            left -= shape.bytes
    return out


def near_pairs(vocab: DataFrame) -> DataFrame:
    """Each near pair of words once: (word, n, near, near_n). ``vocab`` must be a written table of (word, n)."""
    spark = vocab.sparkSession
    sizes = {r.length: r.words for r in vocab.groupBy(F.length("word").alias("length")).agg(
        F.count(F.lit(1)).alias("words")).collect()}
    shapes = {length: shape_of(words) for length, words in sizes.items()}
    alphabet = np.array(sorted(ord(r[0]) for r in vocab.select(F.explode(F.split("word", ""))).distinct().collect() if r[0]), np.uint8)
    letters = sum(length * words for length, words in sizes.items())
    tasks = max(spark.sparkContext.defaultParallelism, -(-letters // TASK_LETTERS))
    dealt = materialize(vocab.repartition(tasks, "word"), "dealt-words")
    hashed = dealt.select("word").mapInArrow(_hash_words(shapes), "length int, part int, hash long")
    pieces = materialize(hashed.groupBy("length", "part").applyInArrow(
        _fill_piece(shapes), "length int, part int, bits binary"), "filters")
    positive: DataFrame | None = None
    for wanted in rounds_of(shapes):
        lengths = sorted({length for length, _ in wanted})
        number = F.col("length").cast("long") * (1 << 20) + F.col("part")
        loaded = {(r.length, r.part): bytes(r.bits) for r in pieces.where(
            number.isin([length * (1 << 20) + part for length, part in wanted])).collect()}
        held = spark.sparkContext.broadcast(loaded)
        edited = dealt.where(F.length("word").isin(sorted(set(lengths) | {x + 1 for x in lengths})))
        found = materialize(edited.mapInArrow(_candidates(alphabet, shapes, held), "word string, n long, near string"), "positives")
        held.destroy()
        positive = found if positive is None else positive.unionByName(found)
    if positive is None:
        return spark.createDataFrame([], "word string, n long, near string, near_n long")
    known = vocab.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    return positive.join(known, "near").select("word", "n", "near", "near_n")


def follow(forms: DataFrame) -> DataFrame:
    """(word, root) for a written table (word, form): the last form reached from each word."""
    at = forms.select("word", F.col("form").alias("root"))
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        at = materialize(at.join(further, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        moved = not at.where("moved").isEmpty()
        at = at.drop("moved")
        if not moved:
            return at


def variants(words: DataFrame, least_length: int = 5, least_count: int = 3, ratio: int = 2) -> DataFrame:
    """Per word of the vocabulary: word, n, n_near, form, form_n, root."""
    spark = words.sparkSession
    path = scratch_path(spark, "spelling")
    with scratch_run(spark, "spelling-steps"):
        vocab = materialize(vocabulary(words, least_length, least_count), "vocabulary")
        pairs = materialize(near_pairs(vocab), "near-pairs")
        both = pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"),
                                              F.col("word").alias("near"), F.col("n").alias("near_n")))
        alone = vocab.select("word", "n", F.lit(None).cast("string").alias("near"), F.lit(None).cast("long").alias("near_n"))
        best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))))
        described = both.unionByName(alone).groupBy("word").agg(
            F.first("n").alias("n"), F.count("near").alias("n_near"), best.alias("best"))
        strong = -F.col("best.less") >= ratio * F.col("n")
        described = materialize(described.select(
            "word", "n", "n_near", F.when(strong, F.col("best.near")).alias("form"),
            F.when(strong, -F.col("best.less")).alias("form_n")), "described")
        roots = follow(described.where(F.col("form").isNotNull()))
        described.join(roots, "word", "left").select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n").write.parquet(path)
    return spark.read.parquet(path)
