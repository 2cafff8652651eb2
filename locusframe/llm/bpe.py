"""Byte-level BPE encoding and decoding with the tokenizers library, over Arrow batches.

The pattern of a byte-level tokenizer never crosses a space that stands between two characters that are
not white space, so a text is cut there and each distinct chunk is encoded once; what was seen is kept in
a table of bounded size, which changes the time and never the ids. A token's text is spelled in a
256-character byte alphabet; the reverse of that alphabet gives each id its bytes, and with them byte
offsets, character offsets and decoding.

A null text counts as empty: no ids. An id without bytes in the vocabulary raises a ValueError when it is
decoded. Rows are independent of each other, so repeated rows get equal results, and columns of the input
are kept as they are; a result column whose name is taken raises a ValueError. An empty table gives an empty
result; a very long text is encoded whole.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

#: Chunks in each of the two generations that a worker keeps, marks that it keeps, and the longest chunk that is kept.
#: A worker holds them on while it serves other stages, so they are bounded by what an executor has to spare.
KEPT_CHUNKS, KEPT_WORDS, KEPT_LENGTH = 400_000, 100_000, 64

#: White space besides the plain space and the line feed.
_OTHER_SPACE = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + (
    "\u2028\u2029\u202f\u205f\u3000")
_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
_CUT = re.compile(r"(?<=\S)(?= \S)")
_codecs: dict[tuple[str, bool], ByteBpe] = {}


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte: printable ones for themselves, the others from 256 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(other)}


class _Chunks(dict):
    """Ids of chunks, as unsigned 32-bit integers, little-endian as on every machine Spark runs on.

    A chunk that begins with a line feed stands for one and the first chunk of a line, any other for itself with a
    space before it. ASCII marks at the end of a chunk begin a match of their own after a letter or digit, so that
    the words before them are encoded once for all their endings.
    """

    def __init__(self, tokenizer, after_space: np.ndarray):
        self.tokenizer, self.after_space, self.older, self.marks = tokenizer, after_space, {}, {}
        self.newline = self._encode(["\n"])[0]

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _joined(self, words: list[str]) -> list[bytes]:
        """Ids of words without white space, each with a space before it: as one text, since only a word's first token begins with a space."""
        if not words:
            return []
        ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        begins = np.flatnonzero(self.after_space[ids])
        if len(begins) != len(words):
            return self._encode([" " + x for x in words])
        data, cuts = ids.tobytes(), (4 * begins).tolist()
        return [data[a:b] for a, b in zip(cuts, [*cuts[1:], len(data)])]

    def _whole(self, chunks: Iterable[str]) -> Iterator[tuple[str, bytes]]:
        words, others, lines = [], [], []
        for x in chunks:
            (lines if x[:1] == "\n" else words if x.split() == [x] else others).append(x)
        for begin in range(0, len(words), 10_000):
            part = words[begin:begin + 10_000]
            yield from zip(part, self._joined(part))
        yield from zip(others, self._encode([" " + x for x in others]))
        yield from zip(lines, (self.newline + ids for ids in self._encode([x[1:] for x in lines])))

    def _ended(self, ended: dict[str, str]) -> dict[str, bytes]:
        """Ids of chunks that end with marks, from their words; not kept, since the words are."""
        ends = {x: x[len(word):] for x, word in ended.items()}
        unknown = [x for x in set(ends.values()) if x not in self.marks]
        self.marks.update(zip(unknown, self._encode(unknown)))
        return {x: self[word] + self.marks[ends[x]] for x, word in ended.items()}

    def _unknown(self, wanted: set[str]) -> set[str]:
        """Those that neither generation holds; what the older one holds is taken over.

        Word by word: ``difference`` would go through the whole table.
        """
        new = {x for x in wanted if x not in self}
        again = {x: self.older[x] for x in new if x in self.older}
        self.update(again)
        return new.difference(again)

    def of(self, chunks: list[str]) -> list[bytes]:
        """The ids of each chunk."""
        if len(self) > KEPT_CHUNKS:
            self.older = dict(self)
            self.clear()
        if len(self.marks) > KEPT_WORDS:
            self.marks.clear()
        found = list(map(self.get, chunks))
        missed = [k for k, ids in enumerate(found) if ids is None]
        new = {chunks[k] for k in missed}
        long = {x for x in new if len(x) > KEPT_LENGTH}
        new -= long
        ended = {x: word for x in new if len(word := x.rstrip(_MARKS)) < len(x) and word and word[-1].isalnum()}
        self.update(self._whole(self._unknown(new.difference(ended).union(ended.values()))))
        here = self._ended(ended)
        here.update(self._whole(long))
        for k in missed:
            x = chunks[k]
            found[k] = here[x] if x in here else self[x]
        return found


class ByteBpe:
    """One tokenizer file: encode texts, give ids their bytes.

    Added tokens that stand in a text are text like any other, or, with ``added``, one id each, as the tokenizer
    file has it; such a text is left to the library whole.
    """

    def __init__(self, path: str, added: bool = False):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        self.tokenizer = tokenizer
        self.added = [t.content for t in tokenizer.get_added_tokens_decoder().values()] if added else []
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        special = {k for k, token in tokenizer.get_added_tokens_decoder().items() if token.special}
        alphabet = byte_alphabet()
        self.bytes_of: list[bytes | None] = [None] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.bytes_of[number] = token.encode() if number in special else bytes(map(alphabet.__getitem__, token))
        self.lengths = np.array([len(b or b"") for b in self.bytes_of], np.int64)
        self.words = list(map(str, range(len(self.bytes_of))))
        self.rest = _Chunks(tokenizer, np.array([(b or b"").startswith(b" ") for b in self.bytes_of]))

    @staticmethod
    def cut(text: str) -> list[str]:
        """The chunks of a text with a line feed before it; those that do not begin a line follow a space."""
        if any(x in text for x in ("  ", "\n\n", " \n", "\n ", *_OTHER_SPACE)):
            head, *others = _CUT.split(text)
            return ["\n" + head, *(c[1:] for c in others)]
        return ("\n" + text.replace("\n", " \n")).split(" ")

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        before = len(self.rest.newline)
        for begin in range(0, len(texts), 500):
            some = texts[begin:begin + 500]
            whole = {k for k, t in enumerate(some) if t and any(token in t for token in self.added)}
            cut = [self.cut("" if k in whole else t or "") for k, t in enumerate(some)]
            found = iter(self.rest.of(list(chain.from_iterable(cut))))
            for k, chunks in enumerate(cut):
                ids = b"".join(islice(found, len(chunks)))[before:]
                yield self._with_added(some[k]) if k in whole else ids

    def _with_added(self, text: str) -> bytes:
        self.tokenizer.encode_special_tokens = False
        try:
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        finally:
            self.tokenizer.encode_special_tokens = True

    def decode(self, ids: list[int]) -> bytes:
        try:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        except (IndexError, TypeError) as error:
            raise ValueError("an id is not in the vocabulary") from error

    def spans(self, ids: np.ndarray, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Per token: the byte it starts at, and the character that byte belongs to."""
        starts = np.concatenate([[0], np.cumsum(self.lengths[ids])])[:-1]
        data = np.frombuffer(text.encode(), np.uint8)
        character = np.cumsum((data & 0xC0) != 0x80) - 1
        return starts, character[starts]


def codec(path: str, added: bool = False) -> ByteBpe:
    """The tokenizer of a file, read once by each worker."""
    if (path, added) not in _codecs:
        _codecs[path, added] = ByteBpe(path, added)
    return _codecs[path, added]


def _extended(df: DataFrame, extra: list[T.StructField]) -> T.StructType:
    taken = {c.lower() for c in df.columns} & {f.name.lower() for f in extra}
    if taken:
        raise ValueError(f"result columns are in the input already: {sorted(taken)}")
    return T.StructType([*df.schema.fields, *extra])


def encode(df: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``df`` with ids, byte_starts and char_starts: of each token the byte and the character it begins in."""
    extra = [T.StructField("ids", T.ArrayType(T.IntegerType())),
             T.StructField("byte_starts", T.ArrayType(T.IntegerType())),
             T.StructField("char_starts", T.ArrayType(T.IntegerType()))]
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for batch in batches:
            texts = batch.column(at).to_pylist()
            ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in bpe.encode(texts)]
            where = [bpe.spans(i, t or "") if len(i) else (i, i) for i, t in zip(ids, texts)]
            lists = [pa.array(x, pa.list_(pa.int32())) for x in (ids, [w[0] for w in where], [w[1] for w in where])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists],
                                             [*batch.schema.names, *(f.name for f in extra)])

    return df.mapInArrow(run, _extended(df, extra))


def decode(df: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``df`` with decoded_bytes and decoded_text.

    A character whose bytes are split over tokens is whole again once its bytes are joined; one that the ids
    hold only in part becomes U+FFFD in decoded_text and stays as it is in decoded_bytes. Null ids give nulls.
    """
    extra = [T.StructField("decoded_bytes", T.BinaryType()), T.StructField("decoded_text", T.StringType())]
    at = df.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for batch in batches:
            data = [None if ids is None else bpe.decode(ids) for ids in batch.column(at).to_pylist()]
            text = [None if d is None else d.decode(errors="replace") for d in data]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(data, pa.binary()), pa.array(text, pa.string())],
                [*batch.schema.names, *(f.name for f in extra)])

    return df.mapInArrow(run, _extended(df, extra))


def digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: number of ids, digest of the ids in decimal, digest of what they decode to.

    Encoding, and decoding of the ids, are those of ``encode`` and ``decode``; ids do not leave the task.
    """
    rows = df.select(id_col, text_col)
    schema = T.StructType([rows.schema[id_col], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for data in bpe.encode(batch.column(1).to_pylist()):
                ids = np.frombuffer(data, "<u4").tolist()
                out[0].append(len(ids))
                out[1].append(hashlib.sha256(" ".join(map(bpe.words.__getitem__, ids)).encode()).hexdigest())
                out[2].append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()),
                 pa.array(out[2], pa.string())], schema.names)

    return rows.mapInArrow(run, schema)
