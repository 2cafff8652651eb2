"""Vectorised hashes of byte strings, words and runs of words; 64 bits, the same in every task and run.

Empty strings and texts without words give empty arrays; a text of any length is hashed whole. Nothing here sees
ids, nulls or other columns.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

U64 = np.uint64
#: Bytes of a word from which on its hash is a digest.
LONG = 64
_random = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _random.integers(0, 2**64, 256, dtype=U64)
_BASE = U64(int(_random.integers(0, 2**64, dtype=U64)) | 5)
_INVERSE = U64(pow(int(_BASE), -1, 2**64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] = _LOWER[97:123]
#: For each number of bytes, a random number and what is left of eight bytes read at once.
_SIZE = _random.integers(0, 2**64, LONG + 1, dtype=U64)
_LEFT = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers = [np.cumprod(np.full(1 << 16, b, U64)) for b in (_BASE, _INVERSE)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        _powers[:] = [np.cumprod(np.full(2 * n, b, U64)) for b in (_BASE, _INVERSE)]
    return _powers[0][:n], _powers[1][:n]


_SHIFTS = U64(30), U64(27), U64(31)
_FACTORS = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread what differs in a few bits over all 64."""
    h = h ^ (h >> _SHIFTS[0])
    h *= _FACTORS[0]
    h ^= h >> _SHIFTS[1]
    h *= _FACTORS[1]
    h ^= h >> _SHIFTS[2]
    return h


def running(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of value times power, and the inverse powers: a run's hash is a difference shifted to power 0."""
    up, down = _power_tables(len(values) + 1)
    sums = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[:len(values)], out=sums[1:])
    return sums, down


def distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted distinct numbers; ``np.unique`` fills a hash table first, which takes several times as long as the sort."""
    keys = np.sort(keys)
    if len(keys) < 2:
        return keys
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    return keys[new]


def runs(values: np.ndarray, length: int, at: np.ndarray | None = None) -> np.ndarray:
    """Hash of the ``length`` values from each position (all whole runs, or those that begin at ``at``)."""
    if len(values) < length:
        return np.zeros(0, U64)
    sums, down = running(values)
    if at is None:
        return mix((sums[length:] - sums[:-length]) * down[:len(values) - length + 1])
    return runs_at(sums, down, length, at)


def runs_at(sums: np.ndarray, down: np.ndarray, length: int, at: np.ndarray) -> np.ndarray:
    """``runs`` from the sums and inverse powers of ``running``, which serve any length."""
    found = sums.take(at + length)
    found -= sums.take(at)
    found *= down.take(at)
    return mix(found)


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE.take(data)


def words(data: np.ndarray, lower: bool = False, salt: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end byte of each word of UTF-8 bytes, cut at ASCII white space.

    Words are read eight bytes at a time, each eight mixed into what came before, the number of bytes into the first;
    words of up to eight bytes of one length never share a hash. Words of more than ``LONG`` bytes have a keyed digest.
    With a ``salt`` all words have one, keyed by it: words that collide under one salt are independent under another.
    Equal words have equal hashes everywhere.
    """
    inside = np.zeros(len(data) + 2, bool)
    np.logical_not(_SPACE.take(data), out=inside[1:-1])
    edge = (inside[1:] != inside[:-1]).nonzero()[0]
    starts, ends = edge[::2], edge[1::2]
    sizes = ends - starts
    if salt:
        found, by_digest = np.zeros(len(starts), U64), np.arange(len(starts))
    else:
        padded = np.zeros(len(data) + 8, np.uint8)
        padded[:len(data)] = _LOWER.take(data) if lower else data
        eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
        found = mix(eight[starts] & _LEFT.take(sizes, mode="clip") ^ _SIZE.take(sizes, mode="clip"))
        rest, at = np.flatnonzero(sizes > 8), 8
        while at < LONG and len(rest):
            found[rest] = mix(found[rest] ^ (eight[starts[rest] + at] & _LEFT.take(sizes[rest] - at, mode="clip")))
            at += 8
            rest = rest[sizes[rest] > at]
        by_digest = np.flatnonzero(sizes > LONG)
    if len(by_digest):
        text, key = data.tobytes(), salt.to_bytes(8, "little")
        text = text.lower() if lower else text  # of bytes: A-Z alone
        found[by_digest] = [int.from_bytes(blake2b(text[a:b], digest_size=8, key=key).digest(), "little")
                            for a, b in zip(starts[by_digest].tolist(), ends[by_digest].tolist())]
    return found, starts, ends


def to_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode(), np.uint8)
