"""Short ways that must give what the long ones give."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import functions as F

from locusframe.llm import exchange, hashing, secrets, suffixes


def test_signs_leave_out_no_match(shipped):
    words = ["Password", "PASSWD", "sEcret", "ToKen", "API_KEY", "apikey", "Client_Id", "keyid", "ACCOUNT_id", "userName", "Login"]
    texts = [f"é {w}{q}{mark} {q}Abc_12345.x" for w in words for q in ("", "'", '"') for mark in (":", "=", " =", "-")]
    texts += [f"x{a}ABCDEFGH12345678 y" for a in ("AKIA", "ASIA", "AIDA", "AROA", "AGPA", "ANPA", "AXIA", "akia")]
    texts += ["", "see http://a.bc/d and https://abcd.ef:80/g", "at https:/abcd.ef", "0123456789abcdef" * 2, "a=b c:d", "ſecret=abcdef"]
    df = shipped.createDataFrame([(t,) for t in texts], "text string")
    found = df.select("text", *(secrets._holds(F.col("text"), kind).alias(kind) for kind in secrets.KINDS)).collect()
    for row in found:
        for kind, (pattern, _) in secrets.PATTERNS.items():
            assert row[kind] == bool(re.search(pattern, row.text, re.ASCII)), (kind, row.text)
    assert all(any(row[kind] for row in found) for kind in secrets.KINDS)


def test_words_read_by_eight_bytes():
    random = np.random.default_rng(3)
    words = {bytes(random.choice(list(b"abZ\0\xc3\xa9"), n).astype(np.uint8)) for n in [*range(1, 70)] * 60}
    data = np.frombuffer(b" ".join(sorted(words)), np.uint8)
    for lower in (False, True):
        found, starts, ends = hashing.words(data, lower=lower)
        kept = [data[a:b].tobytes() for a, b in zip(starts, ends)]
        assert set(kept) == words
        assert len(set(found.tolist())) == len({w.lower() if lower else w for w in words})
        for k in range(0, len(kept), 97):
            text = kept[k].lower() if lower else kept[k]
            assert hashing.words(np.frombuffer(b"\t" + text + b"\nx", np.uint8), lower=lower)[0][0] == found[k]
    for n in (0, 1, 500):
        keys = random.integers(0, 300, n, dtype=np.uint64)
        assert np.array_equal(hashing.distinct(keys), np.unique(keys))


def test_members_are_found_by_tables():
    random = np.random.default_rng(4)
    for most in (1 << 63, 1 << 40, 300, 1):
        for n in (0, 1, 7, 5000):
            keys = np.unique(random.integers(0, most, n, dtype=np.uint64))
            asked = np.r_[keys, random.integers(0, 1 << 63, 1000, dtype=np.uint64), keys + np.uint64(1), np.uint64(2**64 - 1)]
            places = exchange.Members(keys).places(asked)
            assert np.array_equal(places >= 0, np.isin(asked, keys))
            assert np.array_equal(keys[places[places >= 0]], asked[places >= 0])
    clustered = np.arange(1000, dtype=np.uint64) + np.uint64(1 << 60)  # all share their highest bits
    assert np.array_equal(exchange.Members(clustered).places(clustered[::-1]), np.arange(1000)[::-1])


def test_positions_of_the_cover():
    for n in (0, 1, 37, 38, 39, 50, 51, 200, (1 << 16) + 36, (1 << 16) + 37, (1 << 16) + 38, 300_000):
        want = [p for p in range(max(0, n - suffixes.SAMPLE_WIDTH + 1)) if p % suffixes.PERIOD in suffixes.COVER]
        assert suffixes.cover_positions(n).tolist() == want
