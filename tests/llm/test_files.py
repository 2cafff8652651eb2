"""WARC archives and the permutation index."""

from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from locusframe.llm import neighbours, warc
from locusframe.scratch import scratch_path


def page_rows():
    rng = random.Random(1)
    rows = [(i, f"http://h{i % 7}.example.com/p/{i}?q={i % 3}", f"<p>{rng.randrange(40)}</p>" * 3) for i in range(200)]
    return rows + [(200, None, None), (201, "", ""), (202, "http://a.b/é x\r\nInjected: 1", "é😀"), (203, "http://[bad", "x" * 300000),
                   (204, "http://h1.example.com/p/1?q=1", "other"), (None, "http://n.o/", "without id"), (7, "http://again/", "<p>1</p>" * 3)]


def expected(rows, least=0):
    first = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if len(data) >= least and i is not None:
            first[data] = min(first.get(data, i), i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        refers = first.get(data)
        revisit = refers is not None and refers != i
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "revisit" if revisit else "response", refers if revisit else None))
    return sorted(out, key=repr)


@pytest.fixture
def pages(shipped):
    schema = "page_id long, url string, html string, digest int, refers_to int"
    return lambda rows: shipped.createDataFrame([(*r, 1, 2) for r in rows], schema).repartition(3)


@pytest.mark.parametrize("least", [0, 20])
def test_round_trip(pages, least):
    rows = page_rows()
    got = sorted((tuple(r) for r in warc.round_trip(pages(rows), least).collect()), key=repr)
    assert got == expected(rows, least)


def test_no_pages(pages):
    assert warc.round_trip(pages([])).count() == 0


def test_lookup_reads_the_pages_asked_for(shipped, pages, monkeypatch):
    rows = page_rows()
    folder = scratch_path(shipped, "warc-test")
    captures = warc.write_archives(pages(rows), folder)
    directory = warc.build_index(captures, folder, block_captures=5)
    assert directory.count() >= captures.count() / 5
    urls = ["http://h1.example.com/p/1?q=1", "http://nowhere.org/", "http://h6.example.com/p/13?q=1"]
    keys = shipped.createDataFrame([(warc.url_key(u),) for u in urls], "url_key string")
    found = warc.read_records(warc.lookup(directory, keys, folder), folder).collect()
    assert sorted(r.page_id for r in found) == [1, 13, 204]
    assert {r.page_id: r.payload for r in found}[204] == b"other"
    assert {bytes(r.payload).decode() for r in found if r.record_type == "response"} <= {h for _, _, h in rows}


def test_keys_sort_by_reversed_host():
    assert warc.url_key("https://www.Example.com:8080/a/b?c=d#e") == "com,example,www:8080)/a/b?c=d"
    assert warc.url_key(None) == ")/"


def test_damage_is_noticed():
    record = warc.record_bytes(1, "u", b"payload", None)
    import gzip

    with pytest.raises(ValueError, match="damaged"):
        warc.parse_record(gzip.compress(gzip.decompress(record).replace(b"payload", b"paYload")))


def brute(rows, k):
    usable = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in usable:
        if q % 50 == 0:
            scored = [(-(v @ w) / (np.linalg.norm(v) * np.linalg.norm(w)), i) for i, w in usable if i != q and len(w) == len(v)]
            out[q] = [(i, -s) for s, i in sorted(scored, key=lambda x: (round(x[0], 12), x[1]))[:k]]
    return out


def vectors(shipped, rows):
    return shipped.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, rank int, digest int").repartition(3)


def test_small_tables_are_exact(shipped):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(60)]
    rows += [(i, rows[3][1]) for i in range(60, 75)] + [(100, rows[3][1]), (150, [2 * x for x in rows[5][1]])]
    rows += [(200, None), (250, []), (201, [0.0] * 8), (202, [float("nan")] * 8), (203, [None] * 8), (204, [float("inf")] * 8),
             (None, rows[1][1]), (300, [1.0, 2.0]), (301, [2.0, 1.0]), (3, rows[3][1])]
    got = {}
    for r in neighbours.nearest(vectors(shipped, rows), F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    want = brute(list({(i, tuple(v) if v else None): (i, v) for i, v in rows}.values()), 5)
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in want.items()}
    for q in want:
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]])
    assert neighbours.nearest(vectors(shipped, [(1, None)]), F.col("vec_id") % 50 == 0).count() == 0


def test_recall(shipped):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(32).astype(np.float32).tolist()) for i in range(3000)]
    want = brute(rows, 5)
    got = neighbours.nearest(vectors(shipped, rows), F.col("vec_id") % 50 == 0).collect()
    assert len(got) == 5 * len(want)
    hits = sum(r.vec_id in {i for i, _ in want[r.query_id]} for r in got)
    assert hits >= 0.9 * len(got)


def test_footrule():
    orders = np.array([[0, 1, 2], [2, 1, 0], [3, 4, 5]])
    assert neighbours.footrule(orders[:1], orders, 6).tolist() == [[0, 4, 12]]
