"""Suffix dedup, De Bruijn dedup and the Jaccard join against plain loops."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from texts import corpus

from locusframe.llm import debruijn, exchange, hashing, jaccard, suffixes
from locusframe.llm.components import components

BIG = 1 << 62


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def kept_by_suffixes(rows):
    first, out = {}, []
    for i, t in rows:
        data = (t or "").encode()
        for k in range(len(data) - 49):
            key = data[k:k + 50]
            first[key] = min(first.get(key, BIG), BIG if i is None else i)
    for i, t in rows:
        data, gone = (t or "").encode(), set()
        for k in range(len(data) - 49):
            if first[data[k:k + 50]] < (BIG if i is None else i):
                gone.update(range(k, k + 50))
        spans = sum(k not in gone and k + 1 in gone for k in range(-1, len(data)))
        out.append((i, data, bytes(b for k, b in enumerate(data) if k not in gone), len(gone), spans))
    return out


@pytest.mark.parametrize("rows", [corpus(), corpus(8)[::-1], [(1, None)], []], ids=["corpus", "reversed", "null", "empty"])
def test_suffixes(documents, rows):
    want = Counter((i, len(d), n, s, hashlib.sha256(k).hexdigest()) for i, d, k, n, s in kept_by_suffixes(rows))
    assert rows_of(suffixes.report(documents(rows))) == want


def test_removed_repeats_keep_other_columns(documents):
    rows = corpus()
    got = suffixes.remove_repeats(documents(rows))
    assert got.columns == ["doc_id", "text", "row", "spans"]
    want = Counter((i, k.decode(errors="ignore"), f"extra {i}", 5) for i, _, k, _, _ in kept_by_suffixes(rows))
    assert rows_of(got) == want


def test_cover_is_a_difference_cover():
    assert {(a - b) % suffixes.PERIOD for a in suffixes.COVER for b in suffixes.COVER} == set(range(suffixes.PERIOD))


def test_slices_of_long_texts_change_nothing(monkeypatch):
    data = np.frombuffer(np.random.default_rng(3).bytes(5000), np.uint8)
    ties = np.unique(exchange.coarse(suffixes.sample_keys(data)[::7], 6))
    whole = suffixes.tied_windows(data, ties, 6)
    monkeypatch.setattr(suffixes, "SLICE", 333)
    for a, b in zip(whole, suffixes.tied_windows(data, ties, 6)):
        assert (a == b).all()


@pytest.mark.parametrize("rows", [corpus(), corpus(8)[::-1], [(1, None)], []], ids=["corpus", "reversed", "null", "empty"])
def test_debruijn(documents, rows):
    split = [(i, (t or "").encode().split()) for i, t in rows]
    seen = Counter(tuple(w[k:k + 35]) for _, w in split for k in range(len(w) - 34))
    want = Counter()
    for i, w in split:
        gone = {k + j for k in range(len(w) - 34) if seen[tuple(w[k:k + 35])] > 1 for j in range(35)}
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        want[(i, len(w), len(gone), hashlib.sha256(kept).hexdigest())] += 1
    assert rows_of(debruijn.report(documents(rows))) == want


def test_debruijn_starts_anew_when_hashes_collide(documents, monkeypatch):
    rows = corpus()[:40]
    want = rows_of(debruijn.report(documents(rows)))
    real = debruijn._edges

    def collide(copy, shared, skip, bits, salt):
        edges = real(copy, shared, skip, bits, salt)
        return edges if salt else edges.selectExpr("edge % 3 AS edge", "row", "pos")

    monkeypatch.setattr(debruijn, "_edges", collide)
    assert rows_of(debruijn.report(documents(rows))) == want


def shingle_set(text):
    found = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(found[k:k + 5]) for k in range(max(1, len(found) - 4))) if found else frozenset()


def grouped(rows):
    sets, parent = [shingle_set(t) for _, t in rows], list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                parent[root(a)] = root(b)
    groups = defaultdict(list)
    for k in range(len(rows)):
        groups[root(k)].append(k)
    return sets, list(groups.values())


def many_near_copies():
    rng = np.random.default_rng(4)
    rows = []
    for i in range(150):  # small and large sets with more and fewer changes, so that links run in chains
        n = [6, 9, 14, 25, 80][i % 5]
        own = [f"g{i % 10}w{k}" for k in range(n + int(rng.integers(0, 3)))]
        for _ in range(int(rng.integers(0, 3))):
            own[int(rng.integers(0, len(own)))] = f"c{rng.integers(0, 30)}"
        rows.append((i, " ".join(own)))
    return rows


@pytest.mark.parametrize("rows", [corpus(), corpus(8)[::-1], many_near_copies(), [(1, None)], []],
                         ids=["corpus", "reversed", "chains", "null", "empty"])
def test_jaccard(documents, rows):
    sets, groups = grouped(rows)
    want = Counter()
    for group in groups:
        known = [rows[k][0] for k in group if rows[k][0] is not None]
        for k in group:
            want[(rows[k][0], len(sets[k]), min(known) if known else None)] += 1
    got = jaccard.near_duplicates(documents(rows))
    assert rows_of(got.select("doc_id", "n_shingles", "component_id")) == want


def test_one_of_each_group_stays(documents):
    rows = corpus()
    _, groups = grouped(rows)
    got = jaccard.keep_first(documents(rows))
    assert got.columns == ["doc_id", "text", "row", "spans"]
    ids = Counter(r.doc_id for r in got.collect())
    want = Counter(min((rows[k][0] for k in g), key=lambda i: (i is None, i or 0)) for g in groups)
    assert ids == want
    assert got.where("doc_id = 120 AND text IS NULL").count() == 1


def test_light_and_heavy_sets_give_the_same_links(documents, monkeypatch):
    rows = many_near_copies()
    want = rows_of(jaccard.near_duplicates(documents(rows)).select("doc_id", "component_id"))
    for boundary in (0, 12, 10**6):
        monkeypatch.setattr(jaccard, "_boundary", lambda leads, boundary=boundary: boundary)
        assert rows_of(jaccard.near_duplicates(documents(rows)).select("doc_id", "component_id")) == want


def test_components(shipped):
    links = [(k, k + 1) for k in range(0, 30)] + [(100, k) for k in range(101, 160)] + [(200, 201), (7, 7)]
    got = {r.node: r.component for r in components(shipped.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(31)}, **{k: 100 for k in range(100, 160)}, 200: 200, 201: 200}


def test_squeezed_numbers():
    for numbers in ([0], [5], [0, 1, 2**63, 2**64 - 1], list(range(0, 10**6, 997))):
        numbers = np.array(numbers, np.uint64)
        assert (exchange.unsqueeze(exchange.squeeze(numbers)) == numbers).all()


def test_word_hashes_know_words_only():
    a, _, _ = hashing.words(hashing.to_bytes("Ab  cd\x1cx y ab"), lower=True)
    b, _, _ = hashing.words(hashing.to_bytes("ab\n\ncd\x1cx y\tAB"), lower=True)
    assert (a == b).all() and a[0] == a[2] and a[0] != a[1]


def test_near_copies_are_listed_not_enumerated(shipped):
    leads = [(token, node, 25, place) for node in range(100) for place, token in enumerate(range(6))]
    assert jaccard._boundary(shipped.createDataFrame(leads, "token long, node long, n long, place long")) == 1  # no set has pairs


def test_sketches_are_made_without_a_shuffle_of_sets(shipped, monkeypatch):
    """Sketches come from a scan of the sets alone, and there is one for each set."""
    monkeypatch.setattr(jaccard, "SKETCH", 4)
    sets = shipped.createDataFrame([(1, 3, [4, 8, 1]), (2, 2, [3, -1]), (9, 1, [6])], "node long, n long, tokens array<long>")
    sketches = jaccard._sketches(sets)
    assert not re.search("Exchange|Join", sketches._jdf.queryExecution().executedPlan().toString())
    assert {(r.node, r.n, tuple(r.sketch)) for r in sketches.collect()} == {(1, 3, (2, 1, 0, 0)), (2, 2, (0, 0, 0, 2)), (9, 1, (0, 0, 1, 0))}
