"""Spelling variants, SimHash near-duplicates and hard negatives against plain loops, and against SQL where there is some."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from compare import compare
from pyspark.sql import functions as F
from texts import corpus

SF = "/root/testdata/sf0.001"


def same_as_sql(spark, name):
    from locusframe.llm.queries import QUERIES, SQL

    compare(spark, SF, QUERIES[name], SQL[name])


def components_of(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        root[find(a)] = find(b)
    return {n: find(n) for n in nodes}


# Spelling variants

def plain_variants(rows, fault_every=97):
    counts = Counter()
    for doc, text in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", lowered):
            crc = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if fault_every and crc % fault_every == 0:
                at = crc % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    vocab = {w: n for w, n in counts.items() if n >= 3 and len(w) >= 5}
    near = {w: [v for v in vocab if v != w and abs(len(v) - len(w)) <= 1 and one_edit(w, v)] for w in vocab}
    out = {}
    for word, n in vocab.items():
        best = min(near[word], key=lambda v: (-vocab[v], v), default=None)
        form = best if best is not None and vocab[best] >= 2 * n else None
        out[word] = [form, None, n, len(near[word]), vocab[form] if form else None]
    for word in out:
        at = word
        while out[at][0] is not None:
            at = out[at][0]
        out[word][1] = at
    return {w: tuple(v) for w, v in out.items()}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def misspelled(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdeéÿ") for _ in range(rng.randrange(4, 9))) for _ in range(60)]
    base += ["aaaaa", "aaaaaa", "aaaaaaa", "×÷Àßÿ", "x" * 700, "x" * 699, "x" * 300 + "y" + "x" * 399]
    words = []
    for word in base:
        for _ in range(rng.choice([1, 3, 6, 12, 30])):
            own = word
            if rng.random() < 0.3:
                at = rng.randrange(len(own))
                own = own[:at] + rng.choice(["", "b", "e", own[at] * 2]) + own[at + 1:]
            words.append(own.upper() if rng.random() < 0.1 and own.isascii() else own)
    rng.shuffle(words)
    rows = [(i, " ".join(words[i::40])) for i in range(40)]
    return rows + [(None, "without an id an id an id aaaaa aaaaa"), (41, None), (42, ""), (43, "1 2 3 ..."), (7, rows[7][1]), rows[8]]


def found_variants(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.mark.parametrize("fault_every", [3, None])
def test_variants_equal_a_plain_loop(documents, fault_every):
    from locusframe.llm import spelling

    rows = misspelled(fault_every or 0)
    got = found_variants(spelling.variants(spelling.spelled_runs(documents(rows), fault_every=fault_every)))
    assert got == plain_variants(rows, fault_every)


def test_variants_in_many_rounds_of_small_filters(documents, monkeypatch):
    from locusframe.llm import spelling

    monkeypatch.setattr(spelling, "PIECE_BITS", 1024)
    monkeypatch.setattr(spelling, "LEAST_BITS", 512)
    monkeypatch.setattr(spelling, "ROUND_BYTES", 300)
    monkeypatch.setattr(spelling, "EDITS_AT_ONCE", 500)
    rows = misspelled(3)
    assert len(spelling.rounds_of({5: spelling.shape_of(300), 6: spelling.shape_of(10)})) > 2
    got = found_variants(spelling.variants(spelling.spelled_runs(documents(rows), fault_every=97)))
    assert got == plain_variants(rows)


def test_variants_of_a_corpus_and_of_nothing(documents):
    from locusframe.llm import spelling

    rows = corpus()
    assert found_variants(spelling.variants(spelling.spelled_runs(documents(rows), fault_every=97))) == plain_variants(rows)
    assert spelling.variants(spelling.spelled_runs(documents([]))).collect() == []


def test_a_filter_holds_its_words_and_few_others():
    from locusframe.llm import spelling

    rng = np.random.default_rng(1)
    own, other = (rng.integers(0, 2**64, 20000, dtype=np.uint64) for _ in range(2))
    shape = spelling.shape_of(len(own))
    piece = spelling.fill(own, shape)
    assert len(spelling.holds(piece, own, shape)) == len(own)
    assert len(spelling.holds(piece, other, shape)) < 200


def test_variants_equal_sql(shipped):
    same_as_sql(shipped, "op11_spelling_variants")


# SimHash

def plain_print(text):
    words = re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_simhash(rows):
    prints = [plain_print(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    group = components_of(range(len(rows)), links)
    least = defaultdict(lambda: None)
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[group[i]] = doc if least[group[i]] is None else min(least[group[i]], doc)
    return sorted(((d is None, d or 0, f"{p:016x}", least[group[i]]) for i, ((d, _), p) in enumerate(zip(rows, prints))), key=repr)


def test_simhash_equals_a_plain_loop(documents):
    from locusframe.llm import simhash

    rows = corpus() + [(500 + k, "one two three four five " * (k + 2)) for k in range(5)]
    base = " ".join(f"w{i}" for i in range(400))
    rows += [(600 + k, base + f" tail{k}") for k in range(40)] + [(700, base.upper())]
    got = simhash.near_duplicates(documents(rows)).collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id) for r in got), key=repr) == plain_simhash(rows)
    assert simhash.near_duplicates(documents([])).collect() == []
    alone = simhash.near_duplicates(documents([(None, "a"), (None, None)])).collect()
    assert [r.component_id for r in alone] == [None, None]


def crowd(seed, n=3000):
    """Fingerprints at random, clusters around some of them, and chains of steps of two bits."""
    rng = random.Random(seed)
    out = [rng.getrandbits(64) for _ in range(n // 3)]
    centre = rng.getrandbits(64)
    out += [centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(n // 3)]
    at = rng.getrandbits(64)
    for _ in range(n // 3):
        at ^= (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
        out.append(at)
    return np.unique(np.array(out, np.uint64))


def plain_clusters(rows):
    a, b = np.nonzero(np.bitwise_count(rows[:, None] ^ rows[None, :]) <= 2)
    root = np.arange(len(rows))
    while True:
        new = root.copy()
        np.minimum.at(new, a, root[b])
        if (new == root).all():
            return root
        root = new


@pytest.mark.parametrize("direct", [2, 64, 512])
def test_local_clusters_are_those_of_all_pairs(direct, monkeypatch):
    from locusframe.llm import simhash

    monkeypatch.setattr(simhash, "DIRECT", direct)
    monkeypatch.setattr(simhash, "KEYS_AT_ONCE", 20000)
    rows = crowd(direct)
    wanted = plain_clusters(rows)
    a, b = simhash.local_clusters(rows)
    assert dict(zip(a.tolist(), b.tolist())) == {int(rows[i]): int(rows[w]) for i, w in enumerate(wanted) if w != i}


def test_every_link_meets_in_a_leaf():
    from locusframe.llm import simhash

    rows = crowd(9)
    nodes = simhash.grow(rows[::3], 0.05)
    assert len(nodes) > 3
    leaves = [set(own.tolist()) for _, own in simhash.place(rows, nodes)]
    assert max(map(len, leaves)) < len(rows)
    a, b = np.nonzero(np.bitwise_count(rows[:, None] ^ rows[None, :]) <= 2)
    homes = defaultdict(set)
    for number, leaf in enumerate(leaves):
        for own in leaf:
            homes[own].add(number)
    assert all(homes[int(rows[i])] & homes[int(rows[j])] for i, j in zip(a, b))


@pytest.mark.parametrize("most", [50, 1 << 21])
def test_links_over_many_shards(shipped, monkeypatch, most):
    """Small shards, and shards that count as crowded and go over neighbours."""
    from locusframe.llm import simhash
    from locusframe.llm.components import components
    from locusframe.scratch import materialize

    monkeypatch.setattr(simhash, "SHARD", 100)
    monkeypatch.setattr(simhash, "SHARD_MOST", most)
    monkeypatch.setattr(simhash, "SAMPLE", 500)
    rows = crowd(4, 1500)
    frame = materialize(shipped.createDataFrame([(int(x),) for x in rows.view(np.int64)], "fingerprint long"), "prints")
    found = {r.node: r.component for r in components(materialize(simhash.links(frame, len(rows)), "links")).collect()}
    wanted = components_of(range(len(rows)), zip(*(x.tolist() for x in np.nonzero(np.triu(
        np.bitwise_count(rows[:, None] ^ rows[None, :]) <= 2, 1)))))
    groups = defaultdict(set)
    for i, root in wanted.items():
        groups[root].add(int(rows.view(np.int64)[i]))
    got = defaultdict(set)
    for value in rows.view(np.int64).tolist():
        got[found.get(value, value)].add(value)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))


# Hard negatives

def plain_negatives(rows, positives=5, negatives=10, low=30, high=90):
    rows = [r for r in rows if r[0] is not None and r[1] is not None and r[2] is not None and None not in r[2]]
    unique = sorted({(i, lab, tuple(v)) for i, lab, v in rows})
    out = []
    for anchor, label, vector in unique:
        if anchor % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(vector, v)), i, lab) for i, lab, v in unique if i != anchor and len(v) == len(vector)]
        for s, i, _ in sorted(x for x in scored if x[2] == label)[:positives]:
            inside = sorted((t, j) for t, j, lab in scored if lab != label and low * -s <= 100 * -t <= high * -s)
            out += [(anchor, i, n + 1, j, -s, -t) for n, (t, j) in enumerate(inside[:negatives])]
    return sorted(out)


def vectors(seed, n=400, size=6):
    rng = random.Random(seed)
    centres = [[rng.randrange(-90, 160) for _ in range(size)] for _ in range(12)]
    rows = []
    for i in range(n):
        c = rng.randrange(12)
        rows.append((i, c % 5, [x + rng.randrange(-20, 20) for x in centres[c]]))
    rows += [(1000 + 25 * k, 2, rows[3][2]) for k in range(40)] + [(2000 + k, 3, rows[3][2]) for k in range(30)]
    rows += [(3000, None, rows[0][2]), (3100, 1, None), (3200, 1, [1, None] + [0] * (size - 2)), (None, 1, rows[1][2]), rows[100], rows[7],
             (3300, 1, [5]), (3301, 2, [4]), (3302, 1, [3]), (3400, 1, []), (3401, 1, []), (3402, 2, []), (3500, 4, [0] * size),
             (3600, 77, rows[5][2]), (3700, 1, [-x for x in rows[6][2]])]
    return rows


@pytest.mark.parametrize("shard", [8192, 60])
def test_negatives_equal_a_plain_loop(shipped, monkeypatch, shard):
    from locusframe.llm import negatives

    monkeypatch.setattr(negatives, "SHARD", shard)
    monkeypatch.setattr(negatives, "BLOCK", 4)
    monkeypatch.setattr(negatives, "CODES", 8)
    rows = vectors(shard)
    frame = shipped.createDataFrame([(i, lab, v, 1, 2) for i, lab, v in rows],
                                    "vec_id long, label int, vector array<long>, shard int, ids int").repartition(5)
    got = negatives.hard_negatives(frame, F.col("vec_id") % 100 == 0).collect()
    assert sorted(tuple(r) for r in got) == plain_negatives(rows)
    assert negatives.hard_negatives(frame.limit(0), F.lit(True)).collect() == []


def test_cells_come_in_the_order_of_their_bounds_and_hold():
    from locusframe.llm import negatives

    rng = np.random.default_rng(3)
    rows = rng.integers(-200, 200, (600, 8))
    books = negatives.fit_codebook(rows[:, :4].astype(float)), negatives.fit_codebook(rows[:, 4:].astype(float))
    codes = [negatives.nearest_code(h.astype(float), b) for h, b in zip((rows[:, :4], rows[:, 4:]), books)]
    counts = np.zeros((len(books[0]), len(books[1])), np.int64)
    np.add.at(counts, (codes[0][0], codes[1][0]), 1)
    radii = tuple(np.array([away[own == c].max(initial=0) for c in range(len(book))]) for (own, away), book in zip(codes, books))
    index = negatives.Index(books, radii, counts, counts * 0, counts * 0 + 1)
    anchor = rows[0]
    cell = codes[0][0] * counts.shape[1] + codes[1][0]
    scores, seen, after = rows @ anchor, np.zeros(600, bool), np.inf
    for quota in (40, 200, 600):
        until, cells = negatives.visit(anchor, index, after, quota)
        fresh = np.isin(cell, cells)
        assert not (seen & fresh).any()
        seen |= fresh
        assert seen.sum() >= min(quota, 600) and (seen.all() or scores[~seen].max() <= until)
        after = until


def test_products_are_exact_or_raise():
    from locusframe.llm.negatives import products

    big = np.array([[2**29, 3]])
    assert products(big, big).tolist() == [[2**58 + 9]]
    with pytest.raises(ValueError, match="62 bits"):
        products(np.array([[2**40]]), np.array([[2**40]]))


def test_negatives_equal_sql(shipped):
    same_as_sql(shipped, "op13_hard_negatives")
