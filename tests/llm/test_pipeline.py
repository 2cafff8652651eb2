"""The whole pipeline on the smallest tables against plain loops, stage by stage."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from test_dedup import grouped, kept_by_suffixes
from test_text import JSON, naive_secrets

import __spark_entry__ as spark_entry
import corpus_pipeline
from locusframe.llm import bpe, quality, secrets
from locusframe.llm.queries import QUERIES, table

SF_DIR = "/root/testdata/sf0.001"


def masked(text):
    out, at = [], 0
    for start, kind, end in naive_secrets(text):
        if end > at:
            out += [text[at:max(at, start)], f"<{secrets.BASE[kind]}>"]
            at = end
    return "".join(out) + text[at:]


@pytest.mark.filterwarnings("ignore")
def test_pipeline_equals_the_loops(shipped):
    docs = table(shipped, SF_DIR, "documents")
    forest = quality.train(docs, table(shipped, SF_DIR, "labels"))
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    kept = quality.verdicts([t for _, t in rows], forest)[3]
    rows = [r for r, k in zip(rows, kept) if k]
    _, groups = grouped(rows)
    rows = sorted(rows[min(g)] for g in groups)
    rows = [(i, k.decode(errors="ignore")) for i, _, k, _, _ in kept_by_suffixes(rows)]
    rows = [(i, masked(t)) for i, t in rows]
    want = Counter()
    for (i, _), data in zip(rows, bpe.ByteBpe(JSON).encode([t for _, t in rows])):
        ids, begin = [*np.frombuffer(data, "<u4").tolist(), 0], 0
        for piece in range(-(-len(ids) // 2048)):
            length = (len(ids) - begin) % 2048 or 2048
            want[(i, piece, begin, length, zlib.crc32(np.array(ids[begin:begin + length], "<u4").tobytes()))] += 1
            begin += length
    got = corpus_pipeline.run(shipped, SF_DIR).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want


def test_stages_keep_the_columns_of_documents(shipped):
    docs = table(shipped, SF_DIR, "documents").limit(40)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(shipped, docs, SF_DIR).columns == docs.columns


def test_every_query_is_registered():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 11)]
    assert {*QUERIES, "pipeline"} <= set(spark_entry.queries())
