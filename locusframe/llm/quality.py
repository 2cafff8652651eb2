"""Quality rules: gradient-boosted trees over document statistics.

Statistics come from one pass over whole texts. The trees are fitted with numpy on a bounded sample of
labelled rows, flattened into node arrays, and score a batch of documents at once by walking all of them a
level at a time. On chosen statistics the score may only fall: more symbols, repeated lines, repeated words
or capitals never make a document better. Rules that need no training come first, and what they reject
stays rejected.

A null text has no words and fails the base rules, like any text of fewer than ``MIN_WORDS`` words. Without
usable labels (none, or of one class only) the trees are left out and the base rules decide. Labels that
are null are not used; an id labelled twice counts with each label. Repeated rows get equal verdicts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Labelled rows that the trees are fitted on, chosen by a hash of their id.
TRAINING_ROWS = 4000
#: A document goes if the trees give it a lower probability of being good.
KEEP_FROM = 0.5

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Shares and means that the trees see, and the direction in which each may move the score (0: either).
FEATURES = {
    "symbol_share": -1, "mark_share": -1, "bar_share": -1, "upper_share": -1, "digit_share": -1,
    "dup_line_share": -1, "repeat_word_share": -1, "mean_word": 0, "log_words": 0, "distinct_word_share": 0,
    "words_per_line": 0,
}
_SYMBOLS = re.compile(r"[#*$%&|<>]")


def base_statistics(text: str | None) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, lines equal to an earlier one, words in a repeated 3-word window."""
    text = text or ""
    words = text.encode(errors="surrogatepass").split()  # splits at ASCII white space only
    spaces = sum(map(text.count, " \t\n\r\x0b\x0c"))
    seen, repeated_lines = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\r\x0b\x0c"):
            repeated_lines += line in seen
            seen.add(line)
    repeated, windows = 0, Counter(zip(words, words[1:], words[2:]))
    if len(windows) < len(words) - 2:
        until = 0
        for at, window in enumerate(zip(words, words[1:], words[2:])):
            if windows[window] > 1:
                repeated += at + 3 - max(at, until)
                until = at + 3
    return len(words), len(text) - spaces, len(_SYMBOLS.findall(text)), repeated_lines, repeated


def features(text: str | None, base: tuple[int, int, int, int, int]) -> tuple[float, ...]:
    n_words, word_chars, symbols, dup_lines, repeated = base
    text = text or ""
    chars, words = max(word_chars, 1), max(n_words, 1)
    data = np.frombuffer(text.encode(errors="surrogatepass"), np.uint8)
    counts = np.bincount(data, minlength=128)
    lines = text.count("\n") + 1
    return (symbols / chars, counts[33] / chars, counts[124] / words, counts[65:91].sum() / chars,
            counts[48:58].sum() / chars, dup_lines / lines, repeated / words, word_chars / words,
            float(np.log1p(n_words)), len(set(text.lower().split())) / words, n_words / lines)


@dataclass
class Forest:
    """Trees as arrays: a node compares one statistic with a threshold and names its two followers.

    A leaf names itself, so that a walk of ``depth`` steps ends in a leaf from any root.
    """

    statistic: np.ndarray
    threshold: np.ndarray
    below: np.ndarray
    above: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds of being good, for a matrix with one row per document."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.statistic[at]] <= self.threshold[at], self.below[at], self.above[at])
        return self.start + self.value[at].sum(1)


def fit(x: np.ndarray, y: np.ndarray, directions: tuple[int, ...], trees: int = 60, depth: int = 3, rate: float = 0.2,
        bins: int = 64, least: int = 8, ridge: float = 1.0) -> Forest:
    """Boost ``trees`` trees on the logistic loss; splits are searched over quantiles of each statistic.

    Monotonic constraints: a split is refused if its sides are ordered against the direction of its
    statistic, and the values below a split stay on their side of the middle between its sides.
    """
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    code = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], 1)
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    start = float(np.log(share / (1 - share)))
    nodes: list[list[float]] = []  # statistic, threshold, below, above, value
    roots, score = [], np.full(len(y), start)

    def grow(rows: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, level: int, low: float, high: float) -> int:
        g, h = gradient[rows].sum(), hessian[rows].sum()
        me = len(nodes)
        nodes.append([0, 0.0, me, me, rate * float(np.clip(-g / (h + ridge), low, high))])
        if level == depth or len(rows) < 2 * least:
            return me
        best = (1e-9, 0, 0, 0.0, 0.0)
        for j, way in enumerate(directions):
            width = len(edges[j]) + 1
            sums = [np.cumsum(np.bincount(code[rows, j], w, width))[:-1] for w in (gradient[rows], hessian[rows], None)]
            gl, hl, nl = sums
            left = np.clip(-gl / (hl + ridge), low, high)
            right = np.clip(-(g - gl) / (h - hl + ridge), low, high)
            here = np.clip(-g / (h + ridge), low, high)
            fall = lambda gs, hs, v: -(gs * v + 0.5 * (hs + ridge) * v * v)  # noqa: E731  what a value takes off the loss
            gain = fall(gl, hl, left) + fall(g - gl, h - hl, right) - fall(g, h, here)
            gain[(nl < least) | (len(rows) - nl < least) | (way * (right - left) < 0)] = 0
            k = int(np.argmax(gain)) if len(gain) else 0
            if len(gain) and gain[k] > best[0]:
                best = (float(gain[k]), j, k, float(left[k]), float(right[k]))
        gain, j, k, left, right = best
        if gain <= 1e-9:
            return me
        side, middle = code[rows, j] <= k, (left + right) / 2
        bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}
        lower, upper = bounds[directions[j]]
        nodes[me][:2] = [j, float(edges[j][k])]
        nodes[me][2] = grow(rows[side], gradient, hessian, level + 1, *lower)
        nodes[me][3] = grow(rows[~side], gradient, hessian, level + 1, *upper)
        return me

    def flat() -> Forest:
        s, t, b, a, v = map(np.array, zip(*nodes))
        return Forest(s.astype(int), t, b.astype(int), a.astype(int), v, np.array(roots), depth, start)

    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        first = len(nodes)
        roots.append(grow(np.arange(len(y)), p - y, p * (1 - p), 0, -np.inf, np.inf))
        own = Forest(*(np.array(c) for c in _columns(nodes[first:], first)), np.array([0]), depth, 0.0)
        score = score + own.score(x)
    return flat()


def _columns(nodes: list[list[float]], first: int) -> tuple[np.ndarray, ...]:
    """Columns of one tree's nodes, numbered from 0."""
    s, t, b, a, v = map(np.array, zip(*nodes))
    return s.astype(int), t, b.astype(int) - first, a.astype(int) - first, v


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, limit: int) -> list:
    """At most ``limit`` labelled rows with their statistics, the same ones in any order of the input."""
    usable = labels.select(F.col(id_col).alias("label_id"), F.col("quality").cast("int").alias("label")).where(
        "label_id IS NOT NULL AND label IN (0, 1)")
    chosen = usable.orderBy(F.xxhash64("label_id"), "label_id", "label").limit(limit)
    texts = docs.select(F.col(id_col).alias("label_id"), F.col(text_col).alias("label_text"))
    joined = texts.join(F.broadcast(chosen), "label_id")  # bounded by ``limit``
    schema = T.StructType([T.StructField("label", T.IntegerType()), T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [list(map(float, features(t, base_statistics(t)))) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(x, pa.list_(pa.float64()))], ["label", "x"])

    return joined.select("label_text", "label").mapInArrow(run, schema).limit(4 * limit).collect()


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          limit: int = TRAINING_ROWS) -> Forest | None:
    """Trees fitted on the labelled rows; None without labels of both classes."""
    rows = sorted((r.label, *r.x) for r in training_rows(docs, labels, id_col, text_col, limit))
    y = np.array([r[0] for r in rows], float)
    if len(y) == 0 or y.min() == y.max():
        return None
    return fit(np.array([r[1:] for r in rows]), y, tuple(FEATURES.values()))


def verdicts(texts: list[str | None], forest: Forest | None, keep_from: float = KEEP_FROM) -> tuple[np.ndarray, ...]:
    """Base statistics, whether the base rules failed, log odds, and whether a text is kept, for a batch of texts."""
    base = np.array([base_statistics(t) for t in texts], np.int64).reshape(-1, len(BASE))
    failed = (base[:, 0] < MIN_WORDS) | (100 * base[:, 4] > MAX_REPEAT_PERCENT * base[:, 0])
    score = np.zeros(len(texts))
    if forest is None or not len(texts):
        return base, failed, score, ~failed
    score = forest.score(np.array([features(t, tuple(map(int, b))) for t, b in zip(texts, base)]))
    return base, failed, score, ~failed & (score >= float(np.log(keep_from / (1 - keep_from))))


def assess(docs: DataFrame, forest: Forest | None, id_col: str = "doc_id", text_col: str = "text",
           keep_from: float = KEEP_FROM) -> DataFrame:
    """Per row: the id, base statistics, base_failed, quality_score (log odds), kept."""
    rows = docs.select(id_col, text_col)
    schema = T.StructType([rows.schema[id_col], *(T.StructField(c, T.LongType()) for c in BASE),
                           T.StructField("base_failed", T.BooleanType()), T.StructField("quality_score", T.DoubleType()),
                           T.StructField("kept", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, failed, score, kept = verdicts(batch.column(1).to_pylist(), forest, keep_from)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, base.T), pa.array(failed), pa.array(score), pa.array(kept)], schema.names)

    return rows.mapInArrow(run, schema)


def keep_good(docs: DataFrame, forest: Forest | None, text_col: str = "text", keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they are."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(verdicts(batch.column(at).to_pylist(), forest, keep_from)[3]))

    return docs.mapInArrow(run, docs.schema)
