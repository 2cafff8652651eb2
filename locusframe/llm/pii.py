"""Personal data by rules, and by a character-level bidirectional LSTM with CRF transitions.

Base spans come from fixed patterns and always stay. The network is trained in numpy on labelled spans: base
spans of a bounded sample of rows, in their contexts, and the same spans as people disguise them, (at) or at for
@, [.] or dot for a dot, no plus sign, also with long names. It adds spans that the patterns miss.

A whole text is cut into overlapping windows; the network scores each window; scores of a character are
averaged over its windows, more weight to those where it is central; and one Viterbi pass over the whole text
reconciles them, so a span that several windows see is one span. What is added must score well against no
span, must not overlap a base span, and must hold an anchor: a digit, an @ or the word at.

Spans are those of the whole text, but windows that cannot matter are left out: no span is without an anchor,
and around anchors windows are scored until the best path is settled, that is, until the tags of the anchor
and of its whole run are the same for every tag the path may have at the two edges of what was scored. The
path through the whole text has some tags there, so it is the same as well, however far away its text goes on.

A null text counts as empty: no spans. Repeated rows get equal spans. If the sample holds no base span there
is nothing to train on and base spans alone are given. An empty table gives an empty result. Columns other
than id and text are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

#: Kinds in the order of reports.
KINDS = ("email", "ip", "card", "phone")
TAGS = len(KINDS) + 1  # the first is: no personal data

#: Rows that the network is fitted on, chosen by a hash of their id, and windows taken of a row at most.
SAMPLE_ROWS, SAMPLE_WINDOWS = 600, 16
WIDTH, STRIDE, HIDDEN = 64, 32, 16
STEPS, BATCH, RATE = 480, 96, 0.02
#: Least mean advantage of a span's tags over no personal data, in log space.
MARGIN = 3.0

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9][0-9.]*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_AT = re.compile(r"(?<![^\W_])at(?![^\W_])", re.I)
_DOT = re.compile(r"\.|(?<![^\W_])dot(?![^\W_])", re.I)
#: Whatever ``_is_plausible`` accepts holds a match from its first character to the last.
_ANCHOR = re.compile(f"[0-9@]|{_AT.pattern}", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """A match begins at the first local character before its @ that no match holds; every @ is looked at once."""
    free, at = 0, text.find("@")
    while at >= 0:
        begin = free + len(text[free:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            free = domain.end()
            yield begin, free
        else:
            free = max(free, at + 1)
        at = text.find("@", max(free, at + 1))


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers with dots between, taken from each run of digits and dots from the left."""
    for run in _DOTTED.finditer(text):
        if run[0].count(".") < 3:
            continue
        parts = []
        for number in re.finditer("[0-9]+", run[0]):
            if parts and number.start() != parts[-1].end() + 1:
                parts = []
            parts.append(number)
            if len(parts) == 4:
                if all(len(p[0].lstrip("0")) <= 3 and int(p[0].lstrip("0") or 0) <= 255 for p in parts):
                    yield run.start() + parts[0].start(), run.start() + parts[3].end()
                parts = []


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base matches, in order."""
    spans = [(a, 0, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        spans += [(a, 1, b) for a, b in _addresses(text)]
        for match in _CARD.finditer(text):
            digits = match[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append((match.start(), 2, match.end()))
        if "+" in text:
            for match in _PHONE.finditer(text):
                if 10 <= len(_DIGIT.findall(match[0])) <= 15:
                    spans.append((match.start(), 3, match.end()))
    return sorted(spans)


def symbols(text: str) -> np.ndarray:
    """One of 99 symbols for each character: ASCII ones for themselves, white space, other letters, the rest."""
    points = np.frombuffer(text.encode("utf-32-le", errors="surrogatepass"), np.uint32)
    out = np.where(points < 127, points.astype(np.int64) - 31, 97)
    out[points < 32] = 96
    out[(points >= 0xC0) & (points < 0x250)] = 98
    return out


class Network:
    """Parameters, scores of windows, and gradients."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        draw = lambda *shape, by: (rng.standard_normal(shape) * by).astype(np.float32)
        self.p = {"out": draw(2 * HIDDEN, TAGS, by=0.3), "bias": np.zeros(TAGS, np.float32),
                  "moves": np.zeros((TAGS, TAGS), np.float32)}
        for way in "fb":
            self.p[f"in_{way}"] = draw(99, 4 * HIDDEN, by=0.3)
            self.p[f"in_{way}"][:, HIDDEN:2 * HIDDEN] += 0.5  # remember at first
            self.p[f"back_{way}"] = draw(HIDDEN, 4 * HIDDEN, by=0.2)

    def _lstm(self, x: np.ndarray, way: str) -> tuple[np.ndarray, list]:
        """States of one direction for symbols of shape (windows, time)."""
        table, back = self.p[f"in_{way}"], self.p[f"back_{way}"]
        h = c = np.zeros((len(x), HIDDEN), np.float32)
        states, kept = np.empty((*x.shape, HIDDEN), np.float32), []
        for t in range(x.shape[1]):
            z = table[x[:, t]] + h @ back
            gates = 1 / (1 + np.exp(-z[:, :3 * HIDDEN]))
            i, f, o = (gates[:, k * HIDDEN:(k + 1) * HIDDEN] for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN:])
            before, previous = c, h
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            states[:, t] = h
            kept.append((i, f, o, g, before, tc, previous))
        return states, kept

    def _lstm_gradient(self, x: np.ndarray, way: str, kept: list, d: np.ndarray) -> dict[str, np.ndarray]:
        back = self.p[f"back_{way}"]
        d_back, dz_all = np.zeros_like(back), np.empty((*x.shape, 4 * HIDDEN), np.float32)
        dh = dc = np.zeros((len(x), HIDDEN), np.float32)
        for t in range(x.shape[1] - 1, -1, -1):
            i, f, o, g, before, tc, previous = kept[t]
            dh = dh + d[:, t]
            dc = dc + dh * o * (1 - tc * tc)
            dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
            dz_all[:, t] = dz
            d_back += previous.T @ dz
            dh, dc = dz @ back.T, dc * f
        hot = np.zeros((x.size, 99), np.float32)
        hot[np.arange(x.size), x.ravel()] = 1
        return {f"in_{way}": hot.T @ dz_all.reshape(x.size, -1), f"back_{way}": d_back}

    def score(self, x: np.ndarray) -> np.ndarray:
        """Scores of tags, of shape (windows, time, tags)."""
        forward, _ = self._lstm(x, "f")
        backward, _ = self._lstm(x[:, ::-1], "b")
        return np.concatenate([forward, backward[:, ::-1]], 2) @ self.p["out"] + self.p["bias"]

    def gradient(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the negative log likelihood of the tag sequences ``y``, by the forward-backward algorithm."""
        forward, kept_f = self._lstm(x, "f")
        backward, kept_b = self._lstm(x[:, ::-1], "b")
        both = np.concatenate([forward, backward[:, ::-1]], 2)
        e, moves, (n, time) = both @ self.p["out"] + self.p["bias"], self.p["moves"], x.shape
        a, b = np.empty_like(e), np.zeros_like(e)
        a[:, 0] = e[:, 0]
        for t in range(1, time):
            a[:, t] = e[:, t] + _log_sum(a[:, t - 1, :, None] + moves, 1)
        for t in range(time - 2, -1, -1):
            b[:, t] = _log_sum(moves + (e[:, t + 1] + b[:, t + 1])[:, None], 2)
        z = _log_sum(a[:, -1], 1)
        de = np.exp(a + b - z[:, None, None])
        de[np.arange(n)[:, None], np.arange(time), y] -= 1
        pair = np.exp(a[:, :-1, :, None] + moves + (e[:, 1:] + b[:, 1:])[:, :, None] - z[:, None, None, None]).sum((0, 1))
        np.subtract.at(pair, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
        de, pair = de / n, pair / n
        d = de @ self.p["out"].T
        grads = {"out": np.einsum("bth,btk->hk", both, de), "bias": de.sum((0, 1)), "moves": pair}
        grads |= self._lstm_gradient(x, "f", kept_f, d[:, :, :HIDDEN])
        return grads | self._lstm_gradient(x[:, ::-1], "b", kept_b, d[:, ::-1, HIDDEN:])

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = STEPS, seed: int = 7) -> Network:
        """Adam on random batches; half of each from windows that hold a span."""
        rng = np.random.default_rng(seed)
        some = np.flatnonzero(y.any(1))
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        for step in range(1, steps + 1):
            rows = np.concatenate([rng.choice(some, BATCH // 2), rng.integers(0, len(x), BATCH - BATCH // 2)])
            for k, g in self.gradient(x[rows], y[rows]).items():
                g = np.clip(g, -5, 5)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                rate = RATE * (1 if step < 0.7 * steps else 0.25)
                self.p[k] = (self.p[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
        return self


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def viterbi(scores: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The best tag sequence of one stretch."""
    best, came = scores[0], np.empty((len(scores), TAGS), np.int8)
    for t in range(1, len(scores)):
        ways = best[:, None] + moves
        came[t] = ways.argmax(0)
        best = ways.max(0) + scores[t]
    tags = np.empty(len(scores), np.int8)
    tags[-1] = best.argmax()
    for t in range(len(scores) - 1, 0, -1):
        tags[t - 1] = came[t, tags[t]]
    return tags


def settled_paths(scores: list[np.ndarray], moves: np.ndarray, is_open: list[tuple[bool, bool]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each part of a text the best tags, and where they are the same whatever the tags at its open edges.

    An edge that is not open is one of the text. Parts are walked together, the longest first.
    """
    order = sorted(range(len(scores)), key=lambda k: -len(scores[k]))
    sizes = np.array([len(scores[k]) for k in order])
    padded = np.zeros((sizes[0], len(order), TAGS), np.float32)
    for at, k in enumerate(order):
        padded[:len(scores[k]), at] = scores[k]
    left, right = (np.array([is_open[k][side] for k in order]) for side in (0, 1))
    # best[part, tag at the left edge, tag]
    best = np.repeat(padded[0][:, None], TAGS, 1)
    best[left] += np.where(np.eye(TAGS, dtype=bool), np.float32(0), np.float32(-1e9))
    came = np.zeros((sizes[0], len(order), TAGS, TAGS), np.int8)
    counts = [int(np.searchsorted(-sizes, -t)) for t in range(sizes[0] + 1)]  # parts longer than t
    for t in range(1, sizes[0]):
        n = counts[t]
        before = best[:n]
        top, origin = before[:, :, :1] + moves[0], came[t, :n]
        for tag in range(1, TAGS):
            way = before[:, :, tag:tag + 1] + moves[tag]
            origin[way > top] = tag
            np.maximum(top, way, out=top)
        top += padded[t, :n, None]
        best[:n] = top - top.max(2, keepdims=True)
    # path[part, tag at the left edge, tag at the right edge]
    path = np.repeat(best.argmax(2)[:, :, None], TAGS, 2)
    path[right] = np.arange(TAGS)
    tags, same = np.zeros((sizes[0], len(order)), np.int8), np.zeros((sizes[0], len(order)), bool)
    for t in range(sizes[0] - 1, -1, -1):
        own = path[:counts[t]]
        tags[t, :len(own)] = own[:, 0, 0]
        same[t, :len(own)] = (own == own[:, :1, :1]).all((1, 2))
        if t:
            own[:] = np.take_along_axis(came[t, :len(own)], own, 2)
    place = {k: at for at, k in enumerate(order)}
    return [(tags[:len(x), place[k]], same[:len(x), place[k]]) for k, x in enumerate(scores)]


#: Weight of a character by its place in a window.
_WEIGHT = np.minimum(np.arange(1, WIDTH + 1), np.arange(WIDTH, 0, -1)).astype(np.float32)


def _windows(begin: int, end: int) -> list[int]:
    """Where the windows of a stretch begin; the last ones may reach past its end."""
    return list(range(begin, max(begin + 1, end - WIDTH + STRIDE), STRIDE))


def _is_plausible(kind: int, text: str, begin: int, end: int) -> bool:
    piece = text[begin:end]
    digits = len(_DIGIT.findall(piece))
    if kind == 0:
        at = _AT.search(text, begin, end)  # the bare word needs a dot behind it
        return len(piece) >= 6 and bool("@" in piece or at and (
            "(at)" in piece or "[at]" in piece or _DOT.search(text, at.end(), end)))
    return (4 <= digits <= 12, 13 <= digits <= 19, 7 <= digits <= 15)[kind - 1]


class _Scores:
    """Scores of the characters of some texts; a window is scored when it is first needed."""

    def __init__(self, network: Network, texts: list[str]):
        self.network, self.texts, self.marks = network, texts, {}
        self.row: dict[tuple[int, int], int] = {}
        self.table = np.zeros((1, WIDTH, TAGS), np.float32)  # the first row stands for windows that do not exist

    def of(self, parts: list[tuple[int, int, int]]) -> list[np.ndarray]:
        """Of each part: text, first character, a multiple of the stride, and the character after the last."""
        wanted, missing = [], []
        for k, begin, end in parts:
            last = _windows(0, len(self.texts[k]))[-1]
            for at in range(begin, end, STRIDE):
                pair = [(k, x) if 0 <= x <= last else None for x in (at - STRIDE, at)]
                wanted.append(pair)
                for window in pair:
                    if window and window not in self.row:
                        self.row[window] = len(self.table) + len(missing)
                        missing.append(window)
        made = [self.table]
        for first in range(0, len(missing), 2048):
            some = np.zeros((len(missing[first:first + 2048]), WIDTH), np.int64)
            for row, (k, at) in zip(some, missing[first:first + 2048]):
                if k not in self.marks:
                    self.marks[k] = symbols(self.texts[k])
                cut = self.marks[k][at:at + WIDTH]
                row[:len(cut)] = cut
            made.append(self.network.score(some))
        self.table = np.concatenate(made)
        rows = np.array([[self.row[w] if w else 0 for w in pair] for pair in wanted])
        weights = [_WEIGHT[half] * (rows[:, side] > 0)[:, None] for side, half in enumerate((slice(STRIDE, WIDTH), slice(0, STRIDE)))]
        total = (self.table[rows[:, 0], STRIDE:] * weights[0][:, :, None] + self.table[rows[:, 1], :STRIDE] * weights[1][:, :, None])
        total /= (weights[0] + weights[1])[:, :, None]
        out, at = [], 0
        for _, begin, end in parts:
            blocks = -(-(end - begin) // STRIDE)
            out.append(total[at:at + blocks].reshape(-1, TAGS)[:end - begin])
            at += blocks
        return out


def _groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Texts that are taken together."""
    begin, size = 0, 0
    for k, text in enumerate(texts):
        if k > begin and (k - begin == 256 or size + len(text) > 2_000_000):
            yield begin, k
            begin, size = k, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def find(network: Network | None, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """All spans of each text: base ones and what the network adds."""
    found = [base_spans(t) for t in texts]
    if network is None:
        return found
    for first, last in _groups(texts):
        scores, jobs = _Scores(network, texts[first:last]), []
        added: list[set[tuple[int, int, int]]] = [set() for _ in range(first, last)]
        for k, text in enumerate(scores.texts):
            near: dict[int, list[int]] = {}
            for match in _ANCHOR.finditer(text):
                near.setdefault(match.start() // (4 * STRIDE), []).append(match.start())
            jobs += [(k, max(0, (a[0] // STRIDE - 1) * STRIDE), min(len(text), (a[-1] // STRIDE + 2) * STRIDE), a) for a in near.values()]
        step = STRIDE
        while jobs:
            step, wider = 2 * step, []
            for begin in range(0, len(jobs), 1024):
                some = jobs[begin:begin + 1024]
                own = scores.of([job[:3] for job in some])
                is_open = [(a > 0, b < len(scores.texts[k])) for k, a, b, _ in some]
                for (k, a, b, anchors), part, edges, (tags, same) in zip(some, own, is_open, settled_paths(own, network.p["moves"], is_open)):
                    runs, left, right = _runs(np.array(anchors) - a, tags, same, edges)
                    if left or right:
                        wider.append((k, max(0, a - step) if left else a, min(len(scores.texts[k]), -(-b // STRIDE) * STRIDE + step) if right else b, anchors))
                    else:
                        added[k].update(_added(scores.texts[k], a, part, tags, runs, found[first + k]))
            jobs = wider
        for k, spans in enumerate(added, first):
            found[k] = sorted(found[k] + list(spans))
    return found


def _runs(anchors: np.ndarray, tags: np.ndarray, same: np.ndarray, is_open: tuple[bool, bool]) -> tuple[list[tuple[int, int]], bool, bool]:
    """Runs of a tag that hold an anchor, and whether they cannot be told without more text on the left or right."""
    if not same[anchors].all():
        return [], *is_open
    cuts = np.flatnonzero(np.diff(tags)) + 1
    begins, ends = np.r_[0, cuts], np.r_[cuts, len(tags)]
    held = np.unique(np.searchsorted(begins, anchors[tags[anchors] != 0], side="right") - 1)
    runs, left, right = [], False, False
    for a, b in zip(begins[held].tolist(), ends[held].tolist()):
        # settled with the character on either side
        if (a == 0 and is_open[0]) or (b == len(tags) and is_open[1]) or not same[max(0, a - 1):b + 1].all():
            left, right = left or is_open[0], right or is_open[1]
        runs.append((a, b))
    return runs, left, right


def _added(text: str, offset: int, scores: np.ndarray, tags: np.ndarray, runs: list, base: list) -> list[tuple[int, int, int]]:
    spans = []
    for a, b in runs:
        if (scores[a:b, tags[a]] - scores[a:b, 0]).mean() < MARGIN:
            continue
        piece = text[offset + a:offset + b]
        begin = offset + a + len(piece) - len(piece.lstrip())
        end, kind = begin + len(piece.strip()), int(tags[a]) - 1
        if _is_plausible(kind, text, begin, end) and all(end <= s or begin >= e for s, _, e in base):
            spans.append((begin, kind, end))
    return spans


def disguises(text: str, kind: int) -> list[str]:
    """The ways in which a span of a kind is commonly written so that patterns miss it."""
    if kind == 0:
        return [text.replace("@", at).replace(".", dot) for at, dot in (
            (" at ", " dot "), ("(at)", "."), (" [at] ", "."), (" @ ", "."), (" at ", "."), ("(at)", "(dot)"), ("[at]", "[dot]"))]
    if kind == 1:
        return [text.replace(".", dot) for dot in ("[.]", " . ", "(.)")]
    if kind == 2:
        digits = re.sub("[ -]", "", text)
        return [dot.join(digits[k:k + 4] for k in range(0, len(digits), 4)) for dot in (".", "  ", "/")]
    return [text.lstrip("+"), text.lstrip("+").split(" ", 1)[-1], "00" + text.lstrip("+")]


def _lengthened(text: str, near: str) -> str:
    """An address with more names on both sides of its @, of the letters that stand near it."""
    letters = re.sub("[^A-Za-z]", "", near).lower()
    local, domain = text.split("@")
    size = 4 + len(near) * 7 % 9 + len(local) % 3
    names = [letters[k * size:(k + 1) * size] for k in range(4)]
    return f"{names[0]}.{names[1]}-{local}@{names[2]}-{names[3]}.{domain}" if all(names) else text


def examples(text: str, limit: int) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Windows of a text with their base spans, and with the same spans in disguise."""
    base, out = base_spans(text), []
    for begin, kind, end in base:
        own = text[begin:end]
        ways, bare = disguises(own, kind), []
        if kind == 0:  # hardest to learn, and so taken each time: the one that has no signs at all
            bare = [ways.pop(0)]
            ways += disguises(_lengthened(own, text[max(0, begin - 90):begin]), kind)
        turn = begin * 5 + end  # not all ways for each span, so that a row has room for several spans
        for way in [own, *bare, *(ways[(turn + k * (len(ways) // 3)) % len(ways)] for k in range(3))]:
            left = text[max(0, begin - (begin * 7 + len(way)) % 24):begin]
            whole, size = left + way + text[end:end + WIDTH], len(left) + len(way)
            for at in _windows(0, size):
                out.append((whole[at:at + WIDTH], [(len(left) - at, kind, size - at)]))
    near = {m.start() // STRIDE * STRIDE for m in _ANCHOR.finditer(text)}
    for at in _windows(0, len(text)):
        if at in near or at + STRIDE in near:
            out.append((text[at:at + WIDTH], [(s - at, k, e - at) for s, k, e in base if s < at + WIDTH and e > at]))
    return out[:limit]


def training_windows(docs: DataFrame, id_col: str, text_col: str, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and tags of the windows of at most ``rows`` rows, the same in any order of the input."""
    held = docs.select(F.col(id_col).alias("sample_id"), F.col(text_col).alias("sample_text")).where(
        F.col("sample_id").isNotNull() & F.col("sample_text").rlike("[0-9@]"))
    chosen = held.select("sample_id").orderBy(F.xxhash64("sample_id"), "sample_id").limit(rows).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = [], []
            for text in batch.column(0).to_pylist():
                for piece, spans in examples(text, SAMPLE_WINDOWS):
                    marks, tags = symbols(piece[:WIDTH]), np.zeros(WIDTH, np.int64)
                    for start, kind, end in spans:
                        tags[max(0, start):max(0, min(end, len(marks)))] = kind + 1
                    x.append(np.pad(marks, (0, WIDTH - len(marks))).tolist())
                    y.append(tags.tolist())
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x, kind), pa.array(y, kind)], ["x", "y"])

    texts = held.join(F.broadcast(chosen), "sample_id").select("sample_text")  # bounded by ``rows``
    found = sorted((r.x, r.y) for r in texts.mapInArrow(run, "x array<long>, y array<long>").limit(
        rows * SAMPLE_WINDOWS).collect())
    shape = (len(found), WIDTH)
    return (np.array([f[0] for f in found], np.int64).reshape(shape), np.array([f[1] for f in found], np.int64).reshape(shape))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE_ROWS) -> Network | None:
    """The network fitted on a bounded sample; None if the sample holds no span."""
    x, y = training_windows(docs, id_col, text_col, rows)
    return Network().fit(x, y) if y.any() else None


def _as_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def report(docs: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, counts of base spans by kind, digest of the base spans, all spans as text."""
    rows = docs.select(id_col, text_col)
    counts = [f"n_{k}" for k in KINDS]
    schema = T.StructType([rows.schema[id_col], *(T.StructField(c, T.LongType()) for c in counts),
                           T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            every = find(network, texts)
            base = [base_spans(t) for t in texts]
            numbers = [pa.array([sum(k == kind for _, k, _ in b) for b in base], pa.int64()) for kind in range(len(KINDS))]
            digests = [hashlib.sha256(_as_text(b).encode()).hexdigest() for b in base]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *numbers, pa.array(digests, pa.string()), pa.array(map(_as_text, every), pa.string())],
                schema.names)

    return rows.mapInArrow(run, schema)
