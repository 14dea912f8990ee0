"""Secrets in texts: fixed patterns, and a character convolutional network that judges every candidate in its context.

The network is trained in numpy on the driver from a labelled table of findings; its scores are calibrated on a held-out part, and
the threshold is the largest that keeps the wanted recall there.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame

from creditloom.llm.spans import Span, apart, span_table

KINDS, OWN = ["assign", "access", "hex"], "cnn"
#: Characters of context before a candidate, of the candidate itself (head and tail, if longer) and after it.
BEFORE, INSIDE, AFTER = 24, 48, 8
WIDTH = BEFORE + INSIDE + AFTER
RECALL = 0.95

_ASSIGN = re.compile(r"""(?ai:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{16,}")


def base_spans(text: str) -> list[Span]:
    """Leftmost matches of each pattern that are long enough."""
    out = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    out += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return out + [("hex", *m.span()) for m in _HEX.finditer(text)]


def candidates(text: str, known: list[Span]) -> list[tuple[int, int]]:
    """The base spans and every unbroken run of 16 or more key characters."""
    return sorted({(a, b) for _, a, b in known} | {m.span() for m in _CANDIDATE.finditer(text)})


#: Character classes: 0 outside the text, 95 printable ASCII characters, one for white space and one for all others.
CLASSES = 98


def _classes(chars: str) -> np.ndarray:
    code = np.frombuffer(chars.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    return np.where((code > 32) & (code < 127), code - 31, np.where((code == 32) | ((code > 8) & (code < 14)), 96, 97))


def window(text: str, start: int, end: int) -> np.ndarray:
    """Classes of the characters before, in and after a candidate; its middle is left out where it is too long."""
    inside = text[start:end] if end - start <= INSIDE else text[start : start + INSIDE // 2] + text[end - INSIDE // 2 : end]
    out = np.zeros(WIDTH, np.int64)
    before, after = _classes(text[max(0, start - BEFORE) : start]), _classes(text[end : end + AFTER])
    out[BEFORE - len(before) : BEFORE] = before
    out[BEFORE : BEFORE + len(inside)] = _classes(inside)
    out[BEFORE + INSIDE : BEFORE + INSIDE + len(after)] = after
    return out


def labelled_findings(count: int = 2400, seed: int = 3) -> list[tuple[str, int, int, int]]:
    """A labelled table built by rule: text, start and end of the finding, and 1 for a secret, 0 for something that looks like one."""
    r = np.random.default_rng(seed)
    pick = lambda options: options[int(r.integers(len(options)))]
    chars = lambda alphabet, n: "".join(alphabet[k] for k in r.integers(0, len(alphabet), n))
    upper, lower, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    word = lambda: "".join(pick(["an", "er", "tion", "st", "lo", "mi", "ka", "re", "mente", "sch"]) for _ in range(int(r.integers(1, 4))))
    size = lambda lo, hi: int(r.integers(lo, hi))
    secret = [
        lambda: chars(upper + lower + digits, size(20, 64)), lambda: chars(upper + lower + digits + "+/", size(24, 60)) + "==", lambda: chars("0123456789abcdef", pick([32, 40, 64])),
        lambda: "AKIA" + chars(upper + digits, 16), lambda: "ghp_" + chars(upper + lower + digits, 36), lambda: "sk_live_" + chars(upper + lower + digits, 24),
        lambda: ".".join(chars(upper + lower + digits + "_-", n) for n in (20, 40, 30)), lambda: "xoxb-" + chars(digits, 11) + "-" + chars(upper + lower + digits, 24),
    ]
    named = ["key = ", "token: ", "auth=", "password=", "client_secret: ", "Authorization: Bearer ", "secret = \"", "credential '", "", ""]
    harmless = [
        lambda: "".join(word() for _ in range(5))[:60].ljust(16, "a"), lambda: ("".join(word() for _ in range(5)) + ".").ljust(17, "n"), lambda: "-".join(word() for _ in range(6)),
        lambda: "www." + word() + word() + word() + ".example.com/" + word(), lambda: "_".join(word() for _ in range(6)), lambda: "=" * size(16, 60), lambda: "-" * size(16, 60),
        lambda: "." * size(16, 40), lambda: chars(digits, size(16, 22)), lambda: "/usr/" + "/".join(word() for _ in range(5)), lambda: word().capitalize() + "".join(word() for _ in range(5)),
        lambda: "2021-03-04T10.20.30.000", lambda: ".".join(str(size(0, 255)) for _ in range(6)), lambda: "r" * size(16, 30),
    ]
    plain = ["", "", "see ", "file ", "at ", "version ", "id "]
    out = []
    for k in range(count):
        good = k % 2
        value = pick(secret)() if good else pick(harmless)()
        value = value if len(value) >= 16 else value * (16 // max(1, len(value)) + 1)
        lead = " ".join(word() for _ in range(size(0, 7))) + pick([" ", "\n", "*** ", ". "]) + pick(named if good else plain)
        tail = pick(["", '"', "'", ";", " "]) + " " + word()
        out.append((lead + value + tail, len(lead), len(lead) + len(value), good))
    return out


class CharNet:
    """Embedding, one convolution of ``taps`` characters, the largest and the mean response of each filter in each part, one output."""

    PARTS = ((0, BEFORE), (BEFORE, BEFORE + INSIDE), (BEFORE + INSIDE, WIDTH))

    def __init__(self, embed: int = 8, filters: int = 24, taps: int = 5, seed: int = 1):
        r = np.random.default_rng(seed)
        self.taps = taps
        self.p = [
            r.normal(0, 0.5, (CLASSES, embed)), r.normal(0, 1 / np.sqrt(taps * embed), (taps * embed, filters)), np.zeros(filters),
            r.normal(0, 0.1, 2 * filters * len(self.PARTS)), np.zeros(1),
        ]
        self.slope, self.shift, self.threshold = 1.0, 0.0, 0.5

    def _forward(self, x: np.ndarray):
        table, kernel, bias, out, constant = self.p
        half = self.taps // 2
        padded = np.pad(x, ((0, 0), (half, half)))
        near = np.lib.stride_tricks.sliding_window_view(padded, self.taps, axis=1)
        columns = table[near].reshape(len(x), WIDTH, -1)
        h = np.maximum(columns @ kernel + bias, 0)
        pooled, where = [], []
        for a, b in self.PARTS:
            where.append(h[:, a:b].argmax(axis=1) + a)
            pooled += [np.take_along_axis(h, where[-1][:, None], 1)[:, 0], h[:, a:b].mean(axis=1)]
        pooled = np.concatenate(pooled, axis=1)
        return near, columns, h, where, pooled, pooled @ out + constant[0]

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self._forward(x[at : at + 512])[-1] for at in range(0, len(x), 512)]) if len(x) else np.empty(0)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability."""
        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw(x) + self.shift, -40, 40)))

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, rate: float = 0.01, seed: int = 2) -> CharNet:
        """Train on four fifths; calibrate and set the threshold on the rest."""
        r = np.random.default_rng(seed)
        order = r.permutation(len(x))
        held, order = order[: len(x) // 5], order[len(x) // 5 :]
        moments, step = [[np.zeros_like(p), np.zeros_like(p)] for p in self.p], 0
        for _ in range(epochs):
            for at in range(0, len(order), 64):
                step += 1
                rows = order[at : at + 64]
                for p, g, m in zip(self.p, self._slopes(x[rows], y[rows]), moments, strict=True):
                    m[0] = 0.9 * m[0] + 0.1 * g
                    m[1] = 0.999 * m[1] + 0.001 * g * g
                    p -= rate * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.999**step)) + 1e-8)
            order = r.permutation(order)
        raw, truth = self.raw(x[held]), y[held]
        for _ in range(200):  # Platt's scaling, by gradient steps with a little shrinkage
            error = 1 / (1 + np.exp(-np.clip(self.slope * raw + self.shift, -40, 40))) - truth
            self.slope -= 0.1 * (float((error * raw).mean()) + 0.01 * (self.slope - 1))
            self.shift -= 0.1 * (float(error.mean()) + 0.01 * self.shift)
        hits = np.sort(self.score(x[held])[truth > 0])
        if len(hits):  # the largest threshold at which the share found is still ``RECALL``
            self.threshold = float(hits[int((1 - RECALL) * len(hits))])
        return self

    def _slopes(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        table, kernel, _, out, _ = self.p
        near, columns, h, where, pooled, raw = self._forward(x)
        error = (1 / (1 + np.exp(-np.clip(raw, -40, 40))) - y) / len(x)
        down = error[:, None] * out
        dh = np.zeros_like(h)
        size = h.shape[2]
        rows, filters = np.arange(len(x))[:, None], np.arange(size)[None, :]
        for k, (a, b) in enumerate(self.PARTS):
            dh[rows, where[k], filters] += down[:, 2 * k * size : (2 * k + 1) * size]
            dh[:, a:b] += down[:, None, (2 * k + 1) * size : (2 * k + 2) * size] / (b - a)
        dh *= h > 0
        dtable = np.zeros_like(table)
        np.add.at(dtable, near.ravel(), (dh @ kernel.T).reshape(-1, table.shape[1]))
        return [dtable, np.tensordot(columns, dh, axes=([0, 1], [0, 1])), dh.sum(axis=(0, 1)), pooled.T @ error, np.array([error.sum()])]


def train(findings: Sequence[tuple[str, int, int, int]]) -> CharNet:
    """``findings``: text, start, end (code points) and label of each."""
    x = np.stack([window(text, a, b) for text, a, b, _ in findings])
    return CharNet().fit(x, np.array([label for *_, label in findings], float))


def find_secrets(docs: DataFrame, findings: Sequence[tuple[str, int, int, int]] | None = None) -> DataFrame:
    """``doc_id``, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256`` and ``spans`` of every row of ``docs``.

    Base spans come from the patterns and all stay; the network, trained on ``findings``, judges every candidate, and those it takes for secrets that overlap no
    base span are added as ``cnn``. Whole texts are read; NULL and empty ones hold nothing. Rows that repeat an id or a
    text each get their row; a NULL id stays NULL; other columns are not read.
    """
    net = docs.sparkSession.sparkContext.broadcast(train(findings or labelled_findings()))  # some thousand weights

    def more():
        def find(texts: list[str], fixed: list[list[Span]]) -> list[list[Span]]:
            out: list[list[Span]] = [[] for _ in texts]
            windows, places = [], []

            def judge():
                taken = net.value.score(np.stack(windows)) >= net.value.threshold
                for (k, a, b), yes in zip(places, taken.tolist(), strict=True):
                    if yes:
                        out[k] += [(OWN, *s) for s in apart([(a, b)], fixed[k])]
                windows.clear()
                places.clear()

            for k, text in enumerate(texts):
                for a, b in candidates(text, fixed[k]):
                    windows.append(window(text, a, b))
                    places.append((k, a, b))
                    if len(windows) == 2048:
                        judge()
            if windows:
                judge()
            return out

        return find

    return span_table(docs, KINDS, base_spans, more, OWN)
