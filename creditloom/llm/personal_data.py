"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes for what they miss.

The field is trained from a small labelled table on the driver. Where a word's own weights outdo whatever tag changes could add, its tag
is certain, and a text falls into short chains between such words; equally long chains are decoded together by Viterbi in numpy.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame

from creditloom.llm.spans import Span, apart, span_table

KINDS, OWN = ["email", "ip", "card", "phone"], "crf"
TAGS = ["O", *KINDS]
#: Words that are features by themselves; all others count by their shape.
KEYWORDS = ("at", "dot", "phone", "call", "tel", "mail", "email", "e-mail", "card", "ip", "fax", "mobile", "number")
#: Words in a chain, about; words up to this length are remembered with their weights.
BLOCK, REMEMBERED = 128, 64
#: Weights of a word that is O.
FORCED = np.array([[0] + [-1e4] * (len(TAGS) - 1)], np.float32)

_NAME = r"[A-Za-z0-9._%+-]"
_EMAIL = re.compile(rf"{_NAME}++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_EMAIL_FIRST = re.compile(rf"(?<!{_NAME}){_EMAIL.pattern}")  # a run of name characters matches from its start or not at all
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _emails(text: str) -> list[Span]:
    out, at = [], 0
    while "@" in text and (m := _EMAIL.match(text, at) or _EMAIL_FIRST.search(text, at)):
        out.append(("email", *m.span()))
        at = m.end()
    return out


def luhn(digits: list[int]) -> bool:
    return sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits))) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Leftmost matches of each pattern that pass their check; a match that fails is dropped whole."""
    out = _emails(text)
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p) < 4 or not p[:-3].strip("0") for p in m[0].split(".")) and all(int(p[-3:]) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = [int(c) for c in _DIGIT.findall(m[0])] if m.end() - m.start() < 64 else []
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(map(m[0].count, "0123456789")) <= 15:
            out.append(("phone", *m.span()))
    return out


def word_features(word: str) -> list[str]:
    """Shape, shape without repeats, number of digits and marks of one word."""
    shape = "".join("9" if "0" <= c <= "9" else "X" if c.isupper() else "x" if c.isalpha() else c for c in word)
    short = re.sub(r"(.)\1+", r"\1", shape)
    digits = shape.count("9")
    out = [f"short {short}", f"digits {min(digits, 16)}", f"at {'@' in word}", f"dots {min(word.count('.'), 4)}", f"plus {word[:1] == '+'}"]
    if digits:
        out.append(f"shape {shape}")
    bare = word.lower().strip(".,;:!?()[]<>\"'")
    if bare in KEYWORDS:
        out.append(f"word {bare}")
    return out


def labelled_sentences(count: int = 400, seed: int = 11) -> list[tuple[list[str], list[str]]]:
    """A small labelled table built by rule: words and tags of invented sentences with personal data in many spellings."""
    r = np.random.default_rng(seed)
    pick = lambda options: options[int(r.integers(len(options)))]
    digits = lambda n: "".join(map(str, r.integers(0, 10, n)))
    word = lambda: "".join(pick(["an", "er", "tion", "st", "lo", "mi", "ka", "re", "ß", "é"]) for _ in range(int(r.integers(1, 5))))
    plain = [
        word, lambda: word().capitalize(), lambda: word() + pick([".", ",", "***", "!", ":"]), lambda: digits(int(r.integers(1, 5))), lambda: digits(2) + ":" + digits(2),
        lambda: digits(1) + "." + digits(2), lambda: digits(8), lambda: pick(["at", "dot", "call", "number", "card"]), lambda: f"{word()}.{word()}", lambda: "".join(pick("0123456789abcdef") for _ in range(32)),
        lambda: f"{digits(4)}-{digits(2)}-{digits(2)}", lambda: f"v{digits(1)}.{digits(1)}.{digits(2)}", lambda: pick(["=", "-", "@", "+", "&"]),
    ]
    personal = {
        "email": [lambda: [f"{word()}.{digits(2)}@{word()}.com"], lambda: [word(), "at", word(), "dot", "com"], lambda: [word(), "(at)", word(), "(dot)", "org"], lambda: [f"{word()}[at]{word()}.net"]],
        "ip": [lambda: [".".join(str(r.integers(1, 255)) for _ in range(4))], lambda: [".".join(str(r.integers(1, 255)) for _ in range(4)) + pick([",", "."])]],
        "card": [lambda: ["card", *(digits(4) for _ in range(4))], lambda: [".".join(digits(4) for _ in range(4))], lambda: ["/".join(digits(4) for _ in range(4))]],
        "phone": [lambda: [f"+{digits(2)}", digits(3), digits(4), digits(3)], lambda: [f"({digits(3)})", f"{digits(3)}-{digits(4)}"], lambda: [f"{digits(3)}-{digits(3)}-{digits(4)}"], lambda: [f"+{digits(11)}"]],
    }
    # What looks alike and is not: prose around "at", and numbers that the patterns judge by themselves.
    decoys = [
        lambda: [word(), "at", word()], lambda: ["at", "at"], lambda: [word(), "at", "at", word()], lambda: [word(), "at", word(), "dot"], lambda: ["at", word(), "at", word()],
        lambda: [digits(16)], lambda: [digits(4) for _ in range(4)], lambda: ["-".join(digits(4) for _ in range(4))], lambda: [digits(int(r.integers(9, 20)))],
        lambda: [word(), "dot", word()], lambda: ["card", word()], lambda: ["number", digits(3)], lambda: ["call", word(), digits(2)],
    ]
    out = []
    for _ in range(count):
        words = [pick(plain)() if r.random() < 0.4 else word() for _ in range(int(r.integers(3, 9)))]
        tags = ["O"] * len(words)
        if r.random() < 0.5:
            kind = pick(KINDS)
            entity = pick(personal[kind])()
            at = int(r.integers(len(words) + 1))
            words[at:at], tags[at:at] = entity, [kind] * len(entity)
        elif r.random() < 0.7:
            words += pick(decoys)() + [word()]
            tags += ["O"] * (len(words) - len(tags))
        out.append((words, tags))
    return out


class Crf:
    """Weights of word features for a word's own tag, and for those of the words after and before it, and of tag changes."""

    def __init__(self, sentences: list[tuple[list[str], list[str]]], rounds: int = 120, rate: float = 0.1, decay: float = 1e-3):
        self.names = {f: k for k, f in enumerate(sorted({f for words, _ in sentences for w in words for f in word_features(w)}))}
        count, size = len(sentences), max(len(w) for w, _ in sentences)
        x = np.zeros((count, size + 2, len(self.names) + 1), np.float32)  # the last feature marks places outside a sentence
        y = np.zeros((count, size), np.int64)
        mask = np.zeros((count, size), bool)
        x[:, :, -1] = 1
        for i, (words, tags) in enumerate(sentences):
            for t, (word, tag) in enumerate(zip(words, tags, strict=True)):
                x[i, t + 1, -1] = 0
                x[i, t + 1, [self.names[f] for f in word_features(word)]] = 1
                y[i, t], mask[i, t] = TAGS.index(tag), True
        k = len(TAGS)
        views = [x[:, 1:-1], x[:, :-2], x[:, 2:]]
        w, change = [np.zeros((x.shape[2], k)) for _ in views], np.zeros((k, k))
        moments = [[np.zeros_like(p), np.zeros_like(p)] for p in [*w, change]]
        gold = np.eye(k)[y] * mask[..., None]
        pairs = mask[:, 1:]
        gold_change = np.einsum("nti,ntj->ij", gold[:, :-1] * pairs[..., None], gold[:, 1:])
        for step in range(1, rounds + 1):
            e = sum(v @ u for v, u in zip(views, w, strict=True)) * mask[..., None]
            ahead, back = np.zeros_like(e), np.zeros_like(e)
            ahead[:, 0] = e[:, 0]
            for t in range(1, size):
                ahead[:, t] = np.where(mask[:, t, None], e[:, t] + np.logaddexp.reduce(ahead[:, t - 1, :, None] + change, axis=1), ahead[:, t - 1])
            total = np.logaddexp.reduce(ahead[:, -1], axis=1)
            expected_change = np.zeros((k, k))
            for t in range(size - 2, -1, -1):
                after = e[:, t + 1] + back[:, t + 1]
                back[:, t] = np.where(mask[:, t + 1, None], np.logaddexp.reduce(change + after[:, None, :], axis=2), 0)
                both = np.exp(ahead[:, t, :, None] + change + after[:, None, :] - total[:, None, None])
                expected_change += (both * mask[:, t + 1, None, None]).sum(axis=0)
            expected = np.exp(ahead + back - total[:, None, None]) * mask[..., None]
            rest = (gold - expected) / count
            slopes = [np.tensordot(v, rest, axes=([0, 1], [0, 1])) for v in views] + [(gold_change - expected_change) / count]
            for p, g, m in zip([*w, change], slopes, moments, strict=True):
                g = g - decay * p
                m[0] = 0.9 * m[0] + 0.1 * g
                m[1] = 0.99 * m[1] + 0.01 * g * g
                p += rate * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-8)
        self.weights, self.change = np.stack(w).astype(np.float32), change.astype(np.float32)

    def decoder(self) -> Decoder:
        return Decoder(self)


class Decoder(dict):
    """Tags of texts; remembers the feature weights of each kind of word (``most`` words at a time)."""

    def __init__(self, crf: Crf, most: int = 400_000):
        super().__init__()
        self.crf, self.most = crf, most
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.kinds: dict[tuple, int] = {}
        self.rows = [self.crf.weights[:, -1]]  # kind 0: the gap between two texts

    def __missing__(self, word: str) -> int:
        features = tuple(k for f in word_features(word) if (k := self.crf.names.get(f)) is not None)
        kind = self.kinds.get(features)
        if kind is None:
            kind = self.kinds[features] = len(self.rows)
            self.rows.append(self.crf.weights[:, list(features)].sum(axis=1))
        if len(word) <= REMEMBERED:
            self[word] = kind
        return kind

    def tags(self, texts: list[list[str]]) -> np.ndarray:
        """Tag of every word; texts follow one another with a gap, tagged O, before each."""
        if len(self) > self.most:
            self.clear()
        kinds = np.fromiter((k for words in texts for k in (0, *map(self.__getitem__, words))), np.int64)
        table = np.stack(self.rows)
        around = np.r_[0, kinds, 0]
        e = table[kinds, 0] + table[around[:-2], 1] + table[around[2:], 2]
        # A tag other than O at such a word would lose more than its two tag changes can win: its tag is certain, as that of a gap.
        change = self.crf.change
        win = (change - change[:, :1]).max(axis=0) + (change - change[:1]).max(axis=1)
        certain = (kinds == 0) | (e[:, :1] - e[:, 1:] > win[1:] + 1e-3).all(axis=1)
        e[certain] = FORCED
        # Chains begin at certain words, near BLOCK words apart where there are any, and are filled up with O.
        sure = np.flatnonzero(certain)
        begin = np.unique(sure[np.minimum(np.searchsorted(sure, np.arange(0, len(e), BLOCK)), len(sure) - 1)])
        size = np.diff(np.r_[begin, len(e)])
        width = 1 << np.ceil(np.log2(np.maximum(size + 1, BLOCK))).astype(np.int64)
        out = np.zeros(len(e), np.int64)
        e = np.concatenate([e, FORCED])
        for length in np.unique(width).tolist():
            some = np.flatnonzero(width == length)
            for part in np.array_split(some, len(some) * length // 500_000 + 1):
                places = begin[part, None] + np.arange(length)
                places[np.arange(length) >= size[part, None]] = len(out)
                found = viterbi(e[places], change)
                inside = places < len(out)
                out[places[inside]] = found[inside]
        return out


def viterbi(e: np.ndarray, change: np.ndarray) -> np.ndarray:
    """Best tags of equally long blocks of words, all blocks at once."""
    best, came = e[:, 0], np.zeros(e.shape, np.int8)
    for t in range(1, e.shape[1]):
        step = best[:, :, None] + change
        came[:, t] = step.argmax(axis=1)
        best = step.max(axis=1) + e[:, t]
    out = np.zeros(e.shape[:2], np.int64)
    out[:, -1] = best.argmax(axis=1)
    for t in range(e.shape[1] - 1, 0, -1):
        out[:, t - 1] = came[np.arange(len(e)), t, out[:, t]]
    return out


def personal_data(docs: DataFrame, sentences: list[tuple[list[str], list[str]]] | None = None) -> DataFrame:
    """``doc_id``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``base_sha256`` and ``spans`` of every row of ``docs``.

    Base spans come from the patterns; the field, trained on ``sentences`` (words with their tags), adds runs of words tagged alike that overlap no base span, as ``crf``.
    Whole texts are read, each as a chain of its own, so spans do not depend on which texts share a batch; NULL and empty ones hold nothing; an
    empty table gives no rows. Rows that repeat an id or a text each get their row; a NULL id stays
    NULL; other columns are not read.
    """
    crf = docs.sparkSession.sparkContext.broadcast(Crf(sentences or labelled_sentences()))  # some hundred features

    def more():
        decoder = crf.value.decoder()

        def find(texts: list[str], fixed: list[list[Span]]) -> list[list[Span]]:
            words = [t.split() for t in texts]
            tags, at, out = decoder.tags(words), 0, []
            for text, own, known in zip(texts, words, fixed, strict=True):
                mine = tags[at + 1 : at + 1 + len(own)]
                at += 1 + len(own)
                runs = []
                if mine.any():
                    places = [m.span() for m in re.finditer(r"\S+", text)]
                    edges = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1], True])
                    runs = [(places[a][0], places[b - 1][1]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True) if mine[a]]
                out.append([(OWN, a, b) for a, b in apart(runs, known)])
            return out

        return find

    return span_table(docs, KINDS, base_spans, more, OWN)
