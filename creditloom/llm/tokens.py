"""Token ids of whole texts from a ready tokenizer of the ``tokenizers`` library, each distinct word encoded once a worker."""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task keeps to its core
from tokenizers import Tokenizer  # noqa: E402

#: Ids in bytes: little-endian, unsigned, 32 bits.
ID = np.dtype("<u4")
_PIECE = r"(?s)^(?P<core>.*?)(?P<marks>[.,;:!?*%&$#|\-\"()]*)$"


def _strings(texts: pa.Array) -> list[str]:
    """As ``to_pylist``, several times faster."""
    return texts.to_numpy(zero_copy_only=False).tolist()


class WordTokens:
    """Ids (as bytes) of the pieces of a text between spaces, tabs and line ends.

    For tokenizers that drop white space and never join characters across it, so that the ids of a text are those of its
    pieces in turn. Each batch's distinct pieces are looked up once. Pieces are remembered in two generations of up to
    ``most`` each: what is met again moves to the younger one, so frequent pieces stay and rare ones go.
    """

    def __init__(self, tokenizer: str, most: int = 300_000):
        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.most = most
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        probes = ["a", "the", "word", "zq", "internationalisation", "xkcdvv"]
        model = self.tokenizer.model
        #: Do words of a-z alone reach the model as they are?
        self.direct = all(self._ids(p) == self._bytes([t.id for t in model.tokenize(p)]) for p in probes)

    @staticmethod
    def _bytes(ids: list[int]) -> bytes:
        return np.array(ids, ID).tobytes()

    def _ids(self, text: str) -> bytes:
        return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _fresh(self, words: list[str]) -> dict[str, bytes]:
        """Ids of pieces not known yet."""
        plain = [w for w in words if self.direct and w.isascii() and w.isalpha() and w.islower()]
        model = self.tokenizer.model
        known = {w: self._bytes([t.id for t in model.tokenize(w)]) for w in plain}
        others = [w for w in words if w not in known]
        for at in range(0, len(others), 10_000):
            some = others[at : at + 10_000]
            for w, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False), strict=True):
                known[w] = self._bytes(e.ids)
        return known

    def _learn(self, words: list[str]) -> None:
        """Encode new pieces. A plain word with trailing marks (no apostrophe among them) is the word in lower case, then the marks."""
        pieces = pa.array(words, pa.string())
        parts = pc.extract_regex(pieces, _PIECE)
        core, marks = parts.field("core"), parts.field("marks")
        # Up to the letter before U+0130, lower case is the same everywhere.
        plain = pc.and_(pc.utf8_is_alpha(core), pc.invert(pc.match_substring_regex(core, "[^\\x{0}-\\x{12f}]")))
        core = pc.if_else(plain, pc.utf8_lower(core), pieces).dictionary_encode()
        marks = pc.if_else(plain, marks, "").dictionary_encode()
        cores = self._known(core.dictionary)
        ends = self._known(marks.dictionary)
        whole = zip(words, core.indices.to_numpy().tolist(), marks.indices.to_numpy().tolist(), strict=True)
        self.young.update([(word, cores[c] + ends[m]) for word, c, m in whole])

    def _known(self, parts: pa.Array) -> list[bytes]:
        """Ids of distinct parts, encoded if they are new."""
        young, old = self.young, self.old
        words = _strings(parts)
        new = [w for w in words if w not in young and w not in old]
        if new:
            texts = pa.array(new, pa.string())
            holds = [pc.match_substring(texts, s) for s in self.special]
            special = {w for hold in holds if pc.any(hold).as_py() for w in texts.filter(hold).to_pylist()}
            young.update({w: self._ids(w) for w in special})
            young.update(self._fresh([w for w in new if w and w not in special]))
            young[""] = b""
        return [young[w] if w in young else old[w] for w in words]

    def of(self, words: list[str]) -> list[bytes]:
        """Ids of distinct pieces."""
        if len(self.young) > self.most:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        new = []
        for word in words:
            if word not in young:
                if (ids := old.get(word)) is None:
                    new.append(word)
                else:
                    young[word] = ids
        if new:
            self._learn(new)
        return list(map(young.__getitem__, words))

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``texts``, ``end_id`` behind each, and where each text's ids end."""
        if not len(texts):
            return np.empty(0, ID), np.empty(0, np.int64)
        spaced = pc.replace_substring(pc.replace_substring(texts, "\n", " "), "\t", " ")
        pieces = pc.split_pattern(spaced.cast(pa.large_string()), " ")
        coded = pieces.flatten().dictionary_encode()
        ids = self.of(_strings(coded.dictionary))
        each = np.frombuffer(b"".join(ids), ID)
        sizes = np.fromiter(map(len, ids), np.int64, count=len(ids)) // 4
        first = np.cumsum(sizes) - sizes
        which = coded.indices.to_numpy()
        size = sizes[which]
        ends = np.cumsum(size)
        flat = each[np.arange(ends[-1] if len(ends) else 0) + np.repeat(first[which] - (ends - size), size)]
        text_ends = np.r_[0, ends][np.cumsum(pc.list_value_length(pieces).to_numpy())]
        return np.insert(flat, text_ends, end_id), text_ends + np.arange(1, len(texts) + 1)


@lru_cache(maxsize=1)
def word_tokens(tokenizer: str) -> WordTokens:
    """One memory for all tasks of a Python worker."""
    return WordTokens(tokenizer)


def read_tokenizer(path: str) -> str:
    """The tokenizer's file as text; it goes to the executors by broadcast (a fixed file of a few MB)."""
    with open(path, encoding="utf-8") as file:
        return file.read()
