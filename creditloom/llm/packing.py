"""Documents packed into sequences of a fixed number of tokens by the sum-of-squares rule."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from creditloom.llm.common import text_slices, text_table
from creditloom.llm.tokens import read_tokenizer, word_tokens

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
FIELDS = [f.split()[0] for f in PIECE.split(", ")]


class SumOfSquares:
    """Places pieces online: each goes to the fill level whose choice leaves the smallest sum of squared level counts.

    ``counts[h]`` is the number of open windows filled with ``h`` tokens. An open window takes the piece if it fits; an
    empty window (level 0) is always at hand; a full window leaves the counts. Ties go to the fuller window.
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, np.int64)
        self.windows: list[list[list]] = [[] for _ in range(capacity + 1)]
        self.open = 0

    def place(self, piece, size: int) -> list | None:
        """The window's pieces if it is now full."""
        counts, room = self.counts, self.capacity - size
        change = 2 * counts[size:] + 1  # a window more at the level reached,
        change[room] = 0  # which does not count if it is full,
        levels = counts[1 : room + 1]
        change[1:] += np.where(levels > 0, 1 - 2 * levels, 1 << 40)  # and one less at the level left
        return self._into(room - int(np.argmin(change[::-1])), piece, size)

    def _into(self, level: int, piece, size: int) -> list | None:
        if level:
            window = self.windows[level].pop()
            self.counts[level] -= 1
            self.open -= 1
        else:
            window = []
        window.append(piece)
        if level + size == self.capacity:
            return window
        self.windows[level + size].append(window)
        self.counts[level + size] += 1
        self.open += 1
        return None

    def least_room(self) -> int:
        """What the fullest open window still takes."""
        return self.capacity - int(np.flatnonzero(self.counts)[-1])

    def top_up(self, piece, size: int) -> list | None:
        """Put a piece that fits into the fullest open window; its pieces if it is now full."""
        level = self.capacity - self.least_room()
        return self._into(level, piece, size)

    def drain(self) -> list:
        """All pieces of open windows, window by window."""
        pieces = [p for level in self.windows for window in level for p in window]
        self.__init__(self.capacity)
        return pieces


def cut_evenly(pieces: list, capacity: int) -> Iterator[list]:
    """Pieces laid end to end and cut into full windows; the rest into windows of a power of two, which need no padding."""
    total = sum(len(p[2]) // 4 for p in pieces)
    sizes = [capacity] * (total // capacity) + [1 << b for b in range(capacity.bit_length(), -1, -1) if total % capacity >> b & 1]
    left, window = iter(sizes), []
    room = next(left, 0)
    for doc, start, ids, tokens in pieces:
        at = 0
        while at < len(ids):
            part = ids[at : at + 4 * room]
            window.append((doc, start + at // 4, part, tokens))
            at += len(part)
            room -= len(part) // 4
            if not room:
                yield window
                window, room = [], next(left, 0)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1, with_ids: bool = False, most_open: int = 256) -> DataFrame:
    """Pieces of all ``docs`` in sequences of at most ``capacity`` tokens, without padding.

    ``tokenizer`` is the path of a ``tokenizers`` file. A document's ids end with ``end_id``; whole windows are cut off long
    documents, and the rest is placed by the sum-of-squares rule. Every partition of the input packs its own documents,
    in one pass without a shuffle, so a lost task is simply packed again. While ``most_open`` windows are open, the fullest takes
    what it has room for off the next document, so that it closes; the others stay as the rule left them. At the end of the
    partition those still open are laid end to end and cut into full ones; what remains fills sequences whose
    length is a power of two. An empty table gives no rows; texts of any length are encoded whole. NULL and empty texts give the end token alone; a NULL id stays NULL; rows that repeat an id
    are packed one by one; other columns are not read. ``with_ids`` adds the piece's ids (``binary``, little-endian, 32 bits).
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_tokenizer(tokenizer))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokens(shared.value)
        state = SumOfSquares(capacity)
        sequence = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []

        def close(window: list) -> None:
            nonlocal sequence
            offset = 0
            for doc, start, ids, tokens in window:
                length = len(ids) // 4
                rows.append((doc, start, length, zlib.crc32(ids), tokens, sequence, offset, *([bytes(ids)] if with_ids else [])))
                offset += length
            sequence += 1

        def out() -> pa.RecordBatch:
            names = FIELDS + ["ids"] * with_ids
            batch = pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if n == "ids" else pa.int64()) for c, n in zip(zip(*rows, strict=True), names, strict=True)], names)
            rows.clear()
            return batch

        for batch in text_slices(batches):
            encoded, ends = words.encode(batch.column("text"), end_id)
            data, begin = memoryview(encoded.tobytes()), 0
            for doc, until in zip(batch.column("doc_id").to_pylist(), ends.tolist(), strict=True):
                ids, tokens, at = data[4 * begin : 4 * until], until - begin, 0
                begin = until
                while tokens - at >= capacity:
                    close([(doc, at, ids[4 * at : 4 * (at + capacity)], tokens)])
                    at += capacity
                while at < tokens and state.open >= most_open:
                    part = min(tokens - at, state.least_room())
                    if full := state.top_up((doc, at, bytes(ids[4 * at : 4 * (at + part)]), tokens), part):
                        close(full)
                    at += part
                if at < tokens and (full := state.place((doc, at, bytes(ids[4 * at :]), tokens), tokens - at)):
                    close(full)
            if rows:
                yield out()
        for window in cut_evenly(state.drain(), capacity):
            close(window)
        if rows:
            yield out()

    return text_table(docs).mapInArrow(scan, PIECE + (", ids binary" if with_ids else ""))
