"""Repeated passages found by level-wise doubling of word windows.

Windows of a first length are counted over the whole corpus. Only where two neighbouring windows both repeat can the window of
twice that length repeat, so each level counts the survivors of the one before, up to the wanted length or until none is left. Texts stay in chunks
of some megabytes; a level ships each distinct window hash of a chunk once, in one binary value a chunk and hash range, and gets a bit
for each back. A passage that many documents share is thus never more than one entry a chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import NO_ID, findable, id_column, join_hashes, partitions_for, stored, text_slices

#: Bytes of text in a chunk, and window hashes in a range, about.
CHUNK_BYTES, RANGE = 2_000_000, 1_000_000
CHUNKS = "chunk long, doc_ids array<long>, sizes array<long>, packed binary"


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def chunks(docs: DataFrame) -> DataFrame:
    """Texts gathered in compressed chunks, each sorted by ``doc_id`` (NULL last) and stored."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0
        squeeze = zstandard.ZstdCompressor(level=3)

        def close():
            order = np.argsort(np.array(ids, np.int64), kind="stable").tolist()
            sizes = pa.array([[len(texts[k]) for k in order]], pa.list_(pa.int64()))
            packed = pa.array([squeeze.compress(b"".join([texts[k] for k in order]))], pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([[ids[k] for k in order]], pa.list_(pa.int64())), sizes, packed], ["chunk", "doc_ids", "sizes", "packed"]
            )

        for batch in text_slices(batches, CHUNK_BYTES):
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                ids.append(doc)
                texts.append(text)
                size += len(text) + 8
                if size >= CHUNK_BYTES:
                    yield close()
                    number, ids, texts, size = number + 1, [], [], 0
        if ids:
            yield close()

    findable(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(int(NO_ID))).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return stored(texts.mapInArrow(gather, CHUNKS), "chunks")


class Windows:
    """All windows of one chunk, at the first length and then at each double, under two 64-bit hashes each.

    The first hash alone picks candidates, as one clash too many only keeps a window a level longer; the last level tells
    word sequences apart by both.
    """

    def __init__(self, doc_ids: list[int], texts: list[bytes], first: int, final: bool):
        data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
        word = ~_SPACE[data]
        begin = np.flatnonzero(word & ~np.r_[False, word[:-1]])
        end = np.flatnonzero(word & ~np.r_[word[1:], False]) + 1
        self.doc_ids, self.length = np.array(doc_ids, np.int64), first
        self.owner = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), begin, side="right")  # document of each word
        self.sizes = np.bincount(self.owner, minlength=len(texts))
        self.ends = np.cumsum(self.sizes)
        # Every distinct word is hashed once; the words lie end to end in one buffer.
        offsets = np.r_[0, np.cumsum(end - begin)].astype(np.int32)
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data[word])]
        coded = pa.Array.from_buffers(pa.binary(), len(begin), buffers).dictionary_encode()
        digests = b"".join(map(xxhash.xxh3_128_digest, coded.dictionary.to_pylist()))
        lanes = np.frombuffer(digests, ">u8").astype(np.uint64).reshape(-1, 2)[coded.indices.to_numpy()]
        self.hash = [lanes[:, 0].copy(), lanes[:, 1] ^ np.uint64(0x5851F42D4C957F2D)]
        for flat, hash_ in zip([h.copy() for h in self.hash], self.hash, strict=True):
            for k in range(1, first):
                hash_[: max(len(flat) - k, 0)] = join_hashes(hash_[: max(len(flat) - k, 0)], flat[k:])
        places = np.arange(len(begin))
        self.places = places[places + first <= self.ends[self.owner]] if len(places) else places
        self._group(final)

    def _group(self, final: bool) -> None:
        """Distinct hashes of the windows still wanted, in order, with the first place and the number of each."""
        lanes = [h[self.places] for h in self.hash[: 1 + final]]
        order = np.lexsort(lanes[::-1])  # keeps places of one hash in order
        new = np.ones(len(order), bool)
        new[1:] = np.any([lane[order][1:] != lane[order][:-1] for lane in lanes], axis=0)
        self.which = np.empty(len(order), np.int64)
        self.which[order] = np.cumsum(new) - 1
        first = order[new]
        self.lanes = [lane[first] for lane in lanes]
        self.distinct = self.lanes[0]
        self.number = np.diff(np.r_[np.flatnonzero(new), len(order)])
        self.least = self.places[first]  # documents are in order, so the first place is the earliest

    def double(self, repeated: np.ndarray, final: bool) -> None:
        """``repeated``: for each distinct hash. Go on with the places whose two halves both repeat."""
        count, k = len(self.owner), self.length
        alive = np.zeros(count + 2 * k, bool)
        alive[self.places[repeated[self.which]]] = True
        p = np.flatnonzero(alive[:count])
        p = p[alive[p + k]]
        p = p[p + 2 * k <= self.ends[self.owner[p]]]
        for lane, old in enumerate(self.hash):
            self.hash[lane] = np.zeros(count, np.uint64)
            self.hash[lane][p] = join_hashes(old[p], old[p + k])
        self.places, self.length = p, 2 * k
        self._group(final)

    def covered(self, first_here: np.ndarray) -> np.ndarray:
        """Words in a window whose sequence starts earlier; ``first_here``: the chunk holds the first of this hash."""
        later = self.places[~(first_here[self.which] & (self.least[self.which] == self.places))]
        marks = np.zeros(len(self.owner) + 1, np.int64)
        np.add.at(marks, later, 1)
        np.add.at(marks, later + self.length, -1)
        return np.cumsum(marks[:-1]) > 0


def bucket_bounds(distinct: np.ndarray, buckets: int) -> np.ndarray:
    """Where each of ``buckets`` even ranges of hashes begins in the sorted ``distinct``."""
    edges = (np.arange(1, buckets, dtype=object) * (1 << 64) // buckets).astype(np.uint64)
    return np.r_[0, np.searchsorted(distinct, edges), len(distinct)]


def _bits(bitsets: list | None, bounds: np.ndarray) -> np.ndarray:
    """The answer for each distinct hash from those of its ranges."""
    out = np.zeros(bounds[-1], bool)
    for entry in bitsets or []:
        b = entry["bucket"]
        out[bounds[b] : bounds[b + 1]] = np.unpackbits(np.frombuffer(entry["bits"], np.uint8), count=int(bounds[b + 1] - bounds[b]), bitorder="little")
    return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[bytes]]]:
    """Chunk by chunk: the small columns, and the texts as UTF-8."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            joined, ends = zstandard.ZstdDecompressor().decompress(row.pop("packed")), np.cumsum(row["sizes"]).tolist()
            yield row, [joined[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def _windows(row: dict, texts: list[bytes], answers: list[str], first: int, buckets: int, final: bool) -> Windows:
    windows = Windows(row["doc_ids"], texts, first, final and not answers)
    for n, name in enumerate(answers, 1):
        windows.double(_bits(row[name], bucket_bounds(windows.distinct, buckets)), final and n == len(answers))
    return windows


def _ship(answers: list[str], first: int, buckets: int, final: bool):
    """Each chunk's distinct windows in hash ranges, with the documents they start in (``final``) or whether they repeat here."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, texts in _rows(batches):
            windows = _windows(row, texts, answers, first, buckets, final)
            bounds = bucket_bounds(windows.distinct, buckets)
            docs, many = windows.doc_ids[windows.owner[windows.least]], windows.number > 1
            use = np.flatnonzero(np.diff(bounds))
            pieces = [slice(bounds[b], bounds[b + 1]) for b in use.tolist()]
            held = [(docs[p] if final else np.packbits(many[p], bitorder="little")).tobytes() for p in pieces]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(use, pa.int32()),
                    pa.array(np.full(len(use), row["chunk"]), pa.int64()),
                    pa.array([b"".join(lane[p].tobytes() for lane in windows.lanes) for p in pieces], pa.binary()),
                    pa.array(held, pa.binary()),
                ],
                ["bucket", "chunk", "hashes", "held"],
            )

    return scan


def _judge(final: bool):
    """For every hash of every chunk in one range: does it repeat; or, for the final length, is this chunk's the first."""

    def judge(table: pa.Table) -> pa.Table:
        lanes = 1 + final
        hashes = [np.frombuffer(h, np.uint64).reshape(lanes, -1) for h in table.column("hashes").to_pylist()]
        sizes = [h.shape[1] for h in hashes]
        every = np.concatenate([h[0] for h in hashes])
        held = table.column("held").to_pylist()
        chunk = np.repeat(table.column("chunk").to_numpy(), sizes)
        yes = np.zeros(len(every), bool)
        if final:
            docs = np.concatenate([np.frombuffer(h, np.int64) for h in held])
            second = np.concatenate([h[1] for h in hashes])
            order = np.lexsort((chunk, docs, second, every))
            yes[order] = np.r_[True, (every[order][1:] != every[order][:-1]) | (second[order][1:] != second[order][:-1])]
        else:
            _, which, number = np.unique(every, return_inverse=True, return_counts=True)
            own = [np.unpackbits(np.frombuffer(h, np.uint8), count=n, bitorder="little") for h, n in zip(held, sizes, strict=True)]
            yes = (number[which] > 1) | np.concatenate(own).astype(bool)
        cuts = np.split(yes, np.cumsum(sizes)[:-1])
        bits = pa.array([np.packbits(c, bitorder="little").tobytes() for c in cuts], pa.binary())
        alive = pa.array([int(c.sum()) for c in cuts], pa.int64())
        return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "bits": bits, "alive": alive})

    return judge


def _finish(answers: list[str], first: int, buckets: int, with_text: bool):
    """Cut the texts. Without ``answers`` no candidate was left, so nothing repeats."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, texts in _rows(batches):
            if answers:
                windows = _windows(row, texts, answers[:-1], first, buckets, True)
                gone = windows.covered(_bits(row[answers[-1]], bucket_bounds(windows.distinct, buckets)))
            begin, count, removed, kept = 0, [], [], []
            for text in texts:
                words = text.split()
                out = gone[begin : begin + len(words)] if answers else np.zeros(len(words), bool)
                count.append(len(words))
                removed.append(int(out.sum()))
                left = [w for w, g in zip(words, out.tolist(), strict=True) if not g] if removed[-1] else words
                kept.append(b" ".join(left))
                begin += len(words)
            columns = [
                pa.array(row["doc_ids"], pa.int64()),
                pa.array(count, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
            ]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                columns.append(pa.array([k.decode() for k in kept]))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(columns, names)

    return scan


def remove_repeats(docs: DataFrame, size: int = 20, first: int = 5, with_text: bool = True) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` and, ``with_text``, ``kept`` (words joined by a space).

    Each word goes that lies in a window of ``size`` words whose word sequence also starts earlier (smaller ``doc_id``, or earlier in the
    same document), judged on the input. ``size`` is ``first`` times a power of two; levels end there, or earlier when no
    candidate survives. Window sequences are compared by 128-bit hashes.
    Rows that repeat an id come one after another in an order of their own; NULL ids come last. NULL, empty and blank
    texts have no words; documents shorter than a window lose nothing; texts of any length are read whole; an empty table
    gives no rows. Other columns are not read.
    """
    levels = (size // first).bit_length() - 1
    if first << levels != size:
        raise ValueError("size must be first times a power of two")
    texts = chunks(docs)
    length = texts.select(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda n, size: n + size))).first()[0] or 0
    buckets = partitions_for(length // 6, RANGE, docs.sparkSession)  # some six bytes a word
    answers: list[str] = []
    known = None  # what the levels so far answered, a row a chunk
    for level in range(levels + 1):
        final = level == levels
        state = texts if known is None else texts.join(known, "chunk", "left")
        blobs = state.mapInArrow(_ship(list(answers), first, buckets, final), "bucket int, chunk long, hashes binary, held binary")
        judged = blobs.groupBy("bucket").applyInArrow(_judge(final), "chunk long, bucket int, bits binary, alive long")
        name = f"level_{level}"
        bits = judged.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits")).alias(name), F.sum("alive").alias(f"alive_{level}"))
        answers.append(name)  # at most one entry a range
        known = stored(bits if known is None else known.join(bits, "chunk", "left"), "answers")
        if not final and not known.agg(F.sum(f"alive_{level}")).first()[0]:
            answers = []
            break
    result = texts.join(known, "chunk", "left").mapInArrow(
        _finish(answers, first, buckets, with_text),
        "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept string" if with_text else ""),
    )
    return result.withColumn("doc_id", id_column())
