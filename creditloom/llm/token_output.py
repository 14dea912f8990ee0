"""Token ids of a corpus in files of wavelet matrices, one matrix a shard, in ascending document order."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creditloom.llm.common import partitions_for, text_slices, text_table
from creditloom.llm.tokens import ID, read_tokenizer, word_tokens

#: Bits between two entries of a plane's rank directory.
STEP = 512
SHARD = (
    "part int, shard int, tokens_before long, n_tokens long, width int, zeros array<long>, planes binary, ranks binary,"
    " doc_ids binary, doc_known binary, doc_ends binary"
)

#: Rows of 16 bytes that may be broadcast.
MOST_BROADCAST = 1_000_000


class WaveletMatrix:
    """Succinct sequence of ids: one plane of bits for each binary digit, highest first.

    Below each plane the ids are reordered: those with bit 0 first, then those with bit 1, both in their order. A directory of
    ones before every ``STEP`` bits gives rank by one look and a short count, and select by binary search.
    """

    def __init__(self, count: int, width: int, zeros: list[int], planes: bytes, ranks: bytes):
        self.count, self.width, self.zeros = count, width, list(zeros)
        self.planes = np.frombuffer(planes, np.uint8).reshape(width, -1)
        self.ranks = np.frombuffer(ranks, "<u4").reshape(width, -1)

    @classmethod
    def build(cls, ids: np.ndarray, width: int) -> WaveletMatrix:
        count = len(ids)
        size = -(-(count + 1) // STEP) * STEP // 8
        planes, ranks, zeros = np.zeros((width, size), np.uint8), np.zeros((width, size * 8 // STEP), "<u4"), []
        for k in range(width):
            bit = (ids & ids.dtype.type(1 << (width - 1 - k))) != 0
            packed = np.packbits(bit, bitorder="little")
            planes[k, : len(packed)] = packed
            ones = np.bitwise_count(planes[k].view(np.uint64)).reshape(-1, STEP // 64).sum(axis=1, dtype=np.int64)
            ranks[k, 1:] = np.cumsum(ones[:-1])
            zeros.append(count - int(ones.sum()))
            ids = np.concatenate([ids[~bit], ids[bit]])
        return cls(count, width, zeros, planes.tobytes(), ranks.tobytes())

    def rank1(self, plane: int, position: int) -> int:
        """Ones before ``position``."""
        block = position // STEP
        bits = np.unpackbits(self.planes[plane, block * STEP // 8 : -(-position // 8)], bitorder="little")
        return int(self.ranks[plane, block]) + int(bits[: position - block * STEP].sum())

    def _select(self, plane: int, bit: int, nth: int) -> int:
        """Position of the ``nth`` (from 0) digit ``bit``."""
        ones = self.ranks[plane].astype(np.int64)
        before = ones if bit else np.arange(len(ones)) * STEP - ones
        block = int(np.searchsorted(before, nth, side="right")) - 1
        bits = np.unpackbits(self.planes[plane, block * STEP // 8 : (block + 1) * STEP // 8], bitorder="little")
        return block * STEP + int(np.flatnonzero(bits == bit)[nth - int(before[block])])

    def access(self, position: int) -> int:
        """The id at ``position``."""
        value = 0
        for k in range(self.width):
            bit = int(self.planes[k, position >> 3]) >> (position & 7) & 1
            ones = self.rank1(k, position)
            position = self.zeros[k] + ones if bit else position - ones
            value = value * 2 + bit
        return value

    def _range(self, symbol: int, end: int) -> tuple[int, int]:
        begin = 0
        for k in range(self.width):
            ones = self.rank1(k, begin), self.rank1(k, end)
            if symbol >> (self.width - 1 - k) & 1:
                begin, end = self.zeros[k] + ones[0], self.zeros[k] + ones[1]
            else:
                begin, end = begin - ones[0], end - ones[1]
        return begin, end

    def rank(self, symbol: int, position: int | None = None) -> int:
        """Occurrences of ``symbol`` before ``position`` (the end)."""
        if symbol >> self.width:
            return 0
        begin, end = self._range(symbol, self.count if position is None else position)
        return end - begin

    def select(self, symbol: int, nth: int) -> int:
        """Position of the ``nth`` (from 0) occurrence of ``symbol``."""
        if not 0 <= nth < self.rank(symbol):
            raise IndexError(nth)
        position = self._range(symbol, self.count)[0] + nth
        for k in reversed(range(self.width)):
            bit = symbol >> (self.width - 1 - k) & 1
            position = self._select(k, bit, position - self.zeros[k] * bit)
        return position

    def decode(self) -> np.ndarray:
        """All ids: the planes are gone through from the lowest, each undoing its reordering."""
        ids = np.zeros(self.count, np.uint16 if self.width <= 16 else ID)
        for k in reversed(range(self.width)):
            bit = np.unpackbits(self.planes[k], count=self.count, bitorder="little").view(bool)
            above = np.empty_like(ids)
            above[~bit] = ids[: self.zeros[k]]
            above[bit] = ids[self.zeros[k] :] | ids.dtype.type(1 << (self.width - 1 - k))
            ids = above
        return ids


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, shard_tokens: int = 1_000_000, docs_per_partition: int = 20_000) -> None:
    """Write the ids of all ``docs``, each document followed by ``end_id``, to ``path``.

    Documents are dealt out by ranges of ``doc_id`` and sorted within; NULL ids come first, rows that repeat an id
    stand next to each other. Files are Parquet with one row a shard: the wavelet matrix over about ``shard_tokens`` ids (a
    document is never divided) and the documents' ids and ends. NULL and empty texts are the end token alone. Other
    columns are not read. An empty table gives a readable path without shards.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(read_tokenizer(tokenizer))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokens(shared.value)
        width = max(words.tokenizer.get_vocab_size() - 1, end_id).bit_length()
        part, shard, before = TaskContext.get().partitionId(), 0, 0
        held_ids: list[np.ndarray] = []
        held_docs: list[int | None] = []
        held = 0

        def close() -> pa.RecordBatch:
            nonlocal shard, before, held
            sizes = [len(x) for x in held_ids]
            ids = np.concatenate(held_ids)
            matrix = WaveletMatrix.build(ids.astype(np.uint16) if width <= 16 else ids, width)
            values = {
                "part": part, "shard": shard, "tokens_before": before, "n_tokens": len(ids), "width": width, "zeros": matrix.zeros,
                "planes": matrix.planes.tobytes(), "ranks": matrix.ranks.tobytes(),
                "doc_ids": np.array([d or 0 for d in held_docs], "<i8").tobytes(),
                "doc_known": np.array([d is not None for d in held_docs], bool).tobytes(),
                "doc_ends": np.cumsum(sizes).astype("<i8").tobytes(),
            }
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64())] + [pa.binary()] * 5
            before, shard, held = before + len(ids), shard + 1, 0
            held_ids.clear()
            held_docs.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values.values(), kinds, strict=True)], list(values))

        for batch in text_slices(batches):
            encoded, ends = words.encode(batch.column("text"), end_id)
            begin = 0
            for doc, until in zip(batch.column("doc_id").to_pylist(), ends.tolist(), strict=True):
                held_ids.append(encoded[begin:until])
                held_docs.append(doc)
                held += until - begin
                begin = until
                if held >= shard_tokens:
                    yield close()
        if held:
            yield close()

    ranges = partitions_for(docs.count(), docs_per_partition, spark)
    text_table(docs).repartitionByRange(ranges, "doc_id").sortWithinPartitions("doc_id").mapInArrow(scan, SHARD).write.parquet(path)


def shard_matrix(row) -> WaveletMatrix:
    """The matrix of one row of the files (a ``Row`` with the columns of ``SHARD``): access, counting and lookup without decoding."""
    return WaveletMatrix(row["n_tokens"], row["width"], row["zeros"], row["planes"], row["ranks"])


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Per document, from the files at ``path``: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``,
    ``ids_crc32`` (of the ids as little-endian 32 bits) and, with ``with_ids``, the ids themselves."""
    files = spark.read.parquet(path)
    # One short row for each partition that wrote; they meet the shards by broadcast as long as they are few.
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = totals.select("part", F.coalesce(before, F.lit(0)).alias("part_start"))
    files = files.join(F.broadcast(starts) if totals.count() <= MOST_BROADCAST else starts, "part")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (r for k in range(batch.num_rows) for r in batch.slice(k, 1).to_pylist()):
                ids = shard_matrix(row).decode().astype(ID)
                data = memoryview(ids.tobytes())
                ends = np.frombuffer(row["doc_ends"], "<i8")
                begins = np.r_[0, ends[:-1]]
                cuts = [data[4 * b : 4 * e] for b, e in zip(begins.tolist(), ends.tolist(), strict=True)]
                doc = pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=~np.frombuffer(row["doc_known"], bool))
                first = row["part_start"] + row["tokens_before"]
                columns = [doc, pa.array(first + begins), pa.array(ends - begins), pa.array([zlib.crc32(c) for c in cuts], pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array([np.frombuffer(c, ID) for c in cuts], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return files.mapInArrow(scan, "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else ""))
