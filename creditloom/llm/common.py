"""What the corpus operators share: text batches, word hashes, stored intermediate tables, connected components."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.plans.tables import scratch_path

#: A document without an id sorts after all others.
NO_ID = np.iinfo(np.int64).max

HOME = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the files, so that lost executors never reach further back."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def findable(spark: SparkSession) -> None:
    """Let Python workers that share this machine's files import this package (elsewhere it is installed or sent along)."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if HOME not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [HOME, known]))


def text_hash(text: str | Column = "text") -> Column:
    """Tells rows apart that repeat a document id."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def text_table(docs: DataFrame, *more: Column) -> DataFrame:
    """``doc_id`` (long), ``text`` (NULL: empty) and ``more``; other columns, whatever their names, stay out."""
    findable(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *more
    )


def partitions_for(rows: int, per_partition: int, spark: SparkSession) -> int:
    """As many partitions as keep each near ``per_partition`` rows, and no fewer than the session's default."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_partition))


def text_slices(batches: Iterator[pa.RecordBatch], size: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``size`` bytes of text (one longer text makes a slice alone)."""
    for batch in batches:
        total = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, before + size, side="right")))
            yield batch.slice(start, end - start)
            start = end


def doc_ids(batch: pa.RecordBatch) -> np.ndarray:
    """Ids as int64; NULL becomes ``NO_ID``."""
    return pc.fill_null(batch.column("doc_id"), NO_ID).to_numpy(zero_copy_only=False)


def id_column(name: str = "doc_id") -> Column:
    """Back from ``NO_ID`` to NULL."""
    return F.when(F.col(name) != F.lit(int(NO_ID)), F.col(name))


class WordHashes(dict):
    """64-bit hash of each word, remembered up to ``most`` words."""

    def __init__(self, most: int = 400_000, seed: int = 42):
        super().__init__()
        self.most, self.seed = most, seed

    def __missing__(self, word: str | bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, self.seed)
        return value

    def of(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (SplitMix64's finisher; its constants are fixed values)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def join_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a window from those of its two halves, in this order."""
    return mix(left * np.uint64(0x9E3779B97F4A7C15) + right)


#: Bits of a :func:`hash_bitmap`: 8 MB at every size of the data.
BITMAP_BITS = 26


def hash_bitmap(hashes: DataFrame, column: str) -> np.ndarray:
    """Which top ``BITMAP_BITS`` bits occur among 64-bit hashes, as one bitmap of a fixed size.

    For keeping most rows without a partner out of a shuffle; it only ever lets too many through.
    """
    top = F.shiftrightunsigned(column, 64 - BITMAP_BITS)
    parts = hashes.select(F.shiftrightunsigned(top, 15).alias("part"), (top % 32768).alias("bit"))
    parts = parts.groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).repartition(32)
    whole = np.zeros((1 << BITMAP_BITS) // 8, np.uint8)
    for row in parts.toLocalIterator():  # at most 2^BITMAP_BITS / 2^15 rows of 4 KB
        whole[row["part"] * 4096 : (row["part"] + 1) * 4096] = np.frombuffer(row["bits"], np.uint8)
    return whole


def in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = hashes.view(np.uint64) >> np.uint64(64 - BITMAP_BITS)
    return (bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1


def roots(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest member of each element's component under links ``left[i]`` - ``right[i]``."""
    root = np.arange(count)
    while len(left):
        a, b = root[left], root[right]
        apart = a != b
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            deeper = root[root]
            if np.array_equal(deeper, root):
                break
            root = deeper
    return root


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node it is connected with) for every node of ``edges`` (``a``, ``b``: long).

    Alternates two star contractions until no edge changes: each node first hands its larger neighbours to the smallest
    one it knows, then its smaller neighbours. The number of rounds grows with the logarithm of the number of nodes.
    Every round is stored in the shared folder; only counts and checksums reach the driver.
    """

    def sign(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.expr("bit_xor(xxhash64(b, a, 1))")).first())

    now = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    before, after = None, sign(now)
    while before != after:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stored(small.unionByName(least.withColumnRenamed("m", "b")).distinct(), "edges")
        before, after = after, sign(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
