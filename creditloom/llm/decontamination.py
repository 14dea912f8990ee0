"""Benchmark items inside documents: containment search over size-partitioned MinHash sketches, verified exactly.

Items are partitioned by their number of distinct shingles. An item of a partition whose largest item has ``n`` shingles is
sketched by its ``floor((1 - threshold) * n) + 1`` smallest shingle hashes. A document that contains at least ``threshold`` of the item's
shingles misses fewer of them than the sketch holds, so it has at least one hash of the sketch: the search loses nothing,
however much longer the document is. What it finds is verified by exact shingle containment.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import WordHashes, findable, mix, stored, text_hash, text_slices, text_table

SHINGLE, THRESHOLD = 5, 0.8
#: Bytes of item text that one pass over the documents takes; more items are searched for block by block.
BLOCK_BYTES = 16_000_000
WORD = re.compile(r"[^\W_]+")
HIT = "doc_id long, th long, item_id long, item_row long, n_shared long, n_item long"


def words_of(text: str) -> list[str]:
    """Runs of letters and digits in lower case."""
    return WORD.findall(text.lower())


def shingle_texts(words: list[str], size: int) -> list[str]:
    """All word shingles; fewer words give the whole sequence, none give none."""
    return [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words (of all words, if fewer) from the words' hashes."""
    size = min(size, len(hashes))
    return shingles_at(hashes, np.arange(len(hashes) - size + 1), size)


def shingles_at(hashes: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(len(places), np.uint64)
    for k in range(size):
        out = mix(out * np.uint64(31) + hashes[places + k])
    return out


class ItemIndex:
    """Sketches of one block of items, and the items' shingles for verification."""

    def __init__(self, items: list[tuple[int, int, str]], size: int, threshold: float):
        """``items``: row number, id, text."""
        self.size, self.threshold = size, threshold
        words, hashes = {}, WordHashes()
        self.shingles: dict[int, set[str]] = {}
        self.ids = {}
        for row, item, text in items:
            if words_ := words_of(text):
                words[row] = words_
                self.ids[row] = item
                self.shingles[row] = set(shingle_texts(words_, size))
        by_size = defaultdict(list)
        for row, shingles in self.shingles.items():
            by_size[len(shingles).bit_length()].append(row)  # sizes from 2^k to 2^(k+1) - 1
        self.rows_of = defaultdict(list)
        for rows in by_size.values():
            largest = max(len(self.shingles[row]) for row in rows)
            sketch = math.floor((1 - threshold) * largest + 1e-9) + 1
            for row in rows:
                own = np.maximum(hashes.of(words[row]), np.uint64(1))  # 0 stands for words of no item
                for h in np.unique(shingle_hashes(own, size))[:sketch].tolist():
                    self.rows_of[h].append(row)
        self.keys = np.array(sorted(self.rows_of), np.uint64)
        self.shift = np.uint64(64 - max(12, min(26, len(self.keys).bit_length() + 6)))
        self.seen = np.zeros(1 << (64 - int(self.shift)), bool)
        self.seen[self.keys >> self.shift] = True
        self.shorter = any(len(w) < size for w in words.values())
        #: Hash of every word of an item; a shingle with any other word is in no item.
        self.hash_of = {w: hashes[w] or 1 for words_ in words.values() for w in words_}

    def search(self, words: list[str]) -> list[tuple[int, int, int, int]]:
        """Item id, row, shared and own shingles of every item contained in the document."""
        hashes = np.fromiter(map(self.hash_of.get, words, repeat(0)), np.uint64, count=len(words))
        known = np.r_[0, np.cumsum(hashes != 0)]
        found = np.empty(0, np.uint64)
        for size in range(1 if self.shorter else self.size, self.size + 1):  # items of fewer words are one shorter shingle
            places = np.flatnonzero(known[size:] - known[:-size] == size)
            if len(places):
                own = shingles_at(hashes, places, size)
                own = own[self.seen[own >> self.shift]]
                found = np.r_[found, own[np.isin(own, self.keys)]]
        if not len(found):
            return []
        candidates = {row for h in np.unique(found).tolist() for row in self.rows_of[h]}
        own = set()
        for size in {min(self.size, s.count(" ") + 1) for row in candidates for s in [next(iter(self.shingles[row]))]}:
            own.update(shingle_texts(words, size) if len(words) >= size else [])
        out = []
        for row in candidates:
            shared = len(own & self.shingles[row])
            if shared >= self.threshold * len(self.shingles[row]) - 1e-9:
                out.append((self.ids[row], row, shared, len(self.shingles[row])))
        return out


def _blocks(items: DataFrame) -> Iterator[list]:
    """The items in blocks of a bounded number of bytes, one after another through the driver."""
    numbered = stored(
        items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "items",
    )
    block, size = [], 0
    for row in numbered.toLocalIterator():
        block.append((row["row"], row["item_id"], row["text"]))
        size += len(row["text"])
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def contained_items(docs: DataFrame, items: DataFrame, shingle: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs of a document and an item of which it contains at least ``threshold`` of the distinct word shingles.

    Columns: ``doc_id``, ``th`` (text hash of the row), ``item_id``, ``item_row``, ``n_shared``, ``n_item``. Words are runs of
    letters and digits in lower case; an item of fewer words than a shingle is one shorter shingle; NULL, empty
    and wordless items and documents match nothing. Items that repeat an id or a text each give their pairs. Items are a stated
    query set: they are read in blocks of bounded size, each searched in all whole documents without a shuffle.
    """
    spark = docs.sparkSession
    findable(spark)
    texts = text_table(docs, text_hash().alias("th"))

    def search(shared):
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in text_slices(batches):
                rows = []
                for doc, th, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "th", "text")), strict=True):
                    rows += [(doc, th, *hit) for hit in shared.value.search(words_of(text))]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], [f.split()[0] for f in HIT.split(", ")])

        return scan

    out = None
    for block in _blocks(items):
        hits = texts.mapInArrow(search(spark.sparkContext.broadcast(ItemIndex(block, shingle, threshold))), HIT)
        out = hits if out is None else out.unionByName(hits)
    return spark.createDataFrame([], HIT) if out is None else out


def drop_contaminated(docs: DataFrame, items: DataFrame, shingle: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that contain an item; rows and columns of the others are unchanged."""
    hits = stored(contained_items(docs, items, shingle, threshold).select("doc_id", "th").distinct(), "contaminated")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    held = docs.select(row, F.col("doc_id").cast("long").alias("i"), text_hash().alias("t"))
    hits = hits.select(F.col("doc_id").alias("hi"), F.col("th").alias("ht"))
    return held.join(hits, F.col("i").eqNullSafe(F.col("hi")) & (F.col("t") == F.col("ht")), "left_anti").select("row.*")


#: DuckDB: every shared shingle counted, without a search.
ORACLE = """
WITH w AS (
  SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS words FROM documents
  UNION ALL SELECT 'i', item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') FROM benchmark),
s AS (
  SELECT DISTINCT kind, id, array_to_string(words[k : k + 4], ' ') AS shingle
  FROM (SELECT kind, id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS k FROM w WHERE len(words) > 0)),
n AS (SELECT id, count(*) AS n_item FROM s WHERE kind = 'i' GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared, any_value(n_item) AS n_item
FROM s d JOIN s i ON d.kind = 'd' AND i.kind = 'i' AND d.shingle = i.shingle JOIN n ON n.id = i.id
GROUP BY d.id, i.id HAVING count(*) >= 0.8 * any_value(n_item) - 1e-9
"""
