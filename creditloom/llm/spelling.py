"""Spelling variants grouped through a reduced alphabet.

Every letter is hashed to one of a few symbols. The full one-edit neighbourhood of each distinct reduced word (itself, deletions,
replacements, insertions) is generated as 64-bit hashes and joined with the reduced vocabulary; what meets is verified on the
original strings. One edit of a word is at most one edit of its reduced word, so no pair is lost, and a hash that clashes only adds a
candidate. A neighbourhood takes time and rows in proportion to its word's length, whatever that is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import findable, mix, stored

#: Symbols of the reduced alphabet; bits of the bitmap that keeps neighbours without any word out of the shuffle (8 MB at every size).
SYMBOLS, FILTER_BITS = 8, 26
#: Hashes that a task holds at a time, about.
BLOCK = 2_000_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_A = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
_A_INVERSE = np.uint64(pow(_A, -1, 1 << 64))
_LENGTH = 0xC2B2AE3D27D4EB4F


def occurring_words(docs: DataFrame, shortest: int, least: int, spoil: int | None) -> DataFrame:
    """``word`` and ``n`` of the words of whole texts that have ``shortest`` code points and ``least`` occurrences."""
    folded = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
        F.explode(F.regexp_extract_all(folded, F.lit("[a-zÀ-ÿ]+"), 0)).alias("run"),
    )
    word = F.col("run")
    if spoil:
        h = F.crc32(F.concat_ws(":", "doc", "run"))
        at = F.pmod(h, F.length("run")).cast("int")
        less = F.concat(F.expr("substring(run, 1, at)"), F.expr("substring(run, at + 2)"))
        runs = runs.withColumns({"h": h, "at": at})
        word = F.when(F.col("h") % spoil == 0, less).otherwise(word)
    counted = runs.select(word.alias("word")).where(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= least)


class Reduced:
    """Hashes of equally long reduced words and of their one-edit neighbours.

    A reduced word s has the hash of the sum of (s[i] + 1) * A^i, so every edit is a few products of prefix sums.
    """

    def __init__(self, words: list[str], symbols: int):
        length = len(words[0])
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), length)
        spread = (points.astype(np.uint64) * np.uint64(2654435761)) >> np.uint64(16) & np.uint64(0xFFFF)
        self.s = spread % np.uint64(symbols)
        self.length, self.symbols = length, symbols
        self.powers = np.full(length + 1, _A, np.uint64)
        self.powers[0] = 1
        self.powers = np.cumprod(self.powers)
        self.before = np.zeros((len(words), length + 1), np.uint64)
        np.cumsum((self.s + np.uint64(1)) * self.powers[:-1], axis=1, out=self.before[:, 1:])
        self.all = self.before[:, -1:]

    @staticmethod
    def close(sums: np.ndarray, length: int) -> np.ndarray:
        return mix(sums + np.uint64(length * _LENGTH % (1 << 64)))

    def own(self) -> np.ndarray:
        return self.close(self.all[:, 0], self.length)

    def neighbours(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Row and hash of the words themselves and of every different string one edit away, in blocks of positions."""
        one, rows = np.uint64(1), np.arange(len(self.s))
        yield rows, self.own()
        step = max(1, BLOCK // (len(rows) * self.symbols))
        for lo in range(0, self.length + 1, step):
            hi = min(self.length, lo + step)
            s, p, before, after = self.s[:, lo:hi], self.powers[lo:hi], self.before[:, lo:hi], self.before[:, lo + 1 : hi + 1]
            # A run of one symbol loses that symbol once, at its end.
            last = np.ones(s.shape, bool)
            here = min(hi, self.length - 1)
            last[:, : here - lo] = self.s[:, lo:here] != self.s[:, lo + 1 : here + 1]
            at, i = np.nonzero(last)
            yield at, self.close(before[at, i] + (self.all[at, 0] - after[at, i]) * _A_INVERSE, self.length - 1)
            for c in np.arange(self.symbols, dtype=np.uint64):
                at, i = np.nonzero(s != c)
                changed = self.all[at, 0] + (c - s[at, i]) * p[i]
                yield at, self.close(changed, self.length)
                # Put before its like it would be the same as put behind it.
                yield at, self.close(before[at, i] + (c + one) * p[i] + (self.all[at, 0] - before[at, i]) * np.uint64(_A), self.length + 1)
                if lo + step > self.length:
                    yield rows, self.close(self.all[:, 0] + (c + one) * self.powers[-1:], self.length + 1)


def by_length(words: list[str], symbols: int) -> Iterator[tuple[np.ndarray, Reduced]]:
    """Places of equally long words, in blocks that keep a neighbourhood near ``BLOCK`` hashes, and their reduced form."""
    lengths = np.array([len(w) for w in words])
    for length in np.unique(lengths).tolist():
        places = np.flatnonzero(lengths == length)
        count = max(1, BLOCK // ((length + 1) * symbols))
        for at in range(0, len(places), count):
            some = places[at : at + count]
            yield some, Reduced([words[k] for k in some.tolist()], symbols)


def _hashes(symbols: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").to_pylist()
            hashes = np.zeros(len(words), np.uint64)
            for places, reduced in by_length(words, symbols):
                hashes[places] = reduced.own()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hashes.view(np.int64))], [*batch.schema.names, "r"])

    return scan


def _neighbours(symbols: int, bits):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present, shift = bits.value, np.uint64(64 - FILTER_BITS)
        for batch in batches:
            words, own = batch.column("word").to_pylist(), batch.column("r").to_numpy()
            for places, reduced in by_length(words, symbols):
                for at, hashes in reduced.neighbours():
                    bit = hashes >> shift
                    found = (present[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own[places[at[found]]]), pa.array(hashes[found].view(np.int64))], ["r", "q"]
                    )

    return scan


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """The top bits of all hashes as one bitmap of a fixed size."""
    bit = F.shiftrightunsigned("r", 64 - FILTER_BITS)
    parts = hashes.groupBy(F.expr(f"shiftrightunsigned(r, {64 - FILTER_BITS}) div 32768").alias("part")).agg(
        F.bitmap_construct_agg(bit % 32768).alias("bits")
    )
    whole = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for row in parts.toLocalIterator():  # at most 2^FILTER_BITS / 2^15 rows of 4 KB
        whole[row["part"] * 4096 : (row["part"] + 1) * 4096] = np.frombuffer(row["bits"], np.uint8)
    return whole


def near_words(vocabulary: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """``word``, ``n``, ``other``, ``other_n`` for all ordered pairs of ``vocabulary`` (``word``, ``n``) exactly one edit apart."""
    spark = vocabulary.sparkSession
    findable(spark)
    hashed = stored(vocabulary.select("word", "n").mapInArrow(_hashes(symbols), "word string, n long, r long"), "vocabulary")
    distinct = stored(hashed.groupBy("r").agg(F.min("word").alias("word")), "reduced")
    bits = spark.sparkContext.broadcast(_bitmap(distinct))
    wide = distinct.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "r")  # each row grows a hundredfold
    grown = wide.mapInArrow(_neighbours(symbols, bits), "r long, q long")
    meet = stored(grown.join(distinct.select(F.col("r").alias("q")), "q").distinct(), "meet")
    left = hashed.select("r", "word", "n")
    right = hashed.select(F.col("r").alias("q"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    pairs = meet.join(left, "r").join(right, "q").where(F.col("word") != F.col("other"))
    return pairs.where(F.levenshtein("word", "other", 1) == 1).select("word", "n", "other", "other_n")


def follow(links: DataFrame) -> DataFrame:
    """``word`` and ``root``, the last word reached from it, for ``links`` (``word``, ``form``) without circles.

    Each round doubles the way that every word has gone, and is stored; the rounds number the logarithm of the longest way.
    """
    now = stored(links.select("word", F.col("form").alias("root")), "forms")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = now.join(further, "root", "left")
        now = stored(jumped.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms")
        if not now.where("moved").limit(1).count():
            return now.select("word", "root")


def spelling_variants(docs: DataFrame, shortest: int = 5, least: int = 3, factor: int = 2, spoil: int | None = None, symbols: int = SYMBOLS) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of every word of the whole corpus.

    Words are runs of ``[A-Za-zÀ-ÿ]``, A-Z lower-cased, of at least ``shortest`` code points and ``least`` occurrences ``n``. Near words
    differ by exactly one inserted, deleted or replaced code point; ``form`` is the near word of the largest ``n`` (ties: smallest
    in code-point order) if that is at least ``factor`` times the word's, else NULL; ``root`` follows forms to the last word.
    ``spoil`` plants variants: a run whose crc32 of ``<doc_id>:<run>`` it divides loses one code point.

    NULL and empty texts have no words, a NULL id counts as an empty one there; rows that repeat an id or a text count again;
    runs of any length are whole words; an empty table gives no rows; only ``doc_id`` and ``text`` are read.
    """
    words = stored(occurring_words(docs, shortest, least, spoil), "words")
    near = near_words(words, symbols)
    best = near.groupBy("word", "n").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("other"))).alias("best")
    )
    form_n = -F.col("best.less")
    chosen = form_n >= factor * F.col("n")
    found = stored(
        best.select("word", F.when(chosen, F.col("best.other")).alias("form"), "n_near", F.when(chosen, form_n).alias("form_n")), "near"
    )
    roots = follow(found.where("form IS NOT NULL"))
    return (
        words.join(found, "word", "left")
        .join(roots, "word", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
    )
