"""Byte strings that repeat anywhere in the corpus, found in suffix arrays and removed.

Equal windows of ``size`` bytes have equal content, so both choose the same anchor: the least hash among their strings of ``k`` bytes, the
leftmost if tied. Runs of windows that share an anchor are segments; all segments of one anchor meet in one shard, whose suffix array
(see ``suffix_array``) brings equal windows next to each other. Before that, exact copies of a segment are counted
and become one segment with a weight, and anchors seen once are dropped; a text is thus sorted only where something may repeat.
An anchor whose different segments are too many for one task is narrowed instead: windows of a block of offsets share a core, and
blocks are halved and halved again wherever their core repeats, down to single windows.

Texts travel in compressed chunks; a chunk is the unit of every join with texts.
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

from creditloom.llm.common import findable, hash_bitmap, in_bitmap, mix, stored
from creditloom.llm.suffix_array import suffix_array

#: Bytes of text in a chunk, in a piece whose anchors are found at a time, in a shard, in the part of a shard that is sorted at a time,
#: and of one anchor's segments in a shard at most.
CHUNK, PIECE, SHARD, PART, MOST = 1 << 19, 1 << 20, 1 << 19, 1 << 15, 1 << 20
#: Widths of the blocks of windows when an anchor is narrowed.
WIDTHS = (32, 4, 1)

_STEP = 0x9E3779B97F4A7C15


def window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` bytes (a power of two) from each place on."""
    h, length = data.astype(np.uint64) + np.uint64(1), 1
    while length < width:
        h = mix(h[:-length] * np.uint64(_STEP * (2 * length + 1) % (1 << 64)) + h[length:])
        length *= 2
    return h


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    length = 1
    while length * 2 <= width:
        x = np.minimum(x[:-length], x[length:])
        length *= 2
    return np.minimum(x[: -(width - length)], x[width - length :]) if width > length else x


def segments(data: np.ndarray, ends: np.ndarray, size: int, k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Start, number of windows, place of the anchor behind the start, and the anchor's hash, for each run of windows with one anchor.

    ``ends``: where each document of ``data`` ends. Windows lie in one document. Found piece by piece; a run ends with its piece.
    """
    for lo in range(0, len(data), PIECE):
        part = data[lo : lo + PIECE + size - 1]
        if len(part) < size:
            return
        h = window_hashes(part, k)
        bits = np.uint64(max(20, int(len(h)).bit_length()))
        at = (h >> bits << bits) | np.arange(len(h), dtype=np.uint64)
        least = sliding_least(at, size - k + 1)
        place = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        x = np.arange(lo, lo + len(place))
        owner = np.searchsorted(ends, x, side="right")
        good = np.flatnonzero(x <= (ends - size)[owner])
        if not len(good):
            continue
        first = np.r_[True, (place[good][1:] != place[good][:-1]) | (owner[good][1:] != owner[good][:-1]) | (np.diff(good) > 1)]
        begin = np.flatnonzero(first)
        count = np.diff(np.r_[begin, len(good)])
        start = good[begin]
        yield start + lo, count, place[start] - start, h[place[start]]


def _describe(size: int, k: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, texts, held = TaskContext.get().partitionId() << 33, [], [], 0
        squeeze = zstandard.ZstdCompressor(level=3)

        def close() -> pa.RecordBatch:
            joined = b"".join(texts)
            sizes = np.array([len(t) for t in texts], np.int64)
            columns: list[list[np.ndarray]] = [[], [], [], [], []]
            for start, count, at, key in segments(np.frombuffer(joined, np.uint8), np.cumsum(sizes), size, k):
                cut = zip(start.tolist(), (start + count + size - 1).tolist(), strict=True)
                digest = np.frombuffer(b"".join([xxhash.xxh3_64_digest(joined[a:b]) for a, b in cut]), ">i8").astype(np.int64)
                for column, part in zip(columns, (key.view(np.int64), digest, count, at, start), strict=True):
                    column.append(part)
            names = ["key", "digest", "count", "at", "start"]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
            flat = [pa.array(np.concatenate(c) if c else [], t) for c, t in zip(columns, kinds, strict=True)]
            found = pa.ListArray.from_arrays(pa.array([0, len(flat[0])], pa.int32()), pa.StructArray.from_arrays(flat, names))
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([ids], pa.list_(pa.int64())), pa.array([sizes.tolist()], pa.list_(pa.int64())), pa.array([squeeze.compress(joined)], pa.binary()), found],
                ["chunk", "doc_ids", "sizes", "packed", "anchors"],
            )

        for batch in batches:
            for doc, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                ids.append(doc.as_py())
                texts.append(text.as_buffer().to_pybytes())
                held += len(texts[-1])
                if held >= CHUNK or len(ids) >= 10_000:
                    yield close()
                    number, ids, texts, held = number + 1, [], [], 0
        if ids:
            yield close()

    return scan


def _unpack(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def _cut(size: int):
    """The segments wanted of each chunk, with their text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "weight", "size", "start", "count", "at"]
        for batch in batches:
            for k in range(batch.num_rows):
                text, chunk = _unpack(batch.column("packed")[k].as_py()), batch.column("chunk")[k].as_py()
                wanted = batch.column("wanted")[k].values
                columns = [wanted.field(n) for n in names]
                cut = zip(columns[3].to_pylist(), columns[4].to_pylist(), strict=True)
                pieces = pa.array([text[a : a + n + size - 1] for a, n in cut], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pieces), chunk)), *columns, pieces], ["chunk", *names, "bytes"])

    return scan


SEGMENT = "chunk long, key long, weight long, size long, start int, count int, at int, bytes binary"
MARK = "chunk long, lo long, hi long"


def runs(places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the maximal runs that windows at the ascending ``places`` cover."""
    apart = np.r_[True, places[1:] > places[:-1] + size]
    begin = np.flatnonzero(apart)
    return places[begin], places[np.r_[begin[1:] - 1, len(places) - 1]] + size


def shared_core(texts: list[np.ndarray], counts: np.ndarray, at: np.ndarray, size: int, k: int) -> tuple[int, int]:
    """How far before and behind their anchors' places all ``texts`` are alike, within what every window of every one holds.

    (0, 0) if not even the ``k`` bytes of the anchor are alike (two anchors of one hash).
    """
    least, most = int((at - counts).min()) + 1, int(at.max())  # windows start so many bytes before the anchor
    rows = np.stack([t[a - least : a + size - most] for t, a in zip(texts, at.tolist(), strict=True)])
    alike = (rows == rows[0]).all(axis=0)
    if not alike[least : least + k].all():
        return 0, 0
    differ = np.flatnonzero(~alike)
    before, behind = differ[differ < least], differ[differ >= least]
    return least - (int(before[-1]) + 1 if len(before) else 0), (int(behind[0]) if len(behind) else len(alike)) - least


def repeated_windows(
    texts: list[bytes], keys: np.ndarray, counts: np.ndarray, at: np.ndarray, weights: np.ndarray, size: int, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Segment and offset of every window that starts at two places at least: in two segments, or in one of weight two or more.

    What all segments of an anchor share around it is one symbol in the text that is sorted.
    """
    data = [np.frombuffer(t, np.uint8) for t in texts]
    parts, owner, begin, length, core = [], [], [], 0, 256
    for same in np.split(np.arange(len(keys)), np.flatnonzero(np.diff(keys)) + 1):
        before, behind = shared_core([data[i] for i in same], counts[same], at[same], size, k)
        core += 1
        for i in same.tolist():
            t = data[i] + np.int64(2)
            if behind:
                t = np.concatenate([t[: at[i] - before], [core + 2], t[at[i] + behind :]])
            of = np.full(len(t) + 1, -1)
            of[: counts[i]] = i
            begin.append(length)
            length += len(of)
            parts += [t, [1]]  # 1: between segments
            owner.append(of)
    symbols, own, first = np.concatenate([*parts, [0]]), np.concatenate([*owner, [-1]]), np.array(begin)
    order = suffix_array(symbols)
    order = order[own[order] >= 0]  # windows alone, still in order
    segment = own[order]
    offset = order - first[segment]
    sizes = np.array([len(t) for t in texts])
    start = (np.cumsum(sizes) - sizes)[segment] + offset
    eight = np.ndarray((int(sizes.sum()) + 1,), "<u8", b"".join([*texts, bytes(8)]), strides=(1,))
    same = np.arange(len(order) - 1)
    for step in [*range(0, size - 7, 8), size - 8]:
        same = same[eight[start[same] + step] == eight[start[same + 1] + step]]
    new = np.ones(len(order), bool)
    new[same + 1] = False
    which = np.cumsum(new) - 1
    again = np.bincount(which, weights[segment])[which] >= 2
    return segment[again], offset[again]


def _sort(size: int, k: int):
    """Suffix arrays of one shard: where the segments that occur once hold windows that occur again.

    A shard is sorted in parts of whole anchors: lists that fit a processor's cache are sorted in half the time.
    """

    def judge(table: pa.Table) -> pa.Table:
        table = table.sort_by("key")
        names = ("key", "count", "at", "weight", "chunk", "start")
        keys, counts, at, weights, chunk, start = (table.column(n).to_numpy() for n in names)
        texts = table.column("bytes").to_pylist()
        sizes = np.array([len(t) for t in texts])
        new = np.flatnonzero(np.diff(keys)) + 1
        cuts = new[np.flatnonzero(np.diff(np.cumsum(sizes)[new - 1] // PART)) + 1] if len(new) else new
        found: list[tuple[np.ndarray, ...]] = []
        for rows in np.split(np.arange(len(keys)), cuts):
            lo, hi = rows[0], rows[-1] + 1
            segment, offset = repeated_windows(texts[lo:hi], keys[rows], counts[rows], at[rows], weights[rows], size, k)
            segment = segment + lo
            lone = weights[segment] == 1
            segment, offset = segment[lone], offset[lone]
            order = np.lexsort((offset, segment))
            segment, offset = segment[order], offset[order]
            for some in np.split(np.arange(len(segment)), np.flatnonzero(np.diff(segment)) + 1):
                if len(some):
                    i = segment[some[0]]
                    lo, hi = runs(offset[some], size)
                    found.append((np.full(len(lo), chunk[i]), lo + start[i], hi + start[i]))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.empty(0, np.int64)] * 3
        return pa.table(dict(zip(("chunk", "lo", "hi"), columns, strict=True)))

    return judge


def _blocks(size: int, width: int, wider: int | None):
    """Blocks of ``width`` windows of segments that are narrowed, with a hash of what all windows of the block have in common.

    A window's block follows from its anchor's place in it, so equal windows are in equal blocks. Only blocks inside one of the ``alive``
    blocks of ``wider`` windows are listed.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.select(["row", "key", "weight", "count", "at", *(["alive"] if wider else []), "bytes"]).to_pylist()
            for r in rows:
                # Window x has its anchor at - x behind its start.
                some = range((r["at"] - r["count"] + 1) // width, r["at"] // width + 1)
                if wider:
                    alive = set(r["alive"])
                    some = [b for b in some if b * width // wider in alive]
                cores = [r["bytes"][max(0, r["at"] - b * width) : r["at"] - (b + 1) * width + 1 + size] for b in some]
                seeds = r["key"] & ((1 << 64) - 1)
                h = [xxhash.xxh3_128_digest(c + b.to_bytes(4, "big") + seeds.to_bytes(8, "big")) for b, c in zip(some, cores, strict=True)]
                h = np.frombuffer(b"".join(h), ">i8").astype(np.int64).reshape(-1, 2)
                n = len(h)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, r["row"])), pa.array(np.full(n, r["weight"])), pa.array(some, pa.int64()), pa.array(h[:, 0]), pa.array(h[:, 1])],
                    ["row", "weight", "block", "h1", "h2"],
                )

    return scan


def narrowed(wide: DataFrame, size: int) -> DataFrame:
    """``MARK`` rows of segments (``SEGMENT``) whose anchor has too many of them for one suffix array."""
    wide = stored(wide.withColumn("row", F.monotonically_increasing_id()), "wide")
    rows, wider = wide, None
    for width in WIDTHS:
        cores = stored(rows.mapInArrow(_blocks(size, width, wider), "row long, weight long, block long, h1 long, h2 long"), "cores")
        again = cores.groupBy("h1", "h2").agg(F.sum("weight").alias("total")).where("total >= 2").select("h1", "h2")
        alive = cores.join(again, ["h1", "h2"]).groupBy("row").agg(F.collect_list("block").alias("alive"))  # at most `size` a row
        rows, wider = stored(wide.join(alive, "row"), "alive"), width
    lone = rows.where("weight = 1").select("chunk", F.col("start").cast("long").alias("start"), "at", F.explode("alive").alias("block"))
    lo = F.col("start") + F.col("at") - F.col("block")
    return lone.select("chunk", lo.alias("lo"), (lo + size).alias("hi"))


def _with_copies(size: int, bits):
    """Segments of each chunk that may have exact copies (all that do, and few others)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                found = batch.column("anchors")[k].values
                key, digest, count, start = (found.field(n).to_numpy() for n in ("key", "digest", "count", "start"))
                use = in_bitmap(bits.value, digest)
                lo = start[use].astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[use]), pa.array(digest[use]), pa.array(np.full(len(lo), batch.column("chunk")[k].as_py())), pa.array(lo), pa.array(lo + count[use] + size - 1)],
                    ["key", "digest", "chunk", "lo", "hi"],
                )

    return scan


def _finish(with_text: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                text, sizes = _unpack(batch.column("packed")[k].as_py()), batch.column("sizes")[k].as_py()
                marks = batch.column("marks")[k]
                change = np.zeros(len(text) + 1, np.int64)
                if marks.is_valid:
                    np.add.at(change, marks.values.field("lo").to_numpy(), 1)
                    np.add.at(change, marks.values.field("hi").to_numpy(), -1)
                gone = np.cumsum(change[:-1]) > 0
                data = np.frombuffer(text, np.uint8)
                removed, spans, kept, at = [], [], [], 0
                for length in sizes:
                    out = gone[at : at + length]
                    removed.append(int(out.sum()))
                    spans.append(int(out[:1].sum() + (out[1:] & ~out[:-1]).sum()))
                    kept.append(data[at : at + length][~out].tobytes() if removed[-1] else text[at : at + length])
                    at += length
                columns = [batch.column("doc_ids")[k].values, pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in kept])]
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                if with_text:
                    columns.append(pa.array(kept, pa.binary()))
                    names.append("kept")
                yield pa.RecordBatch.from_arrays(columns, names)

    return scan


def remove_repeated_bytes(docs: DataFrame, size: int = 400, with_text: bool = True) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and, ``with_text``, ``kept`` (binary).

    Each byte of a text's UTF-8 goes that lies in a string of ``size`` bytes (24 at least) which also starts anywhere else, in any
    document or its own; all are judged on the input. ``n_spans`` counts the maximal runs removed; a cut may fall inside a character.
    Copies of a segment are told by two 64-bit hashes, strings that repeat in part are compared byte by byte.

    NULL and empty texts have no bytes; texts shorter than ``size`` lose nothing; rows that repeat an id are documents
    of their own (so like rows remove each other's text); NULL ids stay NULL; texts of any length are read whole; an empty
    table gives no rows; columns but ``doc_id`` and ``text`` are not read.
    """
    if size < 24:
        raise ValueError("size must be 24 bytes at least")
    spark = docs.sparkSession
    findable(spark)
    k = 1 << ((size // 3).bit_length() - 1)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    anchor = "array<struct<key: long, digest: long, count: int, at: int, start: int>>"
    chunks = texts.mapInArrow(_describe(size, k), f"chunk long, doc_ids array<long>, sizes array<long>, packed binary, anchors {anchor}")
    chunks = stored(chunks, "chunks")

    every = chunks.select("chunk", F.inline("anchors"))
    kinds = every.groupBy("key", "digest", "count", "at").agg(F.count("*").alias("weight"), F.min(F.struct("chunk", "start")).alias("place"))
    long = F.col("count").cast("long") + (size - 1)
    per_key = kinds.groupBy("key").agg(F.count("*").alias("kinds"), F.sum("weight").alias("total"), F.count_if(F.col("weight") == 1).alias("lone"), F.sum(long).alias("size"))
    kinds = stored(kinds.join(per_key.where("total >= 2"), "key"), "kinds")

    # Exact copies: all their windows repeat.
    copied = kinds.where("weight >= 2").select("key", "digest", "count", "weight")
    bits = spark.sparkContext.broadcast(hash_bitmap(copied, "digest"))
    copies = chunks.select("chunk", "anchors").mapInArrow(_with_copies(size, bits), "key long, digest long, chunk long, lo long, hi long")
    marks = copies.join(copied.select("key", "digest"), ["key", "digest"], "left_semi").select("chunk", "lo", "hi")

    # The others against each other and against the copied ones.
    compared = kinds.where("kinds >= 2 AND lone >= 1")
    wanted = compared.groupBy(F.col("place.chunk").alias("chunk")).agg(
        F.collect_list(F.struct("key", "weight", "size", F.col("place.start").alias("start"), "count", "at")).alias("wanted")  # bounded by the chunk
    )
    cut = chunks.select("chunk", "packed").join(wanted, "chunk").mapInArrow(_cut(size), SEGMENT)
    total, most = compared.agg(F.coalesce(F.sum(long), F.lit(0)), F.coalesce(F.max("size"), F.lit(0))).first()
    if most > MOST:
        cut = stored(cut, "segments")
        marks = marks.unionAll(narrowed(cut.where(F.col("size") > MOST), size))
        cut = cut.where(F.col("size") <= MOST)
    shards = max(1, -(-total // SHARD))
    sorted_ = cut.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards))).groupBy("shard").applyInArrow(_sort(size, k), MARK)
    marks = marks.unionAll(sorted_).groupBy("chunk").agg(F.collect_list(F.struct("lo", "hi")).alias("marks"))  # bounded by the chunk

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else "")
    return chunks.select("chunk", "doc_ids", "sizes", "packed").join(marks, "chunk", "left").mapInArrow(_finish(with_text), schema)
