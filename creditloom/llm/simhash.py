"""Near-duplicate documents by SimHash fingerprints, searched in BK-trees.

Two fingerprints within ``d`` differing bits agree on at least one of ``d + 1`` disjoint blocks of bits, so all
fingerprints that share a block form a shard, and each shard gets a BK-tree: children hang below their parent under the
integer Hamming distance to it. Shard trees travel with the shuffle to the tasks that search them, instead of through the driver,
which would have to hold the fingerprints of all documents. A shard beyond ``SHARD`` fingerprints is divided again by
the blocks of its remaining bits, which loses no pair either.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditloom.llm.common import connected_components, roots, stored, text_hash, text_slices, text_table

#: Fingerprints in a shard above which it is divided, how often that may happen, and fingerprints in one search block.
SHARD, DEPTH, BLOCK = 2048, 4, 32768


def fingerprint(text: str, shingle: int) -> int:
    """64 majority bits over the hashes of all word shingles, repeats included; 0 without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the six ASCII white spaces only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    last = max(0, len(words) - shingle)
    cut = zip(starts[: last + 1].tolist(), ends[min(shingle, len(words)) - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_digest
    data = b"".join([digest(joined[i:j], 42) for i, j in cut])
    ones = np.zeros(64, np.int64)
    rows = np.frombuffer(data, np.uint8).reshape(-1, 8)
    for at in range(0, len(rows), 65536):
        ones += np.unpackbits(rows[at : at + 65536], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(rows)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """``doc_id``, ``th`` (tells rows of one id apart) and ``fp`` of every row, in one pass without a shuffle."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            fps = [fingerprint(text, shingle) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("th"), pa.array(fps, pa.int64())], ["doc_id", "th", "fp"]
            )

    return text_table(docs, text_hash().alias("th")).mapInArrow(scan, "doc_id long, th long, fp long")


def bk_links(shard: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) within ``radius`` bits inside each shard, found in one BK-tree a shard.

    ``shard`` is sorted. Trees grow level by level for all shards at once: of the fingerprints that stand at the same node with
    the same distance to it, the first becomes the child and the others move below it. The search keeps (query, node)
    pairs and follows only edges between distance - radius and distance + radius.
    """
    count = len(fp)
    first = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
    at = np.repeat(first, np.diff(np.r_[first, count]))  # the node where each fingerprint stands
    root = at.copy()
    below = np.setdiff1d(np.arange(count), first, assume_unique=True)
    parents, edges, children = [], [], []
    while len(below):
        edge = np.bitwise_count(fp[below] ^ fp[at[below]]).astype(np.int64)
        key = at[below] * 65 + edge
        keys, who, group = np.unique(key, return_index=True, return_inverse=True)
        child = below[who]
        parents.append(keys // 65)
        edges.append(keys % 65)
        children.append(child)
        at[below] = child[group]
        keep = np.ones(len(below), bool)
        keep[who] = False
        below = below[keep]
    if not parents:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    key = np.concatenate(parents) * 65 + np.concatenate(edges)
    order = np.argsort(key)
    key, child = key[order], np.concatenate(children)[order]
    left, right = [], []
    for begin in range(0, count, 4096):
        query = np.arange(begin, min(begin + 4096, count))
        node = root[query]
        while len(query):
            distance = np.bitwise_count(fp[query] ^ fp[node]).astype(np.int64)
            hit = (distance <= radius) & (node < query)
            left.append(query[hit])
            right.append(node[hit])
            lo = np.searchsorted(key, node * 65 + np.maximum(distance - radius, 0))
            hi = np.searchsorted(key, node * 65 + np.minimum(distance + radius, 64), side="right")
            size = hi - lo
            query = np.repeat(query, size)
            node = child[np.repeat(lo - np.cumsum(size) + size, size) + np.arange(len(query))]
    return np.concatenate(left), np.concatenate(right)


def _masks(radius: int) -> list[dict[tuple[int, ...], list[int]]]:
    """For each depth: path of chosen blocks -> bits that agree. A path's remaining bits are divided evenly."""
    levels: list[dict[tuple[int, ...], list[int]]] = [{(): []}]
    for _ in range(DEPTH):
        deeper = {}
        for path, fixed in levels[-1].items():
            rest = [b for b in range(64) if b not in fixed]
            for k, block in enumerate(np.array_split(rest, radius + 1)):
                deeper[(*path, k)] = fixed + block.tolist()
        levels.append(deeper)
    return levels


def _signed(bits: list[int]) -> int:
    mask = sum(1 << b for b in bits)
    return mask - (1 << 64) if mask >> 63 else mask


def _search(radius: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(path, part, fp):
            new = np.r_[True, (path[1:] != path[:-1]) | (part[1:] != part[:-1])]
            i, j = bk_links(np.cumsum(new), fp.view(np.uint64), radius)
            root = roots(len(fp), i, j)
            moved = np.flatnonzero(root != np.arange(len(fp)))
            return pa.RecordBatch.from_arrays([pa.array(fp[moved]), pa.array(fp[root[moved]])], ["a", "b"])

        held = [np.empty(0, np.int64)] * 3
        for batch in batches:
            held = [np.r_[h, batch.column(c).to_numpy()] for h, c in zip(held, ("path", "part", "fp"), strict=True)]
            if len(held[0]) >= BLOCK:  # all but the last shard are whole
                cut = np.flatnonzero((held[0] == held[0][-1]) & (held[1] == held[1][-1]))[0]
                if cut:
                    yield linked(*(h[:cut] for h in held))
                    held = [h[cut:] for h in held]
        if len(held[0]):
            yield linked(*held)

    return scan


def fingerprint_links(fps: DataFrame, radius: int) -> DataFrame:
    """Links ``a`` - ``b`` that connect all fingerprints within ``radius`` bits of each other.

    ``fps``: distinct ``fp``. Every shard gives a star for each of its groups, not all of their pairs: together the stars
    connect exactly what the pairs connect.
    """
    levels = _masks(radius)
    pending = fps.select("fp", F.lit(0).alias("path"))
    parts = []
    for depth in range(1, DEPTH + 1):
        names = {path: k for k, path in enumerate(levels[depth - 1])}
        choices = [[] for _ in names]
        for k, (path, bits) in enumerate(levels[depth].items()):
            choices[names[path[:-1]]].append((k, _signed(bits)))
        table = F.array(*[F.array(*[F.struct(F.lit(k).alias("k"), F.lit(m).alias("m")) for k, m in c]) for c in choices])
        rows = pending.select("fp", F.explode(table[F.col("path")]).alias("to")).select(
            "fp", F.col("to.k").alias("path"), F.col("fp").bitwiseAND(F.col("to.m")).alias("part")
        )
        big = rows.groupBy("path", "part").count().where(F.col("count") > SHARD).select("path", "part")
        if depth == DEPTH or big.isEmpty():
            parts.append(rows)
            break
        big = stored(big, "shards")
        parts.append(rows.join(big, ["path", "part"], "left_anti").select("fp", "path", "part"))
        pending = rows.join(big, ["path", "part"], "left_semi").select("fp", "path")
    out = None
    for rows in parts:
        near = (
            rows.select(F.col("path").cast("long").alias("path"), "part", "fp")
            .repartition("path", "part")
            .sortWithinPartitions("path", "part", "fp")
            .mapInArrow(_search(radius), "a long, b long")
        )
        out = near if out is None else out.unionByName(near)
    return out.distinct()


def simhash_groups(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """``doc_id``, ``th``, ``fp`` and ``component_id`` (smallest ``doc_id`` reachable) of every row of ``docs``.

    Fingerprints within ``radius`` bits are linked, and links carry on through others. NULL and empty texts, and texts
    without a word, have fingerprint 0 and are linked like any other. Rows that repeat an id or a text each get their
    row; a NULL id never names a component that holds a document with an id. Other columns are not read.
    """
    fps = stored(fingerprints(docs, shingle), "fingerprints")
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = connected_components(fingerprint_links(fps.select("fp").distinct(), radius))
    named = stored(
        nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", "least", F.coalesce("root", "fp").alias("root")
        ),
        "components",
    )
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return fps.join(named.select("fp", "root"), "fp").join(least, "root").select("doc_id", "th", "fp", "component_id")


def hex_fingerprint(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def drop_near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """One row of each group stays, that of the smallest ``doc_id`` (then smallest text hash); columns are unchanged.

    A group without any id keeps one row too. An empty table stays empty.
    """
    groups = simhash_groups(docs, shingle, radius)
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("i"), F.col("th").alias("t"))
    kept = groups.groupBy(F.col("component_id"), F.when(F.col("component_id").isNull(), F.col("fp")).alias("g")).agg(
        F.min(order).alias("k")
    )
    names = docs.columns
    held = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("doc_id").cast("long").alias("i"), text_hash().alias("t")
    ).join(kept.select(F.col("k.i").alias("ki"), F.col("k.t").alias("kt")), F.col("i").eqNullSafe(F.col("ki")) & (F.col("t") == F.col("kt")), "left_semi")
    once = Window.partitionBy("i", "t").orderBy(F.lit(0))
    return held.withColumn("n", F.row_number().over(once)).where("n = 1").select("row.*")
