"""Hard negatives by a multiway hyperplane tree with distance ranges.

Vectors get one more component that brings all to the same length, so a window of inner products with an anchor is an annulus of
distances around it. A node of the tree holds some split points; every vector goes down to the nearest one, and each split point
keeps the least and the largest distance to the members of each sibling's subtree. An anchor passes by a subtree if, for any split
point, that range puts all its members outside the annulus. Leaves are searched exactly, in integers.

The upper tree is fitted on a bounded sample and goes to all tasks; its ranges cover every row. Its leaves are cut into slices, and
each slice grows a tree of its own inside a task. The annulus shrinks as better rows are found, at first in the sample.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.llm.common import NO_ID, findable, id_column, stored

#: Rows that the upper tree is fitted on at most; rows that a leaf of it aims at, and rows or anchors in a slice or block.
SAMPLE, LEAF, SLICE, BLOCK = 4096, 2048, 4096, 1024
#: Split points of a node above and inside a slice; rows that a leaf inside a slice holds.
FAN, INNER_FAN, INNER_LEAF = 16, 8, 128

LOW, HIGH = -(1 << 62), 1 << 62  # no score is beyond them


def inner_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows; beyond ``LOW`` and ``HIGH`` they stop there."""
    a, b = left.astype(np.float64), right.astype(np.float64)
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * left.shape[1] < 2.0**53:  # then sums of doubles are exact
        return np.rint(a @ b.T).astype(np.int64)
    return np.clip(left.astype(object) @ right.astype(object).T, LOW, HIGH).astype(np.int64)


class Tree:
    """Nodes as split points, children and ranges. A child is another node or ``~leaf``."""

    def __init__(self, longest: float):
        self.longest = longest  # squared length that all vectors are brought to
        self.points: list[np.ndarray] = []
        self.children: list[np.ndarray] = []
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self.root = ~0
        self.leaves: list[np.ndarray] = []

    def extended(self, v: np.ndarray) -> np.ndarray:
        v = v.astype(np.float64)
        return np.concatenate([v, np.sqrt(np.maximum(self.longest - (v * v).sum(axis=1), 0))[:, None]], axis=1)

    def distances(self, x: np.ndarray, node: int) -> np.ndarray:
        return np.sqrt(np.maximum(2 * self.longest - 2 * x @ self.points[node].T, 0))

    def grow(self, x: np.ndarray, fan: int, most: float, seed: int = 11) -> Tree:
        """Split until no leaf holds more than ``most`` of the rows ``x`` (or only like ones)."""
        random = np.random.default_rng(seed)

        def split(rows: np.ndarray) -> int:
            if len(rows) > max(most, 2 * fan):
                tried = rows[random.choice(len(rows), min(len(rows), 3 * fan), replace=False)]
                chosen = [0]  # each further split point is the one farthest from those before
                nearest = 1 - x[tried] @ x[tried[0]] / self.longest if self.longest else np.zeros(len(tried))
                while len(chosen) < fan and nearest.max() > 1e-9:
                    chosen.append(int(nearest.argmax()))
                    nearest = np.minimum(nearest, 1 - x[tried] @ x[tried[chosen[-1]]] / self.longest)
                if len(chosen) > 1:
                    node = len(self.points)
                    self.points.append(x[tried[chosen]])
                    far = self.distances(x[rows], node)
                    to = far.argmin(axis=1)
                    self.children.append(np.zeros(len(chosen), np.int64))
                    shape = (len(chosen), len(chosen))
                    self.low.append(np.full(shape, np.inf))
                    self.high.append(np.full(shape, -np.inf))
                    for c in range(len(chosen)):
                        if (to == c).any():
                            self.low[node][:, c], self.high[node][:, c] = far[to == c].min(axis=0), far[to == c].max(axis=0)
                        self.children[node][c] = split(rows[to == c])
                    return node
            self.leaves.append(rows)
            return ~(len(self.leaves) - 1)

        self.root = split(np.arange(len(x)))
        return self

    def route(self, x: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, np.ndarray, np.ndarray]]]:
        """Leaf of each row, and per node and child the least and largest distances from every split point."""
        leaf, ranges = np.zeros(len(x), np.int64), []

        def down(at: int, rows: np.ndarray) -> None:
            if at < 0:
                leaf[rows] = ~at
                return
            far = self.distances(x[rows], at)
            to = far.argmin(axis=1)
            for c in np.unique(to).tolist():
                ranges.append((at, c, far[to == c].min(axis=0), far[to == c].max(axis=0)))
                down(int(self.children[at][c]), rows[to == c])

        if len(x):
            down(self.root, np.arange(len(x)))
        return leaf, ranges

    def search(self, v: np.ndarray, owner: np.ndarray, low: np.ndarray, high: np.ndarray, visit: Callable[[int, np.ndarray], None]) -> None:
        """Call ``visit(leaf, lanes)`` for the lanes (anchor ``v[owner]``, scores from ``low`` to ``high``) that may find rows there.

        ``visit`` may raise ``low`` in place; what follows is then searched within the smaller annulus.
        """
        v = v.astype(np.float64)
        own = (v * v).sum(axis=1)
        slack = 1e-6 * (np.sqrt(self.longest) + np.sqrt(own) + 1)
        base = own + self.longest

        def down(at: int, lanes: np.ndarray) -> None:
            if at < 0:
                visit(~at, lanes)
                return
            anchors, which = np.unique(owner[lanes], return_inverse=True)
            d = np.sqrt(np.maximum(base[anchors, None] - 2 * v[anchors] @ self.points[at][:, :-1].T, 0))
            inner = np.sqrt(np.maximum(base[owner[lanes]] - 2 * high[lanes].astype(np.float64), 0)) - slack[owner[lanes]]
            for c, child in enumerate(self.children[at].tolist()):
                least, most = self.low[at][:, c], self.high[at][:, c]
                if most[0] < least[0]:
                    continue  # nothing there
                near = np.maximum(d - most, least - d).max(axis=1)[which]
                far = (d + most).min(axis=1)[which]
                outer = np.sqrt(np.maximum(base[owner[lanes]] - 2 * low[lanes].astype(np.float64), 0)) + slack[owner[lanes]]
                go = (near <= outer) & (far >= inner) & (low[lanes] <= high[lanes])
                if go.any():
                    down(child, lanes[go])

        down(self.root, np.arange(len(owner)))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), width)


def best_in_slice(asked: pa.Table, rows: pa.Table, width: int, longest: float, k: int, same: bool) -> dict[str, np.ndarray]:
    """The ``k`` best rows of one slice for each lane: score first, then ``vec_id``, then ``rid``."""
    order = np.lexsort((rows.column("rid").to_numpy(), rows.column("vec_id").to_numpy()))
    rid, vec_id, label = (rows.column(n).to_numpy()[order] for n in ("rid", "vec_id", "label"))
    v = _matrix(rows.column("v").combine_chunks(), width)[order]
    a = _matrix(asked.column("v").combine_chunks(), width)
    arid, alabel = asked.column("arid").to_numpy(), asked.column("label").to_numpy()
    lists = [asked.column(n).combine_chunks() for n in ("lanes", "low", "high")]
    owner = np.repeat(np.arange(len(arid)), np.diff(lists[0].offsets.to_numpy()))
    lane, low, high = (np.array(part.flatten()) for part in lists)
    best = np.full((len(owner), k), LOW - 1)
    which = np.full((len(owner), k), len(rid))
    tree = Tree(longest)
    tree.grow(tree.extended(v), INNER_FAN, INNER_LEAF)

    def visit(leaf: int, lanes: np.ndarray) -> None:
        members = tree.leaves[leaf]
        anchors, at = np.unique(owner[lanes], return_inverse=True)
        score = inner_products(a[anchors], v[members])
        fits = (alabel[anchors, None] == label[members]) == same
        score[~fits | (arid[anchors, None] == rid[members])] = LOW - 1
        score = score[at]
        inside = (score >= low[lanes, None]) & (score <= high[lanes, None])
        some = inside.any(axis=1)
        lanes, score = lanes[some], np.where(inside[some], score[some], LOW - 1)
        every = np.concatenate([best[lanes], score], axis=1)
        index = np.concatenate([which[lanes], np.broadcast_to(members, score.shape)], axis=1)
        first = np.lexsort((index, -every), axis=1)[:, :k]
        best[lanes] = np.take_along_axis(every, first, 1)
        which[lanes] = np.take_along_axis(index, first, 1)
        low[lanes] = np.maximum(low[lanes], best[lanes, -1])

    tree.search(a, owner, low, high, visit)
    at, place = np.nonzero(best >= LOW)
    found = which[at, place]
    return {"arid": arid[owner[at]], "lane": lane[at], "rid": rid[found], "vec_id": vec_id[found], "score": best[at, place]}


class Forest:
    """All rows under the upper tree, stored by leaf, and the searches over them."""

    def __init__(self, rows: DataFrame, width: int, count: int, longest: float):
        spark = rows.sparkSession
        self.spark, self.width, self.longest = spark, width, longest
        share = min(1_000_000, int(1.1e6 * SAMPLE / count) + 1)
        sample = rows.where(F.pmod(F.xxhash64("rid"), F.lit(1_000_000)) < share).limit(SAMPLE).toArrow()
        tree, x = Tree(longest), _matrix(sample.column("v").combine_chunks(), width)
        tree.grow(tree.extended(x), FAN, LEAF * len(x) / count)
        tree.leaves = [np.empty(0, np.int64)] * len(tree.leaves)
        self.leaf_count = len(tree.leaves)
        known = (x, sample.column("rid").to_numpy(), sample.column("label").to_numpy())

        shared = spark.sparkContext.broadcast(tree)  # split points out of SAMPLE rows
        schema = "rid long, vec_id long, label long, v array<long>"

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                leaf, _ = shared.value.route(shared.value.extended(_matrix(batch.column("v"), width)))
                yield pa.RecordBatch.from_arrays([pa.array(leaf), *batch.columns], ["leaf", *batch.schema.names])

        def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            least: dict[tuple[int, int], list[np.ndarray]] = {}
            for batch in batches:
                for node, child, low, high in shared.value.route(shared.value.extended(_matrix(batch.column("v"), width)))[1]:
                    if (node, child) in least:
                        low, high = np.minimum(low, least[node, child][0]), np.maximum(high, least[node, child][1])
                    least[node, child] = [low, high]
            for (node, child), (low, high) in least.items():
                n = len(low)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, node)), pa.array(np.full(n, child)), pa.array(np.arange(n)), pa.array(low), pa.array(high)],
                    ["node", "child", "split", "low", "high"],
                )

        self.placed = stored(rows.mapInArrow(place, f"leaf long, {schema}"), "placed")
        spans = rows.mapInArrow(ranges, "node long, child long, split long, low double, high double")
        for r in spans.groupBy("node", "child", "split").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
            tree.low[r["node"]][r["split"], r["child"]] = r["low"]  # one row a node, child and split point
            tree.high[r["node"]][r["split"], r["child"]] = r["high"]
        self.held = self.placed.groupBy("leaf").agg(F.ceil(F.count("*") / SLICE).cast("int").alias("slices"))
        self.shared = spark.sparkContext.broadcast((tree, known))

    def best(self, asked: DataFrame, k: int, same: bool) -> DataFrame:
        """``arid``, ``lane``, ``rid``, ``vec_id``, ``score``, ``rank`` of the ``k`` best rows of every lane of ``asked`` (``arid``, ``label``,
        ``v``, and arrays ``lanes``, ``low``, ``high``) with the anchor's label (``same``) or another; the anchor's own row is left out."""
        width, longest, shared = self.width, self.longest, self.shared
        lists = "lanes array<long>, low array<long>, high array<long>"

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tree, (x, rid, label) = shared.value
            for batch in (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256)):
                v = _matrix(batch.column("v"), width)
                arid, alabel = batch.column("arid").to_numpy(), batch.column("label").to_numpy()
                parts = [batch.column(n) for n in ("lanes", "low", "high")]
                owner = np.repeat(np.arange(len(arid)), np.diff(parts[0].offsets.to_numpy()))
                lane, low, high = (np.array(part.flatten()) for part in parts)
                # The k-th best of the sample is a first bound: no worse row is among the k best of all.
                score = inner_products(v, x)
                score[((alabel[:, None] == label) != same) | (arid[:, None] == rid)] = LOW - 1
                if len(rid) >= k:
                    for some in np.array_split(np.arange(len(owner)), len(owner) // 256 + 1):
                        mine = score[owner[some]]
                        mine = np.where((mine >= low[some, None]) & (mine <= high[some, None]), mine, LOW - 1)
                        low[some] = np.maximum(low[some], np.partition(mine, -k, axis=1)[:, -k])
                where: dict[int, np.ndarray] = {}
                tree.search(v, owner, low, high, lambda leaf, lanes: where.__setitem__(leaf, lanes))
                for leaf, lanes in where.items():
                    anchors, size = np.unique(owner[lanes], return_counts=True)
                    offsets = pa.array(np.r_[0, np.cumsum(size)], pa.int32())
                    taken = batch.select(["arid", "label", "v"]).take(pa.array(anchors))
                    cut = [pa.ListArray.from_arrays(offsets, pa.array(part[lanes])) for part in (lane, low, high)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(anchors), leaf)), *taken.columns, *cut], ["leaf", "arid", "label", "v", "lanes", "low", "high"]
                    )

        sent = stored(asked.mapInArrow(choose, f"leaf long, arid long, label long, v array<long>, {lists}"), "asked")
        blocks = sent.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
        cuts = F.broadcast(self.held.join(blocks, "leaf"))  # one row a leaf, and leaves come out of SAMPLE rows
        part = lambda of, n: F.pmod(F.xxhash64(of), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        left = sent.join(cuts, "leaf").withColumn("block", part("arid", "blocks")).withColumn("slice", every("slices"))
        right = self.placed.join(cuts, "leaf").withColumn("slice", part("rid", "slices")).withColumn("block", every("blocks"))
        keys = ["leaf", "slice", "block"]
        left = left.select(*keys, "arid", "label", "v", "lanes", "low", "high")
        right = right.select(*keys, "rid", "vec_id", "label", "v")

        def compare(asked_here: pa.Table, rows: pa.Table) -> pa.Table:
            names = ["arid", "lane", "rid", "vec_id", "score"]
            if not asked_here.num_rows or not rows.num_rows:
                return pa.table({n: pa.array([], pa.int64()) for n in names})
            return pa.table(best_in_slice(asked_here, rows, width, longest, k, same))

        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
            compare, "arid long, lane long, rid long, vec_id long, score long"
        )
        order = Window.partitionBy("arid", "lane").orderBy(F.desc("score"), "vec_id", "rid")  # k rows a slice that was searched
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def whole_vectors(vectors: DataFrame, label: Column, scale: int, column: str = "embedding") -> DataFrame:
    """``vec_id``, ``label`` and ``v``, every component floor(scale * x), of the rows that take part."""
    x = F.col(f"`{column}`").cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return vectors.select(
        F.coalesce(F.col("vec_id").cast("long"), F.lit(int(NO_ID))).alias("vec_id"),
        label.cast("long").alias("label"),
        F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("long")).alias("v"),
    ).where(x.isNotNull() & ~bad & label.isNotNull())


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column | None = None,
    label: Column | None = None,
    positives: int = 5,
    negatives: int = 10,
    window: tuple[int, int] = (30, 90),
    scale: int = 256,
    column: str = "embedding",
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Components become floor(``scale`` * x) and scores integer inner products with the anchor. Positives of an anchor are its first
    ``positives`` other rows of the same label; for each, the first ``negatives`` rows of other labels whose score lies within
    ``window`` percent of the positive's, both ends included. Higher scores come first, ties go to the smaller ``vec_id``, then
    to the earlier row. ``is_anchor`` is a condition on ``vec_id`` (default: divisible by 100), ``label`` a column (default: ``label``).

    Rows with a NULL label or vector, or a NULL or non-finite component, take no part. Shorter vectors count as zero where they end.
    Rows that repeat an id or a vector are rows of their own, also as anchors; NULL ids are no anchors and come last in ties;
    scores beyond 2^62 stop there. Other columns are not read; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    findable(spark)
    label = F.col("label") if label is None else label
    is_anchor = F.col("vec_id") % 100 == 0 if is_anchor is None else is_anchor
    rows = stored(whole_vectors(vectors, label, scale, column).withColumn("rid", F.monotonically_increasing_id()), "vectors")
    squares = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    count, width, longest = rows.agg(F.count("*"), F.max(F.size("v")), F.max(squares)).first()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not count:
        return spark.createDataFrame([], schema)
    padded = F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("v")))
    rows = rows.select("rid", "vec_id", "label", padded.alias("v"))
    forest = Forest(rows, width, count, longest)
    anchors = rows.where((F.col("vec_id") != F.lit(int(NO_ID))) & is_anchor).withColumnRenamed("rid", "arid")
    one = lambda x: F.array(F.lit(x).cast("long"))
    asked = anchors.select("arid", "label", "v", one(0).alias("lanes"), one(LOW).alias("low"), one(HIGH).alias("high"))
    near = stored(forest.best(asked, positives, same=True).select("arid", "rank", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    # A negative positive score leaves no window. Hundreds and rest are taken apart, so that no product overflows.
    hundreds, rest = F.expr("positive_score div 100"), F.expr("positive_score % 100")
    low = hundreds * window[0] + F.floor((rest * window[0] + 99) / 100)
    high = hundreds * window[1] + F.floor(rest * window[1] / 100)
    lanes = near.where("positive_score >= 0").groupBy("arid").agg(F.collect_list(F.struct(F.col("rank").cast("long").alias("lane"), low.alias("low"), high.alias("high"))).alias("w"))
    asked = anchors.join(lanes, "arid").select("arid", "label", "v", F.col("w.lane").alias("lanes"), F.col("w.low").alias("low"), F.col("w.high").alias("high"))
    hard = forest.best(asked, negatives, same=False).select("arid", F.col("lane").cast("int").alias("lane"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return (
        hard.join(near.withColumnRenamed("rank", "lane"), ["arid", "lane"])
        .join(anchors.select("arid", F.col("vec_id").alias("anchor_id")), "arid")
        .select("anchor_id", id_column("positive_id").alias("positive_id"), "rank", id_column("negative_id").alias("negative_id"), "positive_score", "negative_score")
    )
