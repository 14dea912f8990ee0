"""Hard negatives against a brute-force version in integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditloom.llm import hard_negatives as module
from creditloom.llm.hard_negatives import Tree, hard_negatives, inner_products
from creditloom.llm.queries import queries

SCHEMA = "vec_id long, embedding array<float>, label int, rid long, v string, score int, leaf long, rank int"


def vector_table(spark, rows):
    return spark.createDataFrame([(i, e, label, 1, "v", 2, 3, 4) for i, e, label in rows], SCHEMA)


def brute(rows, anchor=lambda i: i % 100 == 0, first=5, most=10, scale=256):
    """``rows``: id, components, label, in the order of the table."""
    good = [
        (i, [math.floor(scale * float(np.float32(x))) for x in e], label)
        for i, e, label in rows
        if label is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)
    ]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    key = lambda r: (-r[0], r[1] is None, r[1] or 0, r[2])
    found = []
    for a, (anchor_id, va, la) in enumerate(good):
        if anchor_id is None or not anchor(anchor_id):
            continue
        scored = sorted(((dot(va, v), i, n, label) for n, (i, v, label) in enumerate(good) if n != a), key=key)
        for ps, pid, _, _ in [s for s in scored if s[3] == la][:first]:
            hard = [s for s in scored if s[3] != la and 30 * ps <= 100 * s[0] <= 90 * ps][:most]
            found += [(anchor_id, pid, rank, s[1], ps, s[0]) for rank, s in enumerate(hard, 1)]
    return sorted(found, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(5)
    centres = r.normal(size=(12, 8))
    near = [centres[k % 12] + 0.3 * r.normal(size=8) for k in range(900)]
    rows = [(k, (x / np.linalg.norm(x)).tolist(), int(r.integers(0, 4))) for k, x in enumerate(near)]
    same = rows[100][1]
    rows += [(1000 + k, same, k % 2) for k in range(40)]  # like vectors, ties
    rows += [(200, rows[200][1], 1), (200, rows[200][1], 1)]  # repeated rows
    rows += [(None, same, 1), (None, rows[7][1], 0), (1100, None, 1), (1101, [1.0] * 8, None), (1102, [None] * 8, 1)]
    rows += [(1103, [float("nan")] * 8, 1), (1104, [float("inf")] * 8, 1), (1200, [0.0] * 8, 2), (1300, [0.5, 0.5], 1), (1400, [], 0)]
    return rows


def test_against_brute_force(spark, rows):
    assert found(hard_negatives(vector_table(spark, rows))) == brute(rows)


def test_many_small_leaves_slices_and_blocks(spark, rows, monkeypatch):
    for name, value in {"SAMPLE": 300, "LEAF": 40, "SLICE": 30, "BLOCK": 3, "FAN": 4, "INNER_LEAF": 6, "INNER_FAN": 3}.items():
        monkeypatch.setattr(module, name, value)
    assert found(hard_negatives(vector_table(spark, rows))) == brute(rows)


def test_subtrees_outside_the_annulus_are_not_visited():
    r = np.random.default_rng(1)
    x = (256 * np.concatenate([c + 0.05 * r.normal(size=(200, 6)) for c in r.normal(size=(20, 6))])).astype(np.int64)
    tree = Tree(float((x**2).sum(axis=1).max()))
    tree.grow(tree.extended(x), 8, 50)
    score = inner_products(x[:1], x)[0]
    top = np.sort(score)[-20]
    seen = []
    tree.search(x[:1], np.zeros(1, np.int64), np.array([top]), np.array([1 << 62]), lambda leaf, lanes: seen.append(leaf))
    visited = np.concatenate([tree.leaves[leaf] for leaf in seen])
    assert set(np.flatnonzero(score >= top)) <= set(visited.tolist()) and len(visited) < len(x) / 4
    assert sorted(np.concatenate(tree.leaves).tolist()) == list(range(len(x)))


def test_large_components_stay_exact():
    a, b = np.array([[1 << 40, 3]]), np.array([[1 << 20, 1], [1 << 61, 5]])
    assert inner_products(a, b).tolist() == [[(1 << 60) + 3, 1 << 62]]


def test_empty_tables(spark):
    assert found(hard_negatives(vector_table(spark, []))) == []
    assert found(hard_negatives(vector_table(spark, [(1, None, 1), (100, [0.5], 1)]))) == []


def test_query_over_the_smallest_tables(spark):
    directory = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{directory}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    moved = [(r[0], r[1], (r[2] + 1) % 10 if r[0] is not None and r[0] % 7 == 0 and r[2] is not None else r[2]) for r in rows]
    assert found(queries()["op13_hard_negatives"](spark, directory)) == brute(moved)


def test_other_anchors_and_labels(spark, rows):
    some = [r for r in rows if r[0] is not None and r[0] < 200]
    got = found(hard_negatives(vector_table(spark, some), F.col("vec_id") % 7 == 1, F.col("label") % 2, positives=2, negatives=3))
    assert got == brute([(i, e, None if label is None else label % 2) for i, e, label in some], lambda i: i % 7 == 1, 2, 3)
