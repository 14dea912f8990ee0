"""Repeated byte strings against a brute-force version; suffix arrays against plain sorting."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from creditloom.llm import suffix_dedup as module
from creditloom.llm.queries import queries
from creditloom.llm.suffix_array import suffix_array
from creditloom.llm.suffix_dedup import remove_repeated_bytes, repeated_windows, segments


@pytest.mark.parametrize("symbols", [1, 2, 3, 6])
def test_suffix_array_is_that_of_plain_sorting(symbols):
    r = random.Random(symbols)
    for _ in range(400):
        text = [r.randint(1, symbols) for _ in range(r.randint(0, 50))] + [0]
        assert suffix_array(np.array(text)).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def brute(rows, size):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[k : k + size] for _, t in texts for k in range(len(t) - size + 1))
    expected = []
    for i, t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - size + 1):
            if seen[t[k : k + size]] > 1:
                gone[k : k + size] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = int((np.diff(np.r_[False, gone].astype(int)) == 1).sum())
        expected.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(expected, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=repr)


@pytest.fixture(scope="module")
def rows(prose):
    passage, long, line = prose(60), prose(3000), prose(14)
    rows = [(None, None), (1, ""), (2, "short"), (None, passage), (3, "é" * 700), (4, "ab" * 300), (5, long), (5, long), (6, long[:9000] + "!" + long[9001:])]
    rows += [(20 + k, f"{prose(50)} {passage} {prose(30)} {line} {prose(20)}") for k in range(40)]  # shared amid different text
    return rows + [(70 + k, prose(80) + passage[k : k + 180]) for k in range(20)] + [(90, "x" + passage), (91, "x" + passage)]


@pytest.mark.parametrize("size", [40, 100, 400])
def test_against_brute_force(documents, rows, size):
    assert found(remove_repeated_bytes(documents(rows), size)) == brute(rows, size)


def test_frequent_anchors_are_narrowed(documents, rows, monkeypatch):
    monkeypatch.setattr(module, "MOST", 1200)
    monkeypatch.setattr(module, "SHARD", 3000)
    kept = remove_repeated_bytes(documents(rows), 100)
    assert found(kept) == brute(rows, 100)


def test_kept_bytes_are_what_the_digest_says(documents, rows):
    for r in remove_repeated_bytes(documents(rows), 100).collect():
        assert hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] and len(r["kept"]) == r["n_bytes"] - r["n_removed"]


def test_every_window_is_in_one_segment_also_across_pieces(rows, monkeypatch):
    texts = [(t or "").encode() for _, t in rows]
    data, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])
    windows = [int(k) for e, t in zip(ends, texts) for k in range(e - len(t), e - 99)]
    anchors = {}
    for piece in (1 << 20, 700):
        monkeypatch.setattr(module, "PIECE", piece)
        parts = [(s, c, a, k) for p in segments(data, ends, 100, 32) for s, c, a, k in zip(*(x.tolist() for x in p))]
        assert sorted(s + i for s, c, _, _ in parts for i in range(c)) == windows
        for s, c, a, key in parts:
            for i in range(c):  # like windows have like anchors in like places
                assert anchors.setdefault(data[s + i : s + i + 100].tobytes(), (key, a - i)) == (key, a - i)


def test_segments_of_some_anchors(rows):
    """All segments of a table, sorted at once, with their copies left in."""
    texts = [(t or "").encode() for _, t in rows]
    data = np.frombuffer(joined := b"".join(texts), np.uint8)
    start, count, at, key = (np.concatenate(c) for c in zip(*segments(data, np.cumsum([len(t) for t in texts]), 100, 32)))
    order = np.argsort(key, kind="stable")
    start, count, at, key = (x[order] for x in (start, count, at, key))
    pieces = [joined[a : a + n + 99] for a, n in zip(start.tolist(), count.tolist())]
    weights = np.ones(len(key), np.int64)
    seen = Counter(p[k : k + 100] for p in pieces for k in range(len(p) - 99))
    for keys in (key, np.zeros(len(key), np.int64)):  # also with anchors whose hashes are all the same
        found = repeated_windows(pieces, keys, count, at, weights, 100, 32)
        got = sorted(zip(*(x.tolist() for x in found)))
        assert got == sorted((i, k) for i, p in enumerate(pieces) for k in range(len(p) - 99) if seen[p[k : k + 100]] > 1)


def test_empty_table_and_short_size(documents):
    assert found(remove_repeated_bytes(documents([]))) == []
    with pytest.raises(ValueError):
        remove_repeated_bytes(documents([]), 8)


def test_query_over_the_smallest_tables(spark):
    directory = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{directory}/documents.parquet").select("doc_id", "text").collect()]
    assert found(queries()["op12_suffix_dedup"](spark, directory)) == brute(rows, 400)
