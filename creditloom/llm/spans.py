"""Spans in texts: base patterns, their order and their digests."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from creditloom.llm.common import text_slices, text_table

#: Kind, start and end (code points, end exclusive).
Span = tuple[str, int, int]


def in_order(spans: list[Span], kinds: list[str]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], kinds.index(s[0]), s[2]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def apart(spans: list[tuple[int, int]], others: list[Span]) -> list[tuple[int, int]]:
    """Those of ``spans`` that overlap none of ``others``."""
    return [(a, b) for a, b in spans if all(b <= start or end <= a for _, start, end in others)]


def span_table(docs: DataFrame, kinds: list[str], base: Callable[[str], list[Span]], more: Callable[[], Callable[[list[str], list[list[Span]]], list[list[Span]]]], own: str) -> DataFrame:
    """``doc_id``, ``n_<kind>`` of the base kinds, ``base_sha256`` and ``spans`` of every row of ``docs``, in one pass without a shuffle.

    ``base`` gives the base spans of a text; ``more()`` is called once a task and gives a function from texts and their base
    spans to further spans, all of kind ``own``. Counts and the digest are those of the base spans alone.
    """
    order = [*kinds, own]
    names = ["doc_id", *(f"n_{k}" for k in kinds), "base_sha256", "spans"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = more()
        for batch in text_slices(batches):
            texts = batch.column("text").to_pylist()
            fixed = [in_order(base(t), order) for t in texts]
            every = [in_order(b + m, order) for b, m in zip(fixed, find(texts, fixed), strict=True)]
            counts = [pa.array([sum(s[0] == k for s in b) for b in fixed], pa.int64()) for k in kinds]
            digest = pa.array([hashlib.sha256(written(b).encode()).hexdigest() for b in fixed], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, digest, pa.array([written(e) for e in every], pa.string())], names)

    longs = ", ".join(f"n_{k} long" for k in kinds)
    return text_table(docs).mapInArrow(scan, f"doc_id long, {longs}, base_sha256 string, spans string")
