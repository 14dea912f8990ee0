"""Spelling variants against a brute-force version."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from creditloom.llm import spelling
from creditloom.llm.queries import queries
from creditloom.llm.spelling import LOWER, UPPER, Reduced, spelling_variants


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a != b and (a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :])


def expected(rows, shortest=5, least=3, spoil=97):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[a-zÀ-ÿ]+", (text or "").translate(str.maketrans(UPPER, LOWER))):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if spoil and h % spoil == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= shortest
    words = {w: n for w, n in counts.items() if n >= least}
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * n else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items())


def found(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.fixture(scope="module")
def rows(prose):
    long = "ab" * 3000
    odd = [(None, None), (1, ""), (2, " 12 \n"), (None, "ÀÉstran Àéstran àÉSTRAN ×÷×÷×÷ ×÷×÷×÷ ×÷×÷×÷"), (3, f"{long} {long}x {long[1:]}"), (3, f"{long} {long}x {long[1:]}")]
    chain = (200, "planet " * 24 + "planets " * 8 + "planetse " * 3)
    return [*odd, chain, (4, f"{long} {long}x {long[1:]}"), *((10 + k, prose(400)) for k in range(8)), (10, prose(300))]


def test_against_brute_force(documents, rows):
    got = found(spelling_variants(documents(rows), spoil=97))
    assert got == expected(rows)
    assert sum(r[1] is not None for r in got) >= 3 and any(r[1] != r[2] for r in got if r[1])


def test_small_blocks_give_the_same(documents, rows, monkeypatch):
    words = [w for _, text in rows for w in (text or "").split()][:300] + ["aaaaaaaa", "abcabcabc"]
    several = [Reduced([w], 4) for w in words]
    whole = [np.sort(np.concatenate([h for _, h in r.neighbours()])) for r in several]
    monkeypatch.setattr(spelling, "BLOCK", 9)
    assert all(np.array_equal(w, np.sort(np.concatenate([h for _, h in r.neighbours()]))) for w, r in zip(whole, several))


def test_neighbourhood_is_full_and_without_repeats():
    word = "eeebbab"
    reduced = Reduced([word], 4)
    symbols = reduced.s[0].tolist()

    def value(s):
        total = sum((c + 1) * pow(0x9E3779B97F4A7C15, i, 1 << 64) for i, c in enumerate(s)) % (1 << 64)
        return int(Reduced.close(np.array([total], np.uint64), len(s))[0])

    strings = {tuple(symbols)}
    for k in range(len(symbols) + 1):
        strings |= {(*symbols[:k], c, *symbols[k:]) for c in range(4)}
        if k < len(symbols):
            strings |= {(*symbols[:k], c, *symbols[k + 1 :]) for c in range(4)} | {(*symbols[:k], *symbols[k + 1 :])}
    hashes = np.concatenate([h for _, h in reduced.neighbours()]).tolist()
    assert sorted(hashes) == sorted(map(value, strings))


def test_empty_table(documents):
    assert found(spelling_variants(documents([]))) == []


def test_ties_go_to_the_smaller_word(documents):
    text = " ".join(["stone"] * 3 + ["stony"] * 6 + ["stong"] * 6)
    assert found(spelling_variants(documents([(1, text)]))) == [
        ("stone", "stong", "stong", 3, 2, 6), ("stong", None, "stong", 6, 2, None), ("stony", None, "stony", 6, 2, None)
    ]


def test_query_over_the_smallest_tables(spark):
    directory = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{directory}/documents.parquet").select("doc_id", "text").collect()]
    texts = [(i, t) for i, t in rows]
    got = found(queries()["op11_spelling"](spark, directory))
    assert [r[:1] + r[3:4] for r in got] == [r[:1] + r[3:4] for r in expected_counts(texts)]


def expected_counts(rows):
    """As :func:`expected`, without the quadratic search."""
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[a-zÀ-ÿ]+", (text or "").translate(str.maketrans(UPPER, LOWER))):
            h = zlib.crc32(f"{doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 5
    return sorted((w, None, None, n) for w, n in counts.items() if n >= 3)
