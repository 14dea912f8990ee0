"""Packing by its rule, token memory, whole chains, clashing columns."""

import re

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from creditloom.llm import line_dedup, personal_data, secrets
from creditloom.llm.packing import SumOfSquares, pack
from creditloom.llm.queries import vocabulary
from creditloom.llm.tokens import WordTokens, read_tokenizer

SF = "/root/testdata/sf0.001"


def test_each_piece_goes_where_the_sum_of_squares_is_least():
    r = np.random.default_rng(0)
    state, capacity = SumOfSquares(40), 40
    counts = np.zeros(capacity + 1, int)
    for size in r.integers(1, 40, 600).tolist():
        def total(level):
            after = counts.copy()
            after[level] -= level > 0
            after[level + size] += level + size < capacity
            return int((after**2).sum())

        levels = [0, *(h for h in range(1, capacity - size + 1) if counts[h])]
        level = min(levels, key=lambda h: (total(h), -h))
        counts[level] -= level > 0
        counts[level + size] += level + size < capacity
        state.place("x", size)
        assert np.array_equal(state.counts, counts)


def test_few_open_windows_lose_nothing(spark, documents, prose):
    texts = [(k, prose(30 + 17 * k % 260)) for k in range(120)] + [(500, prose(900)), (501, ""), (None, None)]
    for most_open in (1, 4, 256):
        pieces = pack(documents(texts).coalesce(1), vocabulary(), 128, most_open=most_open, with_ids=True).collect()
        by_doc = {}
        for p in pieces:
            by_doc.setdefault(p["doc_id"], []).append(p)
        tokenizer = Tokenizer.from_file(vocabulary())
        for doc, text in texts:
            own = sorted(by_doc[doc], key=lambda p: p["start"])
            ids = [i for p in own for i in np.frombuffer(p["ids"], "<u4").tolist()]
            assert ids == tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        filled = {}
        for p in pieces:
            filled[p["sequence_id"]] = filled.get(p["sequence_id"], 0) + p["length"]
        assert all(n == 128 or n & (n - 1) == 0 for n in filled.values())


@pytest.mark.parametrize("most", [3, 300_000])
def test_ids_are_those_of_whole_texts_whatever_is_remembered(prose, most):
    words = WordTokens(read_tokenizer(vocabulary()), most)
    odd = ["", "a  b\t\n c", "Don't stop—me's NOW...", "İstanbul ſ ß ÅÄ Å(Å)", "x y\r\nz w", "  ", f"{words.special[0]} mid{words.special[-1]}dle.", "ALL caps, 'tis 12:30!?"]
    for _ in range(3):
        texts = [*odd, prose(50), prose(5) + ".", odd[3]]
        ids, ends = words.encode(pa.array(texts), 7)
        for got, text in zip(np.split(ids, ends[:-1]), texts, strict=True):
            assert got.tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids + [7]
    assert words.encode(pa.array([], pa.string()), 7)[0].tolist() == []


def test_spans_do_not_depend_on_layout(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    layouts = [docs.coalesce(1), docs.repartition(7, "text"), docs.repartition(3).sortWithinPartitions("text")]
    found = [sorted(tuple(r) for r in personal_data.personal_data(d).collect()) for d in layouts]
    assert found[0] == found[1] == found[2]


def test_chains_cut_at_certain_words_give_the_best_path():
    crf = personal_data.Crf(personal_data.labelled_sentences())
    decoder = crf.decoder()
    for words, _ in personal_data.labelled_sentences(60, seed=8):
        words = words * 3
        kinds = np.array([0, *map(decoder.__getitem__, words), 0])
        table = np.stack(decoder.rows)
        e = table[kinds, 0]
        e[1:] += table[kinds[:-1], 1]
        e[:-1] += table[kinds[1:], 2]
        e[0] += table[0, 1]
        e[[0, -1]] = [0] + [-1e4] * (len(personal_data.TAGS) - 1)
        whole = personal_data.viterbi(e[None].astype(np.float64), crf.change.astype(np.float64))[0]
        assert np.array_equal(decoder.tags([words])[1:], whole[1:-1])


def test_added_spans_on_sentences_kept_out():
    """Precision and recall of whole tagged runs over sentences with look-alikes, from another seed."""
    decoder = personal_data.Crf(personal_data.labelled_sentences()).decoder()
    test = personal_data.labelled_sentences(600, seed=77)
    tags, at, right, found, wanted = decoder.tags([w for w, _ in test]), 0, 0, 0, 0
    for words, truth in test:
        mine = [personal_data.TAGS[t] for t in tags[at + 1 : at + 1 + len(words)]]
        at += 1 + len(words)

        def runs(own):
            edges = [0, *(k for k in range(1, len(own)) if own[k] != own[k - 1]), len(own)]
            return {(a, b, own[a]) for a, b in zip(edges, edges[1:]) if a < b and own[a] != "O"}

        right, found, wanted = right + len(runs(mine) & runs(truth)), found + len(runs(mine)), wanted + len(runs(truth))
    print("precision", right / found, "recall", right / wanted)
    assert right / found > 0.9 and right / wanted > 0.8


def plain_spans(text, pattern, flags=0):
    return [m.span() for m in re.finditer(pattern, text, flags)]


def test_base_spans_over_a_table(spark):
    """The contract's patterns as they are written, over whole texts."""
    texts = [r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    some = 0
    for text in texts:
        email = plain_spans(text, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
        ip = [(a, b) for a, b in plain_spans(text, r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)") if all(int(p) <= 255 for p in text[a:b].split("."))]
        digits = lambda a, b: [int(c) for c in text[a:b] if c.isdigit()]
        card = [(a, b) for a, b in plain_spans(text, r"[0-9]([\x20-]?[0-9])+") if 12 <= len(digits(a, b)) <= 19 and personal_data.luhn(digits(a, b))]
        phone = [(a, b) for a, b in plain_spans(text, r"\+[0-9][\x20().0-9-]+[0-9]") if 9 <= len(digits(a, b)) <= 15]
        want = {(k, *s) for k, spans in (("email", email), ("ip", ip), ("card", card), ("phone", phone)) for s in spans}
        assert set(personal_data.base_spans(text)) == want
        assign = [
            m.span() for m in re.finditer(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text, re.IGNORECASE | re.ASCII)
            if len(m[2]) >= 6
        ]
        access = [(a, b) for a, b in plain_spans(text, r"AKIA[A-Z0-9]+") if b - a >= 20]
        hexes = [(a, b) for a, b in plain_spans(text, r"[0-9a-f]+") if b - a >= 24]
        want_secrets = {(k, *s) for k, spans in (("assign", assign), ("access", access), ("hex", hexes)) for s in spans}
        assert set(secrets.base_spans(text)) == want_secrets
        some += len(want) + len(want_secrets)
    assert some > 20


def test_line_counts_take_the_place_of_like_columns(spark):
    docs = spark.createDataFrame([(k, "all rights reserved\nown " + str(k), f"s{k}", -1, -2) for k in range(12)], "doc_id long, text string, source string, n_lines int, n_removed int")
    kept = line_dedup.remove_repeated_lines(docs, counts=True)
    assert kept.columns == ["doc_id", "text", "source", "n_lines", "n_removed"]
    assert [(r["n_lines"], r["n_removed"]) for r in kept.orderBy("doc_id").collect()] == [(2, 0)] + [(2, 1)] * 11
    plain = line_dedup.remove_repeated_lines(docs)
    assert plain.columns == docs.columns and {r["n_lines"] for r in plain.collect()} == {-1}
