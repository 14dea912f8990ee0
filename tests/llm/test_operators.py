"""Corpus operators against brute-force versions, and on nulls, empty tables, ties and clashing columns."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from creditloom.llm import decontamination, line_dedup, neighbours, personal_data, secrets, simhash, substring_dedup, token_output, toxicity
from creditloom.llm.packing import pack
from creditloom.llm.queries import vocabulary

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, th long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0, "r", 1) for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """NULLs, empty and long texts, repeated ids and rows, columns whose names the operators use themselves."""
    r = np.random.default_rng(0)
    words = ["an", "er", "tion", "st", "lo", "mi", "ka", "re", "be", "to", "of", "idiot"]
    text = lambda n: " ".join(words[k] for k in r.integers(0, 11, n))
    long, passage = text(5000), text(30)
    rows = [(None, None, None), (1, None, "a"), (2, "", "a"), (3, " \n\t ", "b"), (4, long, "a"), (4, long, "a"), (5, long + " end", "b"), (None, passage, "c")]
    rows += [(10 + k, f"{text(40)} {passage} {text(7)}\nall rights reserved here\n{text(4)}", f"s{k}") for k in range(12)]
    return docs_of(spark, rows).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return df.collect()


def test_empty_tables_give_empty_results(spark, none):
    items = spark.createDataFrame([], "item_id long, text string")
    model = toxicity.fit(none, spark.createDataFrame([], "doc_id long, toxic int"))
    for result in (
        simhash.simhash_groups(none), toxicity.toxicity(none, model), toxicity.drop_toxic(none, model), pack(none, vocabulary()), substring_dedup.remove_repeats(none),
        decontamination.contained_items(none, items), line_dedup.remove_repeated_lines(none), personal_data.personal_data(none), secrets.find_secrets(none),
        neighbours.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")),
    ):
        assert rows(result) == []


def test_simhash_links_are_those_of_all_pairs(odd):
    got = rows(simhash.simhash_groups(odd, 4, 4))
    fps = [simhash.fingerprint(r["text"] or "", 4) & (2**64 - 1) for r in odd.collect()]
    ids = [r["doc_id"] for r in odd.collect()]
    root = list(range(len(fps)))
    for _ in fps:
        for i in range(len(fps)):
            for j in range(len(fps)):
                if (fps[i] ^ fps[j]).bit_count() <= 4:
                    root[i] = root[j] = min(root[i], root[j])
    least = {k: min((ids[i] for i in range(len(ids)) if root[i] == k and ids[i] is not None), default=None) for k in set(root)}
    key = lambda p: tuple((x is None, x) for x in p)
    expected = sorted(((ids[i], least[root[i]]) for i in range(len(ids))), key=key)
    assert sorted(((r["doc_id"], r["component_id"]) for r in got), key=key) == expected


def test_near_duplicates_leave_one_row_each(odd):
    kept = rows(simhash.drop_near_duplicates(odd))
    assert [r["doc_id"] for r in kept].count(4) == 1 and kept[0].__fields__ == odd.columns


def test_substring_dedup_against_brute_force(odd):
    known = sorted((r for r in odd.collect() if r["doc_id"] is not None), key=lambda r: r["doc_id"])
    seen, expected = set(), []
    for r in [*known, *(r for r in odd.collect() if r["doc_id"] is None)]:
        w = (r["text"] or "").encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - 19):
            key = tuple(w[k : k + 20])
            if key in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(key)
        expected.append((r["doc_id"], len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone, strict=True) if not g)).hexdigest()))
    for first in (5, 10, 20):
        got = [tuple(r) for r in rows(substring_dedup.remove_repeats(odd, 20, first, with_text=False))]
        assert sorted(got, key=str) == sorted(expected, key=str)


def expected_ids(text, end):
    return Tokenizer.from_file(vocabulary()).encode(text or "", add_special_tokens=False).ids + [end]


def test_packing_holds_every_id_once(odd):
    pieces = rows(pack(odd, vocabulary(), with_ids=True))
    tokens = sum(len(expected_ids(r["text"], 1)) for r in odd.collect())
    assert sum(p["length"] for p in pieces) == tokens
    whole = {tuple(expected_ids(r["text"], 1)) for r in odd.collect()}
    for p in pieces:
        ids = np.frombuffer(p["ids"], "<u4")
        assert zlib.crc32(p["ids"]) == p["ids_crc32"] and len(ids) == p["length"]
        assert any(len(w) == p["doc_tokens"] and w[p["start"] : p["start"] + p["length"]] == tuple(ids.tolist()) for w in whole)
    fill = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == fill.get(p["sequence_id"], 0)
        fill[p["sequence_id"]] = p["offset"] + p["length"]
    assert all(n <= 2048 and n & (n - 1) == 0 for n in fill.values())


def test_token_files_give_back_the_ids(spark, odd, tmp_path):
    token_output.write_tokens(odd, str(tmp_path / "t"), vocabulary(), shard_tokens=500)
    got = rows(token_output.read_tokens(spark, str(tmp_path / "t"), with_ids=True))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["ids"]) for r in got) == sorted((r["doc_id"] is None, r["doc_id"] or 0, expected_ids(r["text"], 2)) for r in odd.collect())
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]


def test_wavelet_matrix_access_rank_select():
    ids = np.random.default_rng(1).integers(0, 50, 3000).astype(np.uint16)
    m = token_output.WaveletMatrix.build(ids, 6)
    assert np.array_equal(m.decode(), ids) and all(m.access(k) == ids[k] for k in range(0, 3000, 37))
    assert m.rank(7) == (ids == 7).sum() and m.rank(7, 1234) == (ids[:1234] == 7).sum()
    assert [m.select(7, k) for k in range(5)] == np.flatnonzero(ids == 7)[:5].tolist()


def test_contained_items_against_counting(spark, odd):
    text = [r["text"] for r in odd.collect() if r["doc_id"] == 12][0]
    items = spark.createDataFrame([(1, " ".join(text.split()[5:40]), 1), (2, "never seen words in any of these texts", 1), (3, None, 1), (4, "", 1)], "item_id long, text string, row long")
    hits = {(r["doc_id"], r["item_id"]) for r in rows(decontamination.contained_items(odd, items))}
    expected = set()
    for d in odd.collect():
        own = set(decontamination.shingle_texts(decontamination.words_of(d["text"] or ""), 5))
        for i in items.collect():
            want = set(decontamination.shingle_texts(decontamination.words_of(i["text"] or ""), 5))
            if want and len(own & want) >= 0.8 * len(want):
                expected.add((d["doc_id"], i["item_id"]))
    assert hits == expected and (12, 1) in hits
    assert decontamination.drop_contaminated(odd, items).count() == odd.count() - len({d for d, _ in hits})


def test_boilerplate_lines_go_but_first(odd):
    got = {r["doc_id"]: r for r in rows(line_dedup.remove_repeated_lines(odd)) if (r["doc_id"] or 0) >= 10}
    assert "all rights" in got[10]["text"] and not any("all rights" in got[k]["text"] for k in range(11, 22))
    assert line_dedup.remove_repeated_lines(odd).count() == odd.count()


def test_folding_and_exception_phrases():
    assert toxicity.folded_words("1d1ot іdiot ID​IOT $$$ 42 end***") == ["idiot", "idiot", "idiot", "end"]
    model = toxicity.ToxicityModel({" idiot ": 3.0, " trash ": 2.0}, [" trash  can "])
    found = toxicity.matches(model.automaton(), "the idiot trash can trash".split())
    assert sum(weight for _, weight, _ in found) == 5.0


def test_toxicity_on_documents_kept_out(spark):
    r = np.random.default_rng(4)
    word = lambda: "".join(r.choice(["an", "er", "ti", "st", "lo"], 3))
    data = [(k, " ".join(word() for _ in range(60)) + (" 1diot " if k % 4 == 0 else " ") + word(), "s") for k in range(400)]
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(400)], "doc_id long, toxic int")
    docs = docs_of(spark, [*data, (None, None, None)])
    model = toxicity.fit(docs, labels, keep=~toxicity.held_out())
    got = {x["doc_id"]: x for x in rows(toxicity.toxicity(docs, model))}
    assert all(got[k]["predicted"] == (k % 4 == 0) for k in range(400)) and got[None]["predicted"] == 0
    assert toxicity.drop_toxic(docs, model).count() == 301


def test_personal_data_patterns_and_field(spark):
    text = "Mail a.b%c@x.com%d@e.fr now 10.0.0.255 or 300.1.1.1, 4111 1111 1111 1111 or +49 (30) 1234-5678."
    found = {(k, text[a:b]) for k, a, b in personal_data.base_spans(text)}
    assert found == {("email", "a.b%c@x.com"), ("email", "%d@e.fr"), ("ip", "10.0.0.255"), ("card", "4111 1111 1111 1111"), ("phone", "+49 (30) 1234-5678")}
    test = personal_data.labelled_sentences(200, seed=5)
    tags = personal_data.Crf(personal_data.labelled_sentences()).decoder().tags([w for w, _ in test])
    truth = [t for _, own in test for t in ("O", *own)]
    assert np.mean([personal_data.TAGS[a] == b for a, b in zip(tags, truth, strict=True)]) > 0.97


def test_viterbi_finds_the_best_path():
    r = np.random.default_rng(0)
    e, change = r.normal(size=(3, 5, 3)), r.normal(size=(3, 3))
    paths = np.stack(np.meshgrid(*[range(3)] * 5, indexing="ij"), -1).reshape(-1, 5)
    for block, got in zip(e, personal_data.viterbi(e, change), strict=True):
        worth = block[np.arange(5), paths].sum(1) + change[paths[:, :-1], paths[:, 1:]].sum(1)
        assert np.array_equal(paths[worth.argmax()], got)


def test_secret_patterns_and_network():
    text = 'API_key = "abcdef" token:x ' + "AKIA" + "Z9" * 8 + " " + "0f" * 12 + " paßword=1234567 PASSWORD:=ok"
    assert [(k, text[a:b]) for k, a, b in secrets.base_spans(text)] == [("assign", 'API_key = "abcdef'), ("access", "AKIA" + "Z9" * 8), ("hex", "0f" * 12)]
    net, test = secrets.train(secrets.labelled_findings()), secrets.labelled_findings(400, seed=9)
    yes = net.score(np.stack([secrets.window(*f[:3]) for f in test])) >= net.threshold
    truth = np.array([f[3] for f in test]) > 0
    assert yes[truth].mean() > 0.9 and yes[~truth].mean() < 0.05


def test_span_tables_cover_every_row(odd):
    for result in (personal_data.personal_data(odd), secrets.find_secrets(odd)):
        assert result.count() == odd.count()


def test_neighbours_recall_ties_and_unusable_vectors(spark):
    v = np.random.default_rng(2).normal(size=(3000, 16))
    v[7] = v[8] = v[9]
    data = [(k, x.tolist(), "x") for k, x in enumerate(v)] + [(3000, None, "x"), (3020, [0.0] * 16, "x"), (3040, [float("nan")] * 16, "x"), (3060, [None] * 16, "x")]
    found = rows(neighbours.nearest(spark.createDataFrame(data, "vec_id long, embedding array<double>, rid string")))
    query = np.arange(0, 3000, 20)
    score = v[query] @ v.T
    score[np.arange(len(query)), query] = -np.inf
    best = {int(q): set(np.argsort(-s)[:20].tolist()) for q, s in zip(query, score, strict=True)}
    got = {}
    for r in found:
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert set(got) == set(best) and all(len(g) == 20 for g in got.values())
    assert np.mean([len(set(got[q]) & best[q]) / 20 for q in best]) >= 0.9
    few = neighbours.nearest(spark.createDataFrame([(0, [1.0, 0.0]), (2, [0.5, 0.0]), (1, [0.5, 0.0])], "vec_id long, embedding array<double>"), F.col("vec_id") == 0)
    assert [tuple(r) for r in few.orderBy("rank").collect()] == [(0, 1, 1, 0.5), (0, 2, 2, 0.5)]
