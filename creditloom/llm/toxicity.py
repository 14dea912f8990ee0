"""Toxicity of whole texts by a weighted lexicon, matched by Aho-Corasick after folding look-alike characters and digits.

The lexicon (whole words and word beginnings), its exception phrases and the curve from matches to a score are learnt from a
bounded sample of labelled documents. Only texts and labels are used.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import findable, stored, text_hash, text_slices, text_table

#: Labelled documents to learn from at most, and lengths of the word beginnings considered.
MAX_LABELLED, BEGINNINGS = 8000, (4, 5, 6)

# Letters of other scripts and the Latin ones they look like.
LOOK_ALIKE = str.maketrans("аеорсхуіјѕԁһӏкмтвαεορτυικν", "aeopcxyijsdhlkmtbaeoptuikv")
# Digits and marks in place of letters.
SUBSTITUTE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
HIDDEN = re.compile("[\u00ad\u200b-\u200f\u2060\ufeff]")
INSIDE = re.compile(r"[013457@$!](?=[013457@$!]*[^\W\d_])")
WORD = re.compile(r"[^\W\d_]+")


def folded_words(text: str) -> list[str]:
    """Words in lower case; look-alikes become Latin letters, and digits and marks before a letter the letters they stand for."""
    if not text.isascii():
        text = HIDDEN.sub("", unicodedata.normalize("NFKC", text)).lower().translate(LOOK_ALIKE)
    return WORD.findall(INSIDE.sub(lambda m: SUBSTITUTE[m[0]], text.lower()))


@dataclass
class ToxicityModel:
    """``weights``: ' word ' or ' beginning' -> weight. ``exceptions``: phrases (' word  word ') that count nothing."""

    weights: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    curve: tuple[float, float, float] = (-2.0, 1.0, 0.0)  # constant, log of summed weights, log of weights a thousand words

    def automaton(self):
        found = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            found.add_word(term, (weight, len(term)))
        for phrase in self.exceptions:
            found.add_word(phrase, (0.0, len(phrase)))
        if len(found):
            found.make_automaton()
        return found

    def score(self, total: np.ndarray, words: np.ndarray) -> np.ndarray:
        x = features(total, words) @ np.array(self.curve)
        return 1 / (1 + np.exp(-x))


def features(total: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(total)), np.log1p(total), np.log1p(1000 * total / (words + 20))], axis=1)


def joined(words: list[str]) -> str:
    """Each word between spaces of its own, so that matches of neighbours never share one."""
    return f" {'  '.join(words)} "


def matches(automaton, words: list[str]) -> list[tuple[int, float, int]]:
    """End, weight and length of the leftmost longest matches."""
    return [(end, *value) for end, value in automaton.iter_long(joined(words))] if len(automaton) and words else []


def _terms(words: list[str]) -> set[str]:
    own = set(words)
    return {f" {w} " for w in own} | {f" {w[:n]}" for n in BEGINNINGS for w in own if len(w) > n}


def _counts(sample: DataFrame, terms: Callable[[list[str]], set[str]]) -> DataFrame:
    """``term``, ``t``, ``c``: toxic and other documents that hold it; counted in each task, then added up."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[int]] = {}
        for batch in text_slices(batches):
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                for term in terms(folded_words(text)):
                    seen.setdefault(term, [0, 0])[0 if toxic else 1] += 1
            if len(seen) > 500_000:
                yield out(seen)
                seen = {}
        if seen:
            yield out(seen)

    def out(seen):
        t, c = zip(*seen.values(), strict=True)
        return pa.RecordBatch.from_arrays([pa.array(seen), pa.array(t, pa.int64()), pa.array(c, pa.int64())], ["term", "t", "c"])

    return sample.mapInArrow(scan, "term string, t long, c long").groupBy("term").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))


def fit(docs: DataFrame, labels: DataFrame, keep: Column | None = None, most: int = MAX_LABELLED) -> ToxicityModel:
    """Learn from at most ``most`` labelled documents (those with the smallest hashes of their ids) for which ``keep`` holds.

    ``labels``: ``doc_id``, ``toxic`` (NULL: not labelled). A term enters the lexicon if toxic documents hold it more often than chance allows over
    all terms tried (likelihood ratio); its weight is its log odds. Without toxic or without other documents the lexicon is empty.
    """
    findable(docs.sparkSession)
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL")
    known = (known if keep is None else known.where(keep)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    sample = stored(text_table(docs).join(F.broadcast(chosen), "doc_id"), "labelled")  # at most ``most`` rows are broadcast
    toxic, other = sample.agg(F.count(F.expr("CASE WHEN toxic > 0 THEN 1 END")), F.count(F.expr("CASE WHEN toxic <= 0 THEN 1 END"))).first()
    if not toxic or not other:
        return ToxicityModel({})
    base = toxic / (toxic + other)
    counts = stored(_counts(sample, _terms), "terms")
    tried = counts.count()
    ratio = F.expr(f"2 * (t * ln(t / ((t + c) * {base})) + CASE WHEN c > 0 THEN c * ln(c / ((t + c) * {1 - base})) ELSE 0 END)")
    strong = counts.where(f"t >= 3 AND t > 2 * (t + c) * {base}").where(ratio > 2 * np.log(4 * tried))
    odds = {r["term"]: float(np.log((r["t"] + 0.5) / (toxic + 1)) - np.log((r["c"] + 0.5) / (other + 1))) for r in strong.collect()}
    weights = {}
    for term in sorted(odds, key=len):  # a longer term only where it says more than the beginning it shares
        shorter = max((weights.get(term[:n], 0.0) for n in range(2, len(term))), default=0.0)
        if odds[term] > 0 and (odds[term] > shorter + 1 or not shorter):
            weights[term] = odds[term]
    model = ToxicityModel(weights)

    def phrases(words: list[str]) -> set[str]:
        text, out = joined(words), set()
        for end, _, size in matches(automaton(), words):
            first = end - size + 1
            stop = text.index(" ", first + 1) + 1
            if stop < len(text):
                out.add(text[first : text.index(" ", stop + 1) + 1])
            if first:
                out.add(text[text.rindex(" ", 0, first - 1) : stop])
        return out

    held = []

    def automaton():
        if not held:
            held.append(ToxicityModel(weights).automaton())
        return held[0]

    harmless = _counts(sample, phrases).where("c >= 3 AND t * 4 <= c").collect()
    model.exceptions = sorted(r["term"] for r in harmless)
    rows = totals(sample, model, "toxic").select("total", "n_words", "toxic").toPandas()  # at most ``most`` documents
    x, y = features(rows["total"].to_numpy(), rows["n_words"].to_numpy()), (rows["toxic"].to_numpy() > 0).astype(float)
    model.curve = tuple(_logistic(x, y).tolist())
    return model


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton's steps on the penalised likelihood."""
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w = w + np.clip(step, -2, 2)
    return w


def totals(texts: DataFrame, model: ToxicityModel, extra: str) -> DataFrame:
    """``doc_id``, the long column ``extra``, ``total`` (summed weights) and ``n_words`` of every row."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.automaton()
        for batch in text_slices(batches):
            found, sizes = [], []
            for text in batch.column("text").to_pylist():
                words = folded_words(text)
                sizes.append(len(words))
                found.append(sum(weight for _, weight, _ in matches(automaton, words)))
            columns = [batch.column("doc_id"), batch.column(extra).cast(pa.int64()), pa.array(found, pa.float64()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", extra, "total", "n_words"])

    return texts.select("doc_id", "text", F.col(extra).cast("long").alias(extra)).mapInArrow(scan, f"doc_id long, {extra} long, total double, n_words long")


def toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id``, ``th`` (tells rows of one id apart), ``score`` from 0 to 1 and ``predicted`` (1 from a score of 0.5) of every row of ``docs``.

    One pass without a shuffle. NULL and empty texts score as a text without a match; rows that repeat an id or a text each get
    their row; a NULL id stays NULL; other columns are not read.
    """
    constant, once, dense = model.curve
    x = F.lit(constant) + F.lit(once) * F.log1p("total") + F.lit(dense) * F.log1p(F.col("total") * 1000 / (F.col("n_words") + 20))
    scored = totals(text_table(docs, text_hash().alias("th")), model, "th").withColumn("score", 1 / (1 + F.exp(-x)))
    return scored.select("doc_id", "th", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "total", "n_words")


def drop_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` without the rows predicted toxic; rows and columns of the others are unchanged."""
    automaton_of = model.automaton

    def judge(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = automaton_of()
        for batch in texts:
            total, size = [], []
            for text in batch.to_pylist():
                words = folded_words(text)
                size.append(len(words))
                total.append(sum(w for _, w, _ in matches(automaton, words)))
            yield pa.array(model.score(np.array(total, float), np.array(size, float)) >= 0.5)

    findable(docs.sparkSession)
    toxic = F.arrow_udf(judge, "boolean")
    return docs.where(~toxic(F.coalesce(F.col("text"), F.lit(""))))


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents kept out of training: every fifth by checksum of the id."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0
