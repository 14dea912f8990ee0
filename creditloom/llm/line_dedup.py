"""Boilerplate lines: those found on many distinct sites."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import stored, text_hash, text_table

#: Sites from which a line is boilerplate; words (single spaces apart) below which a line never is; HLL's log2 of registers.
MIN_SITES, MIN_WORDS, LOG_K = 8, 3, 12

COUNTS = ("n_lines", "n_removed")


def _lines(docs: DataFrame, site: str, min_words: int) -> DataFrame:
    """Every counted line as two independent hashes with its site, document and number."""
    line = F.trim("line")
    words = F.length(line) - F.length(F.replace(line, F.lit(" "))) + 1
    return (
        text_table(docs, text_hash().alias("th"), F.col(site).cast("string").alias("site"))
        .select("doc_id", "th", "site", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
        .where(words >= min_words)
        .select(F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2"), "site", "doc_id", "th", "pos")
    )


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, log_k: int = LOG_K) -> DataFrame:
    """``h1``, ``h2`` of the lines on at least ``min_sites`` distinct sites (NULL is not a site).

    One HyperLogLog sketch of the sites a line, merged by aggregation. Sketches decide where they are clear of the
    threshold by three standard errors and at least one site; lines nearer to it get exact distinct counts.
    """
    error = max(1.0, 3 * 1.04 / math.sqrt(1 << log_k) * min_sites)
    spread = stored(
        lines.groupBy("h1", "h2")
        .agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", log_k)).alias("sites"))
        .where(F.col("sites") >= min_sites - error),
        "line-spread",
    )
    clear = spread.where(F.col("sites") > min_sites + error).select("h1", "h2")
    near = spread.where(F.col("sites") <= min_sites + error).select("h1", "h2")
    exact = (
        lines.join(near, ["h1", "h2"], "left_semi")
        .where("site IS NOT NULL")
        .groupBy("h1", "h2", "site")
        .agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2")
        .count()
        .where(F.col("count") >= min_sites)
        .select("h1", "h2")
    )
    return clear.unionByName(exact)


def repeated_lines(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id``, ``th`` and ``gone`` (numbers of the lines that go, from 0) for each row of ``docs`` that loses lines.

    The first occurrence of a boilerplate line, by ``doc_id`` (NULL last) and line number, stays.
    """
    lines = stored(_lines(docs, site, min_words), "lines")
    place = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("pos").alias("p"))
    found = lines.join(stored(boilerplate(lines, min_sites), "boilerplate"), ["h1", "h2"])
    first = found.groupBy("h1", "h2").agg(F.min(place).alias("first"))
    return (
        found.join(first, ["h1", "h2"])
        .where(place > F.col("first"))
        .groupBy("doc_id", "th")
        .agg(F.collect_set("pos").alias("gone"))  # at most the lines of one document
    )


def kept_text(text: Column, gone: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line, at: ~F.array_contains(gone, at))
    return F.when(gone.isNull(), text).otherwise(F.array_join(lines, "\n"))


def remove_repeated_lines(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, min_words: int = MIN_WORDS, counts: bool = False) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``; with ``counts`` also ``n_lines`` before and ``n_removed``.

    A line is what stands between two line feeds; spaces at its ends do not count. Every row stays, also one that is empty
    afterwards; a NULL text has no line and stays NULL, an empty text has one. Lines of rows without a site never count towards
    the spread, yet go if they are boilerplate elsewhere. Rows that repeat an id are told apart by their text; equal rows
    lose the same lines, and as neither comes before the other, first occurrences stay in both. Other columns, whatever
    their names, are passed through; only with ``counts`` these take the place of columns of their own names. An empty table
    gives no rows; lines and texts of any length are whole.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    held = docs.select(row, F.col("doc_id").cast("long").alias("i"), text_hash().alias("t"))
    gone = repeated_lines(docs, site, min_sites, min_words).select(F.col("doc_id").alias("gi"), F.col("th").alias("gt"), "gone")
    text = F.col("row").getField("text")
    joined = held.join(gone, F.col("i").eqNullSafe(F.col("gi")) & (F.col("t") == F.col("gt")), "left")
    n_lines = F.when(text.isNull(), F.lit(0)).otherwise(F.size(F.split(text, "\n"))).cast("long")
    n_removed = F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.size("gone")).cast("long")
    return joined.select(
        *[(kept_text(text, F.col("gone")) if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns if not counts or c not in COUNTS],
        *[n.alias(c) for n, c in zip((n_lines, n_removed), COUNTS, strict=True)][: 2 * counts],
    )


#: DuckDB: exact distinct counts over whole lines.
ORACLE = """
WITH held AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT doc_id, source, l.pos - 1 AS pos, l.line AS line, trim(l.line, ' ') AS bare
  FROM (SELECT doc_id, source, unnest(list_transform(string_split(text, chr(10)), lambda x, i: {'line': x, 'pos': i})) AS l FROM held)),
counted AS (SELECT * FROM lines WHERE length(bare) - length(replace(bare, ' ', '')) >= 2),
boiler AS (SELECT bare, min((doc_id, pos)) AS first FROM counted GROUP BY bare HAVING count(DISTINCT source) >= 8),
gone AS (SELECT c.doc_id, c.pos FROM counted c JOIN boiler b USING (bare) WHERE (c.doc_id, c.pos) > b.first)
SELECT l.doc_id, count(*) AS n_lines, count(g.pos) AS n_removed,
       md5(coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (g.pos IS NULL), '')) AS kept_md5
FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos
GROUP BY l.doc_id
"""
