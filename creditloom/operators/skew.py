"""Hot-key handling for joins on a key that may hold a large share of all rows.

A key is hot when it holds more than twice the rows of an average task: ``rows(key) > 2 * rows(all) / parallelism``.
There can be no more than ``parallelism / 2`` such keys whatever the data volume. The list therefore stays small enough
for the driver and for a broadcast, and all slices together number about ``1.5 * parallelism`` at most, which bounds the
copies that :func:`replicate` makes. The list only steers the data layout: a key that it misses or over-estimates is
still joined exactly. Without hot keys every helper returns its input unchanged and the join stays a plain join.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE = "_slice"
REPEAT_BLOCK = 1 << 13  # copies of one row that a task writes in one go
_HOT = 2  # times the rows of an average task
_MAX_TRACKED = 1_000_000  # upper limit of the sketch

HotKeys = Mapping[str, int]  # key -> number of slices


def hot_keys(frames: Iterable[DataFrame], key: str, parallelism: int | None = None) -> dict[str, int]:
    """Find the hot values of ``key`` over all ``frames``; runs one job and returns at most ``parallelism`` keys.

    The job is one pass over the key column with a mergeable frequent-items sketch, without a shuffle by key. The
    number of slices grows with the share of the key, so each slice holds about one task's worth of rows.
    """
    keys = reduce(DataFrame.unionAll, [f.select(key) for f in frames]).filter(F.col(key).isNotNull())
    n = parallelism or max(2, int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    tracked = min(_MAX_TRACKED, 10 * n)
    # Sketches of the input splits are merged in about sqrt(n) tasks first, so the last merge sees only that many.
    group = (F.spark_partition_id() % isqrt(n)).alias("_group")
    partial = keys.groupBy(group).agg(
        F.expr(f"approx_top_k_accumulate({key}, {tracked})").alias("sketch"), F.count(F.lit(1)).alias("n")
    )
    # Grouped by a constant: no rows in, no row out (sketches cannot be merged from nothing).
    merged = partial.groupBy(F.lit("all")).agg(
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {tracked}), {min(n, tracked)})").alias("top"),
        F.sum("n").alias("n_rows"),
    )
    share = F.col("count") * n / F.col("n_rows")  # in average tasks
    hot = merged.select("n_rows", F.inline("top")).filter(share > _HOT).select("item", F.ceil(share).alias("slices"))
    return {row["item"]: int(row["slices"]) for row in hot.collect()}


def hot_keys_sql(source: str, key: str, parallelism: int) -> str:
    """:func:`hot_keys` as a query text over the table ``source``, with the columns ``key`` and ``slices``.

    For persistent views, which find their hot keys anew each time they are read; at most ``parallelism / 2`` rows.
    """
    tracked = min(_MAX_TRACKED, 10 * parallelism)
    sketches = (
        f"SELECT _group, approx_top_k_accumulate({key}, {tracked}) AS sketch, count(*) AS n "
        f"FROM (SELECT {key}, spark_partition_id() % {isqrt(parallelism)} AS _group FROM {source} WHERE {key} IS NOT NULL) "
        "GROUP BY _group"
    )
    merged = (
        f"SELECT approx_top_k_estimate(approx_top_k_combine(sketch, {tracked}), {min(parallelism, tracked)}) AS top, "
        f"sum(n) AS n_rows FROM ({sketches}) GROUP BY sketch IS NULL"  # one group, or none without rows
    )
    return (
        f"SELECT _t.item AS {key}, CAST(ceil(_t.count * {parallelism} / n_rows) AS INT) AS slices "
        f"FROM ({merged}) LATERAL VIEW inline(top) _t AS item, count WHERE _t.count * {parallelism} / n_rows > {_HOT}"
    )


def spread_sql(source: str, key: str, hot: str, by: str) -> str:
    """:func:`spread` as a query text; ``hot`` names a relation like that of :func:`hot_keys_sql`."""
    salt = f"coalesce(CAST(pmod(xxhash64(spark_partition_id(), _l.{by}), _h.slices) AS INT), 0)"
    return f"SELECT /*+ BROADCAST(_h) */ _l.*, {salt} AS {SLICE} FROM {source} _l LEFT JOIN {hot} _h ON _l.{key} = _h.{key}"


def replicate_sql(source: str, key: str, hot: str) -> str:
    """:func:`replicate` as a query text."""
    return (
        f"SELECT /*+ BROADCAST(_h) */ _l.*, _s.{SLICE} FROM {source} _l LEFT JOIN {hot} _h ON _l.{key} = _h.{key} "
        f"LATERAL VIEW explode(sequence(0, coalesce(_h.slices, 1) - 1)) _s AS {SLICE}"
    )


def repeat_rows_sql(source: str, columns: str, times: str, tasks: int, block: int = REPEAT_BLOCK) -> str:
    """:func:`repeat_rows` as a query text: ``columns`` of ``source``, each row ``times`` times, dealt to ``tasks`` tasks."""
    dealt = (
        f"SELECT /*+ REPARTITION({tasks}, {columns}, _block) */ * "
        f"FROM {source} LATERAL VIEW explode(sequence(0L, ({times} - 1) DIV {block})) _b AS _block"
    )
    return (
        f"SELECT {columns} FROM ({dealt}) "
        f"LATERAL VIEW explode(sequence(1L, least({block}L, {times} - _block * {block}))) _c AS _copy"
    )


def listed(keys: DataFrame, key: str, hot: HotKeys) -> set[str]:
    """Which of the hot keys occur in the frame ``keys`` (at most ``len(hot)`` values reach the driver)."""
    if not hot:
        return set()
    return {row[key] for row in keys.filter(F.col(key).isin(*hot)).select(key).distinct().collect()}


def slice_key(key: str, hot: HotKeys) -> list[str]:
    """Columns to join on."""
    return [key, SLICE] if hot else [key]


def spread(df: DataFrame, key: str, hot: HotKeys, *by: str) -> DataFrame:
    """Give each row a slice number: 0 for ordinary keys, a hash of ``by`` and the input split for hot ones.

    The input split is part of the hash so that exact copies of a row are spread too. Both parts are the same when a
    lost task is run again.
    """
    if not hot:
        return df
    salt = F.pmod(F.xxhash64(F.spark_partition_id(), *by), F.col("slices")).cast("int")
    return _with_slices(df, key, hot).withColumn(SLICE, F.coalesce(salt, F.lit(0))).drop("slices")


def replicate(df: DataFrame, key: str, hot: HotKeys) -> DataFrame:
    """Counterpart of :func:`spread`: one copy of each row per slice of its key."""
    if not hot:
        return df
    slices = F.sequence(F.lit(0), F.coalesce(F.col("slices"), F.lit(1)) - 1)
    return _with_slices(df, key, hot).withColumn(SLICE, F.explode(slices)).drop("slices")


def _with_slices(df: DataFrame, key: str, hot: HotKeys) -> DataFrame:
    rows = df.sparkSession.createDataFrame(list(hot.items()), f"{key} {df.schema[key].dataType.simpleString()}, slices int")
    return df.join(F.broadcast(rows), key, "left")  # at most `parallelism` rows


def repeat_rows(df: DataFrame, times: str | Column, block: int = REPEAT_BLOCK, tasks: int | None = None) -> DataFrame:
    """Repeat each row ``times`` times, in blocks, so that no array grows beyond ``block`` or ``times / block``.

    Blocks are dealt to tasks before they are spelled out, so one row with a very large ``times`` keeps no task busy
    alone. The number of ``tasks`` is given, as adaptive execution would merge them by the few bytes that blocks take; whoever knows
    the number of rows to come can choose it by them (default: as many as the session's shuffles have).
    """
    n = F.col(times) if isinstance(times, str) else times
    blocks = F.sequence(F.lit(0).cast("bigint"), F.floor((n - 1) / block))
    in_block = F.least(F.lit(block).cast("bigint"), n - F.col("_block") * block)
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        df.filter(n > 0)
        .withColumn("_block", F.explode(blocks))
        .repartition(tasks, *df.columns, "_block")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), in_block)))
        .drop("_block", "_copy")
    )
