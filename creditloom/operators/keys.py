"""Keys that occur more than once, and exclusion of listed keys."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a list's bitmap, 64 bits each.
SLOTS = 1 << 14


def duplicate_keys(frames: Iterable[DataFrame], key: str) -> DataFrame:
    """Distinct keys that occur more than once inside at least one of the frames. NULL counts as one key.

    All frames are counted in one aggregation: rows of a key collapse before the single shuffle, and the grouping
    already makes the result distinct.
    """
    tables = list(frames)
    tagged = [f.select(key, F.lit(i).alias("_table")) for i, f in enumerate(tables)]
    per_table = [F.count_if(F.col("_table") == i).alias(f"_n{i}") for i in range(len(tables))]
    counts = reduce(DataFrame.unionAll, tagged).groupBy(key).agg(*per_table)
    repeated = reduce(Column.__or__, [F.col(f"_n{i}") > 1 for i in range(len(tables))])
    return counts.filter(repeated).select(key)


def exclude_keys(
    df: DataFrame, keys: DataFrame, column: str, null_mode: str = "not_in", on: Iterable[str] = (), bypass: bool = False
) -> DataFrame:
    """Rows of ``df`` whose ``column`` is not in the single-column list ``keys``.

    ``null_mode="not_in"`` follows SQL ``NOT IN``: a NULL in the list removes every row, and a NULL in ``df`` survives
    only an empty list. ``null_mode="ignore"`` matches non-NULL keys only. Either way the work is an ordinary anti
    join, which can be sort-merged when the list is too large to broadcast; a literal NOT IN cannot.
    ``on`` names further join columns present in both inputs (a slice number, for instance).

    ``bypass`` reads ``df`` twice in place of shuffling it: rows whose key is surely not listed, told by a bitmap of the list, stay
    where they are, so a key with many rows that is not listed is never brought together; only the others meet the list.
    It pays where ``df`` is stored and few rows are listed. The bitmap has a fixed size; the longer the list, the fewer
    rows it lets by.
    """
    check_null_mode(null_mode)
    # An inferred list may hold numbers where the keys are text; compare in the type of the keys.
    keys = keys.select(F.col(column).cast(df.schema[column].dataType).alias(column), *on)
    if not bypass:
        kept = df.join(keys, [column, *on], "left_anti")
        if null_mode == "ignore":
            return kept
        return kept.filter(nothing_unknown(keys, column)).filter(F.col(column).isNotNull() | is_empty(keys))
    bitmap = list_bitmap(keys, column)
    place = F.pmod(F.xxhash64(column), F.lit(64 * SLOTS))
    flagged = df.withColumns({"_slot": F.shiftright(place, 6), "_bit": (place % 64).cast("int")})
    flagged = flagged.join(F.broadcast(bitmap.select("_slot", "_bits")), "_slot", "left")  # at most SLOTS rows
    maybe = F.coalesce(F.getbit("_bits", F.col("_bit")) == 1, F.lit(False))
    surely_not, others = (flagged.filter(c).select(*df.columns) for c in (~maybe, maybe))
    kept = surely_not.unionAll(others.join(keys, [column, *on], "left_anti"))
    if null_mode == "ignore":
        return kept
    # Both facts about the list come from the bitmap's few rows.
    known = bitmap.agg(F.coalesce(F.sum("_nulls"), F.lit(0)) == 0).scalar()
    empty = bitmap.agg(F.count(F.lit(1)) == 0).scalar()
    return kept.filter(known).filter(F.col(column).isNotNull() | empty)


def list_bitmap(keys: DataFrame, column: str) -> DataFrame:
    """The list as a bitmap over hashes: ``_slot``, ``_bits`` (64 of them) and ``_nulls``, in at most ``SLOTS`` rows."""
    place = F.pmod(F.xxhash64(column), F.lit(64 * SLOTS))
    bit = F.expr("shiftleft(1L, CAST(_place % 64 AS INT))")
    return (
        keys.select(column, place.alias("_place"))
        .groupBy(F.shiftright("_place", 6).alias("_slot"))
        .agg(F.bit_or(bit).alias("_bits"), F.count_if(F.col(column).isNull()).alias("_nulls"))
    )


def check_null_mode(null_mode: str) -> None:
    if null_mode not in ("not_in", "ignore"):
        raise ValueError(f"null_mode must be 'not_in' or 'ignore', not {null_mode!r}")


def nothing_unknown(keys: DataFrame, column: str) -> Column:
    """True unless the list holds a NULL; a scalar subquery over the list."""
    return keys.agg(F.count_if(F.col(column).isNull()) == 0).scalar()


def is_empty(keys: DataFrame) -> Column:
    return keys.agg(F.count(F.lit(1)) == 0).scalar()
