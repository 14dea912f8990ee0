"""Reusable cleansing operators: gate, dedup, imputation, category whitelist, payment repair."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "reject_reason"
INGESTED = "ingest_date"


class SplitResult(NamedTuple):
    """Rows that passed and rows that were quarantined (the latter with a ``reject_reason``)."""

    good: DataFrame
    rejected: DataFrame


def quality_gate(df: DataFrame, is_bad: Column, reason: str) -> SplitResult:
    """Split on one condition. Both sides are plain filters, so each reaches the Parquet scan."""
    return SplitResult(df.filter(~is_bad), df.filter(is_bad).withColumn(REASON, F.lit(reason)))


def isolate_corrupt(df: DataFrame, column: str, reason: str) -> SplitResult:
    """Split off rows that the reader could not parse, told by the raw text it kept in ``column``. They keep that text."""
    broken = F.col(column).isNotNull()
    return SplitResult(df.filter(~broken).drop(column), df.filter(broken).withColumn(REASON, F.lit(reason)))


def stamp(df: DataFrame, ingest_ts: Column | None = None) -> DataFrame:
    """Add the ingest time. Pass a fixed ``ingest_ts`` to get one value over several writes of one run."""
    return df.withColumn(INGESTED, F.current_timestamp() if ingest_ts is None else ingest_ts)


def dedupe(df: DataFrame) -> DataFrame:
    """Drop exact copies. Copies collapse before the shuffle, and rows are spread by the hash of the whole row,
    so neither many copies of one row nor many variants of one key fill a single task."""
    return df.dropDuplicates()


def impute_floor_mean(df: DataFrame, column: str) -> DataFrame:
    """Replace NULLs by the floor of the column's mean (all NULL: stays NULL).

    The mean is a scalar subquery: one number, no join, and it is pruned when ``column`` is not selected.
    """
    mean = df.agg(F.floor(F.avg(column))).scalar()
    return df.withColumn(column, F.coalesce(F.col(column), mean))


def standardise_category(df: DataFrame, column: str, allowed: Iterable[str], default: str) -> DataFrame:
    """Keep values of the (case-sensitive) whitelist, map everything else to ``default``."""
    value = F.col(column)
    return df.withColumn(column, F.when(value.isin(*allowed), value).otherwise(default))


def repaired_total() -> Column:
    """The total payment, rebuilt from its parts where it is zero although principal was received."""
    principal, total = F.col("total_principal_received"), F.col("total_payment_received")
    rebuilt = principal + F.col("total_interest_received") + F.col("total_late_fee_received")
    return F.when((principal != 0.0) & (total == 0.0), rebuilt).otherwise(total)


def repair_total_payment(df: DataFrame) -> DataFrame:
    """Rebuild a zero total from its parts where principal was in fact received."""
    return df.withColumn("total_payment_received", repaired_total())
