"""Account for every input row of every feed."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions.casts import any_nan, any_null
from creditloom.operators.cleanse import CUSTOMER_MANDATORY, LOAN_MANDATORY, REPAYMENT_MANDATORY, is_delinquent
from creditloom.operators.quality import repaired_total
from creditloom.sources.schemas import CUSTOMER_RENAMES, T_CUSTOMERS, T_DELINQ, T_LOANS, T_REC_ENQ, T_REPAYMENTS

COUNTS = ("total", "success", "rejected", "duplicates", "zero_total", "nan_amount", "delinq", "rec_enq")


def _row(feed: str, counted: DataFrame, **counts: Column) -> DataFrame:
    """Aggregate one feed to one row; counts that do not apply are NULL."""
    aggregates = [F.coalesce(counts[c], F.lit(0)).alias(c) for c in counts]
    missing = {c: F.lit(None).cast("bigint") for c in COUNTS if c not in counts}
    return counted.agg(*aggregates).withColumns({"feed": F.lit(feed), **missing}).select("feed", *COUNTS)


def _broken(corrupt_column: str | None) -> Column:
    return F.col(corrupt_column).isNotNull() if corrupt_column else F.lit(False)


def count_customers(raw: DataFrame, stored: Column | None = None, corrupt_column: str | None = None) -> DataFrame:
    """Identical rows are grouped with their number, so one aggregation yields total, duplicates and rejects.

    With ``stored``, the number of rows kept, no rows are grouped: what passed the gate and was not kept is a copy.
    """
    named, bad = raw.withColumnsRenamed(CUSTOMER_RENAMES), any_null(*CUSTOMER_MANDATORY) | _broken(corrupt_column)
    if stored is not None:
        passed = F.count_if(~bad)
        total, rejected = F.count(F.lit(1)), F.count_if(bad)
        return _row("customers", named, total=total, success=stored, rejected=rejected, duplicates=passed - stored)
    groups = named.groupBy(*named.columns).agg(F.count(F.lit(1)).alias("_copies"))
    copies = F.col("_copies")
    return _row(
        "customers",
        groups,
        total=F.sum(copies),
        success=F.count_if(~bad),
        rejected=F.sum(F.when(bad, copies)),
        duplicates=F.sum(F.when(~bad, copies - 1)),
    )


def loan_counts(corrupt_column: str | None = None) -> dict[str, Column]:
    """Aggregates over the loans feed."""
    bad = any_null(*LOAN_MANDATORY) | _broken(corrupt_column)
    return {"total": F.count(F.lit(1)), "success": F.count_if(~bad), "rejected": F.count_if(bad)}


def repayment_counts(corrupt_column: str | None = None) -> dict[str, Column]:
    """Aggregates over the repayments feed."""
    missing, nan = any_null(*REPAYMENT_MANDATORY) | _broken(corrupt_column), any_nan(*REPAYMENT_MANDATORY)
    usable, paid = ~missing & ~nan, repaired_total() != 0.0
    return {
        "total": F.count(F.lit(1)),
        "success": F.count_if(usable & paid),
        "rejected": F.count_if(missing),
        "zero_total": F.count_if(usable & ~paid),
        "nan_amount": F.count_if(~missing & nan),
    }


def defaulter_counts(corrupt_column: str | None = None) -> dict[str, Column]:
    """Aggregates over the defaulters feed. Its two tables overlap, so their sizes are shown without a balance check."""
    broken = _broken(corrupt_column)
    rejected = {"rejected": F.count_if(broken)} if corrupt_column else {}
    both = {"delinq": F.count_if(is_delinquent() & ~broken), "rec_enq": F.count_if(~broken)}
    return {"total": F.count(F.lit(1)), **both, **rejected}


def count_loans(raw: DataFrame, corrupt_column: str | None = None) -> DataFrame:
    return _row("loans", raw, **loan_counts(corrupt_column))


def count_repayments(raw: DataFrame, corrupt_column: str | None = None) -> DataFrame:
    return _row("repayments", raw, **repayment_counts(corrupt_column))


def count_defaulters(raw: DataFrame, corrupt_column: str | None = None) -> DataFrame:
    return _row("defaulters", raw, **defaulter_counts(corrupt_column))


#: Feeds whose good rows are written without a shuffle, so that counting while writing sees every row once even if tasks
#: are run again on other executors; what is counted before a shuffle may be counted twice then.
COUNTED_WHILE_WRITTEN = {"loans": loan_counts, "repayments": repayment_counts, "defaulters": defaulter_counts}


def reconcile_written(
    customers: DataFrame, seen: Mapping[str, Mapping[str, int]], stored: Mapping[str, int], corrupt_column: str | None = None
) -> DataFrame:
    """:func:`reconcile` from counts that arose while the tables were written: ``seen`` by feed, ``stored`` rows by table.

    Only the customers are read again, in their mandatory columns.
    """
    proofs = {(feed, column): stored[table] for table, (feed, column) in _PROOF.items() if table in stored}
    lines = []
    for feed, counts in seen.items():
        known = dict(counts) | {column: n for (of, column), n in proofs.items() if of == feed}
        lines.append((feed, *(known.get(c) for c in COUNTS)))
    schema = "feed string, " + ", ".join(f"{c} bigint" for c in COUNTS)
    people = count_customers(customers, F.lit(stored[T_CUSTOMERS]).cast("bigint"), corrupt_column)
    people = people.withColumn("rejected", F.lit(stored[f"{T_CUSTOMERS}_rejected"]).cast("bigint"))
    return _balance(people.unionAll(customers.sparkSession.createDataFrame(lines, schema)))


def _balance(counts: DataFrame) -> DataFrame:
    unaccounted = F.col("total") - F.col("success") - F.col("rejected")
    return counts.withColumns({"unaccounted": unaccounted, "balanced": unaccounted == 0})


def reconcile(
    feeds: Mapping[str, DataFrame], written: Mapping[str, DataFrame] | None = None, corrupt_column: str | None = None
) -> DataFrame:
    """One row per feed: total, success, rejected, unaccounted and its breakdown, balanced.

    ``balanced`` is the plain check ``success + rejected = total``; removed duplicates, zero payments and NaN amounts
    make it false, and ``unaccounted`` equals their sum when nothing was lost. Each feed is read once. With ``written``
    (``{"customers": table, "customers_rejected": table, ...}``), success and rejected are the rows actually stored. Rows with a text in ``corrupt_column`` count as rejected.
    """
    stored = {name: df.agg(F.count(F.lit(1))).scalar() for name, df in (written or {}).items()}
    counters = {
        "customers": lambda raw, corrupt: count_customers(raw, stored.get(T_CUSTOMERS), corrupt),
        "loans": count_loans,
        "repayments": count_repayments,
        "defaulters": count_defaulters,
    }
    counts = reduce(DataFrame.unionAll, [counters[name](df, corrupt_column) for name, df in feeds.items()])
    for table, size in stored.items():
        feed, column = _PROOF[table]
        counts = counts.withColumn(column, F.when(F.col("feed") == feed, size).otherwise(F.col(column)))
    return _balance(counts)


# Stored table -> (feed, count it proves)
_PROOF = {
    T_CUSTOMERS: ("customers", "success"),
    f"{T_CUSTOMERS}_rejected": ("customers", "rejected"),
    T_LOANS: ("loans", "success"),
    f"{T_LOANS}_rejected": ("loans", "rejected"),
    T_REPAYMENTS: ("repayments", "success"),
    f"{T_REPAYMENTS}_rejected": ("repayments", "rejected"),
    T_DELINQ: ("defaulters", "delinq"),
    T_REC_ENQ: ("defaulters", "rec_enq"),
    f"{T_REC_ENQ}_rejected": ("defaulters", "rejected"),
}
