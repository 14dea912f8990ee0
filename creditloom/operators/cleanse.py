"""One cleansing operator per feed. Each takes the feed as read and returns lazy DataFrames.

``corrupt_column`` names the column in which the reader kept the raw text of rows that it could not parse; those rows are then
rejected as such, whatever else they hold.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions.casts import any_nan, any_null, blank_sentinel, digits_only, to_int_or_null, to_int_trunc
from creditloom.operators.quality import (
    SplitResult,
    dedupe,
    impute_floor_mean,
    isolate_corrupt,
    quality_gate,
    repair_total_payment,
    stamp,
    standardise_category,
)
from creditloom.sources.schemas import CUSTOMER_RENAMES

# --- fixed values: mandatory columns, accepted purposes, sentinels and reject texts ---

CUSTOMER_MANDATORY = ("annual_income", "address_state")
LOAN_MANDATORY = (
    "loan_amount",
    "funded_amount",
    "loan_term_months",
    "interest_rate",
    "monthly_installment",
    "issue_date",
    "loan_status",
    "loan_purpose",
)
REPAYMENT_MANDATORY = (
    "total_principal_received",
    "total_interest_received",
    "total_late_fee_received",
    "total_payment_received",
    "last_payment_amount",
)

LOAN_PURPOSES = (
    "debt_consolidation",
    "credit_card",
    "home_improvement",
    "other",
    "major_purchase",
    "medical",
    "small_business",
    "car",
    "vacation",
    "moving",
    "house",
    "wedding",
    "renewable_energy",
    "educational",
)
OTHER_PURPOSE = "other"
UNKNOWN_STATE = "NA"
NO_DATE = "0.0"
TERM_SUFFIX = " months"

REASON_CUSTOMER = "Missing Income or State"
REASON_LOAN = "Null values in critical columns"
REASON_REPAYMENT = f"Null values detected in one of: {list(REPAYMENT_MANDATORY)}"
REASON_CORRUPT = "Malformed row"


class DefaulterTables(NamedTuple):
    """``delinq``: members with a delinquency. ``rec_enq``: records and enquiries of every member."""

    delinq: DataFrame
    rec_enq: DataFrame


def _apart(cleanse: Callable[[DataFrame, Column | None], SplitResult], df: DataFrame, ingest_ts: Column | None, corrupt_column: str) -> SplitResult:
    """Cleanse the rows that could be parsed; the others join the rejects with a reason of their own and their raw text."""
    whole, broken = isolate_corrupt(df, corrupt_column, REASON_CORRUPT)
    good, rejected = cleanse(whole, ingest_ts)
    broken = stamp(broken.withColumnsRenamed(CUSTOMER_RENAMES), ingest_ts)
    return SplitResult(good, rejected.unionByName(broken, allowMissingColumns=True))


def clean_customers(df: DataFrame, ingest_ts: Column | None = None, corrupt_column: str | None = None) -> SplitResult:
    """Gate, drop exact copies, turn employment length into a number, impute it, blank long state texts.

    The mean that fills missing lengths is taken over accepted, de-duplicated rows.
    """
    if corrupt_column:
        return _apart(clean_customers, df, ingest_ts, corrupt_column)
    renamed = df.withColumnsRenamed(CUSTOMER_RENAMES)
    incomplete = any_null(*CUSTOMER_MANDATORY)
    rejected = quality_gate(stamp(renamed, ingest_ts), incomplete, REASON_CUSTOMER).rejected
    years = dedupe(renamed.filter(~incomplete)).withColumn("emp_length", to_int_or_null(digits_only(F.col("emp_length"))))
    state = F.col("address_state")
    cleaned = impute_floor_mean(years, "emp_length").withColumn(
        "address_state", F.when(F.length(state) > 2, UNKNOWN_STATE).otherwise(state)
    )
    return SplitResult(stamp(cleaned, ingest_ts), rejected)


def clean_loans(df: DataFrame, ingest_ts: Column | None = None, corrupt_column: str | None = None) -> SplitResult:
    """Gate on the mandatory columns, express the term in whole years, standardise the purpose."""
    if corrupt_column:
        return _apart(clean_loans, df, ingest_ts, corrupt_column)
    good, rejected = quality_gate(stamp(df, ingest_ts), any_null(*LOAN_MANDATORY), REASON_LOAN)
    months = to_int_or_null(F.replace(F.col("loan_term_months"), F.lit(TERM_SUFFIX), F.lit("")))
    cleaned = good.withColumn("loan_term_years", (months / 12).cast("int")).drop("loan_term_months")
    return SplitResult(standardise_category(cleaned, "loan_purpose", LOAN_PURPOSES, OTHER_PURPOSE), rejected)


def clean_repayments(df: DataFrame, ingest_ts: Column | None = None, corrupt_column: str | None = None) -> SplitResult:
    """Gate, repair totals, drop rows without any payment, blank placeholder dates.

    NULL amounts are quarantined; NaN amounts are neither good nor quarantined (reconciliation counts them).
    """
    if corrupt_column:
        return _apart(clean_repayments, df, ingest_ts, corrupt_column)
    stamped = stamp(df, ingest_ts)
    incomplete = any_null(*REPAYMENT_MANDATORY)
    rejected = quality_gate(stamped, incomplete, REASON_REPAYMENT).rejected
    # Plain NULL tests reach the scan; NaN tests are checked on the rows that it returns.
    whole = stamped.filter(~incomplete & ~any_nan(*REPAYMENT_MANDATORY))
    paid = repair_total_payment(whole).filter(
        F.col("total_payment_received") != 0.0
    )
    dates = {c: blank_sentinel(F.col(c), NO_DATE) for c in ("last_payment_date", "next_payment_date")}
    return SplitResult(paid.withColumns(dates), rejected)


def is_delinquent() -> Column:
    """On the feed as read: a whole delinquency or any months since the last one."""
    return (to_int_trunc(F.col("delinq_2yrs")) > 0) | (F.col("mths_since_last_delinq") > 0)


def corrupt_defaulters(df: DataFrame, corrupt_column: str, ingest_ts: Column | None = None) -> DataFrame:
    """Defaulter rows that could not be parsed; this feed has no other rejects."""
    return stamp(isolate_corrupt(df, corrupt_column, REASON_CORRUPT).rejected, ingest_ts)


def split_defaulters(df: DataFrame, corrupt_column: str | None = None) -> DefaulterTables:
    """Count columns become ints with 0 for missing; the delinquency table keeps its own subset of the rows."""
    if corrupt_column:
        df = isolate_corrupt(df, corrupt_column, REASON_CORRUPT).good

    def count(column: str) -> Column:
        return F.coalesce(to_int_trunc(F.col(column)), F.lit(0)).alias(column)

    delinq = df.filter(is_delinquent()).select(
        "member_id",
        count("delinq_2yrs"),
        "delinq_amnt",
        to_int_trunc(F.col("mths_since_last_delinq")).alias("mths_since_last_delinq"),
    )
    rec_enq = df.select("member_id", count("pub_rec"), count("pub_rec_bankruptcies"), count("inq_last_6mths"))
    return DefaulterTables(delinq, rec_enq)
