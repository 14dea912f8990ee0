import datetime
import math

import pytest
from pyspark.sql import functions as F

from creditloom.functions import blank_sentinel, digits_only, to_int_or_null, to_int_trunc
from creditloom.operators import (
    clean_customers,
    clean_loans,
    clean_repayments,
    dedupe,
    impute_floor_mean,
    quality_gate,
    split_defaulters,
    standardise_category,
)
from creditloom.sources.schemas import CUSTOMERS, DEFAULTERS, LOAN_RENAMES, LOANS, REPAYMENT_RENAMES, REPAYMENTS

NAN = float("nan")


def customer(member, emp_length="10 years", income=41_250.0, state="OR", title="Welder"):
    return (member, title, emp_length, "MORTGAGE", income, state, "970xx", "USA", "C", "C4", "Source Verified", 28_400.0, "Joint App", 77_000.0, None)


def customers(spark, *members):
    return spark.createDataFrame(list(members), CUSTOMERS)


def loan(loan_id="1", amount=7_350.0, term="36 months", purpose="car", status="Current", title="t"):
    return (loan_id, "m", amount, 7_200.0, term, 11.75, 238.4, "Sep-2019", status, purpose, title)


def loans(spark, *items):
    return spark.createDataFrame(list(items), LOANS).withColumnsRenamed(LOAN_RENAMES)


def repayments(spark, *items):
    return spark.createDataFrame(list(items), REPAYMENTS).withColumnsRenamed(REPAYMENT_RENAMES)


# --- scalar helpers ---


def test_scalar_casts(spark):
    texts = spark.createDataFrame(
        [("10+ years", " 36"), ("< 1 year", "36.5"), ("n/a", "abc"), ("1.5 years", ""), (None, None)], "e string, t string"
    )
    got = texts.select(digits_only(F.col("e")), to_int_or_null(digits_only(F.col("e"))), to_int_or_null(F.col("t")))
    assert [tuple(r) for r in got.collect()] == [
        ("10", 10, 36),
        ("1", 1, 36),
        ("", None, None),
        ("15", 15, None),
        (None, None, None),
    ]


def test_float_to_int_truncates_and_clamps(spark):
    values = [(2.9,), (-0.9,), (NAN,), (3e9,), (-3e9,), (None,)]
    df = spark.createDataFrame(values, "x float").select(to_int_trunc(F.col("x")).alias("x"))
    assert [r.x for r in df.collect()] == [2, 0, 0, 2**31 - 1, -(2**31), None]
    assert dict(df.dtypes)["x"] == "int"


def test_sentinel_is_exact(spark):
    df = spark.createDataFrame([("0.0",), ("0",), ("0.00",), (None,)], "d string")
    assert [r[0] for r in df.select(blank_sentinel(F.col("d"), "0.0")).collect()] == [None, "0", "0.00", None]


# --- reusable operators ---


def test_quality_gate_splits_without_overlap(spark):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    good, rejected = quality_gate(df, F.col("x").isNull(), "no x")
    assert [tuple(r) for r in good.collect()] == [(1,)]
    assert [tuple(r) for r in rejected.collect()] == [(None, "no x")]


def test_impute_floor_mean(spark):
    df = spark.createDataFrame([(1,), (4,), (4,), (None,)], "x int")
    assert sorted(r.x for r in impute_floor_mean(df, "x").collect()) == [1, 3, 4, 4]
    empty = spark.createDataFrame([(None,), (None,)], "x int")
    assert [r.x for r in impute_floor_mean(empty, "x").collect()] == [None, None]


def test_dedupe_and_category(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("A", 1), (None, 1)], "c string, n int")
    kept = standardise_category(dedupe(df), "c", ["a"], "other")
    assert sorted(r.c for r in kept.collect()) == ["a", "other", "other"]


# --- customers ---


def test_employment_length_is_imputed(spark):
    good, rejected = clean_customers(customers(spark, customer("1"), customer("2", income=6e4), customer("3", None, 7e4)))
    assert {r.member_id: r.emp_length for r in good.collect()} == {"1": 10, "2": 10, "3": 10}
    assert rejected.count() == 0
    assert dict(good.dtypes)["emp_length"] == "bigint"


def test_mean_uses_accepted_distinct_rows_only(spark):
    feed = customers(
        spark,
        customer("1", "1 year"),
        customer("1", "1 year"),  # an exact copy counts once
        customer("2", "6 years"),
        customer("3", "n/a"),
        customer("4", "99 years", income=None),  # rejected, hence not part of the mean
    )
    good, rejected = clean_customers(feed)
    assert {r.member_id: r.emp_length for r in good.collect()} == {"1": 1, "2": 6, "3": 3}
    assert good.count() == 3 and rejected.count() == 1


@pytest.mark.parametrize("state, expected", [("", ""), ("N", "N"), ("NY", "NY"), ("NYC", "NA")])
def test_state_length(spark, state, expected):
    good, _ = clean_customers(customers(spark, customer("1", state=state)))
    assert good.first().address_state == expected


def test_customer_rejects(spark):
    feed = customers(spark, customer("1", income=None), customer("1", income=None), customer("2", state=None), customer("3", income=NAN))
    good, rejected = clean_customers(feed, F.lit(datetime.datetime(2024, 1, 1)))
    assert [r.member_id for r in good.collect()] == ["3"]  # NaN counts as present
    assert sorted(r.member_id for r in rejected.collect()) == ["1", "1", "2"]  # rejects keep copies
    assert {r.reject_reason for r in rejected.collect()} == {"Missing Income or State"}
    assert rejected.columns[-2:] == ["ingest_date", "reject_reason"] and len(rejected.columns) == 17
    assert good.columns[-1] == "ingest_date" and len(good.columns) == 16
    assert good.columns[2] == "emp_length" and good.columns[4:8] == [
        "annual_income",
        "address_state",
        "address_zipcode",
        "address_country",
    ]


# --- loans ---


@pytest.mark.parametrize(
    "term, years",
    [("36 months", 3), (" 36 months", 3), ("60 months", 5), ("18 months", 1), ("36 Months", None), ("36months", None)],
)
def test_loan_term(spark, term, years):
    good, rejected = clean_loans(loans(spark, loan(term=term)))
    assert good.first().loan_term_years == years
    assert rejected.count() == 0


@pytest.mark.parametrize(
    "purpose, expected",
    [("debt_consolidation", "debt_consolidation"), ("credit_card", "credit_card"), ("Car", "other"), ("spaceship", "other")],
)
def test_loan_purpose(spark, purpose, expected):
    assert clean_loans(loans(spark, loan(purpose=purpose))).good.first().loan_purpose == expected


def test_loan_rejects(spark):
    good, rejected = clean_loans(loans(spark, loan("1"), loan("2", amount=None), loan("3", purpose=None), loan("4", title=None)))
    assert sorted(r.loan_id for r in good.collect()) == ["1", "4"]
    assert sorted(r.loan_id for r in rejected.collect()) == ["2", "3"]
    assert {r.reject_reason for r in rejected.collect()} == {"Null values in critical columns"}
    assert good.columns[-2:] == ["ingest_date", "loan_term_years"] and "loan_term_months" not in good.columns
    assert "loan_term_months" in rejected.columns and len(rejected.columns) == 13


def test_loans_without_title_column(spark):
    df = loans(spark, loan("1"), loan("2", amount=None)).drop("loan_title")
    good, rejected = clean_loans(df)
    assert (good.count(), rejected.count()) == (1, 1)


# --- repayments ---


def test_repayments(spark):
    feed = repayments(
        spark,
        ("ok", 1.0, 2.0, 3.0, 6.0, 1.0, "Feb-2021", "0.0"),
        ("repaired", 100.0, 5.0, 1.0, 0.0, 1.0, "0.0", None),
        ("zero", 0.0, 5.0, 1.0, 0.0, 1.0, "Feb-2021", "Feb-2021"),
        ("minus zero", 0.0, 5.0, 1.0, -0.0, 1.0, "Feb-2021", "Feb-2021"),
        ("negative", 1.0, 0.0, 0.0, -5.0, 1.0, None, None),
        ("nan", 1.0, NAN, 0.0, 5.0, 1.0, None, None),
        ("null", 1.0, 0.0, 0.0, 5.0, None, None, None),
        ("null and nan", NAN, 0.0, 0.0, 5.0, None, None, None),
    )
    good, rejected = clean_repayments(feed)
    kept = {r.loan_id: r for r in good.collect()}
    assert set(kept) == {"ok", "repaired", "negative"}
    assert kept["repaired"].total_payment_received == 106.0
    assert (kept["ok"].last_payment_date, kept["ok"].next_payment_date) == ("Feb-2021", None)
    assert kept["repaired"].last_payment_date is None
    assert sorted(r.loan_id for r in rejected.collect()) == ["null", "null and nan"]
    assert rejected.first().reject_reason == (
        "Null values detected in one of: ['total_principal_received', 'total_interest_received', "
        "'total_late_fee_received', 'total_payment_received', 'last_payment_amount']"
    )
    assert dict(good.dtypes)["total_payment_received"] == "float"


# --- defaulters ---


def defaulter(member, delinq=0.0, pub=0.0, bankrupt=0.0, inq=0.0, months=0.0):
    return (member, delinq, 500.0, pub, bankrupt, inq, 0.0, months, 0.0)


def test_split_defaulters(spark):
    feed = spark.createDataFrame(
        [
            defaulter("count", 2.0),
            defaulter("months", months=12.0),
            defaulter("clean"),
            defaulter("part", 0.9),  # truncated to no delinquency
            defaulter("nan months", months=NAN),  # NaN is greater than zero
            defaulter("nulls", None, None, None, None, None),
            defaulter("null months", 1.0, months=None),
        ],
        DEFAULTERS,
    )
    delinq, rec_enq = split_defaulters(feed)
    found = {r.member_id: r for r in delinq.collect()}
    assert set(found) == {"count", "months", "nan months", "null months"}
    assert found["null months"].mths_since_last_delinq is None and found["nan months"].mths_since_last_delinq == 0
    assert [t for _, t in delinq.dtypes] == ["string", "int", "float", "int"]
    assert rec_enq.count() == 7
    assert [t for _, t in rec_enq.dtypes] == ["string", "int", "int", "int"]
    assert tuple(rec_enq.filter("member_id = 'nulls'").first()) == ("nulls", 0, 0, 0)
    assert not any(math.isnan(r.pub_rec) for r in rec_enq.collect())
