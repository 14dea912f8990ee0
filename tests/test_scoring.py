from decimal import Decimal
from itertools import product

import pytest
from pyspark.sql import functions as F

from creditloom.operators import ScoreParams, gold, grade, ledger, loan_points, payment_history, points

NAN = float("nan")
P = ScoreParams()


def values(spark, expression, schema, data):
    return [r[0] for r in spark.createDataFrame(data, schema).select(F.expr(expression)).collect()]


@pytest.fixture(scope="module")
def tables(spark):
    """One member with a loan half way: some points of every level."""
    make = spark.createDataFrame
    return {
        "customers": make([("ada", "RENT", "B", "B3", 40_000.0)], "member_id string, home_ownership string, grade string, sub_grade string, total_high_credit_limit double"),
        "loans": make([("K7", "ada", 6_000.0, "Current", 250.0)], "loan_id string, member_id string, funded_amount double, loan_status string, monthly_installment double"),
        "loans_repayments": make([("K7", 2_000.0, 500.0)], "loan_id string, total_payment_received double, last_payment_amount double"),
        "loans_defaulters_delinq": make([("ada", 1, 35.5, 7)], "member_id string, delinq_2yrs int, delinq_amnt double, mths_since_last_delinq int"),
        "loans_defaulters_detail_rec_enq": make([("ada", 0, 2, 4)], "member_id string, pub_rec int, pub_rec_bankruptcies int, inq_last_6mths int"),
    }


@pytest.fixture(scope="module")
def nobody(spark):
    return spark.createDataFrame([("bo",)], "member_id string")


def doubled(tables, old="ada", new="bo", loan="K9"):
    """The same rows again for a second member."""
    more = {}
    for name, df in tables.items():
        copy = df
        if "member_id" in df.columns:
            copy = copy.withColumn("member_id", F.regexp_replace("member_id", old, new))
        if "loan_id" in df.columns:
            copy = copy.withColumn("loan_id", F.lit(loan))
        more[name] = df.unionByName(copy)
    return more


def test_golden_row(tables, nobody):
    scored = grade(gold(tables, nobody))
    assert [tuple(r) for r in scored.collect()] == [
        ("ada", Decimal("260.00"), Decimal("630.00"), Decimal("782.2500"), "HIGH_RISK")
    ]
    assert [t for _, t in scored.dtypes] == ["string", "decimal(13,2)", "decimal(13,2)", "decimal(16,4)", "string"]


def test_stacked_tables(tables, nobody):
    assert [tuple(r) for r in payment_history(tables, nobody).collect()] == [("ada", 800, 500)]
    assert [tuple(r) for r in ledger(tables, nobody).collect()] == [("ada", 800, 500, 250, 800, 250, 100)]
    assert payment_history(tables, nobody).columns == ["member_id", "last_payment_pts", "total_payment_pts"]
    assert ledger(tables, nobody).columns[3:] == ["delinq_pts", "public_records_pts", "public_bankruptcies_pts", "enq_pts"]


def test_excluded_member_is_removed_everywhere(spark, tables, nobody):
    both = doubled(tables)
    nothing = spark.createDataFrame([], "member_id string")
    for build in (payment_history, ledger, gold):
        assert {r.member_id for r in build(both, nothing).collect()} == {"ada", "bo"}
        assert {r.member_id for r in build(both, nobody).collect()} == {"ada"}


def test_null_in_the_list_empties_the_scores(spark, tables):
    with_null = spark.createDataFrame([("bo",), (None,)], "member_id string")
    for build in (payment_history, ledger, gold):
        assert build(tables, with_null).count() == 0
        assert build(tables, with_null, null_mode="ignore").count() == 1
    with pytest.raises(ValueError):
        gold(tables, with_null, null_mode="sometimes")


def test_member_without_delinquency_has_no_score(tables, nobody):
    clean = tables | {"loans_defaulters_delinq": tables["loans_defaulters_delinq"].filter("false")}
    assert gold(clean, nobody).count() == 0 and ledger(clean, nobody).count() == 0
    assert payment_history(clean, nobody).count() == 1


def two_loans(tables):
    second = tables["loans"].withColumns({"loan_id": F.lit("K8"), "loan_status": F.lit("Fully Paid")})
    paid = tables["loans_repayments"].withColumns({"loan_id": F.lit("K8"), "last_payment_amount": F.lit(100.0)})
    return tables | {
        "loans": tables["loans"].unionByName(second),
        "loans_repayments": tables["loans_repayments"].unionByName(paid),
    }


def test_member_grain_pairs_repayments_with_loans(tables, nobody):
    found = sorted((float(r.payment_history_pts), float(r.financial_health_pts)) for r in gold(two_loans(tables), nobody).collect())
    assert found == sorted(product([260.0, 120.0], [782.25, 887.25]))


def test_loan_grain_scores_each_repayment_with_its_loan(tables, nobody):
    found = gold(two_loans(tables), nobody, grain="loan")
    assert sorted((r.loan_id, float(r.payment_history_pts), float(r.financial_health_pts)) for r in found.collect()) == [
        ("K7", 260.0, 782.25),
        ("K8", 120.0, 887.25),
    ]
    assert {r.row_count for r in gold(two_loans(tables), nobody, grain="loan", weighted=True).collect()} == {1}
    with pytest.raises(ValueError):
        gold(tables, nobody, grain="branch")


def test_duplicate_rows_multiply(spark, tables, nobody):
    """Rows that no list excludes count as often as they occur, in every input."""
    doubled_rows = {name: df.unionAll(df) for name, df in tables.items()}
    assert payment_history(doubled_rows, nobody).count() == 4
    assert ledger(doubled_rows, nobody).count() == 16
    assert gold(doubled_rows, nobody).count() == 16 * 4
    weighted = gold(doubled_rows, nobody, weighted=True).collect()
    assert [r.row_count for r in weighted] == [64]


# --- point rules ---


def test_last_payment_bands(spark):
    paid = [(0.0, 100.0), (49.0, 100.0), (50.0, 100.0), (99.0, 100.0), (100.0, 100.0), (101.0, 100.0), (150.0, 100.0), (151.0, 100.0)]
    unusual = [(NAN, 100.0), (None, 100.0), (100.0, None), (NAN, NAN), (-6.0, -10.0), (-10.0, -10.0)]
    got = values(spark, points.last_payment_points(P), "last_payment_amount float, monthly_installment float", paid + unusual)
    assert got == [100, 100, 100, 100, 500, 650, 650, 800] + [800, 0, 0, 500, 100, 100]


def test_total_payment_bands(spark):
    data = [(50.0, 100.0), (49.0, 100.0), (0.0, 100.0), (None, 100.0), (-1.0, 100.0), (10.0, None), (0.0, None), (NAN, 100.0), (5.0, NAN), (0.0, 0.0)]
    got = values(spark, points.total_payment_points(P), "total_payment_received float, funded_amount float", data)
    assert got == [650, 500, 0, 0, None, None, 0, 650, 500, 650]


@pytest.mark.parametrize(
    "rule, column, worst",
    [
        (points.delinquency_points, "delinq_2yrs", 750),
        (points.public_record_points, "pub_rec", 100),
        (points.bankruptcy_points, "pub_rec_bankruptcies", 100),
        (points.enquiry_points, "inq_last_6mths", 0),
    ],
)
def test_count_bands(spark, rule, column, worst):
    data = [(n,) for n in (0, 1, 2, 3, 5, 6, 99, None, -1)]
    assert values(spark, rule(P), f"{column} int", data) == [800, 250, 250, 100, 100, worst, worst, worst, None]


def test_worst_delinquency_can_be_ranked_last(spark):
    params = ScoreParams(delinq_worst=0)
    assert values(spark, points.delinquency_points(params), "delinq_2yrs int", [(6,), (1,)]) == [0, 250]


def test_status_points(spark):
    texts = ["Fully Paid", "x status:FULLY PAID", "Current", "In Grace Period", "Late (16-30 days)", "Charged Off", "Default", "late but current", None]
    assert values(spark, points.status_points(P), "loan_status string", [(t,) for t in texts]) == [800, 800, 500, 250, 100, 0, 0, 500, 0]


def test_ownership_points(spark):
    texts = ["OWN", "unknown", "Rent", "MORTGAGE", "OWNED", "", None]
    assert values(spark, points.ownership_points(P), "home_ownership string", [(t,) for t in texts]) == [800, 800, 500, 250, 100, 100, 100]


def test_utilisation_points(spark):
    data = [(float(x), 1000.0) for x in (100, 101, 200, 201, 300, 301, 500, 501, 700, 701)]
    unusual = [(1.0, None), (None, 1.0), (1.0, 0.0), (0.0, 0.0), (-5.0, -10.0), (NAN, 10.0), (1.0, NAN)]
    got = values(spark, points.utilisation_points(P), "funded_amount float, total_high_credit_limit float", data + unusual)
    assert got == [800, 650, 650, 500, 500, 250, 250, 100, 100, 0] + [0, 0, 0, 800, 800, 0, 800]


def test_sub_grade_points(spark):
    base = {"A": 800, "B": 650, "C": 500, "D": 250, "E": 100}
    factor = {"1": "1", "2": "0.95", "3": "0.90", "4": "0.85", "5": "0.80"}
    data = [(g, g + s) for g in base for s in factor]
    expected = [Decimal(base[g]) * Decimal(factor[sub[1]]) for g, sub in data]
    odd = [("F", "F1"), ("A", "B1"), ("A", "A6"), ("A", "A11"), (None, "A1"), ("A", None), ("a", "a1")]
    got = values(spark, points.sub_grade_points(P), "grade string, sub_grade string", data + odd)
    assert got == expected + [0] * len(odd)


def test_fractional_points_keep_their_decimals(spark):
    params = ScoreParams(excellent=Decimal("800.25"))
    got = values(spark, points.sub_grade_points(params), "grade string, sub_grade string", [("A", "A2"), ("E", "E1")])
    assert got == [Decimal("800.25") * Decimal("0.95"), 100]


def test_loan_points_of_known_customers_only(tables):
    both = doubled(tables)
    scored = loan_points(both | {"customers": tables["customers"]}).collect()
    assert [tuple(r) for r in scored] == [("K7", "ada", 500, 500, 650, Decimal("585.00"))]


# --- grading and parameters ---


def test_grades(spark):
    data = [(2500.0,), (2499.99,), (2000.0,), (1500.0,), (1499.0,), (None,)]
    df = spark.createDataFrame(data, "financial_health_pts double").withColumns(
        {"payment_history_pts": F.lit(300.0), "defaulters_history_pts": F.lit(300.0)}
    )
    labels = [r.loan_final_grade for r in grade(df).collect()]
    assert labels == ["EXCELLENT", "GOOD", "GOOD", "MEDIUM", "HIGH_RISK", "HIGH_RISK"]
    total = [r.loan_final_grade for r in grade(df, basis="total").collect()]
    assert total == ["EXCELLENT", "EXCELLENT", "EXCELLENT", "GOOD", "GOOD", "HIGH_RISK"]
    low = grade(df, ScoreParams(cutoff_very_good=1, cutoff_good=0, cutoff_bad=0))
    assert [r.loan_final_grade for r in low.collect()] == ["EXCELLENT"] * 5 + ["HIGH_RISK"]


def test_params_from_configuration():
    assert ScoreParams.from_mapping({}) == ScoreParams()
    conf = {
        "score.pts.unacceptable": "0",
        "score.pts.very_bad": "100",
        "score.pts.bad": "250",
        "score.pts.good": "500",
        "score.pts.very_good": "650",
        "score.pts.excellent": " 900 ",
        "grade.cutoff.unacceptable": "750",
        "grade.cutoff.very_good": "2400.5",
        "other.key": "x",
    }
    params = ScoreParams.from_mapping(conf)
    assert params.excellent == 900 and isinstance(params.excellent, int)
    assert params.cutoff_very_good == Decimal("2400.5") and params.worst_delinquency == 750


def test_changed_points_change_the_scores(tables, nobody):
    scored = gold(tables, nobody, ScoreParams(good=1000, very_good=0)).first()
    assert scored.payment_history_pts == Decimal("360.00")


def test_points_stay_in_the_allowed_set(spark, tables):
    allowed = {0, 100, 250, 500, 650, 750, 800}
    counts = [(n,) for n in range(12)]
    assert set(values(spark, points.delinquency_points(P), "delinq_2yrs int", counts)) <= allowed
