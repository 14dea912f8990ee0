"""Hot members must change the layout of a join, never its result."""

import random

import pytest
from pyspark.sql import functions as F

from creditloom.operators import gold, ledger, payment_history
from creditloom.operators.scoring import hot_members
from creditloom.operators.skew import SLICE, hot_keys, listed, repeat_rows, replicate, spread

STATUSES = ["Fully Paid", "Current", "Late", "Default"]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all loans belongs to one member; another member holds a third of the defaulter rows."""
    rng = random.Random(7)
    members = [f"m{i}" for i in range(40)]
    owner = ["m0" if i % 3 == 0 else rng.choice(members) for i in range(600)]
    loans = [(f"L{i}", m, float(rng.randint(1, 40)) * 100, rng.choice(STATUSES), 100.0) for i, m in enumerate(owner)]
    paid = [(f"L{rng.randint(0, 620)}", float(rng.randint(0, 200)), float(rng.randint(1, 2000))) for _ in range(500)]
    people = [(m, rng.choice(["OWN", "RENT", "x"]), float(rng.randint(1, 9)) * 1000, "B", f"B{rng.randint(1, 5)}") for m in members]
    counts = [(m, rng.randint(0, 7), rng.randint(0, 7), rng.randint(0, 7)) for m in members + ["m1"] * 20]
    delinq = [(m, rng.randint(0, 7)) for m in members[:-5] + ["m1"] * 20]
    make = spark.createDataFrame
    return {
        "loans": make(loans, "loan_id string, member_id string, funded_amount float, loan_status string, monthly_installment float"),
        "loans_repayments": make(paid, "loan_id string, last_payment_amount float, total_payment_received float"),
        "customers": make(people, "member_id string, home_ownership string, total_high_credit_limit float, grade string, sub_grade string"),
        "loans_defaulters_detail_rec_enq": make(counts, "member_id string, pub_rec int, pub_rec_bankruptcies int, inq_last_6mths int"),
        "loans_defaulters_delinq": make(delinq, "member_id string, delinq_2yrs int"),
    }


@pytest.fixture(scope="module")
def excluded(spark):
    return spark.createDataFrame([("m1",), ("m7",), ("stranger",)], "member_id string")


def test_hot_keys_are_found_with_slices_by_share(spark):
    df = spark.range(900).select(F.when(F.col("id") < 300, "hot").when(F.col("id") < 400, "warm").otherwise(F.col("id").cast("string")).alias("k"))
    found = hot_keys([df], "k", 24)  # counts are estimates from above
    assert set(found) == {"hot", "warm"} and 8 <= found["hot"] <= 10 and 3 <= found["warm"] <= 4
    assert set(hot_keys([df], "k", 12)) == {"hot"}
    assert hot_keys([df.filter("k = 'none'")], "k", 12) == {}
    nulls = df.withColumn("k", F.when(F.col("k") != "hot", F.col("k")))
    assert hot_keys([nulls], "k", 8) == {}  # NULLs never join and are not counted


def test_number_of_hot_keys_is_bounded(spark):
    even = spark.range(1000).select((F.col("id") % 5).cast("string").alias("k"))
    assert len(hot_keys([even], "k", 8)) == 0
    assert len(hot_keys([even], "k", 12)) == 5


def test_spread_and_replicate_join_to_the_same_rows(spark, rows):
    left = spark.range(200).select(F.when(F.col("id") % 2 == 0, "h").otherwise(F.col("id").cast("string")).alias("k"), "id")
    right = spark.createDataFrame([("h", 1), ("h", 2), ("3", 3)], "k string, v int")
    hot = {"h": 7}
    salted = spread(left, "k", hot, "id").join(replicate(right, "k", hot), ["k", SLICE]).drop(SLICE)
    assert rows(salted) == rows(left.join(right, "k"))
    assert spread(left, "k", hot, "id").filter("k = 'h'").select(SLICE).distinct().count() == 7
    assert spread(left, "k", {}, "id").columns == left.columns


def test_copies_of_one_row_are_spread_by_input_split(spark):
    df = spark.range(0, 400, 1, 16).select(F.lit("h").alias("k"), F.lit("same").alias("x"))
    assert spread(df, "k", {"h": 4}, "x").select(SLICE).distinct().count() > 1


def test_listed(spark, excluded):
    assert listed(excluded, "member_id", {"m1": 2, "m0": 3}) == {"m1"}
    assert listed(excluded, "member_id", {}) == set()


@pytest.mark.parametrize("block", [1, 3, 1 << 16])
def test_repeat_rows(spark, block):
    df = spark.createDataFrame([("a", 1), ("b", 0), ("c", 7), ("d", None)], "k string, n bigint")
    counts = {r.k: r["count"] for r in repeat_rows(df, "n", block).groupBy("k").count().collect()}
    assert counts == {"a": 1, "c": 7}


@pytest.mark.parametrize("build", [ledger, gold])
def test_hot_members_do_not_change_results(skewed, excluded, rows, build):
    hot = hot_members(skewed, parallelism=16)
    assert "m0" in hot
    plain = rows(build(skewed, excluded, hot={}))
    assert plain and rows(build(skewed, excluded, hot=hot)) == plain
    # every member hot, the excluded ones among them
    assert rows(build(skewed, excluded, hot={f"m{i}": 3 for i in range(40)})) == plain


def test_other_shapes_of_gold(skewed, excluded, rows):
    hot = {"m0": 5, "m1": 3}
    assert rows(gold(skewed, excluded, grain="loan", hot=hot)) == rows(gold(skewed, excluded, grain="loan", hot={}))
    weighted = gold(skewed, excluded, weighted=True, hot=hot)
    assert rows(repeat_rows(weighted, "row_count").drop("row_count")) == rows(gold(skewed, excluded, hot={}))
    assert weighted.count() == weighted.select("member_id", "payment_history_pts", "defaulters_history_pts", "financial_health_pts").distinct().count()


def test_gold_equals_the_plain_row_join(skewed, excluded, rows):
    """Brute force: join the rows themselves, without counting first."""
    from creditloom.operators import ScoreParams, points

    p = ScoreParams()
    history = ledger(skewed, excluded, hot={})
    joined = history.join(skewed["loans"], "member_id").join(skewed["customers"], "member_id")
    expected = joined.select(
        "member_id",
        F.expr(points.payment_history_score()).alias("payment_history_pts"),
        F.expr(points.defaulters_history_score()).alias("defaulters_history_pts"),
        F.expr(points.financial_health_score(p)).alias("financial_health_pts"),
    )
    assert rows(gold(skewed, excluded)) == rows(expected)


def test_payment_history_is_unaffected_by_member_tables(skewed, excluded):
    paid = skewed["loans_repayments"].join(skewed["loans"], "loan_id")
    assert payment_history(skewed, excluded).count() == paid.filter("member_id NOT IN ('m1', 'm7')").count()
