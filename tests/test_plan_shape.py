"""Physical plans: what is scanned, pushed down, shuffled and broadcast."""

import re

import pytest

from checks.catalogue import bad_members, silver
from creditloom.operators import clean_customers, clean_loans, gold, ledger, payment_history
from creditloom.plans import Locations, run_silver
from creditloom.sources import read_feed, star_feeds
from creditloom.sources.schemas import LOAN_RENAMES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Cleansed tables as files, the state in which the scoring job finds them."""
    root = tmp_path_factory.mktemp("silver")
    return run_silver(star_feeds(spark, SF), Locations.under(str(root))).good


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df):
    """The plan after execution, as adaptive execution changed it."""
    query = df._jdf.queryExecution()
    query.toRdd().count()
    text = query.executedPlan().toString()
    return text[: text.rindex("\n+- == Initial Plan ==")]  # subqueries print initial plans of their own before


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_large_inputs_need_no_broadcast(spark, stored, no_broadcast):
    excluded = bad_members(stored)
    for df in (ledger(stored, excluded, hot={}), gold(stored, excluded, hot={}), gold(stored, excluded, hot={"1": 3})):
        text = plan(df)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
        assert "SortMergeJoin" in text
    # without hot members nothing at all is broadcast
    assert "BroadcastExchange" not in plan(gold(stored, excluded, hot={}))


def test_no_python_in_any_plan(stored):
    text = plan(gold(stored, bad_members(stored), hot={}))
    assert "Python" not in text and "ArrowEval" not in text


def test_loans_are_shuffled_once_per_key(stored, no_broadcast):
    """Scoring shuffles repayments and loans by loan, and everything else by member."""
    text = plan(gold(stored, bad_members(stored), hot={}))
    keys = re.findall(r"Exchange hashpartitioning\((\w+)#\d+L?(?:, (\w+))?", text)
    assert [k for k, _ in keys].count("loan_id") == 2
    assert {k for k, _ in keys} == {"loan_id", "member_id"}


def test_scans_read_only_the_columns_they_need(stored):
    text = plan(gold(stored, bad_members(stored), hot={}))
    read = set(re.findall(r"ReadSchema: struct<([^>\n]*)>", text))
    columns = {c.split(":")[0] for schema in read for c in schema.split(",")}
    assert columns == {
        "member_id",
        "loan_id",
        "home_ownership",
        "total_high_credit_limit",
        "grade",
        "sub_grade",
        "funded_amount",
        "monthly_installment",
        "loan_status",
        "last_payment_amount",
        "total_payment_received",
        "delinq_2yrs",
        "pub_rec",
        "pub_rec_bankruptcies",
        "inq_last_6mths",
    }


def test_null_gates_reach_the_parquet_scan(spark, tmp_path):
    source = {published: column for column, published in LOAN_RENAMES.items()}
    star_feeds(spark, SF, "loans")["loans"].withColumnsRenamed(source).write.parquet(f"{tmp_path}/parquet")
    good, rejected = clean_loans(read_feed(spark, "loans", f"{tmp_path}/parquet"))
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan(good)).group(1)
    assert "IsNotNull(loan_amnt)" in pushed and "IsNotNull(funded_amnt)" in pushed
    assert "Or(" in re.search(r"PushedFilters: \[([^\]]*)\]", plan(rejected)).group(1)


def test_customers_are_shuffled_once(spark):
    """The mean that fills missing lengths reuses the shuffle that drops the copies."""
    good = clean_customers(star_feeds(spark, SF, "customers")["customers"]).good
    text = executed(good)
    assert "ReusedExchange" in text
    # The mean is not computed at all for a consumer that does not read the column.
    assert "avg(" not in plan(good.select("member_id", "grade"))
    assert "Join" not in plan(good.select("emp_length")).replace("BroadcastHashJoin [c_nationkey", "")


def test_exclusion_list_takes_one_shuffle(stored):
    text = plan(bad_members(stored))
    assert text.count("Exchange hashpartitioning(member_id") == 1
    assert text.count("Exchange") == 1 and "partial_count" in text


def test_hot_loan_is_split_by_adaptive_execution(spark, stored, no_broadcast):
    """A third of all repayments belongs to one loan. A shuffle by member follows, so the split costs nothing extra."""
    loan = stored["loans"].select("loan_id").first()[0]
    repeated = spark.range(20_000).selectExpr(f"'{loan}' AS loan_id", "CAST(id AS FLOAT) AS last_payment_amount", "CAST(id AS FLOAT) AS total_payment_received")
    few = stored["loans_repayments"].select("loan_id", "last_payment_amount", "total_payment_received")
    skewed = stored | {"loans_repayments": few.unionAll(repeated)}
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        excluded = bad_members(stored)
        for df in (payment_history(skewed, excluded), gold(skewed, excluded, weighted=True, hot={})):
            assert "SortMergeJoin(skew=true)" in executed(df)
    finally:
        for key in small:
            spark.conf.unset(key)


def test_silver_from_feeds_is_lazy(spark):
    tables = silver(star_feeds(spark, SF))
    assert set(tables) == {"customers", "loans", "loans_repayments", "loans_defaulters_delinq", "loans_defaulters_detail_rec_enq"}
