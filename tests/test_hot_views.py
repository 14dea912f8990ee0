"""A member with most of the rows must not fill one task, neither in the persistent views nor in the loan grain."""

import uuid

import pytest

from creditloom.operators import gold
from creditloom.operators.scoring import hot_members
from creditloom.plans import DAILY, Locations, run
from creditloom.sources import star_feeds

SF, MEMBER, MORE, TASKS = "/root/testdata/sf0.001", "13", 60_000, 16


@pytest.fixture(scope="module")
def feeds(spark):
    return star_feeds(spark, SF)


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/catalog'")
    spark.conf.set("spark.sql.shuffle.partitions", TASKS)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield name
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.sql(f"DROP DATABASE {name} CASCADE")


def more_loans(spark, feeds, member=MEMBER, loans=MORE):
    one = feeds["loans"].filter("loan_amount IS NOT NULL AND loan_purpose IS NOT NULL").limit(1)
    return feeds["loans"].unionByName(
        spark.range(loans).crossJoin(one).selectExpr("concat('more-', id) AS loan_id", f"'{member}' AS member_id", *feeds["loans"].columns[2:])
    )


def more_repayments(spark, feeds, loan):
    """``MORE`` repayments; ``loan``: an expression over ``id``."""
    one = feeds["repayments"].filter("last_payment_amount IS NOT NULL AND total_payment_received > 0").limit(1)
    return feeds["repayments"].unionByName(
        spark.range(MORE).crossJoin(one).selectExpr(f"{loan} AS loan_id", *feeds["repayments"].columns[1:])
    )


def uneven(stages):
    """Largest task and mean of every stage whose largest task reads more than four times the mean."""
    return [(max(tasks), sum(tasks) / TASKS) for tasks in stages if max(tasks) > max(2_000, 4 * sum(tasks) / TASKS)]


def read(df):
    return lambda: df.write.format("noop").mode("overwrite").save()


def test_gold_view_with_a_member_of_many_loans(spark, feeds, database, tmp_path, shuffled_rows):
    run({**feeds, "loans": more_loans(spark, feeds)}, Locations.under(str(tmp_path)), database, schedule=DAILY)
    view = spark.table(f"{database}.view_gold_loan_score_realtime")
    assert view.filter(f"member_id = '{MEMBER}'").count() > MORE
    assert uneven(shuffled_rows(read(view))) == []


def test_ledger_view_with_a_member_of_many_payments(spark, feeds, database, tmp_path, shuffled_rows):
    paid = more_repayments(spark, feeds, "concat('more-', id)")
    run({**feeds, "loans": more_loans(spark, feeds), "repayments": paid}, Locations.under(str(tmp_path)), database, schedule=DAILY)
    view = spark.table(f"{database}.view_staging_ldh_ph_pts")
    assert view.filter(f"member_id = '{MEMBER}'").count() > MORE
    assert uneven(shuffled_rows(read(view))) == []


@pytest.mark.parametrize("loan, loans", [("concat('more-', id % 50)", 50), ("'more-0'", 1), ("concat('more-', id)", MORE)])
def test_loan_grain_with_a_member_hot_through_repayments(spark, feeds, database, tmp_path, shuffled_rows, loan, loans):
    skewed = {**feeds, "loans": more_loans(spark, feeds, loans=loans), "repayments": more_repayments(spark, feeds, loan)}
    result = run(skewed, Locations.under(str(tmp_path)), schedule=DAILY)
    hot = hot_members(result.silver.good)
    scored = gold(result.silver.good, result.excluded, grain="loan", hot=hot)
    assert scored.filter(f"member_id = '{MEMBER}'").count() > MORE
    assert uneven(shuffled_rows(read(scored))) == []
