"""Shape an order-entry star schema (customer, nation, orders) into the four raw credit feeds.

The source tables hold no NULLs, sentinels or duplicates, so the mapping derives them from the keys: every source row
takes part, each source is scanned once per feed, and the result grows with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from creditloom.sources.schemas import FEEDS


def customers_feed(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """One row per customer; every 29th has an exact copy, every 31st a copy with another job title."""
    titles = (
        "array_compact(array(c_name, CASE WHEN c_custkey % 29 = 1 THEN c_name END, "
        "CASE WHEN c_custkey % 31 = 2 THEN concat(c_name, '-b') END))"
    )
    letter = "substr('ABCDEFG', CAST(c_custkey % 7 AS INT) + 1, 1)"
    return customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).selectExpr(
        "CAST(c_custkey AS STRING) AS member_id",
        f"explode({titles}) AS emp_title",
        "CASE c_custkey % 13 WHEN 0 THEN NULL WHEN 1 THEN '< 1 year' WHEN 11 THEN '10+ years' WHEN 12 THEN 'n/a' "
        "ELSE concat(c_custkey % 13, ' years') END AS emp_length",
        "CASE c_custkey % 5 WHEN 0 THEN 'OWN' WHEN 1 THEN 'RENT' WHEN 2 THEN 'MORTGAGE' WHEN 3 THEN 'ANY' "
        "ELSE 'unknown' END AS home_ownership",
        "CASE WHEN c_custkey % 17 <> 0 THEN CAST(abs(c_acctbal) * 10 AS FLOAT) END AS annual_inc",
        "CASE WHEN c_custkey % 19 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN n_name "
        "ELSE concat('S', c_nationkey % 10) END AS addr_state",
        "concat(c_custkey % 1000, 'xx') AS zip_code",
        "'USA' AS country",
        f"{letter} AS grade",
        f"concat({letter}, c_custkey DIV 7 % 5 + 1) AS sub_grade",
        "'Verified' AS verification_status",
        "CASE WHEN c_custkey % 23 <> 0 THEN CAST((c_acctbal + 1000) * 200 AS FLOAT) END AS tot_hi_cred_lim",
        "'Individual' AS application_type",
        "CAST(NULL AS FLOAT) AS annual_inc_joint",
        "CAST(NULL AS STRING) AS verification_status_joint",
    )


def loans_feed(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "CAST(o_orderkey AS STRING) AS loan_id",
        "CAST(o_custkey AS STRING) AS member_id",
        "CASE WHEN o_orderkey % 37 <> 0 THEN CAST(o_totalprice AS FLOAT) END AS loan_amnt",
        "CAST(o_totalprice AS FLOAT) AS funded_amnt",
        "CASE o_orderkey % 3 WHEN 0 THEN ' 36 months' WHEN 1 THEN '60 months' ELSE '18 months' END AS term",
        "CAST(5 + o_orderkey % 20 AS FLOAT) AS int_rate",
        "CAST(o_totalprice / 36 AS FLOAT) AS installment",
        "CAST(CAST(o_orderdate AS DATE) AS STRING) AS issue_d",
        "CASE o_orderkey % 7 WHEN 0 THEN 'Fully Paid' WHEN 1 THEN 'Current' WHEN 2 THEN 'In Grace Period' "
        "WHEN 3 THEN 'Late (31-120 days)' WHEN 4 THEN 'Charged Off' WHEN 5 THEN 'Default' "
        "ELSE 'Does not meet the credit policy. Status:Fully Paid' END AS loan_status",
        "CASE o_orderkey % 6 WHEN 0 THEN 'debt_consolidation' WHEN 1 THEN 'credit_card' WHEN 2 THEN 'Car' "
        "WHEN 3 THEN 'car' WHEN 4 THEN 'buying_a_spaceship' "
        "ELSE CASE WHEN o_orderkey % 5 <> 0 THEN 'house' END END AS purpose",
        "o_orderpriority AS title",
    )


def repayments_feed(orders: DataFrame) -> DataFrame:
    """One repayment record per order; one in eleven names a loan that does not exist, so that its loan has none."""
    share = (
        "CASE o_orderkey % 8 WHEN 0 THEN 0.25D WHEN 1 THEN 0.5D WHEN 2 THEN 0.75D WHEN 3 THEN 1D WHEN 4 THEN 1.25D "
        "WHEN 5 THEN 1.5D WHEN 6 THEN 2D ELSE 0D END"
    )
    principal = "o_totalprice * (o_orderkey % 10) / 10"
    day = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
    return orders.selectExpr(
        "CASE WHEN o_orderkey % 11 = 3 THEN concat('unknown-', o_orderkey) ELSE CAST(o_orderkey AS STRING) END AS loan_id",
        f"CAST({principal} AS FLOAT) AS total_rec_prncp",
        "CAST(o_orderkey % 100 AS FLOAT) AS total_rec_int",
        "CAST(o_orderkey % 4 AS FLOAT) AS total_rec_late_fee",
        f"CAST(CASE WHEN o_orderkey % 13 = 0 THEN 0D ELSE {principal} + 10 END AS FLOAT) AS total_pymnt",
        "CASE WHEN o_orderkey % 41 <> 0 "
        f"THEN CAST(CAST(CAST(o_totalprice / 36 AS FLOAT) AS DOUBLE) * {share} AS FLOAT) END AS last_pymnt_amnt",
        f"CASE WHEN o_orderkey % 9 = 0 THEN '0.0' ELSE {day} END AS last_pymnt_d",
        f"CASE o_orderkey % 4 WHEN 0 THEN '0.0' WHEN 1 THEN NULL ELSE {day} END AS next_pymnt_d",
    )


def defaulters_feed(customer: DataFrame) -> DataFrame:
    """One row per customer; every 43rd has a copy."""
    return customer.selectExpr(
        "CAST(c_custkey AS STRING) AS member_id",
        "CAST(nullif(c_custkey % 9, 8) AS FLOAT) AS delinq_2yrs",
        "CAST(abs(c_acctbal) AS FLOAT) AS delinq_amnt",
        "CAST(nullif(c_custkey DIV 3 % 8, 7) AS FLOAT) AS pub_rec",
        "CAST(c_custkey DIV 5 % 8 AS FLOAT) AS pub_rec_bankruptcies",
        "CAST(c_custkey DIV 7 % 8 AS FLOAT) AS inq_last_6mths",
        "CAST(0 AS FLOAT) AS total_rec_late_fee",
        "CAST(c_custkey % 4 AS FLOAT) AS mths_since_last_delinq",
        "CAST(NULL AS FLOAT) AS mths_since_last_record",
        "explode(sequence(0, if(c_custkey % 43 = 5, 1, 0))) AS _copy",
    ).drop("_copy")


def star_feeds(spark: SparkSession, directory: str, *names: str) -> dict[str, DataFrame]:
    """The named feeds (default: all four) from ``directory/<table>.parquet``, under the names that
    :func:`creditloom.sources.feeds.read_feed` gives their columns. Each source table is opened once."""
    tables: dict[str, DataFrame] = {}

    def table(source: str) -> DataFrame:
        if source not in tables:
            tables[source] = spark.read.parquet(f"{directory}/{source}.parquet")
        return tables[source]

    build = {
        "customers": lambda: customers_feed(table("customer"), table("nation")),
        "loans": lambda: loans_feed(table("orders")),
        "repayments": lambda: repayments_feed(table("orders")),
        "defaulters": lambda: defaulters_feed(table("customer")),
    }
    return {name: build[name]().withColumnsRenamed(FEEDS[name][1]) for name in names or build}
