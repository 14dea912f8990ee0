"""Named queries over the star-schema tables; each one reads its whole input tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.operators import (
    ScoreParams,
    clean_customers,
    clean_loans,
    clean_repayments,
    duplicate_keys,
    exclude_keys,
    gold,
    grade,
    ledger,
    loan_points,
    payment_history,
    reconcile,
    split_defaulters,
)
from creditloom.operators.quality import INGESTED
from creditloom.operators.skew import hot_keys
from creditloom.plans import DAILY, WEEKLY, Locations, deploy_functions, open_feeds, run
from creditloom.plans.tables import scratch_path
from creditloom.sources import read_feed, read_key_list, star_feeds
from creditloom.sources.schemas import (
    FEEDS,
    T_CUSTOMERS,
    T_DELINQ,
    T_GOLD_WEEKLY,
    T_LOANS,
    T_REC_ENQ,
    T_REPAYMENTS,
    V_GOLD,
    V_LEDGER,
)

Query = Callable[[SparkSession, str], DataFrame]

#: Holds the raw text of malformed CSV rows.
CORRUPT = "raw_row"

LOW_CUTOFFS = ScoreParams(cutoff_very_good=800, cutoff_good=600, cutoff_bad=400)


def silver(feeds: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The five cleansed tables, straight from the feeds."""
    delinq, rec_enq = split_defaulters(feeds["defaulters"])
    return {
        T_CUSTOMERS: clean_customers(feeds["customers"]).good,
        T_LOANS: clean_loans(feeds["loans"]).good,
        T_REPAYMENTS: clean_repayments(feeds["repayments"]).good,
        T_DELINQ: delinq,
        T_REC_ENQ: rec_enq,
    }


def bad_members(tables: dict[str, DataFrame]) -> DataFrame:
    return duplicate_keys([tables[t] for t in (T_CUSTOMERS, T_DELINQ, T_REC_ENQ)], "member_id")


def _plain(df: DataFrame) -> DataFrame:
    """Drop the ingest time (different on every run) and show decimals as doubles."""
    shown = df.drop(INGESTED)
    decimals = [c for c, t in shown.dtypes if t.startswith("decimal")]
    return shown.withColumns({c: F.col(c).cast("double") for c in decimals})


def _cleansed(feed: str, cleanse, side: str) -> Query:
    return lambda spark, directory: _plain(getattr(cleanse(star_feeds(spark, directory, feed)[feed]), side))


def _over_silver(build) -> Query:
    """``build(tables, excluded members)`` over all cleansed tables."""

    def query(spark: SparkSession, directory: str) -> DataFrame:
        tables = silver(star_feeds(spark, directory))
        return _plain(build(tables, bad_members(tables)))

    return query


def _over_members(build) -> Query:
    """``build(tables, excluded members, hot members)``; hot members are looked for in the feeds, before dedup."""

    def query(spark: SparkSession, directory: str) -> DataFrame:
        feeds = star_feeds(spark, directory)
        tables = silver(feeds)
        hot = hot_keys([feeds[f] for f in ("loans", "customers", "defaulters")], "member_id")
        return _plain(build(tables, bad_members(tables), hot))

    return query


def _csv_copy(spark: SparkSession, directory: str, feed: str) -> DataFrame:
    """Store a feed as CSV under its source column names and read it back."""
    path = scratch_path(spark, f"csv-{feed}")
    source = {published: name for name, published in FEEDS[feed][1].items()}
    raw = star_feeds(spark, directory, feed)[feed].withColumnsRenamed(source)
    raw.write.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(path)
    return read_feed(spark, feed, path, fmt="csv")


def _batch(
    result: Callable[[SparkSession, str], DataFrame],
    feeds: Callable[[SparkSession, str], dict[str, DataFrame]] = star_feeds,
    schedule: str = WEEKLY,
    **options,
) -> Query:
    """Run the batch job into a database of its own, then read one of its tables or views."""

    def query(spark: SparkSession, directory: str) -> DataFrame:
        root = scratch_path(spark, "batch")
        database = f"creditloom_{uuid.uuid4().hex[:12]}"
        spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/catalog'")
        run(feeds(spark, directory), Locations.under(root), database, schedule=schedule, **options)
        return _plain(result(spark, database))

    return query


#: The member that holds half of all loans in the skewed feeds.
HOT_MEMBER = "13"


def skewed_feeds(spark: SparkSession, directory: str, paid: bool = True) -> dict[str, DataFrame]:
    """The feeds with one more loan for each loan, all of one member, and with ``paid`` one more repayment for each repayment."""
    feeds = star_feeds(spark, directory)
    extra = F.concat(F.lit("extra-"), F.col("loan_id"))
    more = feeds["loans"].withColumns({"loan_id": extra, "member_id": F.lit(HOT_MEMBER)})
    feeds["loans"] = feeds["loans"].unionByName(more)
    if paid:
        feeds["repayments"] = feeds["repayments"].unionByName(feeds["repayments"].withColumn("loan_id", extra))
    return feeds


def odd_feeds(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """The feeds with NULL members, NaN amounts, fractions and numbers beyond the int range on some keys."""
    feeds = star_feeds(spark, directory)
    key = F.regexp_extract("member_id", r"\d+", 0).cast("long")
    loan = F.regexp_extract("loan_id", r"\d+", 0).cast("long")

    def where(number: Column, by: int, rest: int, column: str, value: float | None) -> Column:
        return F.when(number % by == rest, F.lit(value).cast("float")).otherwise(F.col(column))

    nan = float("nan")
    return {
        "customers": feeds["customers"].withColumn("member_id", F.when(key % 40 != 6, F.col("member_id"))),
        "loans": feeds["loans"].withColumn("member_id", F.when(key % 45 != 11, F.col("member_id"))),
        "repayments": feeds["repayments"].withColumns({
            "total_interest_received": where(loan, 23, 4, "total_interest_received", nan),
            "last_payment_amount": where(loan, 29, 7, "last_payment_amount", nan),
        }),
        "defaulters": feeds["defaulters"].withColumns({
            "delinq_2yrs": F.when(key % 14 == 3, F.col("delinq_2yrs") + F.lit(0.5).cast("float")).otherwise(where(key, 53, 13, "delinq_2yrs", 1e20)),
            "mths_since_last_delinq": where(key, 37, 21, "mths_since_last_delinq", nan),
            "pub_rec": where(key, 29, 5, "pub_rec", nan),
            "inq_last_6mths": where(key, 31, 8, "inq_last_6mths", -3e9),
            "member_id": F.when(key % 50 != 7, F.col("member_id")),
        }),
    }


def _odd(build: Callable[[dict[str, DataFrame], dict[str, DataFrame]], DataFrame]) -> Query:
    """``build(feeds, tables)`` over the odd feeds."""

    def query(spark: SparkSession, directory: str) -> DataFrame:
        feeds = odd_feeds(spark, directory)
        return _plain(build(feeds, silver(feeds)))

    return query


def _parquet_copy(spark: SparkSession, directory: str, feed: str) -> DataFrame:
    """Store a feed as Parquet with wider numbers, in another order and with one column more; the path tells the format."""
    path = f"{scratch_path(spark, feed)}-parquet"
    source = {published: name for name, published in FEEDS[feed][1].items()}
    raw = star_feeds(spark, directory, feed)[feed].withColumnsRenamed(source)
    wide = [F.col(c).cast("double" if t == "float" else t).alias(c.upper()) for c, t in reversed(raw.dtypes)]
    raw.select(F.lit("x").alias("more"), *wide).write.parquet(path)
    return read_feed(spark, feed, path)


def _listed(fmt: str, result: Callable[[SparkSession, str], DataFrame], schedule: str) -> Query:
    """The batch job with a list of members from outside, inferred numbers in CSV or a typed Parquet column."""

    def query(spark: SparkSession, directory: str) -> DataFrame:
        path = f"{scratch_path(spark, 'list')}-{fmt}"
        members = spark.read.parquet(f"{directory}/customer.parquet").where("c_custkey % 6 = 1")
        listed = members.select(F.col("c_custkey").cast("string").alias("member_id"))
        listed.write.option("header", True).format(fmt).save(path)
        return _batch(result, schedule=schedule, listed=read_key_list(spark, path))(spark, directory)

    return query


def malformed_loans(spark: SparkSession, directory: str) -> DataFrame:
    """The loans as CSV lines, some with a word for a number, some cut short and some with a field too many, read back with
    the column that keeps such lines."""
    raw = star_feeds(spark, directory, "loans")["loans"]
    key = F.col("loan_id").cast("long")
    amount = F.when(key % 19 == 5, F.lit("abc")).otherwise(F.col("loan_amount").cast("string"))
    fields = [amount if c == "loan_amount" else F.col(c).cast("string") for c in raw.columns]
    whole = F.array_join(F.array(*fields), ",", "")
    short = F.array_join(F.array(*fields[:7]), ",", "")
    line = F.when(key % 23 == 3, short).when(key % 31 == 7, F.concat(whole, F.lit(",more"))).otherwise(whole)
    path = scratch_path(spark, "lines")
    raw.select(line.alias("line")).write.option("header", True).option("sep", "\u0001").option("ignoreLeadingWhiteSpace", False).csv(path)
    return open_feeds(spark, {"loans": path}, "csv", CORRUPT)["loans"]


def _malformed(spark: SparkSession, directory: str) -> DataFrame:
    rejected = clean_loans(malformed_loans(spark, directory), corrupt_column=CORRUPT).rejected
    return rejected.select("loan_id", "reject_reason", F.substring_index(CORRUPT, ",", 1).alias("raw_id"))


def _gold_function(arguments: str) -> Callable[[SparkSession, str], DataFrame]:
    """Functions are deployed once, with the usual points; the caller may change some of them."""

    def result(spark: SparkSession, database: str) -> DataFrame:
        deploy_functions(spark, database)
        before = spark.catalog.currentDatabase()
        spark.catalog.setCurrentDatabase(database)  # table functions are called by their bare names
        try:
            return spark.sql(f"SELECT * FROM gold_loan_scores({arguments})")
        finally:
            spark.catalog.setCurrentDatabase(before)

    return result


def _stamps(spark: SparkSession, database: str) -> DataFrame:
    """Rows of the stored tables by whether they carry the one ingest time of the run."""
    first = spark.table(f"{database}.{T_LOANS}").agg(F.min(INGESTED)).scalar()
    tables = [
        spark.table(f"{database}.{t}").select(F.lit(t).alias("stored"), (F.col(INGESTED) == first).alias("stamped"))
        for t in (T_CUSTOMERS, T_LOANS, T_REPAYMENTS)
    ]
    return reduce(DataFrame.unionAll, tables).groupBy("stored", "stamped").agg(F.count("*").alias("n"))


def _injected_stamp(spark: SparkSession, directory: str) -> DataFrame:
    at = F.lit("2024-02-03 04:05:06").cast("timestamp")
    good, rejected = clean_loans(star_feeds(spark, directory, "loans")["loans"], at)
    shown = [df.select("loan_id", F.date_format(INGESTED, "yyyy-MM-dd HH:mm:ss").alias("ingested")) for df in (good, rejected)]
    return shown[0].unionAll(shown[1])


def _skewed_loan_grain(spark: SparkSession, directory: str) -> DataFrame:
    feeds = skewed_feeds(spark, directory)
    tables = silver(feeds)
    hot = hot_keys([feeds[f] for f in ("loans", "customers", "defaulters")], "member_id")
    return _plain(gold(tables, bad_members(tables), grain="loan", hot=hot))


def queries() -> dict[str, Query]:
    named: dict[str, Query] = {
        "silver_customers": _cleansed("customers", clean_customers, "good"),
        "reject_customers": _cleansed("customers", clean_customers, "rejected"),
        "silver_loans": _cleansed("loans", clean_loans, "good"),
        "reject_loans": _cleansed("loans", clean_loans, "rejected"),
        "silver_repayments": _cleansed("repayments", clean_repayments, "good"),
        "reject_repayments": _cleansed("repayments", clean_repayments, "rejected"),
        "delinquencies": _cleansed("defaulters", split_defaulters, "delinq"),
        "records_enquiries": _cleansed("defaulters", split_defaulters, "rec_enq"),
        "bad_members": _over_silver(lambda s, x: x),
        "clean_members_not_in": _over_silver(lambda s, x: exclude_keys(s[T_REC_ENQ], x, "member_id")),
        "clean_members_ignore_nulls": _over_silver(
            lambda s, x: exclude_keys(s[T_CUSTOMERS], x, "member_id", null_mode="ignore")
        ),
        "clean_members_bypass_not_in": _over_silver(lambda s, x: exclude_keys(s[T_REC_ENQ], x, "member_id", bypass=True)),
        "clean_members_bypass_ignore_nulls": _over_silver(
            lambda s, x: exclude_keys(s[T_CUSTOMERS], x, "member_id", null_mode="ignore", bypass=True)
        ),
        "payment_history": _over_silver(payment_history),
        "ledger": _over_members(lambda s, x, hot: ledger(s, x, hot=hot)),
        "gold_realtime": _over_members(lambda s, x, hot: gold(s, x, hot=hot)),
        "gold_realtime_weighted": _over_members(lambda s, x, hot: gold(s, x, weighted=True, hot=hot)),
        "gold_loan_grain": _over_members(lambda s, x, hot: gold(s, x, grain="loan", hot=hot)),
        "gold_weekly": _over_members(lambda s, x, hot: grade(gold(s, x, hot=hot))),
        "gold_weekly_low_cutoffs": _over_members(lambda s, x, hot: grade(gold(s, x, hot=hot), LOW_CUTOFFS)),
        "gold_weekly_total_basis": _over_members(lambda s, x, hot: grade(gold(s, x, hot=hot), basis="total")),
        "reconciliation": lambda spark, directory: reconcile(star_feeds(spark, directory)),
    }
    for feed in FEEDS:
        named[f"csv_roundtrip_{feed}"] = lambda spark, directory, feed=feed: _csv_copy(spark, directory, feed)
    named["batch_weekly_table"] = _batch(lambda spark, database: spark.table(f"{database}.{T_GOLD_WEEKLY}"))
    named["batch_gold_view"] = _batch(lambda spark, database: spark.table(f"{database}.{V_GOLD}"))
    named["batch_ledger_view"] = _batch(lambda spark, database: spark.table(f"{database}.{V_LEDGER}"))
    named |= {
        "odd_delinquencies": _odd(lambda feeds, s: s[T_DELINQ]),
        "odd_records_enquiries": _odd(lambda feeds, s: s[T_REC_ENQ]),
        "odd_silver_repayments": _odd(lambda feeds, s: s[T_REPAYMENTS]),
        "odd_bad_members": _odd(lambda feeds, s: bad_members(s)),
        "odd_clean_members_not_in": _odd(lambda feeds, s: exclude_keys(s[T_REC_ENQ], bad_members(s), "member_id")),
        "odd_clean_members_ignore_nulls": _odd(
            lambda feeds, s: exclude_keys(s[T_REC_ENQ], bad_members(s), "member_id", null_mode="ignore")
        ),
        "odd_reconciliation": _odd(lambda feeds, s: reconcile(feeds)),
        "batch_gold_view_null_list": _batch(lambda spark, database: spark.table(f"{database}.{V_GOLD}"), odd_feeds, DAILY),
        "batch_gold_view_ignore_nulls": _batch(
            lambda spark, database: spark.table(f"{database}.{V_GOLD}"), odd_feeds, DAILY, null_mode="ignore"
        ),
        "batch_external_list": _listed("csv", lambda spark, database: spark.table(f"{database}.{T_GOLD_WEEKLY}"), WEEKLY),
        "batch_external_list_view": _listed("parquet", lambda spark, database: spark.table(f"{database}.{V_LEDGER}"), DAILY),
        "batch_managed_customers": _batch(
            lambda spark, database: spark.table(f"{database}.{T_CUSTOMERS}"), schedule=DAILY, tables="managed"
        ),
        "gold_function": _batch(_gold_function(""), schedule=DAILY),
        "gold_function_changed_points": _batch(
            _gold_function("p_excellent => 900, p_bad => 200, p_cutoff_very_good => 900, p_cutoff_good => 600, p_cutoff_bad => 400"),
            schedule=DAILY,
        ),
        "batch_bucketed_weekly": _batch(
            lambda spark, database: spark.table(f"{database}.{T_GOLD_WEEKLY}"), schedule=WEEKLY, tables="bucketed"
        ),
        "batch_ingest_stamps": _batch(_stamps, schedule=DAILY),
        "injected_ingest_time": _injected_stamp,
        "malformed_csv_rejects": _malformed,
    }
    for feed in FEEDS:
        named[f"parquet_feed_{feed}"] = lambda spark, directory, feed=feed: _parquet_copy(spark, directory, feed)
    named["skewed_gold_view"] = _batch(
        lambda spark, database: spark.table(f"{database}.{V_GOLD}"), lambda s, d: skewed_feeds(s, d, paid=False), DAILY
    )
    named["skewed_ledger_view"] = _batch(lambda spark, database: spark.table(f"{database}.{V_LEDGER}"), skewed_feeds, DAILY)
    named["skewed_gold_loan_grain"] = _skewed_loan_grain
    for name, column in {
        "status_points": "loan_status_pts",
        "ownership_points": "home_ownership_pts",
        "utilisation_points": "credit_utilisation_pts",
        "subgrade_points": "sub_grade_pts",
    }.items():
        named[name] = _over_silver(lambda s, x, column=column: loan_points(s).select("loan_id", "member_id", column))
    return named
