import uuid

import pytest
from pyspark.sql import functions as F

from creditloom.operators import ScoreParams, gold, payment_history, reconcile
from creditloom.plans import DAILY, WEEKLY, Locations, deploy_views, open_feeds, report, run, run_gold, run_silver, weekly_scores
from creditloom.plans.batch import open_configured_feeds
from creditloom.plans.tables import FEED_KEYS
from creditloom.sources import star_feeds
from creditloom.sources.schemas import FEEDS, SILVER_TABLES

SF = "/root/testdata/sf0.001"
GOLD_ROWS, MEMBERS, EXCLUDED, LEDGER_ROWS, PAYMENT_ROWS = 10_202, 118, 8, 1_108, 1_182


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/catalog'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture(scope="module")
def feeds(spark):
    return star_feeds(spark, SF)


def kind(spark, table):
    return spark.catalog.getTable(table).tableType


def test_weekly_run_with_a_database(spark, feeds, database, tmp_path, rows):
    where = Locations.under(str(tmp_path))
    result = run(feeds, where, database, schedule="weekly")
    names = {t.name: t.tableType for t in spark.catalog.listTables(database) if not t.isTemporary}
    assert {n for n, k in names.items() if k == "EXTERNAL"} == {
        *SILVER_TABLES,
        "consolidated_bad_members",
        "view_internal_bad_members",
        "gold_loan_scores_weekly",
    }
    assert {n for n, k in names.items() if k == "VIEW"} == {
        "view_staging_ph_pts",
        "view_staging_ldh_ph_pts",
        "view_gold_loan_score_realtime",
    }
    weekly = spark.table(f"{database}.gold_loan_scores_weekly")
    assert weekly.count() == GOLD_ROWS and weekly.select("member_id").distinct().count() == MEMBERS
    assert {r[0] for r in weekly.select("loan_final_grade").distinct().collect()} == {"HIGH_RISK"}
    assert spark.read.parquet(where.gold_weekly).count() == GOLD_ROWS
    assert result.excluded.count() == spark.table(f"{database}.view_internal_bad_members").count() == EXCLUDED

    # The persistent views, which are SQL text, hold what the DataFrame operators return.
    assert rows(spark.table(f"{database}.view_staging_ph_pts")) == rows(payment_history(result.silver.good, result.excluded))
    assert spark.table(f"{database}.view_staging_ldh_ph_pts").count() == LEDGER_ROWS
    view = spark.table(f"{database}.view_gold_loan_score_realtime")
    assert rows(view) == rows(weekly.drop("loan_final_grade"))
    assert view.dtypes == gold(result.silver.good, result.excluded).dtypes
    assert rows(weekly_scores(spark, database)) == rows(weekly)

    # One ingest time for the run, and every input row accounted for.
    stamps = [df.select("ingest_date").distinct() for t, df in result.silver.good.items() if "loans_def" not in t]
    assert len({r[0] for s in stamps for r in s.collect()}) == 1
    counts = {r.feed: r for r in result.reconciliation.collect()}
    assert (counts["customers"].total, counts["customers"].success, counts["customers"].rejected) == (161, 138, 17)
    assert counts["customers"].unaccounted == counts["customers"].duplicates == 6
    assert counts["loans"].balanced and counts["loans"].total == 1500
    assert (counts["repayments"].success, counts["repayments"].zero_total, counts["repayments"].balanced) == (1452, 11, False)
    assert (counts["defaulters"].delinq, counts["defaulters"].rec_enq, counts["defaulters"].balanced) == (145, 154, None)


def test_daily_run_defines_views_only(spark, feeds, database, tmp_path):
    result = run(feeds, Locations.under(str(tmp_path)), database, schedule=DAILY)
    assert result.weekly is None
    assert not spark.catalog.tableExists(f"{database}.gold_loan_scores_weekly")
    assert spark.table(f"{database}.view_gold_loan_score_realtime").count() == GOLD_ROWS


def test_run_twice_overwrites(spark, feeds, database, tmp_path):
    where = Locations.under(str(tmp_path))
    for _ in range(2):
        run(feeds, where, database, schedule=WEEKLY)
    assert spark.table(f"{database}.loans").count() == 1411
    assert spark.table(f"{database}.gold_loan_scores_weekly").count() == GOLD_ROWS


def test_managed_tables(spark, feeds, database, tmp_path):
    where = Locations.under(str(tmp_path))
    run_silver(feeds, where, database, tables="managed")
    assert {kind(spark, f"{database}.{t}") for t in SILVER_TABLES} == {"MANAGED"}
    assert spark.table(f"{database}.customers").count() == spark.read.parquet(where.silver["customers"]).count() == 138
    with pytest.raises(ValueError):
        run_silver(feeds, where, database, tables="temporary")


def test_run_without_a_database_uses_temporary_views(spark, feeds, tmp_path, rows):
    result = run(feeds, Locations.under(str(tmp_path)), schedule=WEEKLY)
    assert result.weekly.count() == GOLD_ROWS
    assert rows(spark.table("view_gold_loan_score_realtime")) == rows(result.weekly.drop("loan_final_grade"))
    assert spark.table("view_staging_ldh_ph_pts").count() == LEDGER_ROWS
    assert spark.table("view_staging_ph_pts").count() == PAYMENT_ROWS
    low = ScoreParams(cutoff_very_good=800, cutoff_good=600, cutoff_bad=400)
    grades = {r[0]: r[1] for r in weekly_scores(spark, None, low).groupBy("loan_final_grade").count().collect()}
    assert grades == {"EXCELLENT": 1362, "GOOD": 3036, "MEDIUM": 3481, "HIGH_RISK": 2323}


def test_weekly_table_in_other_shapes(spark, feeds, database, tmp_path):
    where = Locations.under(str(tmp_path))
    result = run(feeds, where, database, schedule=WEEKLY, weighted=True)
    assert result.weekly.agg(F.sum("row_count")).first()[0] == GOLD_ROWS > result.weekly.count()
    by_loan = run_gold(result.silver.good, result.excluded, where, database, schedule=WEEKLY, grain="loan")
    assert by_loan.count() == LEDGER_ROWS - by_loan_without_customer(result)
    assert {"loan_id", "loan_final_grade"} <= set(by_loan.columns)


def by_loan_without_customer(result):
    """Scored repayments of members that the customer table does not hold."""
    from creditloom.operators import ledger

    return ledger(result.silver.good, result.excluded, hot={}).join(result.silver.good["customers"], "member_id", "left_anti").count()


def test_null_rules_of_the_persistent_views(spark, feeds, database, tmp_path):
    run(feeds, Locations.under(str(tmp_path)), database)
    listed = f"{database}.view_internal_bad_members"
    spark.sql(f"DROP TABLE {listed}")
    spark.createDataFrame([(None,), ("1",)], "member_id string").write.saveAsTable(listed)
    for view in ("view_staging_ph_pts", "view_staging_ldh_ph_pts", "view_gold_loan_score_realtime"):
        assert spark.table(f"{database}.{view}").count() == 0


def test_views_freeze_their_parameters(spark, feeds, database, tmp_path):
    run(feeds, Locations.under(str(tmp_path)), database)
    points = f"{database}.view_staging_ph_pts"
    before = spark.table(points).agg(F.max("last_payment_pts")).first()[0]
    deploy_views(spark, database, ScoreParams(excellent=9000))
    assert (before, spark.table(points).agg(F.max("last_payment_pts")).first()[0]) == (800, 9000)


def test_csv_feeds_are_parsed_once(spark, feeds, tmp_path, rows):
    for name, df in feeds.items():
        source = {published: column for column, published in FEEDS[name][1].items()}
        df.withColumnsRenamed(source).write.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(f"{tmp_path}/{name}")
    opened = open_configured_feeds(spark, {key: f"{tmp_path}/{name}" for name, key in FEED_KEYS.items()})
    for name, df in opened.items():
        assert rows(df) == rows(feeds[name])
        assert all(path.endswith(".parquet") for path in df.inputFiles())
    direct = open_feeds(spark, {"loans": opened["loans"].inputFiles()[0]}, fmt="parquet")
    assert direct["loans"].columns == feeds["loans"].columns


def test_malformed_rows_are_rejected_apart(spark, feeds, tmp_path, rows):
    from checks.catalogue import CORRUPT

    for name, df in feeds.items():
        source = {published: column for column, published in FEEDS[name][1].items()}
        shown = df.withColumnsRenamed(source)
        number = next(c for c, t in shown.dtypes if t == "float")
        key = F.regexp_extract(shown.columns[0], r"\d+", 0).cast("long")
        bad = shown.withColumn(number, F.when(key % 10 == 3, F.lit("n/a")).otherwise(F.col(number).cast("string")))
        bad.write.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(f"{tmp_path}/{name}")
    broken = {name: df.filter(F.regexp_extract(df.columns[0], r"\d+", 0).cast("long") % 10 == 3).count() for name, df in feeds.items()}
    opened = open_feeds(spark, {name: f"{tmp_path}/{name}" for name in feeds}, "csv", CORRUPT)
    result = run(opened, Locations.under(f"{tmp_path}/out"), schedule=DAILY, corrupt_column=CORRUPT)
    for name, table in {"customers": "customers", "loans": "loans", "repayments": "loans_repayments", "defaulters": "loans_defaulters_detail_rec_enq"}.items():
        apart = result.silver.rejected[table].filter(F.col(CORRUPT).isNotNull())
        assert apart.count() == broken[name] > 0
        assert {r[0] for r in apart.select("reject_reason").distinct().collect()} == {"Malformed row"}
        assert CORRUPT not in result.silver.good[table].columns
    counts = {r.feed: r for r in result.reconciliation.collect()}
    assert counts["loans"].balanced and counts["loans"].total == feeds["loans"].count()
    assert counts["defaulters"].rejected == broken["defaulters"] and counts["customers"].unaccounted == counts["customers"].duplicates
    assert counts["repayments"].unaccounted == counts["repayments"].zero_total


def test_locations_from_configuration():
    conf = {
        "customer.output.path": "s/c",
        "loan.output.path": "s/l",
        "loanrepayments.output.path": "s/r",
        "defaulters.delinq.output.path": "s/d",
        "defaulters.enq.output.path": "s/e",
        "customer.reject.path": "e/c",
        "loan.reject.path": "e/l",
        "loanrepayments.reject.path": "e/r",
        "consolidated.reject.path": "e/b",
        "gold.weekly.output.path": "g/w",
    }
    where = Locations.from_mapping(conf)
    assert where.silver["loans_defaulters_delinq"] == "s/d" and where.rejected["loans_repayments"] == "e/r"
    assert (where.bad_members, where.gold_weekly) == ("e/b", "g/w")


def test_reconciliation_without_stored_tables_agrees(spark, feeds, rows, tmp_path):
    silver = run_silver(feeds, Locations.under(str(tmp_path)))
    written = silver.good | {f"{t}_rejected": df for t, df in silver.rejected.items()}
    assert rows(reconcile(feeds)) == rows(reconcile(feeds, written))


def test_report_warns_about_feeds_that_do_not_add_up(feeds, caplog):
    with caplog.at_level("INFO", logger="creditloom"):
        lines = report(reconcile(feeds))
    assert "loans: total=1500, success=1411, rejected=89, unaccounted=0, balanced=True" in lines
    warned = [r.message.split(":")[0] for r in caplog.records if r.levelname == "WARNING"]
    assert warned == ["customers", "repayments"] and len(lines) == 4


def test_reconciliation_counts_nan_amounts(spark):
    schema = FEEDS["repayments"][0]
    nan = float("nan")
    raw = spark.createDataFrame(
        [("a", 1.0, 1.0, 1.0, 3.0, 1.0, None, None), ("b", nan, 1.0, 1.0, 3.0, 1.0, None, None), ("c", nan, 1.0, 1.0, 3.0, None, None, None)],
        schema,
    ).withColumnsRenamed(FEEDS["repayments"][1])
    counted = reconcile({"repayments": raw}).first()
    assert (counted.total, counted.success, counted.rejected, counted.nan_amount, counted.unaccounted) == (3, 1, 1, 1, 1)


def test_reconciliation_sees_lost_rows(spark, feeds, tmp_path):
    silver = run_silver(feeds, Locations.under(str(tmp_path)))
    lost = reconcile(feeds, silver.good | {"loans": silver.good["loans"].filter("loan_id <> '1'"), "loans_rejected": silver.rejected["loans"]})
    loans = lost.filter("feed = 'loans'").first()
    assert (loans.unaccounted, loans.balanced) == (1, False)


def test_views_and_stored_scores_leave_out_the_same_members(spark, feeds, database, tmp_path, rows):
    """A list from outside that holds a NULL, in both null modes."""
    where = Locations.under(str(tmp_path))
    listed = spark.createDataFrame([("1",), (None,)], "member_id string")
    silver = run(feeds, where, database, schedule="weekly", null_mode="ignore", listed=listed).silver.good
    for mode in ("ignore", "not_in"):
        if mode == "not_in":
            run_gold(silver, listed, where, database, schedule="WEEKLY", null_mode=mode)
        weekly = spark.table(f"{database}.gold_loan_scores_weekly").drop("loan_final_grade")
        assert rows(spark.table(f"{database}.view_gold_loan_score_realtime")) == rows(weekly)
        assert weekly.isEmpty() == (mode == "not_in")
