"""How results are stored: file sizes, readers during a run, counts that arise while writing."""

import glob
import threading
import uuid

import pytest

from creditloom.operators import reconcile
from creditloom.plans import WEEKLY, Locations, run, run_silver
from creditloom.plans.tables import register_table, write_parquet
from creditloom.sources import star_feeds
from creditloom.sources.schemas import SILVER_TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/catalog'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture(scope="module")
def feeds(spark):
    return star_feeds(spark, SF)


def files(path):
    return len(glob.glob(f"{path}/part-*"))


def test_files_are_as_many_as_their_size_calls_for(spark, feeds, tmp_path):
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    try:
        where = Locations.under(str(tmp_path))
        run({name: df.repartition(9) if name == "defaulters" else df for name, df in feeds.items()}, where, schedule=WEEKLY)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    # All results are far below 128 MB, so one file each would do.
    uneven = [where.silver["customers"], where.silver["loans_defaulters_delinq"], where.bad_members, where.gold_weekly]
    uneven += [where.rejected[t] for t in ("customers", "loans", "loans_repayments")]
    assert {path: files(path) for path in uneven if files(path) > 2} == {}


def test_readers_go_on_through_a_run(spark, feeds, database, tmp_path):
    first = run(feeds, Locations.new_version(str(tmp_path)), database, schedule=WEEKLY)
    tables = [f"{database}.{t}" for t in (*SILVER_TABLES, "consolidated_bad_members", "gold_loan_scores_weekly")]
    expected = [spark.table(t).count() for t in tables]
    before = [spark.table(t).inputFiles() for t in tables]
    held = [spark.table(t) for t in tables]  # queries that began before the run
    done, counts, failed = threading.Event(), [], []

    def read():
        while not done.is_set():
            try:
                counts.append([spark.table(t).count() for t in tables])
            except Exception as problem:
                failed.append(problem)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        run(feeds, Locations.new_version(str(tmp_path)), database, schedule=WEEKLY)
    finally:
        done.set()
        reader.join()
    assert not failed and counts and all(c == expected for c in counts)
    assert [df.count() for df in held] == expected and first.weekly is not None
    assert all(set(spark.table(t).inputFiles()).isdisjoint(old) for t, old in zip(tables, before))


def test_a_table_of_other_columns_is_made_anew(spark, database, tmp_path):
    name = f"{database}.numbers"
    for columns in (["id"], ["id", "2 * id AS twice"]):
        path = f"{tmp_path}/{len(columns)}"
        write_parquet(spark.range(5).selectExpr(*columns), path)
        assert register_table(spark, name, path).count() == 5
    assert spark.table(name).columns == ["id", "twice"]
    spark.sql(f"DROP TABLE {name}")
    spark.range(3).write.saveAsTable(name)
    assert register_table(spark, name, f"{tmp_path}/1").count() == 5


def test_counts_that_arise_while_writing(spark, feeds, tmp_path, rows, shuffled_rows):
    result = run(feeds, Locations.under(str(tmp_path)))
    assert rows(result.reconciliation) == rows(reconcile(feeds))
    # Nothing but the customers' mandatory columns is read for it.
    plan = result.reconciliation._jdf.queryExecution().executedPlan().toString()
    assert "orders" not in plan and "o_totalprice" not in plan


def test_empty_feeds(spark, feeds, tmp_path):
    empty = {name: spark.createDataFrame([], df.schema) for name, df in feeds.items()}
    result = run_silver(empty, Locations.under(str(tmp_path)))
    assert all(df.count() == 0 for df in (*result.good.values(), *result.rejected.values()))
    assert set(result.counts.stored.values()) == {0}
    assert {n for counts in result.counts.seen.values() for n in counts.values()} == {0}


def test_bucketed_tables_join_without_a_shuffle(spark, feeds, database, tmp_path, rows):
    from creditloom.operators import gold

    where = Locations.under(str(tmp_path))
    result = run(feeds, where, database, schedule=WEEKLY, tables="bucketed")
    assert rows(result.reconciliation) == rows(reconcile(feeds))
    t = {name: spark.table(f"{database}.{name}") for name in SILVER_TABLES}
    assert rows(gold(t, result.excluded)) == rows(spark.table(f"{database}.gold_loan_scores_weekly").drop("loan_final_grade"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        by_loan = t["loans_repayments"].join(t["loans"], "loan_id")
        by_member = t["customers"].join(t["loans_defaulters_delinq"], "member_id").join(t["loans_defaulters_detail_rec_enq"], "member_id")
        for df in (by_loan, by_member, by_member.groupBy("member_id").count()):
            text = df._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in text and "Exchange" not in text
        # Scoring shuffles no repayments either; what goes on to the members are counts.
        text = gold(t, result.excluded, hot={})._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(loan_id" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(ValueError):
        run_silver(feeds, where, tables="bucketed")
