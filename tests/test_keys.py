import pytest

from creditloom.operators import duplicate_keys, exclude_keys


def keys(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "member_id string")


def members(df):
    return sorted((r.member_id for r in df.collect()), key=repr)


def test_duplicates_inside_each_table(spark):
    found = duplicate_keys([keys(spark, "a", "a", "b"), keys(spark, "b", "c", "c", "c"), keys(spark, "d", "a", "a")], "member_id")
    assert members(found) == ["a", "c"]  # b occurs twice overall, but once per table


def test_duplicate_null_key_is_listed_once(spark):
    assert members(duplicate_keys([keys(spark, None, None), keys(spark, None, None)], "member_id")) == [None]
    assert members(duplicate_keys([keys(spark, None), keys(spark, None)], "member_id")) == []


@pytest.mark.parametrize(
    "listed, not_in, ignore",
    [
        (["a"], ["b", "b"], ["b", "b", None]),
        ([], ["a", "b", "b", None], ["a", "b", "b", None]),
        (["a", None], [], ["b", "b", None]),
        ([None], [], ["a", "b", "b", None]),
    ],
)
@pytest.mark.parametrize("bypass", [False, True])
def test_exclusion_follows_sql_not_in(spark, listed, not_in, ignore, bypass):
    df, exclude = keys(spark, "a", "b", "b", None), keys(spark, *listed)
    assert members(exclude_keys(df, exclude, "member_id", bypass=bypass)) == sorted(not_in, key=repr)
    assert members(exclude_keys(df, exclude, "member_id", null_mode="ignore", bypass=bypass)) == sorted(ignore, key=repr)
    df.createOrReplaceTempView("probe")
    exclude.createOrReplaceTempView("listed")
    literal = spark.sql("SELECT * FROM probe WHERE member_id NOT IN (SELECT member_id FROM listed)")
    assert members(literal) == sorted(not_in, key=repr)


def test_exclusion_is_idempotent(spark):
    df, exclude = keys(spark, "a", "b", "c"), keys(spark, "b")
    once = exclude_keys(df, exclude, "member_id")
    assert members(exclude_keys(once, exclude, "member_id")) == members(once) == ["a", "c"]


def test_inferred_numeric_list(spark):
    numbers = spark.createDataFrame([(17,), (18,)], "member_id int")
    assert members(exclude_keys(keys(spark, "17", "m9"), numbers, "member_id")) == ["m9"]


def test_unknown_null_mode(spark):
    with pytest.raises(ValueError):
        exclude_keys(keys(spark, "a"), keys(spark, "b"), "member_id", null_mode="other")


def test_large_list_is_not_forced_into_a_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = exclude_keys(keys(spark, "a"), keys(spark, "b"), "member_id")
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "LeftAnti" in plan
    assert "Broadcast" not in plan


def test_bypass_keeps_unlisted_rows_out_of_the_shuffle(spark, shuffled_rows, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spark.range(0, 60_000, 1, 8).selectExpr("if(id % 3 = 0, 'hot', concat('m', id)) AS member_id", "id").write.parquet(f"{tmp_path}/rows")
        spark.range(0, 500).selectExpr("concat('m', id) AS member_id").write.parquet(f"{tmp_path}/list")
        df, listed = spark.read.parquet(f"{tmp_path}/rows"), spark.read.parquet(f"{tmp_path}/list")
        kept = exclude_keys(df, listed, "member_id", bypass=True)
        stages = shuffled_rows(lambda: kept.write.format("noop").mode("overwrite").save())
        assert sum(map(sum, stages)) < 5_000  # the list twice, its bitmap, and what the bitmap does not let by
        assert kept.count() == exclude_keys(df, listed, "member_id").count() == 60_000 - 333
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
