import pytest
from pyspark.sql import functions as F

from creditloom.sources import feed_format, read_feed, read_key_list
from creditloom.sources.schemas import FEEDS, LOAN_RENAMES


@pytest.mark.parametrize(
    "path, fmt, expected",
    [
        ("/x/loans.csv", None, "csv"),
        ("/x/loans", None, "csv"),
        ("/x/loans_PARQUET/part", None, "parquet"),
        ("/x/loans", "Parquet", "parquet"),
        ("/x/loans_parquet", "csv", "csv"),
    ],
)
def test_format(path, fmt, expected):
    assert feed_format(path, fmt) == expected


@pytest.mark.parametrize("name", list(FEEDS))
def test_feed_columns(spark, tmp_path, name):
    """Schemas and renames of every feed, for both formats."""
    schema, renames = FEEDS[name]
    row = tuple("1" if f.dataType.simpleString() == "string" else 1.5 for f in schema.fields)
    df = spark.createDataFrame([row], schema)
    df.write.option("header", True).csv(f"{tmp_path}/c")
    df.write.parquet(f"{tmp_path}/parquet")
    for path in (f"{tmp_path}/c", f"{tmp_path}/parquet"):
        read = read_feed(spark, name, path)
        assert read.columns == [renames.get(c, c) for c in schema.names]
        assert [f.dataType for f in read.schema] == [f.dataType for f in schema]
        assert [tuple(r) for r in read.collect()] == [row]


def test_customers_keep_their_source_names():
    assert FEEDS["customers"][1] == {} and FEEDS["loans"][1] == LOAN_RENAMES and len(LOAN_RENAMES) == 8


def test_malformed_csv_is_permissive(spark, tmp_path):
    (tmp_path / "loans.csv").write_text(
        "any,header,at,all,is,ignored,since,the,schema,is,positional\n"
        "L1,M1,abc,1000,36 months,5,100,2024-01-01,Current,car,ok\n"  # bad number
        "L2,M2,1000,1000\n"  # short
        "L3,M3,1000,1000,36 months,5,100,2024-01-01,Current,car,ok,surplus\n"
        "L4,M4,1000,1000,36 months,5,NaN,2024-01-01,Current,car,\n"
    )
    rows = {r.loan_id: r for r in read_feed(spark, "loans", f"{tmp_path}/loans.csv").collect()}
    assert rows["L1"].loan_amount is None and rows["L1"].funded_amount == 1000
    assert rows["L2"].loan_term_months is None and rows["L2"].loan_title is None
    assert rows["L3"].loan_title == "ok"
    assert rows["L4"].monthly_installment != rows["L4"].monthly_installment and rows["L4"].loan_title is None

    marked = read_feed(spark, "loans", f"{tmp_path}/loans.csv", corrupt_column="_bad").cache()
    assert sorted(r.loan_id for r in marked.filter(F.col("_bad").isNotNull()).collect()) == ["L1", "L2", "L3"]
    assert marked.filter("loan_id = 'L1'").first()["_bad"].startswith("L1,M1,abc")
    marked.unpersist()


def test_parquet_of_other_types_is_conformed(spark, tmp_path):
    df = spark.createDataFrame([("R1", 1.25, 2)], "loan_id string, total_rec_prncp double, TOTAL_REC_INT int")
    df.write.parquet(f"{tmp_path}/parquet")
    read = read_feed(spark, "repayments", f"{tmp_path}/parquet")
    first = read.first()
    assert dict(read.dtypes)["total_principal_received"] == "float"
    assert (first.total_principal_received, first.total_interest_received, first.last_payment_date) == (1.25, 2.0, None)


def test_key_list(spark, tmp_path):
    df = spark.createDataFrame([("17",), ("x",)], "member_id string")
    df.write.option("header", True).csv(f"{tmp_path}/list")
    df.write.parquet(f"{tmp_path}/list_parquet")
    for path in ("list", "list_parquet"):
        read = read_key_list(spark, f"{tmp_path}/{path}")
        assert read.columns == ["member_id"] and sorted(r[0] for r in read.collect()) == ["17", "x"]
    df.limit(1).write.option("header", True).csv(f"{tmp_path}/numbers")
    assert dict(read_key_list(spark, f"{tmp_path}/numbers").dtypes)["member_id"] == "int"  # a CSV list is inferred
