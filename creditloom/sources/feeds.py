"""Readers for the raw feeds and for the exclusion list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from creditloom.sources.schemas import FEEDS


def feed_format(path: str, fmt: str | None = None) -> str:
    """An explicit format wins; otherwise a path that mentions parquet is Parquet, anything else CSV."""
    if fmt:
        return fmt.lower()
    return "parquet" if "parquet" in path.lower() else "csv"


def read_feed(
    spark: SparkSession,
    name: str,
    path: str,
    fmt: str | None = None,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Read feed ``name`` (customers, loans, repayments, defaulters) under its fixed schema.

    CSV is read with a header in permissive mode: a bad number becomes NULL, a short row ends in NULLs,
    surplus fields are ignored. ``corrupt_column`` keeps the raw text of such CSV rows in a column of that
    name, so they can be told from rows whose values were simply missing.
    """
    schema, renames = FEEDS[name]
    if feed_format(path, fmt) == "parquet":
        df = _conform(spark.read.parquet(path), schema)
        if corrupt_column:
            df = df.withColumn(corrupt_column, F.lit(None).cast("string"))  # Parquet rows are never malformed
    else:
        reader = spark.read.option("header", True)
        if corrupt_column:
            schema = StructType(list(schema.fields)).add(corrupt_column, StringType())
            reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
        df = reader.schema(schema).csv(path)
    return df.withColumnsRenamed(renames)


def _conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Give Parquet files of other numeric widths the feed's types.

    A column that already has the right type stays a bare reference, so its filters still reach the scan.
    """
    found = {f.name.lower(): f for f in df.schema.fields}

    def column(field):
        have = found.get(field.name.lower())
        if have is None:
            return F.lit(None).cast(field.dataType).alias(field.name)
        if have.dataType == field.dataType:
            return F.col(have.name).alias(field.name)
        return F.col(have.name).try_cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in schema.fields])


def read_key_list(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Read an exclusion list. Parquet carries its own schema; a CSV list has a header and is inferred."""
    if feed_format(path, fmt) == "parquet":
        return spark.read.parquet(path)
    return spark.read.option("header", True).option("inferSchema", True).csv(path)
