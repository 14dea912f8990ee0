"""Where results go: Parquet directories and catalog tables, always as a full overwrite."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from creditloom.sources.schemas import (
    SILVER_TABLES,
    T_BAD_MEMBERS,
    T_CUSTOMERS,
    T_DELINQ,
    T_GOLD_WEEKLY,
    T_LOANS,
    T_REC_ENQ,
    T_REPAYMENTS,
)

# --- fixed values: configuration keys of the paths ---

FEED_KEYS = {
    "customers": "customer.obj.path",
    "loans": "loan.obj.path",
    "repayments": "loanrepayments.obj.path",
    "defaulters": "defaulters.obj.path",
}
OUTPUT_KEYS = {
    T_CUSTOMERS: "customer.output.path",
    T_LOANS: "loan.output.path",
    T_REPAYMENTS: "loanrepayments.output.path",
    T_DELINQ: "defaulters.delinq.output.path",
    T_REC_ENQ: "defaulters.enq.output.path",
}
REJECT_KEYS = {
    T_CUSTOMERS: "customer.reject.path",
    T_LOANS: "loan.reject.path",
    T_REPAYMENTS: "loanrepayments.reject.path",
}
#: Only needed where malformed defaulter rows are told apart.
CORRUPT_KEYS = {T_REC_ENQ: "defaulters.reject.path"}
BAD_MEMBERS_KEY = "consolidated.reject.path"
GOLD_WEEKLY_KEY = "gold.weekly.output.path"


@dataclass(frozen=True)
class Locations:
    """Output directories by table."""

    silver: Mapping[str, str]
    rejected: Mapping[str, str]
    bad_members: str
    gold_weekly: str

    @classmethod
    def under(cls, root: str, version: str | None = None) -> Locations:
        """The usual layout below one directory. With a ``version`` each table's files go to a folder of that name in its directory."""
        below = f"/{version}" if version else ""
        return cls(
            silver={t: f"{root}/silver/{t}{below}" for t in SILVER_TABLES},
            rejected={t: f"{root}/error/{t}{below}" for t in (*REJECT_KEYS, T_REC_ENQ)},
            bad_members=f"{root}/error/{T_BAD_MEMBERS}{below}",
            gold_weekly=f"{root}/gold/{T_GOLD_WEEKLY}{below}",
        )

    @classmethod
    def new_version(cls, root: str) -> Locations:
        """:meth:`under` a version of its own, later in name than those before.

        Catalog tables are then pointed at the new files when these are complete, and whoever reads them keeps the files that
        the query began with. Old versions are left to the owner of the directory, who knows when the last reader is done.
        """
        return cls.under(root, f"version-{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}")

    @classmethod
    def from_mapping(cls, conf: Mapping[str, str]) -> Locations:
        """Read the paths from a flat configuration."""
        return cls(
            silver={t: conf[key] for t, key in OUTPUT_KEYS.items()},
            rejected={t: conf[key] for t, key in (REJECT_KEYS | CORRUPT_KEYS).items() if t in REJECT_KEYS or key in conf},
            bad_members=conf[BAD_MEMBERS_KEY],
            gold_weekly=conf[GOLD_WEEKLY_KEY],
        )


def qualified(database: str | None, name: str) -> str:
    return f"{database}.{name}" if database else name


def write_parquet(df: DataFrame, path: str, even: bool = False) -> DataFrame:
    """Overwrite ``path`` and return its content, so that later steps start from the stored files.

    ``even`` lets adaptive execution merge and split what is written to files near its advisory size; it costs a shuffle, so it is
    meant for results that are small, or that a shuffle or a strict filter leaves uneven. Rows that come straight from a
    scan need none: their files are as large as the scan's splits.
    """
    (df.hint("rebalance") if even else df).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def save_table(df: DataFrame, name: str, path: str | None = None, even: bool = False) -> DataFrame:
    """Overwrite a catalog table: managed without ``path``, external with it."""
    if path:
        return register_table(df.sparkSession, name, path, write_parquet(df, path, even).schema)
    (df.hint("rebalance") if even else df).write.mode("overwrite").format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def save_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Overwrite an external table whose files are dealt by the hash of ``key`` into ``buckets`` and sorted by it.

    Tables of like keys and buckets then join and aggregate on the key without a shuffle. All rows of a key lie in one bucket, which
    one task reads, so this layout is for keys of which none holds more than a task's share.
    """
    dealt = df.repartition(buckets, key)  # otherwise every task would write a file a bucket
    dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def register_table(spark: SparkSession, name: str, path: str, schema: StructType | None = None) -> DataFrame:
    """Point an external table at files that are already there; no data is copied.

    A table of the same columns stays and only changes its location, so that it never is missing for its readers.
    """
    schema = schema or spark.read.parquet(path).schema
    if spark.catalog.tableExists(name):
        same = [(f.name, f.dataType) for f in spark.table(name).schema] == [(f.name, f.dataType) for f in schema]
        if same and spark.catalog.getTable(name).tableType == "EXTERNAL":
            escaped = path.replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{escaped}'")
            spark.catalog.refreshTable(name)
            return spark.table(name)
        spark.sql(f"DROP TABLE {name}")
    spark.catalog.createTable(name, path=path, source="parquet", schema=schema)
    return spark.table(name)


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new directory in the shared folder the cluster names in ``spark.checkpoint.dir``.

    Where none is named, a local session gets a temporary folder; on a cluster that folder would differ from machine
    to machine, so there it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="creditloom-")
    return f"{folder.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
