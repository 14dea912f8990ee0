"""The batch job: feeds -> cleansed and quarantined tables -> exclusion list -> score views -> weekly grades."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from creditloom.operators.cleanse import clean_customers, clean_loans, clean_repayments, corrupt_defaulters, split_defaulters
from creditloom.operators.keys import duplicate_keys
from creditloom.operators.points import ScoreParams
from creditloom.operators.reconcile import COUNTED_WHILE_WRITTEN, reconcile, reconcile_written
from creditloom.operators.scoring import LOAN, MEMBER, ROW_COUNT, gold, grade, hot_members
from creditloom.operators.skew import repeat_rows
from creditloom.plans.tables import (
    FEED_KEYS,
    Locations,
    qualified,
    register_table,
    save_bucketed,
    save_table,
    scratch_path,
    write_parquet,
)
from creditloom.plans.views import deploy_views
from creditloom.sources.feeds import feed_format, read_feed
from creditloom.sources.schemas import (
    T_BAD_MEMBERS,
    T_BAD_MEMBERS_INTERNAL,
    T_CUSTOMERS,
    T_DELINQ,
    T_GOLD_WEEKLY,
    T_LOANS,
    T_REC_ENQ,
    T_REPAYMENTS,
)

DAILY, WEEKLY = "DAILY", "WEEKLY"

#: The list that the persistent views use when it is not the one found by the job.
T_EXCLUDED = "excluded_members"

WRITERS = 4  # silver tables written at a time
UNEVEN = (T_CUSTOMERS, T_DELINQ)  # silver tables that a shuffle or a filter leaves in files of any size
ROWS_A_TASK = 1 << 20  # weekly scores that a task spells out and writes; they repeat, so their files come out small

logger = logging.getLogger(__name__)


class Counts(NamedTuple):
    """What was counted while writing: aggregates over feeds, and rows by table (rejects: ``<table>_rejected``)."""

    seen: dict[str, dict[str, int]]
    stored: dict[str, int]


class SilverTables(NamedTuple):
    """Stored tables by name."""

    good: dict[str, DataFrame]
    rejected: dict[str, DataFrame]
    counts: Counts | None = None


class RunResult(NamedTuple):
    silver: SilverTables
    excluded: DataFrame
    weekly: DataFrame | None
    reconciliation: DataFrame


def open_feeds(
    spark: SparkSession, paths: Mapping[str, str], fmt: str | None = None, corrupt_column: str | None = None
) -> dict[str, DataFrame]:
    """Read the four feeds. CSV text is parsed once: it is stored as Parquet in the shared scratch folder, and the
    passes that follow (good rows, rejects, counts) read columns from there.

    With ``corrupt_column`` every feed has a column of that name: the raw text of CSV rows that could not be parsed, else NULL.
    """
    feeds = {}
    for name, path in paths.items():
        feed = read_feed(spark, name, path, fmt, corrupt_column)
        if feed_format(path, fmt) != "parquet":
            feed = write_parquet(feed, scratch_path(spark, name))
        feeds[name] = feed
    return feeds


def open_configured_feeds(spark: SparkSession, conf: Mapping[str, str]) -> dict[str, DataFrame]:
    """:func:`open_feeds` with the paths of a flat configuration."""
    return open_feeds(spark, {feed: conf[key] for feed, key in FEED_KEYS.items()})


def run_silver(
    feeds: Mapping[str, DataFrame],
    locations: Locations,
    database: str | None = None,
    ingest_ts: Column | None = None,
    tables: str = "external",
    corrupt_column: str | None = None,
) -> SilverTables:
    """Cleanse the four feeds and store good rows and rejects, with ``corrupt_column`` also those that could not be parsed.

    With a database the good rows also become catalog tables: ``tables="external"`` registers the directory just
    written, ``"managed"`` stores a second copy that the catalog owns, and ``"bucketed"`` stores loans and repayments in buckets
    by loan and the member tables in buckets by member, as many as the session's shuffles have partitions. Joins on those keys
    then read the buckets without a shuffle; see :func:`creditloom.plans.tables.save_bucketed` for when it pays.
    """
    if tables not in ("external", "managed", "bucketed"):
        raise ValueError(f"tables must be 'external', 'managed' or 'bucketed', not {tables!r}")
    if tables == "bucketed" and not database:
        raise ValueError("buckets are kept by the catalog; name a database")
    observed = {feed: Observation() for feed in COUNTED_WHILE_WRITTEN}
    watched = {
        feed: feeds[feed].observe(seen, *[c.alias(n) for n, c in COUNTED_WHILE_WRITTEN[feed](corrupt_column).items()])
        for feed, seen in observed.items()
    }
    splits = {
        T_CUSTOMERS: clean_customers(feeds["customers"], ingest_ts, corrupt_column),
        T_LOANS: clean_loans(watched["loans"], ingest_ts, corrupt_column),
        T_REPAYMENTS: clean_repayments(watched["repayments"], ingest_ts, corrupt_column),
    }
    defaulters = split_defaulters(watched["defaulters"], corrupt_column)
    results = {t: split.good for t, split in splits.items()} | {T_REC_ENQ: defaulters.rec_enq}
    results[T_DELINQ] = split_defaulters(feeds["defaulters"], corrupt_column).delinq  # rows are counted in one write only
    rejects = {
        T_CUSTOMERS: splits[T_CUSTOMERS].rejected,
        T_LOANS: clean_loans(feeds["loans"], ingest_ts, corrupt_column).rejected,
        T_REPAYMENTS: clean_repayments(feeds["repayments"], ingest_ts, corrupt_column).rejected,
    }
    if corrupt_column:
        rejects[T_REC_ENQ] = corrupt_defaulters(feeds["defaulters"], corrupt_column, ingest_ts)
    if tables == "bucketed":
        return _bucketed(results, rejects, locations, database)
    with ThreadPoolExecutor(WRITERS) as pool:  # independent writes fill the gaps that the last tasks of others leave
        good = {t: pool.submit(_counted, df, locations.silver[t], t in UNEVEN) for t, df in results.items()}
        rejected = {t: pool.submit(_counted, df, locations.rejected[t], True) for t, df in rejects.items()}
        good = {t: written.result() for t, written in good.items()}
        rejected = {t: written.result() for t, written in rejected.items()}
    stored = {t: n for t, (_, n) in good.items()} | {f"{t}_rejected": n for t, (_, n) in rejected.items()}
    counts = Counts({feed: seen.get for feed, seen in observed.items()}, stored)
    if database:
        for t, (written, _) in good.items():
            if tables == "managed":
                save_table(written, qualified(database, t))
            else:
                register_table(written.sparkSession, qualified(database, t), locations.silver[t], written.schema)
    return SilverTables({t: df for t, (df, _) in good.items()}, {t: df for t, (df, _) in rejected.items()}, counts)


def _bucketed(
    results: Mapping[str, DataFrame], rejects: Mapping[str, DataFrame], locations: Locations, database: str
) -> SilverTables:
    """Dealing rows to buckets is a shuffle, so they are not counted on the way to it (see ``COUNTED_WHILE_WRITTEN``)."""
    good = {}
    for t, df in results.items():
        key = LOAN if t in (T_LOANS, T_REPAYMENTS) else MEMBER
        buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        good[t] = save_bucketed(df, qualified(database, t), locations.silver[t], key, buckets)
    return SilverTables(good, {t: write_parquet(df, locations.rejected[t], even=True) for t, df in rejects.items()})


def _counted(df: DataFrame, path: str, even: bool) -> tuple[DataFrame, int]:
    """Store ``df`` and count its rows on the way, in the tasks that write them."""
    rows = Observation()
    df = df.hint("rebalance") if even else df
    written = write_parquet(df.observe(rows, F.count(F.lit(1)).alias("n")), path)
    return written, rows.get["n"]


def run_exclusions(
    silver: Mapping[str, DataFrame], locations: Locations, database: str | None = None, tables: str = "external"
) -> DataFrame:
    """Store the members that occur more than once in a member-level table. One write serves both table names, unless
    ``tables="managed"`` asks for a second copy that the catalog owns."""
    spark = silver[T_CUSTOMERS].sparkSession
    found = duplicate_keys([silver[t] for t in (T_CUSTOMERS, T_DELINQ, T_REC_ENQ)], "member_id")
    if not database:
        stored = write_parquet(found, locations.bad_members, even=True)
        stored.createOrReplaceTempView(T_BAD_MEMBERS)
        return stored
    stored = save_table(found, qualified(database, T_BAD_MEMBERS), locations.bad_members, even=True)
    if tables == "managed":
        save_table(stored, qualified(database, T_BAD_MEMBERS_INTERNAL))
    else:
        register_table(spark, qualified(database, T_BAD_MEMBERS_INTERNAL), locations.bad_members)
    return stored


def run_gold(
    silver: Mapping[str, DataFrame],
    excluded: DataFrame,
    locations: Locations,
    database: str | None = None,
    params: ScoreParams | None = None,
    schedule: str = DAILY,
    basis: str = "financial_health",
    null_mode: str = "not_in",
    grain: str = "member",
    weighted: bool = False,
    excluded_table: str | None = None,
) -> DataFrame | None:
    """Deploy the score views; on a WEEKLY run also store the graded scores. Other schedules stop at the views.

    ``grain`` and ``weighted`` shape the stored scores as in :func:`creditloom.operators.scoring.gold`. Views and stored
    scores leave out the same members: with a database, ``excluded`` is stored as a table of its own for the views, unless
    ``excluded_table`` names one of that database that holds it already.
    """
    spark = excluded.sparkSession
    if not database:
        for table, df in silver.items():
            df.createOrReplaceTempView(table)
    elif not excluded_table:
        excluded_table = T_EXCLUDED
        excluded = save_table(excluded, qualified(database, excluded_table))
    hot = hot_members(silver) if schedule == WEEKLY or not database else {}
    deploy_views(spark, database, params, hot, excluded_table if database else excluded, null_mode)
    if schedule != WEEKLY:
        return None
    # The distinct scores are stored first, a few rows a member; their number says how many tasks spell them out.
    scores = write_parquet(gold(silver, excluded, params, null_mode, grain, True, hot), scratch_path(spark, "scores"), even=True)
    if not weighted:
        total = scores.agg(F.sum(ROW_COUNT)).first()[0] or 0
        scores = repeat_rows(scores, ROW_COUNT, tasks=max(1, -(-total // ROWS_A_TASK))).drop(ROW_COUNT)
    graded = grade(scores, params, basis)
    if not database:
        return write_parquet(graded, locations.gold_weekly, even=weighted)
    return save_table(graded, qualified(database, T_GOLD_WEEKLY), locations.gold_weekly, even=weighted)


def run(
    feeds: Mapping[str, DataFrame],
    locations: Locations,
    database: str | None = None,
    params: ScoreParams | None = None,
    schedule: str = DAILY,
    basis: str = "financial_health",
    null_mode: str = "not_in",
    grain: str = "member",
    weighted: bool = False,
    tables: str = "external",
    listed: DataFrame | None = None,
    corrupt_column: str | None = None,
) -> RunResult:
    """The whole job with one ingest time for all tables. Every stage starts from the files of the one before, so a
    lost executor never sends the work back to the feeds. ``listed`` (as :func:`creditloom.sources.read_key_list` reads it) takes the
    place of the members found here when scoring; those are stored all the same. ``corrupt_column``: as in :func:`open_feeds`."""
    schedule = schedule.upper()
    spark = feeds["customers"].sparkSession
    now = spark.range(1).select(F.current_timestamp()).first()[0]
    silver = run_silver(feeds, locations, database, F.lit(now), tables, corrupt_column)
    excluded = run_exclusions(silver.good, locations, database, tables)
    own = T_BAD_MEMBERS_INTERNAL if listed is None else None
    excluded = excluded if listed is None else listed
    weekly = run_gold(
        silver.good, excluded, locations, database, params, schedule, basis, null_mode, grain, weighted, own
    )
    if silver.counts:
        counted = reconcile_written(feeds["customers"], *silver.counts, corrupt_column)
    else:
        written = silver.good | {f"{t}_rejected": df for t, df in silver.rejected.items()}
        counted = reconcile(feeds, written, corrupt_column)
    return RunResult(silver, excluded, weekly, counted)


def report(reconciliation: DataFrame) -> list[str]:
    """Log one line per feed, as a warning where the counts do not add up, and return the lines (four at most)."""
    lines = []
    for row in reconciliation.collect():
        known = {c: n for c, n in row.asDict().items() if n is not None and c != "feed"}
        lines.append(f"{row['feed']}: " + ", ".join(f"{c}={n}" for c, n in known.items()))
        logger.log(logging.WARNING if row["balanced"] is False else logging.INFO, lines[-1])
    return lines
