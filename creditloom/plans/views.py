"""The three stacked score views.

Without a database they are temporary views over the DataFrame operators. With one they are persistent views, whose
definition has to be SQL text; it is assembled from the same point rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from creditloom.operators import points
from creditloom.operators.keys import check_null_mode
from creditloom.operators.points import ParameterNames, ScoreParams
from creditloom.operators.scoring import GOLD_COLUMNS, LEDGER_COLUMNS, LOAN, gold, grade, hot_members, ledger, payment_history
from creditloom.operators.skew import SLICE, HotKeys, hot_keys_sql, repeat_rows_sql, replicate_sql, spread_sql
from creditloom.plans.tables import qualified
from creditloom.sources.schemas import (
    SILVER_TABLES,
    T_BAD_MEMBERS,
    T_BAD_MEMBERS_INTERNAL,
    T_CUSTOMERS,
    T_DELINQ,
    T_LOANS,
    T_REC_ENQ,
    T_REPAYMENTS,
    V_GOLD,
    V_LEDGER,
    V_PAYMENT_HISTORY,
)


def deploy_views(
    spark: SparkSession,
    database: str | None = None,
    params: ScoreParams | None = None,
    hot: HotKeys | None = None,
    excluded: DataFrame | str | None = None,
    null_mode: str = "not_in",
) -> None:
    """Create or replace the views over the cleansed tables of ``database`` (default: tables and views by bare name).

    The parameter values are part of the definition, so a later change needs a new deployment. ``excluded`` is the list
    of members to leave out: the name of a table, or without a database also a DataFrame (default: the stored list).
    """
    params = params or ScoreParams()
    if database:
        if isinstance(excluded, DataFrame):
            raise ValueError("a persistent view refers to its list by name; store it as a table first")
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        for name, body in view_definitions(database, params, excluded, null_mode, tasks).items():
            spark.sql(f"CREATE OR REPLACE VIEW {qualified(database, name)} AS {body}")
        return
    silver = {t: spark.table(t) for t in SILVER_TABLES}
    if not isinstance(excluded, DataFrame):
        excluded = spark.table(excluded or T_BAD_MEMBERS)
    hot = hot_members(silver) if hot is None else hot
    payment_history(silver, excluded, params, null_mode).createOrReplaceTempView(V_PAYMENT_HISTORY)
    ledger(silver, excluded, params, null_mode, hot).createOrReplaceTempView(V_LEDGER)
    gold(silver, excluded, params, null_mode, hot=hot).createOrReplaceTempView(V_GOLD)


def deploy_functions(
    spark: SparkSession,
    database: str,
    defaults: ScoreParams | None = None,
    excluded: str | None = None,
    null_mode: str = "not_in",
    basis: str = "financial_health",
) -> None:
    """Create or replace table functions of ``database`` that return what the views hold, with points and cutoffs as parameters.

    A change of points needs no new deployment: ``SELECT * FROM gold_loan_scores(p_excellent => 900)`` (with ``database`` as the
    current one: Spark calls table functions by their bare names). The functions are ``payment_history_scores``, ``ledger_scores`` and ``gold_loan_scores``, the last with the grade; parameters are named like the
    fields of :class:`ScoreParams` with ``p_`` before them and default to ``defaults``.
    """
    defaults = defaults or ScoreParams()
    names = ParameterNames()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = view_definitions(database, defaults, excluded, null_mode, tasks, stacked=False)
    bodies = view_definitions(database, names, excluded, null_mode, tasks, stacked=False)

    def graded(gold: str, params: ScoreParams | ParameterNames) -> str:
        return f"SELECT *, {points.final_grade(params, basis)} AS loan_final_grade FROM ({gold})"

    functions = {
        "payment_history_scores": (bodies[V_PAYMENT_HISTORY], plain[V_PAYMENT_HISTORY]),
        "ledger_scores": (bodies[V_LEDGER], plain[V_LEDGER]),
        "gold_loan_scores": (graded(bodies[V_GOLD], names), graded(plain[V_GOLD], defaults)),
    }
    for name, (body, example) in functions.items():
        columns = ", ".join(f"{c} {t}" for c, t in spark.sql(example).dtypes)
        spark.sql(
            f"CREATE OR REPLACE FUNCTION {qualified(database, name)}({ParameterNames.declared(defaults)}) "
            f"RETURNS TABLE ({columns}) RETURN {body}"
        )


def weekly_scores(
    spark: SparkSession, database: str | None = None, params: ScoreParams | None = None, basis: str = "financial_health"
) -> DataFrame:
    """Grade the rows of the deployed gold view."""
    return grade(spark.table(qualified(database, V_GOLD)), params, basis)


def view_definitions(
    database: str,
    params: ScoreParams | ParameterNames,
    excluded: str | None = None,
    null_mode: str = "not_in",
    tasks: int = 200,
    stacked: bool = True,
) -> dict[str, str]:
    """View name -> SELECT text, in order of deployment. ``excluded`` names a table (default: the stored list).

    ``tasks`` is what a member's share of the rows is measured by; rows are also spelled out in as many tasks. Both hold
    however the tables change after deployment. ``stacked`` texts read the view before them, others hold its text."""
    check_null_mode(null_mode)
    t = {name: qualified(database, name) for name in (*SILVER_TABLES, V_PAYMENT_HISTORY, V_LEDGER)}
    excluded = qualified(database, excluded or T_BAD_MEMBERS_INTERNAL)

    def not_listed(member: str, listed: str, *also: str) -> tuple[str, str]:
        """NOT IN as an anti join plus its NULL rules (a literal NOT IN would have to broadcast the list)."""
        join = f"LEFT ANTI JOIN {listed} x ON " + " AND ".join([f"x.member_id = {member}", *also])
        if null_mode == "ignore":
            return join, "true"
        nulls = (
            f"(SELECT count_if(member_id IS NULL) FROM {excluded}) = 0 "
            f"AND ({member} IS NOT NULL OR (SELECT count(*) FROM {excluded}) = 0)"
        )
        return join, nulls

    # Members that hold a large share of the loans are found when the view is read; their loans are cut into slices,
    # and what meets them by member is copied to each slice.
    hot = f"hot AS ({hot_keys_sql(t[T_LOANS], 'member_id', tasks)}), sliced AS ({spread_sql(t[T_LOANS], 'member_id', 'hot', LOAN)})"

    # As in `scoring.payment_history`, the list is applied to loans.
    join, nulls = not_listed("l.member_id", f"({replicate_sql(excluded, 'member_id', 'hot')})", f"x.{SLICE} = l.{SLICE}")
    payment = (
        f"WITH {hot}, kept AS (SELECT l.* FROM sliced l {join} WHERE {nulls}) "
        f"SELECT member_id, {points.last_payment_points(params)} AS last_payment_pts, "
        f"{points.total_payment_points(params)} AS total_payment_pts "
        f"FROM {t[T_REPAYMENTS]} r JOIN kept k ON r.loan_id = k.loan_id"
    )
    if not stacked:
        t[V_PAYMENT_HISTORY] = f"({payment})"
    # Every side is counted by its points before the members meet, so that a member has a handful of rows in the joins.
    join, nulls = not_listed("e.member_id", excluded)
    ledger_columns = ", ".join(LEDGER_COLUMNS)
    counted = (
        f"paid AS (SELECT member_id, last_payment_pts, total_payment_pts, count(*) AS payments FROM {t[V_PAYMENT_HISTORY]} GROUP BY ALL), "
        f"late AS (SELECT member_id, {points.delinquency_points(params)} AS delinq_pts, count(*) AS lates FROM {t[T_DELINQ]} GROUP BY ALL), "
        f"records AS (SELECT member_id, {points.public_record_points(params)} AS public_records_pts, "
        f"{points.bankruptcy_points(params)} AS public_bankruptcies_pts, {points.enquiry_points(params)} AS enq_pts, "
        f"count(*) AS records FROM {t[T_REC_ENQ]} GROUP BY ALL), "
        "history AS (SELECT p.*, delinq_pts, public_records_pts, public_bankruptcies_pts, enq_pts, payments * lates * records AS n "
        "FROM records e JOIN late d ON e.member_id = d.member_id JOIN paid p ON e.member_id = p.member_id "
        f"{join} WHERE {nulls})"
    )
    history = f"WITH {counted} {repeat_rows_sql('history', ledger_columns, 'n', tasks)}"
    # As in `scoring.gold`, pairs of payments and loans are counted first and spelled out last.
    pairs = (
        f"WITH {hot}, {counted}, "
        f"scored AS (SELECT member_id, {points.payment_history_score()} AS payment_history_pts, "
        f"{points.defaulters_history_score()} AS defaulters_history_pts, sum(n) AS payments FROM history GROUP BY ALL), "
        f"people AS ({replicate_sql(t[T_CUSTOMERS], 'member_id', 'hot')}), "
        f"held AS (SELECT l.member_id, l.{SLICE}, {points.financial_health_score(params)} AS financial_health_pts, count(*) AS loans "
        f"FROM sliced l JOIN people c ON l.member_id = c.member_id AND l.{SLICE} = c.{SLICE} GROUP BY ALL), "
        "pairs AS (SELECT scored.*, financial_health_pts, scored.payments * loans AS n FROM scored JOIN held USING (member_id)) "
        + repeat_rows_sql("pairs", ", ".join(GOLD_COLUMNS), "n", tasks)
    )
    return {V_PAYMENT_HISTORY: payment, V_LEDGER: history, V_GOLD: pairs}
