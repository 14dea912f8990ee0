"""Score tables built from the cleansed tables.

Column names do not overlap between the cleansed tables except for the keys, so rules refer to plain names.

The member-level score pairs every scored repayment of a member with every loan of that member. Joining the rows
themselves would push all those pairs through the joins, so both sides are first reduced to distinct scores with a row
count: a member then has a handful of rows on each side however many loans they hold. Pairs are only spelled out, row
by row, at the very end and only when asked for (``weighted=False``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.operators import points
from creditloom.operators.keys import check_null_mode, exclude_keys, nothing_unknown
from creditloom.operators.points import ScoreParams
from creditloom.operators.skew import HotKeys, hot_keys, listed, repeat_rows, replicate, slice_key, spread
from creditloom.sources.schemas import T_CUSTOMERS, T_DELINQ, T_LOANS, T_REC_ENQ, T_REPAYMENTS

MEMBER = "member_id"
LOAN = "loan_id"
ROW_COUNT = "row_count"

Silver = Mapping[str, DataFrame]  # table name -> cleansed table

PAYMENT_COLUMNS = (MEMBER, "last_payment_pts", "total_payment_pts")
LEDGER_COLUMNS = (
    *PAYMENT_COLUMNS,
    "delinq_pts",
    "public_records_pts",
    "public_bankruptcies_pts",
    "enq_pts",
)
GOLD_COLUMNS = (MEMBER, "payment_history_pts", "defaulters_history_pts", "financial_health_pts")


def _repaid_loans(silver: Silver, params: ScoreParams, *loan_columns: str, hot_loans: HotKeys | None = None) -> DataFrame:
    """Repayments joined to their loans, with both payment scores. Loans without repayments drop out.

    With ``hot_loans``, like repayments of a loan become one row with their number, and those of a hot loan are cut into
    slices; number and slice stay in the result.
    """
    loans = silver[T_LOANS].select(LOAN, MEMBER, "funded_amount", "monthly_installment", *loan_columns)
    paid = silver[T_REPAYMENTS].select(LOAN, "last_payment_amount", "total_payment_received")
    if hot_loans:
        paid = paid.groupBy(*paid.columns).agg(F.count(F.lit(1)).alias(ROW_COUNT))
        paid = spread(paid, LOAN, hot_loans, "last_payment_amount", "total_payment_received")
        loans = replicate(loans, LOAN, hot_loans)
    return paid.join(loans, slice_key(LOAN, hot_loans or {})).withColumns(
        {
            "last_payment_pts": F.expr(points.last_payment_points(params)),
            "total_payment_pts": F.expr(points.total_payment_points(params)),
        }
    )


def payment_history(
    silver: Silver, exclusions: DataFrame, params: ScoreParams | None = None, null_mode: str = "not_in"
) -> DataFrame:
    """One row per repayment of a loan whose member is not excluded.

    The list is applied to loans, so that repayments are never shuffled by member.
    """
    kept = exclude_keys(silver[T_LOANS], exclusions, MEMBER, null_mode)
    return _repaid_loans({**silver, T_LOANS: kept}, params or ScoreParams()).select(*PAYMENT_COLUMNS)


class _Members:
    """Member-level tables prepared for joining on the member, or on ``(member, slice)`` when members are hot.

    Excluded members that are hot leave while scanning, before anything is shuffled; hot members that stay get one
    copy per slice.
    """

    def __init__(self, silver: Silver, exclusions: DataFrame, null_mode: str, hot: HotKeys | None):
        check_null_mode(null_mode)
        exclusions = exclusions.select(F.col(MEMBER).cast("string").alias(MEMBER))
        found = hot_members(silver) if hot is None else hot
        self.gone = listed(exclusions, MEMBER, found)
        self.hot = {member: slices for member, slices in found.items() if member not in self.gone}
        self.on = slice_key(MEMBER, self.hot)
        self.silver, self.exclusions, self.null_mode = silver, exclusions, null_mode

    def staying(self, df: DataFrame) -> DataFrame:
        return df.filter(~F.col(MEMBER).isin(*self.gone)) if self.gone else df

    def spread(self, df: DataFrame, *by: str) -> DataFrame:
        return spread(self.staying(df), MEMBER, self.hot, *(by or (LOAN,)))

    def replicate(self, df: DataFrame) -> DataFrame:
        return replicate(self.staying(df), MEMBER, self.hot)

    def table(self, name: str, *columns: str) -> DataFrame:
        return self.replicate(self.silver[name].select(MEMBER, *columns))

    def delinquent(self, params: ScoreParams) -> DataFrame:
        """Members present in both defaulter tables and not excluded, with their four point columns."""
        enquiries = self.table(T_REC_ENQ, "pub_rec", "pub_rec_bankruptcies", "inq_last_6mths")
        # A member that is both excluded and hot is gone by now, so the rest of the list sits in slice 0; it goes
        # through the same step as the tables and the joins keep one common partitioning.
        excluded = replicate(self.exclusions, MEMBER, self.hot)
        kept = exclude_keys(enquiries, excluded, MEMBER, "ignore", on=self.on[1:])
        if self.null_mode == "not_in":
            # The joins drop NULL members anyway, so of the NULL rules only this one is left. It refers to no column
            # and is therefore checked on this table alone; the other scans do not wait for the list.
            kept = kept.filter(nothing_unknown(self.exclusions, MEMBER))
        return kept.join(self.table(T_DELINQ, "delinq_2yrs"), self.on).select(
            *self.on,
            F.expr(points.delinquency_points(params)).alias("delinq_pts"),
            F.expr(points.public_record_points(params)).alias("public_records_pts"),
            F.expr(points.bankruptcy_points(params)).alias("public_bankruptcies_pts"),
            F.expr(points.enquiry_points(params)).alias("enq_pts"),
        )


def hot_members(silver: Silver, parallelism: int | None = None) -> dict[str, int]:
    """Members that hold more rows than an average task. Runs one job over the member columns.

    The delinquency table is a subset of the enquiry table's rows and needs no look of its own.
    """
    return hot_keys([silver[t] for t in (T_LOANS, T_CUSTOMERS, T_REC_ENQ) if t in silver], MEMBER, parallelism)


def ledger(
    silver: Silver,
    exclusions: DataFrame,
    params: ScoreParams | None = None,
    null_mode: str = "not_in",
    hot: HotKeys | None = None,
) -> DataFrame:
    """Payment scores with the member's delinquency, record and enquiry scores; one row per scored repayment.

    Members without a delinquency have no row in the delinquency table and therefore no score. ``hot`` takes the
    result of :func:`hot_members`; by default it is computed here.
    """
    params = params or ScoreParams()
    members = _Members(silver, exclusions, null_mode, hot)
    # Repayments are counted before they meet their member: one with very many has a handful of rows in the join.
    counted = _repaid_loans(silver, params).groupBy(*PAYMENT_COLUMNS).agg(F.count(F.lit(1)).alias(ROW_COUNT))
    paid = members.spread(counted, *PAYMENT_COLUMNS)
    return repeat_rows(paid.join(members.delinquent(params), members.on), ROW_COUNT).select(*LEDGER_COLUMNS)


def loan_points(silver: Silver, params: ScoreParams | None = None) -> DataFrame:
    """The four parts of financial health for each loan of a known customer."""
    params = params or ScoreParams()
    return silver[T_LOANS].join(silver[T_CUSTOMERS], MEMBER).select(
        LOAN,
        MEMBER,
        F.expr(points.status_points(params)).alias("loan_status_pts"),
        F.expr(points.ownership_points(params)).alias("home_ownership_pts"),
        F.expr(points.utilisation_points(params)).alias("credit_utilisation_pts"),
        F.expr(points.sub_grade_points(params)).alias("sub_grade_pts"),
    )


def gold(
    silver: Silver,
    exclusions: DataFrame,
    params: ScoreParams | None = None,
    null_mode: str = "not_in",
    grain: str = "member",
    weighted: bool = False,
    hot: HotKeys | None = None,
    hot_loans: HotKeys | None = None,
) -> DataFrame:
    """The three scores of every member.

    ``grain="member"`` pairs each scored repayment with each loan of the member; ``grain="loan"`` scores a repayment
    with its own loan only and adds ``loan_id``. ``weighted=True`` returns distinct rows with a ``row_count`` in place
    of repeated rows (same content, bounded size per member). ``hot`` takes the result of :func:`hot_members`, and
    ``hot_loans``, for the loan grain, those of the repayments' loans; by default both are computed here.
    """
    if grain not in ("member", "loan"):
        raise ValueError(f"grain must be 'member' or 'loan', not {grain!r}")
    params = params or ScoreParams()
    members = _Members(silver, exclusions, null_mode, hot)
    profile = members.table(T_CUSTOMERS, "home_ownership", "total_high_credit_limit", "grade", "sub_grade")
    people = members.delinquent(params).join(profile, members.on)
    paid_score = F.expr(points.payment_history_score()).alias("payment_history_pts")
    scores = {
        "defaulters_history_pts": F.expr(points.defaulters_history_score()),
        "financial_health_pts": F.expr(points.financial_health_score(params)),
    }
    n = F.count(F.lit(1))

    if grain == "loan":
        # Repayments are counted by loan and score before they meet their member, so that a member is no hotter here than in
        # the table of loans. As counting needs no shuffle after the join, hot loans are cut into slices beforehand.
        if hot_loans is None:
            hot_loans = hot_keys([silver[T_REPAYMENTS]], LOAN)
        repaid = _repaid_loans(silver, params, "loan_status", hot_loans=hot_loans)
        keys = [LOAN, MEMBER, "funded_amount", "loan_status", "last_payment_pts", "total_payment_pts"]
        times = F.sum(ROW_COUNT) if hot_loans else n
        counted = repaid.groupBy(*slice_key(LOAN, hot_loans), *keys[1:]).agg(times.alias(ROW_COUNT)).select(*keys, ROW_COUNT)
        scored = members.spread(counted, LOAN, "last_payment_pts", "total_payment_pts").join(people, members.on)
        scored = scored.withColumns(scores).select(LOAN, MEMBER, paid_score, *scores, ROW_COUNT)
        if weighted:
            return scored.groupBy(*scored.columns[:-1]).agg(F.sum(ROW_COUNT).alias(ROW_COUNT))
        return repeat_rows(scored, ROW_COUNT).drop(ROW_COUNT)

    # Payments of a member as distinct scores: partial counts are taken before the shuffle.
    paid = _repaid_loans(silver, params).groupBy(MEMBER, paid_score).agg(n.alias("_payments"))
    # Loans of a member likewise, slice by slice; the join has already brought each slice together.
    loans = members.spread(silver[T_LOANS].select(MEMBER, LOAN, "funded_amount", "loan_status"))
    held = loans.join(people, members.on).withColumns(scores).groupBy(*members.on, *scores).agg(n.alias("_loans"))
    # Slices split a hot member's loans, and every slice meets all payment scores of the member.
    pairs = held.join(members.replicate(paid), members.on).withColumn(ROW_COUNT, F.col("_payments") * F.col("_loans"))
    if weighted:
        return pairs.groupBy(*GOLD_COLUMNS).agg(F.sum(ROW_COUNT).alias(ROW_COUNT))
    return repeat_rows(pairs, ROW_COUNT).select(*GOLD_COLUMNS)


def grade(scores: DataFrame, params: ScoreParams | None = None, basis: str = "financial_health") -> DataFrame:
    """Add ``loan_final_grade``. ``basis="total"`` grades the sum of the three scores instead of the third alone."""
    return scores.withColumn("loan_final_grade", F.expr(points.final_grade(params or ScoreParams(), basis)))
