"""DuckDB statements that state each query independently of the Spark code."""

from __future__ import annotations

from checks.feeds_sql import FEED_SQL


# --- fixed values: feed columns in their order, and the names under which they are published ---

_CUSTOMERS = """member_id, emp_title, emp_length, home_ownership, annual_inc, addr_state, zip_code, country, grade, sub_grade,
    verification_status, tot_hi_cred_lim, application_type, annual_inc_joint, verification_status_joint"""
_CUSTOMERS_RENAMED = """member_id, emp_title, emp_length, home_ownership, annual_inc AS annual_income, addr_state AS address_state,
    zip_code AS address_zipcode, country AS address_country, grade, sub_grade, verification_status,
    tot_hi_cred_lim AS total_high_credit_limit, application_type, annual_inc_joint AS join_annual_income, verification_status_joint"""
_LOANS = """loan_id, member_id, loan_amnt AS loan_amount, funded_amnt AS funded_amount, term AS loan_term_months,
    int_rate AS interest_rate, installment AS monthly_installment, issue_d AS issue_date, loan_status, purpose AS loan_purpose,
    title AS loan_title"""
_REPAYMENTS = """loan_id, total_rec_prncp AS total_principal_received, total_rec_int AS total_interest_received,
    total_rec_late_fee AS total_late_fee_received, total_pymnt AS total_payment_received, last_pymnt_amnt AS last_payment_amount,
    last_pymnt_d AS last_payment_date, next_pymnt_d AS next_payment_date"""
_DEFAULTERS = """member_id, delinq_2yrs, delinq_amnt, pub_rec, pub_rec_bankruptcies, inq_last_6mths, total_rec_late_fee,
    mths_since_last_delinq, mths_since_last_record"""


def _int(number: str) -> str:
    """Float to int towards zero: NaN becomes 0, what is beyond the int range stops at its ends."""
    return (
        f"CASE WHEN isnan({number}) THEN 0 WHEN {number} >= 2147483647 THEN 2147483647 WHEN {number} <= -2147483648 "
        f"THEN -2147483648 ELSE TRY_CAST(trunc({number}) AS INTEGER) END"
    )


_CTES: list[tuple[str, str]] = [
    ("read_customers", f"SELECT {_CUSTOMERS} FROM ({FEED_SQL['customers']})"),
    ("raw_customers", f"SELECT {_CUSTOMERS_RENAMED} FROM ({FEED_SQL['customers']})"),
    ("raw_loans", f"SELECT {_LOANS} FROM ({FEED_SQL['loans']})"),
    ("raw_repayments", f"SELECT {_REPAYMENTS} FROM ({FEED_SQL['repayments']})"),
    ("raw_defaulters", f"SELECT {_DEFAULTERS} FROM ({FEED_SQL['defaulters']})"),
    (
        "customers_numbered",
        """
        SELECT DISTINCT * REPLACE (TRY_CAST(regexp_replace(emp_length, '[^0-9]', '', 'g') AS INTEGER) AS emp_length)
        FROM (SELECT DISTINCT * FROM raw_customers
              WHERE annual_income IS NOT NULL AND address_state IS NOT NULL)
        """,
    ),
    (
        "customers",
        """
        SELECT * REPLACE (
            CAST(coalesce(emp_length, (SELECT CAST(floor(avg(emp_length)) AS BIGINT) FROM customers_numbered))
                 AS BIGINT) AS emp_length,
            CASE WHEN length(address_state) > 2 THEN 'NA' ELSE address_state END AS address_state)
        FROM customers_numbered
        """,
    ),
    (
        "rejected_customers",
        """
        SELECT *, 'Missing Income or State' AS reject_reason FROM raw_customers
        WHERE annual_income IS NULL OR address_state IS NULL
        """,
    ),
    (
        "loans",
        """
        SELECT loan_id, member_id, loan_amount, funded_amount, interest_rate, monthly_installment, issue_date,
               loan_status,
               CASE WHEN loan_purpose IN ('debt_consolidation', 'credit_card', 'home_improvement', 'other',
                    'major_purchase', 'medical', 'small_business', 'car', 'vacation', 'moving', 'house', 'wedding',
                    'renewable_energy', 'educational') THEN loan_purpose ELSE 'other' END AS loan_purpose,
               loan_title,
               CAST(trunc(TRY_CAST(replace(loan_term_months, ' months', '') AS INTEGER) / 12.0) AS INTEGER)
                   AS loan_term_years
        FROM raw_loans
        WHERE loan_amount IS NOT NULL AND funded_amount IS NOT NULL AND loan_term_months IS NOT NULL
          AND interest_rate IS NOT NULL AND monthly_installment IS NOT NULL AND issue_date IS NOT NULL
          AND loan_status IS NOT NULL AND loan_purpose IS NOT NULL
        """,
    ),
    (
        "rejected_loans",
        """
        SELECT *, 'Null values in critical columns' AS reject_reason FROM raw_loans
        WHERE loan_amount IS NULL OR funded_amount IS NULL OR loan_term_months IS NULL OR interest_rate IS NULL
           OR monthly_installment IS NULL OR issue_date IS NULL OR loan_status IS NULL OR loan_purpose IS NULL
        """,
    ),
    (
        "repayments_complete",
        """
        SELECT * REPLACE (
            CASE WHEN total_principal_received <> 0 AND total_payment_received = 0
                 THEN total_principal_received + total_interest_received + total_late_fee_received
                 ELSE total_payment_received END AS total_payment_received,
            nullif(last_payment_date, '0.0') AS last_payment_date,
            nullif(next_payment_date, '0.0') AS next_payment_date)
        FROM raw_repayments
        WHERE total_principal_received IS NOT NULL AND NOT isnan(total_principal_received)
          AND total_interest_received IS NOT NULL AND NOT isnan(total_interest_received)
          AND total_late_fee_received IS NOT NULL AND NOT isnan(total_late_fee_received)
          AND total_payment_received IS NOT NULL AND NOT isnan(total_payment_received)
          AND last_payment_amount IS NOT NULL AND NOT isnan(last_payment_amount)
        """,
    ),
    ("repayments", "SELECT * FROM repayments_complete WHERE total_payment_received <> 0"),
    (
        "rejected_repayments",
        """
        SELECT *, 'Null values detected in one of: [''total_principal_received'', ''total_interest_received'', '
                  || '''total_late_fee_received'', ''total_payment_received'', ''last_payment_amount'']'
                  AS reject_reason
        FROM raw_repayments
        WHERE total_principal_received IS NULL OR total_interest_received IS NULL
           OR total_late_fee_received IS NULL OR total_payment_received IS NULL OR last_payment_amount IS NULL
        """,
    ),
    (
        "delinq",
        f"""
        SELECT member_id, coalesce({_int('delinq_2yrs')}, 0) AS delinq_2yrs, delinq_amnt,
               {_int('mths_since_last_delinq')} AS mths_since_last_delinq
        FROM raw_defaulters WHERE {_int('delinq_2yrs')} > 0 OR mths_since_last_delinq > 0
        """,
    ),
    (
        "rec_enq",
        f"""
        SELECT member_id, coalesce({_int('pub_rec')}, 0) AS pub_rec,
               coalesce({_int('pub_rec_bankruptcies')}, 0) AS pub_rec_bankruptcies,
               coalesce({_int('inq_last_6mths')}, 0) AS inq_last_6mths
        FROM raw_defaulters
        """,
    ),
    (
        "bad_members",
        """
        SELECT member_id FROM customers GROUP BY member_id HAVING count(*) > 1
        UNION SELECT member_id FROM delinq GROUP BY member_id HAVING count(*) > 1
        UNION SELECT member_id FROM rec_enq GROUP BY member_id HAVING count(*) > 1
        """,
    ),
    (
        "payment_points",
        """
        SELECT l.loan_id, l.member_id,
               CASE WHEN r.last_payment_amount < l.monthly_installment THEN 100
                    WHEN r.last_payment_amount = l.monthly_installment THEN 500
                    WHEN CAST(r.last_payment_amount AS DOUBLE) <= CAST(l.monthly_installment AS DOUBLE) * 1.5 THEN 650
                    WHEN CAST(r.last_payment_amount AS DOUBLE) > CAST(l.monthly_installment AS DOUBLE) * 1.5 THEN 800
                    ELSE 0 END AS last_payment_pts,
               CASE WHEN CAST(r.total_payment_received AS DOUBLE) >= CAST(l.funded_amount AS DOUBLE) * 0.5 THEN 650
                    WHEN r.total_payment_received > 0 THEN 500
                    WHEN r.total_payment_received = 0 THEN 0 END AS total_payment_pts
        FROM repayments r JOIN loans l ON l.loan_id = r.loan_id
        WHERE l.member_id NOT IN (SELECT member_id FROM bad_members)
        """,
    ),
    (
        "ledger_rows",
        """
        SELECT p.*,
               CASE WHEN delinq_2yrs = 0 THEN 800 WHEN delinq_2yrs IN (1, 2) THEN 250
                    WHEN delinq_2yrs IN (3, 4, 5) THEN 100 WHEN delinq_2yrs > 5 THEN 750 END AS delinq_pts,
               CASE WHEN pub_rec = 0 THEN 800 WHEN pub_rec IN (1, 2) THEN 250 WHEN pub_rec >= 3 THEN 100 END
                   AS public_records_pts,
               CASE WHEN pub_rec_bankruptcies = 0 THEN 800 WHEN pub_rec_bankruptcies IN (1, 2) THEN 250
                    WHEN pub_rec_bankruptcies >= 3 THEN 100 END AS public_bankruptcies_pts,
               CASE WHEN inq_last_6mths = 0 THEN 800 WHEN inq_last_6mths IN (1, 2) THEN 250
                    WHEN inq_last_6mths IN (3, 4, 5) THEN 100 WHEN inq_last_6mths > 5 THEN 0 END AS enq_pts
        FROM rec_enq e JOIN delinq d ON d.member_id = e.member_id JOIN payment_points p ON p.member_id = e.member_id
        WHERE e.member_id NOT IN (SELECT member_id FROM bad_members)
        """,
    ),
    (
        "health_points",
        """
        SELECT l.loan_id, l.member_id,
               CASE WHEN lower(loan_status) LIKE '%fully paid%' THEN 800 WHEN lower(loan_status) LIKE '%current%' THEN 500
                    WHEN lower(loan_status) LIKE '%in grace period%' THEN 250
                    WHEN lower(loan_status) LIKE '%late%' THEN 100 ELSE 0 END AS loan_status_pts,
               CASE WHEN lower(home_ownership) LIKE '%own' THEN 800 WHEN lower(home_ownership) LIKE '%rent' THEN 500
                    WHEN lower(home_ownership) LIKE '%mortgage' THEN 250 ELSE 100 END AS home_ownership_pts,
               CASE WHEN total_high_credit_limit IS NULL THEN 0
                    WHEN CAST(funded_amount AS DOUBLE) <= CAST(total_high_credit_limit AS DOUBLE) * 0.10 THEN 800
                    WHEN CAST(funded_amount AS DOUBLE) <= CAST(total_high_credit_limit AS DOUBLE) * 0.20 THEN 650
                    WHEN CAST(funded_amount AS DOUBLE) <= CAST(total_high_credit_limit AS DOUBLE) * 0.30 THEN 500
                    WHEN CAST(funded_amount AS DOUBLE) <= CAST(total_high_credit_limit AS DOUBLE) * 0.50 THEN 250
                    WHEN CAST(funded_amount AS DOUBLE) <= CAST(total_high_credit_limit AS DOUBLE) * 0.70 THEN 100
                    ELSE 0 END AS credit_utilisation_pts,
               coalesce(g.points * s.share, 0) AS sub_grade_pts
        FROM loans l JOIN customers c ON c.member_id = l.member_id
        LEFT JOIN (VALUES ('A', 800), ('B', 650), ('C', 500), ('D', 250), ('E', 100)) AS g(letter, points)
               ON g.letter = c.grade
        LEFT JOIN (VALUES ('1', 1.00), ('2', 0.95), ('3', 0.90), ('4', 0.85), ('5', 0.80)) AS s(step, share)
               ON c.sub_grade = c.grade || s.step
        """,
    ),
]

_GOLD = """
    SELECT {extra} p.member_id,
           CAST((last_payment_pts + total_payment_pts) * 0.20 AS DOUBLE) AS payment_history_pts,
           CAST((delinq_pts + public_records_pts + public_bankruptcies_pts + enq_pts) * 0.45 AS DOUBLE)
               AS defaulters_history_pts,
           CAST((loan_status_pts + home_ownership_pts + credit_utilisation_pts + sub_grade_pts) * 0.35 AS DOUBLE)
               AS financial_health_pts
    FROM ledger_rows p JOIN health_points h ON h.member_id = p.member_id {also}
"""

_CTES.append(("gold_rows", _GOLD.format(extra="", also="")))


def _with(select: str, **others: str) -> str:
    """Prefix the CTEs that ``select`` needs, found from the back so that unused ones are left out; ``others`` replace bodies."""
    needed, text = [], select
    for name, body in reversed(_CTES):
        if name in text:
            body = others.get(name, body)
            needed.append(f"{name} AS ({body})")
            text += body
    return "WITH " + ",\n".join(reversed(needed)) + "\n" + select


def _grades(score: str, excellent: int, good: int, medium: int) -> str:
    return (
        f"SELECT *, CASE WHEN {score} >= {excellent} THEN 'EXCELLENT' WHEN {score} >= {good} THEN 'GOOD' "
        f"WHEN {score} >= {medium} THEN 'MEDIUM' ELSE 'HIGH_RISK' END AS loan_final_grade FROM gold_rows"
    )


_TOTAL = "(payment_history_pts + defaulters_history_pts + financial_health_pts)"

_RECONCILIATION = """
    SELECT feed, total, success, rejected, duplicates, zero_total, nan_amount, delinq, rec_enq,
           total - success - rejected AS unaccounted, total - success - rejected = 0 AS balanced
    FROM (
        SELECT 'customers' AS feed, (SELECT count(*) FROM raw_customers) AS total,
               (SELECT count(*) FROM customers) AS success, (SELECT count(*) FROM rejected_customers) AS rejected,
               (SELECT count(*) FROM raw_customers WHERE annual_income IS NOT NULL AND address_state IS NOT NULL)
                   - (SELECT count(*) FROM customers) AS duplicates,
               CAST(NULL AS BIGINT) AS zero_total, CAST(NULL AS BIGINT) AS nan_amount,
               CAST(NULL AS BIGINT) AS delinq, CAST(NULL AS BIGINT) AS rec_enq
        UNION ALL
        SELECT 'loans', (SELECT count(*) FROM raw_loans), (SELECT count(*) FROM loans),
               (SELECT count(*) FROM rejected_loans), NULL, NULL, NULL, NULL, NULL
        UNION ALL
        SELECT 'repayments', (SELECT count(*) FROM raw_repayments), (SELECT count(*) FROM repayments),
               (SELECT count(*) FROM rejected_repayments), NULL,
               (SELECT count(*) FROM repayments_complete WHERE total_payment_received = 0),
               (SELECT count(*) FROM raw_repayments) - (SELECT count(*) FROM rejected_repayments)
                   - (SELECT count(*) FROM repayments_complete), NULL, NULL
        UNION ALL
        SELECT 'defaulters', (SELECT count(*) FROM raw_defaulters), NULL, NULL, NULL, NULL, NULL,
               (SELECT count(*) FROM delinq), (SELECT count(*) FROM rec_enq)
    )
"""


def oracle_sql() -> dict[str, str]:
    statements = {
        "silver_customers": "SELECT * FROM customers",
        "reject_customers": "SELECT * FROM rejected_customers",
        "silver_loans": "SELECT * FROM loans",
        "reject_loans": "SELECT * FROM rejected_loans",
        "silver_repayments": "SELECT * FROM repayments",
        "reject_repayments": "SELECT * FROM rejected_repayments",
        "delinquencies": "SELECT * FROM delinq",
        "records_enquiries": "SELECT * FROM rec_enq",
        "bad_members": "SELECT * FROM bad_members",
        "clean_members_not_in": "SELECT * FROM rec_enq WHERE member_id NOT IN (SELECT member_id FROM bad_members)",
        "clean_members_ignore_nulls": """
            SELECT * FROM customers c
            WHERE NOT EXISTS (SELECT 1 FROM bad_members b WHERE b.member_id = c.member_id)""",
        "payment_history": "SELECT member_id, last_payment_pts, total_payment_pts FROM payment_points",
        "ledger": "SELECT * EXCLUDE (loan_id) FROM ledger_rows",
        "status_points": "SELECT loan_id, member_id, loan_status_pts FROM health_points",
        "ownership_points": "SELECT loan_id, member_id, home_ownership_pts FROM health_points",
        "utilisation_points": "SELECT loan_id, member_id, credit_utilisation_pts FROM health_points",
        "subgrade_points": "SELECT loan_id, member_id, CAST(sub_grade_pts AS DOUBLE) AS sub_grade_pts FROM health_points",
        "gold_realtime": "SELECT * FROM gold_rows",
        "gold_realtime_weighted": """
            SELECT member_id, payment_history_pts, defaulters_history_pts, financial_health_pts,
                   CAST(count(*) AS BIGINT) AS row_count FROM gold_rows GROUP BY ALL""",
        "gold_loan_grain": _GOLD.format(extra="p.loan_id,", also="AND h.loan_id = p.loan_id"),
        "gold_weekly": _grades("financial_health_pts", 2500, 2000, 1500),
        "gold_weekly_low_cutoffs": _grades("financial_health_pts", 800, 600, 400),
        "gold_weekly_total_basis": _grades(_TOTAL, 2500, 2000, 1500),
        "reconciliation": _RECONCILIATION,
        "csv_roundtrip_customers": "SELECT * FROM read_customers",
        "csv_roundtrip_loans": "SELECT * FROM raw_loans",
        "csv_roundtrip_repayments": "SELECT * FROM raw_repayments",
        "csv_roundtrip_defaulters": "SELECT * FROM raw_defaulters",
        "batch_weekly_table": _grades("financial_health_pts", 2500, 2000, 1500),
        "batch_gold_view": "SELECT * FROM gold_rows",
        "batch_ledger_view": "SELECT * EXCLUDE (loan_id) FROM ledger_rows",
    }
    plain = {name: _with(text) for name, text in statements.items()}
    bodies = dict(_CTES)
    more_loans = bodies["raw_loans"] + " UNION ALL SELECT * REPLACE ('extra-' || loan_id AS loan_id, '13' AS member_id) FROM (" + bodies["raw_loans"] + ")"
    more_paid = bodies["raw_repayments"] + " UNION ALL SELECT * REPLACE ('extra-' || loan_id AS loan_id) FROM (" + bodies["raw_repayments"] + ")"
    # The odd feeds: NULL members, NaN, fractions, numbers beyond the int range.
    odd = {
        "raw_customers": "SELECT * REPLACE (CASE WHEN CAST(member_id AS BIGINT) % 40 <> 6 THEN member_id END AS member_id) "
        f"FROM ({bodies['raw_customers']})",
        "raw_loans": "SELECT * REPLACE (CASE WHEN CAST(member_id AS BIGINT) % 45 <> 11 THEN member_id END AS member_id) "
        f"FROM ({bodies['raw_loans']})",
        "raw_repayments": f"""
            SELECT * EXCLUDE (k) REPLACE (
                CASE WHEN k % 23 = 4 THEN CAST('NaN' AS FLOAT) ELSE total_interest_received END AS total_interest_received,
                CASE WHEN k % 29 = 7 THEN CAST('NaN' AS FLOAT) ELSE last_payment_amount END AS last_payment_amount)
            FROM (SELECT *, CAST(replace(loan_id, 'unknown-', '') AS BIGINT) AS k FROM ({bodies['raw_repayments']}))""",
        "raw_defaulters": f"""
            SELECT * EXCLUDE (k) REPLACE (
                CASE WHEN k % 50 <> 7 THEN member_id END AS member_id,
                CASE WHEN k % 14 = 3 THEN CAST(delinq_2yrs + 0.5 AS FLOAT) WHEN k % 53 = 13 THEN CAST(1e20 AS FLOAT)
                     ELSE delinq_2yrs END AS delinq_2yrs,
                CASE WHEN k % 37 = 21 THEN CAST('NaN' AS FLOAT) ELSE mths_since_last_delinq END AS mths_since_last_delinq,
                CASE WHEN k % 29 = 5 THEN CAST('NaN' AS FLOAT) ELSE pub_rec END AS pub_rec,
                CASE WHEN k % 31 = 8 THEN CAST(-3e9 AS FLOAT) ELSE inq_last_6mths END AS inq_last_6mths)
            FROM (SELECT *, CAST(member_id AS BIGINT) AS k FROM ({bodies['raw_defaulters']}))""",
    }
    known = bodies["bad_members"] + " EXCEPT SELECT NULL"
    outside = "SELECT CAST(c_custkey AS VARCHAR) AS member_id FROM customer WHERE c_custkey % 6 = 1"
    broken = "CAST(loan_id AS BIGINT) % 19 = 5 OR CAST(loan_id AS BIGINT) % 23 = 3 OR CAST(loan_id AS BIGINT) % 31 = 7"
    feeds = {f"parquet_feed_{name}": plain[f"csv_roundtrip_{name}"] for name in ("customers", "loans", "repayments", "defaulters")}
    return plain | feeds | {
        "clean_members_bypass_not_in": plain["clean_members_not_in"],
        "clean_members_bypass_ignore_nulls": plain["clean_members_ignore_nulls"],
        "odd_delinquencies": _with(statements["delinquencies"], **odd),
        "odd_records_enquiries": _with(statements["records_enquiries"], **odd),
        "odd_silver_repayments": _with(statements["silver_repayments"], **odd),
        "odd_bad_members": _with(statements["bad_members"], **odd),
        "odd_clean_members_not_in": _with(statements["clean_members_not_in"], **odd),
        "odd_clean_members_ignore_nulls": _with(
            "SELECT * FROM rec_enq c WHERE NOT EXISTS (SELECT 1 FROM bad_members b WHERE b.member_id = c.member_id)", **odd
        ),
        "odd_reconciliation": _with(statements["reconciliation"], **odd),
        "batch_gold_view_null_list": _with(statements["batch_gold_view"], **odd),
        "batch_gold_view_ignore_nulls": _with(statements["batch_gold_view"], **odd, bad_members=known),
        "batch_external_list": _with(statements["batch_weekly_table"], bad_members=outside),
        "batch_external_list_view": _with(statements["batch_ledger_view"], bad_members=outside),
        "batch_bucketed_weekly": plain["batch_weekly_table"],
        "gold_function": plain["gold_weekly"],
        "gold_function_changed_points": _with(
            _grades("financial_health_pts", 900, 600, 400),
            **{name: bodies[name].replace("800", "900").replace("250", "200") for name in ("payment_points", "ledger_rows", "health_points")},
        ),
        "batch_managed_customers": plain["silver_customers"],
        "batch_ingest_stamps": _with("""
            SELECT 'customers' AS stored, true AS stamped, count(*) AS n FROM customers
            UNION ALL SELECT 'loans', true, count(*) FROM loans
            UNION ALL SELECT 'loans_repayments', true, count(*) FROM repayments"""),
        "injected_ingest_time": _with("SELECT loan_id, '2024-02-03 04:05:06' AS ingested FROM raw_loans"),
        "malformed_csv_rejects": _with(f"""
            SELECT loan_id, CASE WHEN {broken} THEN 'Malformed row' ELSE reject_reason END AS reject_reason,
                   CASE WHEN {broken} THEN loan_id END AS raw_id
            FROM raw_loans LEFT JOIN (SELECT loan_id, reject_reason FROM rejected_loans) r USING (loan_id)
            WHERE {broken} OR reject_reason IS NOT NULL"""),
        "skewed_gold_view": _with(statements["batch_gold_view"], raw_loans=more_loans),
        "skewed_ledger_view": _with(statements["batch_ledger_view"], raw_loans=more_loans, raw_repayments=more_paid),
        "skewed_gold_loan_grain": _with(statements["gold_loan_grain"], raw_loans=more_loans, raw_repayments=more_paid),
    }
