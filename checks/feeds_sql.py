"""The feed mapping as SQL for DuckDB; the Spark side is ``creditloom.sources.star_schema``."""

_CUSTOMERS = """
WITH base AS (
  SELECT c_custkey AS k,
         CAST(c_custkey AS STRING) AS member_id,
         c_name AS emp_title,
         CASE c_custkey % 13 WHEN 0 THEN NULL WHEN 1 THEN '< 1 year' WHEN 11 THEN '10+ years' WHEN 12 THEN 'n/a'
              ELSE concat(c_custkey % 13, ' years') END AS emp_length,
         CASE c_custkey % 5 WHEN 0 THEN 'OWN' WHEN 1 THEN 'RENT' WHEN 2 THEN 'MORTGAGE' WHEN 3 THEN 'ANY'
              ELSE 'unknown' END AS home_ownership,
         CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST(abs(c_acctbal) * 10 AS FLOAT) END AS annual_inc,
         CASE WHEN c_custkey % 19 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN n_name
              ELSE concat('S', c_nationkey % 10) END AS addr_state,
         concat(c_custkey % 1000, 'xx') AS zip_code,
         'USA' AS country,
         substr('ABCDEFG', CAST(c_custkey % 7 + 1 AS INT), 1) AS grade,
         concat(substr('ABCDEFG', CAST(c_custkey % 7 + 1 AS INT), 1),
                CAST(floor(c_custkey / 7) AS BIGINT) % 5 + 1) AS sub_grade,
         'Verified' AS verification_status,
         CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE CAST((c_acctbal + 1000) * 200 AS FLOAT) END AS tot_hi_cred_lim,
         'Individual' AS application_type,
         CAST(NULL AS FLOAT) AS annual_inc_joint,
         CAST(NULL AS STRING) AS verification_status_joint
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)
SELECT member_id, emp_title, emp_length, home_ownership, annual_inc, addr_state, zip_code, country, grade,
       sub_grade, verification_status, tot_hi_cred_lim, application_type, annual_inc_joint,
       verification_status_joint
FROM base
UNION ALL
SELECT member_id, emp_title, emp_length, home_ownership, annual_inc, addr_state, zip_code, country, grade,
       sub_grade, verification_status, tot_hi_cred_lim, application_type, annual_inc_joint,
       verification_status_joint
FROM base WHERE k % 29 = 1
UNION ALL
SELECT member_id, concat(emp_title, '-b'), emp_length, home_ownership, annual_inc, addr_state, zip_code, country,
       grade, sub_grade, verification_status, tot_hi_cred_lim, application_type, annual_inc_joint,
       verification_status_joint
FROM base WHERE k % 31 = 2
"""

_LOANS = """
SELECT CAST(o_orderkey AS STRING) AS loan_id,
       CAST(o_custkey AS STRING) AS member_id,
       CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE CAST(o_totalprice AS FLOAT) END AS loan_amnt,
       CAST(o_totalprice AS FLOAT) AS funded_amnt,
       CASE o_orderkey % 3 WHEN 0 THEN ' 36 months' WHEN 1 THEN '60 months' ELSE '18 months' END AS term,
       CAST(5 + o_orderkey % 20 AS FLOAT) AS int_rate,
       CAST(o_totalprice / 36 AS FLOAT) AS installment,
       CAST(CAST(o_orderdate AS DATE) AS STRING) AS issue_d,
       CASE o_orderkey % 7 WHEN 0 THEN 'Fully Paid' WHEN 1 THEN 'Current' WHEN 2 THEN 'In Grace Period'
            WHEN 3 THEN 'Late (31-120 days)' WHEN 4 THEN 'Charged Off' WHEN 5 THEN 'Default'
            ELSE 'Does not meet the credit policy. Status:Fully Paid' END AS loan_status,
       CASE o_orderkey % 6 WHEN 0 THEN 'debt_consolidation' WHEN 1 THEN 'credit_card' WHEN 2 THEN 'Car'
            WHEN 3 THEN 'car' WHEN 4 THEN 'buying_a_spaceship'
            ELSE CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'house' END END AS purpose,
       o_orderpriority AS title
FROM orders
"""

_REPAYMENTS = """
SELECT CASE WHEN o_orderkey % 11 = 3 THEN concat('unknown-', o_orderkey) ELSE CAST(o_orderkey AS STRING) END AS loan_id,
       CAST(o_totalprice * (o_orderkey % 10) / 10 AS FLOAT) AS total_rec_prncp,
       CAST(o_orderkey % 100 AS FLOAT) AS total_rec_int,
       CAST(o_orderkey % 4 AS FLOAT) AS total_rec_late_fee,
       CASE WHEN o_orderkey % 13 = 0 THEN CAST(0 AS FLOAT)
            ELSE CAST(o_totalprice * (o_orderkey % 10) / 10 + 10 AS FLOAT) END AS total_pymnt,
       CASE WHEN o_orderkey % 41 = 0 THEN NULL
            ELSE CAST(CAST(CAST(o_totalprice / 36 AS FLOAT) AS DOUBLE)
                 * CAST(CASE o_orderkey % 8 WHEN 0 THEN 0.25 WHEN 1 THEN 0.5 WHEN 2 THEN 0.75 WHEN 3 THEN 1
                        WHEN 4 THEN 1.25 WHEN 5 THEN 1.5 WHEN 6 THEN 2 ELSE 0 END AS DOUBLE) AS FLOAT)
            END AS last_pymnt_amnt,
       CASE WHEN o_orderkey % 9 = 0 THEN '0.0' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS last_pymnt_d,
       CASE o_orderkey % 4 WHEN 0 THEN '0.0' WHEN 1 THEN NULL
            ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS next_pymnt_d
FROM orders
"""

_DEFAULTERS = """
WITH base AS (
  SELECT c_custkey AS k,
         CAST(c_custkey AS STRING) AS member_id,
         CASE WHEN c_custkey % 9 = 8 THEN NULL ELSE CAST(c_custkey % 9 AS FLOAT) END AS delinq_2yrs,
         CAST(abs(c_acctbal) AS FLOAT) AS delinq_amnt,
         CASE WHEN CAST(floor(c_custkey / 3) AS BIGINT) % 8 = 7 THEN NULL
              ELSE CAST(CAST(floor(c_custkey / 3) AS BIGINT) % 8 AS FLOAT) END AS pub_rec,
         CAST(CAST(floor(c_custkey / 5) AS BIGINT) % 8 AS FLOAT) AS pub_rec_bankruptcies,
         CAST(CAST(floor(c_custkey / 7) AS BIGINT) % 8 AS FLOAT) AS inq_last_6mths,
         CAST(0 AS FLOAT) AS total_rec_late_fee,
         CAST(c_custkey % 4 AS FLOAT) AS mths_since_last_delinq,
         CAST(NULL AS FLOAT) AS mths_since_last_record
  FROM customer
)
SELECT member_id, delinq_2yrs, delinq_amnt, pub_rec, pub_rec_bankruptcies, inq_last_6mths, total_rec_late_fee,
       mths_since_last_delinq, mths_since_last_record
FROM base
UNION ALL
SELECT member_id, delinq_2yrs, delinq_amnt, pub_rec, pub_rec_bankruptcies, inq_last_6mths, total_rec_late_fee,
       mths_since_last_delinq, mths_since_last_record
FROM base WHERE k % 43 = 5
"""

FEED_SQL = {"customers": _CUSTOMERS, "loans": _LOANS, "repayments": _REPAYMENTS, "defaulters": _DEFAULTERS}
