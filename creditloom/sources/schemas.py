"""Feed schemas, column renames and the names of the tables the jobs exchange."""

from __future__ import annotations

from pyspark.sql.types import FloatType, StringType, StructType

_TYPES = {"STRING": StringType(), "FLOAT": FloatType()}


def _layout(columns: str) -> StructType:
    """``"name TYPE, ..."`` as a schema; unlike ``StructType.fromDDL`` it needs no running session."""
    schema = StructType()
    for column in columns.split(", "):
        name, type_name = column.split()
        schema = schema.add(name, _TYPES[type_name], True)
    return schema


# --- fixed values: feed layouts (column order and types are part of the file contract) ---

CUSTOMERS = _layout(
    "member_id STRING, emp_title STRING, emp_length STRING, home_ownership STRING, annual_inc FLOAT, "
    "addr_state STRING, zip_code STRING, country STRING, grade STRING, sub_grade STRING, "
    "verification_status STRING, tot_hi_cred_lim FLOAT, application_type STRING, annual_inc_joint FLOAT, "
    "verification_status_joint STRING"
)

LOANS = _layout(
    "loan_id STRING, member_id STRING, loan_amnt FLOAT, funded_amnt FLOAT, term STRING, int_rate FLOAT, "
    "installment FLOAT, issue_d STRING, loan_status STRING, purpose STRING, title STRING"
)

REPAYMENTS = _layout(
    "loan_id STRING, total_rec_prncp FLOAT, total_rec_int FLOAT, total_rec_late_fee FLOAT, "
    "total_pymnt FLOAT, last_pymnt_amnt FLOAT, last_pymnt_d STRING, next_pymnt_d STRING"
)

DEFAULTERS = _layout(
    "member_id STRING, delinq_2yrs FLOAT, delinq_amnt FLOAT, pub_rec FLOAT, pub_rec_bankruptcies FLOAT, "
    "inq_last_6mths FLOAT, total_rec_late_fee FLOAT, mths_since_last_delinq FLOAT, "
    "mths_since_last_record FLOAT"
)

# --- fixed values: source column -> published column ---

CUSTOMER_RENAMES = {
    "annual_inc": "annual_income",
    "addr_state": "address_state",
    "zip_code": "address_zipcode",
    "country": "address_country",
    "tot_hi_cred_lim": "total_high_credit_limit",
    "annual_inc_joint": "join_annual_income",
}

LOAN_RENAMES = {
    "loan_amnt": "loan_amount",
    "funded_amnt": "funded_amount",
    "term": "loan_term_months",
    "int_rate": "interest_rate",
    "installment": "monthly_installment",
    "issue_d": "issue_date",
    "purpose": "loan_purpose",
    "title": "loan_title",
}

REPAYMENT_RENAMES = {
    "total_rec_prncp": "total_principal_received",
    "total_rec_int": "total_interest_received",
    "total_rec_late_fee": "total_late_fee_received",
    "total_pymnt": "total_payment_received",
    "last_pymnt_amnt": "last_payment_amount",
    "last_pymnt_d": "last_payment_date",
    "next_pymnt_d": "next_payment_date",
}

# --- fixed values: catalog names that downstream users query ---

T_CUSTOMERS = "customers"
T_LOANS = "loans"
T_REPAYMENTS = "loans_repayments"
T_DELINQ = "loans_defaulters_delinq"
T_REC_ENQ = "loans_defaulters_detail_rec_enq"
T_BAD_MEMBERS = "consolidated_bad_members"
T_BAD_MEMBERS_INTERNAL = "view_internal_bad_members"
T_GOLD_WEEKLY = "gold_loan_scores_weekly"
V_PAYMENT_HISTORY = "view_staging_ph_pts"
V_LEDGER = "view_staging_ldh_ph_pts"
V_GOLD = "view_gold_loan_score_realtime"

SILVER_TABLES = (T_CUSTOMERS, T_LOANS, T_REPAYMENTS, T_DELINQ, T_REC_ENQ)

# Feed name -> (schema, renames applied while reading). Customers keep their source names until they
# are cleansed, so that rejects and duplicates can be told apart on the untouched row.
FEEDS: dict[str, tuple[StructType, dict[str, str]]] = {
    "customers": (CUSTOMERS, {}),
    "loans": (LOANS, LOAN_RENAMES),
    "repayments": (REPAYMENTS, REPAYMENT_RENAMES),
    "defaulters": (DEFAULTERS, {}),
}
