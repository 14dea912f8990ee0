from creditloom.operators.cleanse import clean_customers, clean_loans, clean_repayments, split_defaulters
from creditloom.operators.keys import duplicate_keys, exclude_keys
from creditloom.operators.points import ScoreParams
from creditloom.operators.quality import (
    SplitResult,
    dedupe,
    impute_floor_mean,
    quality_gate,
    repair_total_payment,
    standardise_category,
)
from creditloom.operators.reconcile import reconcile
from creditloom.operators.scoring import gold, grade, ledger, loan_points, payment_history

__all__ = [
    "ScoreParams",
    "SplitResult",
    "clean_customers",
    "clean_loans",
    "clean_repayments",
    "dedupe",
    "duplicate_keys",
    "exclude_keys",
    "gold",
    "grade",
    "impute_floor_mean",
    "ledger",
    "loan_points",
    "payment_history",
    "quality_gate",
    "reconcile",
    "repair_total_payment",
    "split_defaulters",
    "standardise_category",
]
