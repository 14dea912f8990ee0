"""Score parameters and the point rules, as data."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields
from decimal import Decimal

from creditloom.functions.rules import first_match


@dataclass(frozen=True)
class ScoreParams:
    """Points per level and grade cutoffs. The defaults are the shipped configuration."""

    # --- fixed values: points ---
    unacceptable: int | Decimal = 0
    very_bad: int | Decimal = 100
    bad: int | Decimal = 250
    good: int | Decimal = 500
    very_good: int | Decimal = 650
    excellent: int | Decimal = 800
    # --- fixed values: cutoffs ---
    cutoff_unacceptable: int | Decimal = 750
    cutoff_very_bad: int | Decimal = 1000
    cutoff_bad: int | Decimal = 1500
    cutoff_good: int | Decimal = 2000
    cutoff_very_good: int | Decimal = 2500
    # Points for more than five delinquencies. By default this is the lowest grade *cutoff*, so the worst band
    # outscores one or two delinquencies; pass ``unacceptable``'s value to rank it last.
    delinq_worst: int | Decimal | None = None

    @classmethod
    def from_mapping(cls, conf: Mapping[str, str]) -> ScoreParams:
        """Read ``score.pts.<level>`` and ``grade.cutoff.<level>`` keys; absent keys keep their defaults."""
        values = {}
        for field in fields(cls):
            prefix, level = "score.pts.", field.name
            if level.startswith("cutoff_"):
                prefix, level = "grade.cutoff.", level.removeprefix("cutoff_")
            if prefix + level in conf:
                number = Decimal(str(conf[prefix + level]).strip())
                values[field.name] = int(number) if number == number.to_integral_value() else number
        return cls(**values)

    @property
    def worst_delinquency(self) -> int | Decimal:
        return self.cutoff_unacceptable if self.delinq_worst is None else self.delinq_worst


class ParameterNames:
    """Stands in for :class:`ScoreParams` where rules refer to SQL parameters: each value is the name of its parameter."""

    PREFIX = "p_"

    def __getattr__(self, name: str) -> str:
        if name not in {f.name for f in fields(ScoreParams)}:
            raise AttributeError(name)
        return self.PREFIX + name

    @property
    def worst_delinquency(self) -> str:
        return f"coalesce({self.PREFIX}delinq_worst, {self.PREFIX}cutoff_unacceptable)"

    @classmethod
    def declared(cls, defaults: ScoreParams) -> str:
        """The parameter list of a SQL function; a whole number each."""
        values = {f.name: getattr(defaults, f.name) for f in fields(ScoreParams)}
        if not all(v is None or isinstance(v, int) for v in values.values()):
            raise ValueError("points and cutoffs of a SQL function are whole numbers")
        return ", ".join(f"{cls.PREFIX}{n} INT DEFAULT {'NULL' if v is None else v}" for n, v in values.items())


# --- fixed values: shares of the three parts, patterns, utilisation steps, grade letters and factors ---

POINT_LEVELS = ("unacceptable", "very_bad", "bad", "good", "very_good", "excellent")

WEIGHT_PAYMENT = "0.20"
WEIGHT_DEFAULTERS = "0.45"
WEIGHT_HEALTH = "0.35"

STATUS_CONTAINS = (
    ("fully paid", "excellent"),
    ("current", "good"),
    ("in grace period", "bad"),
    ("late", "very_bad"),
    ("charged off", "unacceptable"),
)
OWNERSHIP_ENDS = (("own", "excellent"), ("rent", "good"), ("mortgage", "bad"))
UTILISATION_UP_TO = (
    ("0.10", "excellent"),
    ("0.20", "very_good"),
    ("0.30", "good"),
    ("0.50", "bad"),
    ("0.70", "very_bad"),
)
GRADE_LEVELS = (("A", "excellent"), ("B", "very_good"), ("C", "good"), ("D", "bad"), ("E", "very_bad"))
SUB_GRADE_FACTORS = (("1", "1.00"), ("2", "0.95"), ("3", "0.90"), ("4", "0.85"), ("5", "0.80"))

GRADE_LABELS = (("EXCELLENT", "cutoff_very_good"), ("GOOD", "cutoff_good"), ("MEDIUM", "cutoff_bad"))
GRADE_BELOW = "HIGH_RISK"


def last_payment_points(p: ScoreParams) -> str:
    """How the last payment compares with the instalment. Two bands below the instalment earn the same points."""
    paid, due = "last_payment_amount", "monthly_installment"
    return first_match(
        [
            (f"{paid} < {due} * 0.5 OR {paid} < {due}", p.very_bad),
            (f"{paid} = {due}", p.good),
            (f"{paid} <= {due} * 1.5", p.very_good),
            (f"{paid} > {due} * 1.5", p.excellent),
        ],
        otherwise=p.unacceptable,
    )


def total_payment_points(p: ScoreParams) -> str:
    """Share of the funded amount repaid so far. A negative total earns NULL, not zero."""
    paid = "total_payment_received"
    return first_match(
        [
            (f"{paid} >= funded_amount * 0.5", p.very_good),
            (f"{paid} > 0 AND funded_amount IS NOT NULL", p.good),
            (f"{paid} = 0 OR {paid} IS NULL", p.unacceptable),
        ]
    )


def count_points(column: str, worst: int | Decimal, p: ScoreParams) -> str:
    """Bands of an event count: none, 1-2, 3-5, more (or unknown). A negative count earns NULL."""
    return first_match(
        [
            (f"{column} = 0", p.excellent),
            (f"{column} BETWEEN 1 AND 2", p.bad),
            (f"{column} BETWEEN 3 AND 5", p.very_bad),
            (f"{column} > 5 OR {column} IS NULL", worst),
        ]
    )


def delinquency_points(p: ScoreParams) -> str:
    return count_points("delinq_2yrs", p.worst_delinquency, p)


def public_record_points(p: ScoreParams) -> str:
    return count_points("pub_rec", p.very_bad, p)


def bankruptcy_points(p: ScoreParams) -> str:
    return count_points("pub_rec_bankruptcies", p.very_bad, p)


def enquiry_points(p: ScoreParams) -> str:
    return count_points("inq_last_6mths", p.unacceptable, p)


def status_points(p: ScoreParams) -> str:
    arms = [(f"contains(lower(loan_status), '{text}')", getattr(p, level)) for text, level in STATUS_CONTAINS]
    return first_match(arms, otherwise=p.unacceptable)


def ownership_points(p: ScoreParams) -> str:
    """Decided by how the text ends, so 'unknown' counts as 'own'."""
    arms = [(f"endswith(lower(home_ownership), '{text}')", getattr(p, level)) for text, level in OWNERSHIP_ENDS]
    return first_match(arms, otherwise=p.very_bad)


def utilisation_points(p: ScoreParams) -> str:
    """Funded amount as a share of the member's total credit limit."""
    arms = [
        (f"funded_amount <= total_high_credit_limit * {share}", getattr(p, level))
        for share, level in UTILISATION_UP_TO
    ]
    return first_match(arms, otherwise=p.unacceptable)


def sub_grade_points(p: ScoreParams) -> str:
    """Points of the grade letter, reduced by the step within it. The step must belong to the same letter."""
    base = first_match([(f"grade = '{letter}'", getattr(p, level)) for letter, level in GRADE_LEVELS])
    factor = first_match([(f"sub_grade = concat(grade, '{step}')", share) for step, share in SUB_GRADE_FACTORS])
    points = f"coalesce({base} * {factor}, {p.unacceptable})"
    # Whole points need two decimals; finer points keep every decimal the product has.
    whole = all(isinstance(getattr(p, level), (int, str)) for level in POINT_LEVELS)
    return f"CAST({points} AS DECIMAL(12,2))" if whole else points


def payment_history_score() -> str:
    return f"(last_payment_pts + total_payment_pts) * {WEIGHT_PAYMENT}"


def defaulters_history_score() -> str:
    return f"(delinq_pts + public_records_pts + public_bankruptcies_pts + enq_pts) * {WEIGHT_DEFAULTERS}"


def financial_health_score(p: ScoreParams) -> str:
    parts = (status_points(p), ownership_points(p), utilisation_points(p), sub_grade_points(p))
    return f"({' + '.join(parts)}) * {WEIGHT_HEALTH}"


# Name of the score that grades -> expression over the gold columns.
GRADE_BASIS = {
    "financial_health": "financial_health_pts",
    "total": "(payment_history_pts + defaulters_history_pts + financial_health_pts)",
}


def final_grade(p: ScoreParams, basis: str = "financial_health") -> str:
    """Letter grade of a gold row. NULL scores fall through to the lowest grade."""
    score = GRADE_BASIS[basis]

    def number(value: int | Decimal | str) -> str:
        return f"CAST({value} AS DOUBLE)" if isinstance(value, str) else f"{float(value)}D"

    arms = [(f"{score} >= {number(getattr(p, cutoff))}", f"'{label}'") for label, cutoff in GRADE_LABELS]
    return first_match(arms, otherwise=f"'{GRADE_BELOW}'")
