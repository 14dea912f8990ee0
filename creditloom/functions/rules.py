"""Point rules written as data and compiled to one SQL CASE expression.

Rules are SQL text so that the DataFrame operators (through ``F.expr``) and the persistent catalog views
(whose definition must be text) are generated from the same source.
"""

from __future__ import annotations

from collections.abc import Iterable


def first_match(arms: Iterable[tuple[str, object]], otherwise: object | None = None) -> str:
    """CASE over ``(condition, points)`` pairs; the first true condition wins, NULL conditions do not match."""
    body = " ".join(f"WHEN {condition} THEN {points}" for condition, points in arms)
    tail = "" if otherwise is None else f" ELSE {otherwise}"
    return f"CASE {body}{tail} END"
