"""Column helpers whose results do not depend on the session's ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INT_MIN, _INT_MAX = -(2**31), 2**31 - 1


def digits_only(col: Column) -> Column:
    """'10+ years' -> '10', 'n/a' -> ''."""
    return F.regexp_replace(col, r"\D", "")


def to_int_or_null(col: Column) -> Column:
    """Text to int; text that is not a number becomes NULL and a fraction is cut off ('36.5' -> 36).

    The pattern is only tried on text that is not a plain integer.
    """
    text = F.trim(col)
    return F.coalesce(text.try_cast("int"), F.regexp_replace(text, r"\.\d*$", "").try_cast("int"))


def to_int_trunc(col: Column) -> Column:
    """Float to int towards zero. NULL stays NULL, NaN becomes 0, values beyond the int range are clamped."""
    number = F.nanvl(col.cast("double"), F.lit(0.0))
    clamped = F.least(F.greatest(number, F.lit(float(_INT_MIN))), F.lit(float(_INT_MAX)))
    return F.when(col.isNotNull(), clamped.cast("int"))


def blank_sentinel(col: Column, sentinel: str) -> Column:
    """NULL where the text equals ``sentinel`` exactly."""
    return F.nullif(col, F.lit(sentinel))


def any_null(*columns: str) -> Column:
    """True when at least one of the columns is NULL. NaN and empty text count as present."""
    hit = F.col(columns[0]).isNull()
    for name in columns[1:]:
        hit = hit | F.col(name).isNull()
    return hit


def any_nan(*columns: str) -> Column:
    hit = F.isnan(columns[0])
    for name in columns[1:]:
        hit = hit | F.isnan(name)
    return hit
