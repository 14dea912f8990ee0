from creditloom.functions.casts import (
    any_nan,
    any_null,
    blank_sentinel,
    digits_only,
    to_int_or_null,
    to_int_trunc,
)
from creditloom.functions.rules import first_match

__all__ = [
    "any_nan",
    "any_null",
    "blank_sentinel",
    "digits_only",
    "first_match",
    "to_int_or_null",
    "to_int_trunc",
]
