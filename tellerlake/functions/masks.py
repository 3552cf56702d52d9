"""Masking expressions, one per policy."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tellerlake.functions.numbers import money

_STARS = "***"


def first_letter(value: Column) -> Column:
    return F.concat(F.left(value, F.lit(1)), F.lit(_STARS))


def email(value: Column) -> Column:
    """A value without '@' keeps an empty domain."""
    domain = F.split_part(value, F.lit("@"), F.lit(2))
    return F.concat(F.left(value, F.lit(1)), F.lit(_STARS + "@"), domain)


def phone(value: Column) -> Column:
    return F.concat(F.lit("***-***-"), F.right(value, F.lit(4)))


def identifier(value: Column) -> Column:
    """Only the part after the first '-' is hidden; a value without one stays readable."""
    return F.concat(F.split_part(value, F.lit("-"), F.lit(1)), F.lit("-" + _STARS))


def amount(value: Column) -> Column:
    """Zero for every row, NULL amounts included."""
    return money(F.lit("0.00"))


POLICIES: dict[str, Callable[[Column], Column]] = {
    "MASK_NAME": first_letter,
    "MASK_EMAIL": email,
    "MASK_PHONE": phone,
    "MASK_LOCATION": first_letter,
    "MASK_FINANCIAL_ID": identifier,
    "MASK_AMOUNT": amount,
}
