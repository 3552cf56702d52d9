"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the accepted shape of an e-mail address.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}$"

# Field texts that mean NULL in a delivered file.
NULL_TOKENS = ["", "NULL"]


def null_tokens_to_null(text: Column) -> Column:
    return F.when(~text.isin(NULL_TOKENS), text)


def bad_email(email: Column) -> Column:
    """True for a present but malformed address; NULL addresses pass."""
    return email.isNotNull() & ~email.rlike(EMAIL_PATTERN)


def full_name(first: Column, last: Column) -> Column:
    """NULL if either part is NULL, as string addition gives."""
    return F.concat(first, F.lit(" "), last)
