"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tellerlake.schemas import MONEY


def money(value: Column) -> Column:
    return value.cast(MONEY)


def ratio(total: Column, n: Column) -> Column:
    """DOUBLE quotient, NULL where the divisor is 0 or NULL."""
    return F.try_divide(total.cast("double"), n.cast("double"))
