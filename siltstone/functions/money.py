"""Exact amounts: doubles are turned into decimals before they are summed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ten decimal places keep any amount written with fewer digits exact, and leave
# room for 10^18 in one value and 10^28 in a sum.
EXACT = T.DecimalType(28, 10)

# A decimal of up to 18 digits is kept in a machine word and sums several times faster.
_WORD_DIGITS = 18


def as_exact(amount: Column, data_type: T.DataType, places: int | None = None) -> Column:
    """Decimals and integers are exact already; doubles take the value they print as.

    ``places`` is the number of decimal places the doubles are known to have.
    """
    if not isinstance(data_type, (T.DoubleType, T.FloatType)):
        return amount
    return amount.cast(EXACT if places is None else T.DecimalType(_WORD_DIGITS, places))


def exact_or_not(amount: Column) -> tuple[Column, Column]:
    """A double as a decimal, and whether that decimal holds it: finite, below 10^17, right to 10^-9 of itself."""
    value = amount.cast("double")
    exact = F.when(F.abs(value) < 1e17, value.cast(EXACT))
    return exact, F.coalesce(F.abs(exact.cast("double") - value) <= F.abs(value) * 1e-9, F.lit(False))


def sum_of_doubles(amount: Column, scale: int = 2) -> Column:
    """Sum of doubles, rounded half up: exact where decimals hold all values, else the plain sum.

    A decimal holds a value that is finite, below 10^17, and loses no more than 10^-9 of itself
    at ten places. NaN and infinities therefore count as in a plain sum. Both sums are kept by
    the same partial aggregation.
    """
    value = amount.cast("double")
    exact, held = exact_or_not(amount)
    plain = F.max(value.isNotNull() & ~held)
    total = F.round(F.sum(F.when(held, exact)), scale).cast("double")
    return F.when(plain, F.round(F.sum(value), scale)).otherwise(total)


def round_money(amount: Column, data_type: T.DataType, scale: int = 2) -> Column:
    """Half-up rounding of the value as printed, back in the type the column came in."""
    return F.round(amount, scale).cast(data_type)
