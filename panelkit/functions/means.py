"""Exact means of money amounts.

Amounts are decimals of AMOUNT_SCALE places, so their sums are exact and the
same whatever the order, partitioning or grouping of the rows.  A mean is one
decimal division, rounded half up to MEAN_SCALE places, and then the double
next to it; :func:`mean_amount` gives that double's decimal back, so that a
weighted mean of stored means is exact too.  (A mean whose count is below 10^10
is rounded once; MEAN_SCALE places of a mean below 3 * 10^7 survive a double.)
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

AMOUNT_SCALE = 6
MEAN_SCALE = 8
AMOUNT = DecimalType(20, AMOUNT_SCALE)
AMOUNT_SUM = DecimalType(38, AMOUNT_SCALE)
_MEAN = DecimalType(18, MEAN_SCALE)
_COUNT = DecimalType(18, 0)
_TOTAL = DecimalType(28, MEAN_SCALE)  # divided by _COUNT it keeps 18 places


def amount(c: Column | str) -> Column:
    """A money amount as a decimal."""
    return (F.col(c) if isinstance(c, str) else c).cast(AMOUNT)


def mean_amount(c: Column | str) -> Column:
    """A mean of :func:`exact_mean` as the decimal it stands for."""
    return (F.col(c) if isinstance(c, str) else c).cast(_MEAN)


def weighted(mean: Column, weight: Column) -> Column:
    """A mean times a whole number, exact."""
    return mean_amount(mean) * weight.cast(_COUNT)


def exact_mean(total: Column, n: Column) -> Column:
    """``total / n`` as a double; NULL without a total or for a count of zero."""
    return F.round(F.try_divide(total.cast(_TOTAL), n.cast(_COUNT)), MEAN_SCALE).cast("double")
