"""Month arithmetic and spreadsheet date decoding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: day zero of spreadsheet serial dates (1900 date system).
EXCEL_EPOCH = "1899-12-30"
# Fixed value: from this day of the month on, the previous month is complete.
PUBLICATION_DAY = 5


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def excel_serial_to_date(serial: Column | str) -> Column:
    """Serial day number (text or number) → date; non-numbers give NULL."""
    days = F.floor(_c(serial).cast("string").try_cast("double")).try_cast("int")
    return F.date_add(F.lit(EXCEL_EPOCH).cast("date"), days)


def reference_month(as_of: Column | str) -> Column:
    """Month to process on a given day.

    From the 5th on it is the previous month, before that the one before.
    The day is floored to the month first, so the 31st never lands on a
    missing day.
    """
    d = _c(as_of).cast("date")
    back = F.when(F.dayofmonth(d) >= PUBLICATION_DAY, F.lit(-1)).otherwise(F.lit(-2))
    return F.add_months(F.trunc(d, "month"), back)


def next_month(d: Column | str) -> Column:
    return F.add_months(_c(d), 1)
