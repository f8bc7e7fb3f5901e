"""Code columns of the register: modality, size range, dictionary codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Modalities whose worker type is collapsed to ".1".
COLLAPSED_MODALITIES = ["32", "33", "14"]


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def code_text(x: Column | str) -> Column:
    """A code as text, printed like an integer when it is a whole number:
    ``3`` and ``3.0`` both give ``'3'``, strings pass unchanged (registers
    store codes as numbers or as text)."""
    return F.regexp_replace(_c(x).cast("string"), r"\.0$", "")


def modality_code(mod: Column | str = "mod", tipotrc: Column | str = "tipotrc") -> Column:
    """``mod.tipotrc``; modalities 32, 33 and 14 collapse to ``<mod>.1``.

    ``concat`` propagates NULL (a NULL worker type gives a NULL code), which is
    what the register's string join does; ``concat_ws`` would skip it.
    """
    m = code_text(mod)
    return F.when(m.isin(*COLLAPSED_MODALITIES), F.concat(m, F.lit(".1"))).otherwise(
        F.concat(m, F.lit("."), code_text(tipotrc))
    )


def employer_modality_code(mod: Column | str = "mod") -> Column:
    """Employers are counted per modality only: code ``<mod>.1``."""
    return F.concat(code_text(mod), F.lit(".1"))


def size_label(size: Column | str = "size_cierre") -> Column:
    """Literal ``'NA'`` means missing; other labels are lower-cased."""
    s = _c(size)
    return F.when(s != F.lit("NA"), F.lower(s))


def normalize_code(code: Column | str = "sheet_name_code") -> Column:
    """Repair dictionary codes that a spreadsheet stored as long floats.

    Codes longer than five characters are read as numbers, rounded to one
    decimal and printed back the way R prints a double: ``10.100000000000001``
    becomes ``10.1`` and ``1234567`` stays ``1234567``.  A long code that is
    not a number becomes NULL (the reference does the same, with a warning).
    Printing goes through ``decimal(38,1)`` so large values never switch to
    scientific notation.
    """
    c = _c(code)
    as_num = F.round(c.try_cast("double"), 1).try_cast("decimal(38,1)").cast("string")
    printed = F.regexp_replace(as_num, r"\.0$", "")
    return F.when(F.length(c) > 5, printed).otherwise(c)


def unparsable_code(code: Column | str = "sheet_name_code") -> Column:
    """True for a code that is set but that :func:`normalize_code` turns into NULL."""
    return _c(code).isNotNull() & normalize_code(code).isNull()
