"""Display labels and keys of panel members (delegations, subdelegations)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _padded(x: Column, width: int) -> Column:
    # printf-style zero padding; a missing code prints as NA, not 'null'.
    return F.when(x.isNull(), F.lit("NA")).otherwise(F.format_string(f"%0{width}d", x))


def member_label(
    del_code: Column | str = "clave_delegacion",
    subdel_code: Column | str = "clave_subdelegacion",
    del_name: Column | str = "delegacion",
    subdel_name: Column | str = "subdelegacion",
) -> Column:
    """``DD-SSS | delegation - subdelegation`` or ``DD | delegation``."""
    d, s, dn, sn = _c(del_code), _c(subdel_code), _c(del_name), _c(subdel_name)
    dn = F.coalesce(dn, F.lit("NA"))
    has_sub = sn.isNotNull() & (sn != F.lit(""))
    return F.when(
        has_sub,
        F.concat(_padded(d, 2), F.lit("-"), _padded(s, 3), F.lit(" | "), dn, F.lit(" - "), sn),
    ).otherwise(F.concat(_padded(d, 2), F.lit(" | "), dn))


def member_key(del_code: Column | str = "clave_delegacion", subdel_code: Column | str = "clave_subdelegacion") -> Column:
    """``<del>_<subdel>`` with ``NA`` for a missing code."""
    d, s = _c(del_code), _c(subdel_code)
    return F.concat_ws(
        "_", F.coalesce(d.cast("string"), F.lit("NA")), F.coalesce(s.cast("string"), F.lit("NA"))
    )
