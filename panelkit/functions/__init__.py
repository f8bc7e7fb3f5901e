"""Scalar column expressions (built-in Spark functions only, no UDFs)."""

from panelkit.functions.codes import code_text, employer_modality_code, modality_code, normalize_code, size_label
from panelkit.functions.dates import excel_serial_to_date, next_month, reference_month
from panelkit.functions.labels import member_key, member_label
from panelkit.functions.text import (
    first_number,
    remove_first_dot,
    remove_first_suffix,
    sentence_case,
    squish,
    strip_accents,
)

__all__ = [
    "code_text",
    "employer_modality_code",
    "excel_serial_to_date",
    "first_number",
    "member_key",
    "member_label",
    "modality_code",
    "next_month",
    "normalize_code",
    "reference_month",
    "remove_first_dot",
    "remove_first_suffix",
    "sentence_case",
    "size_label",
    "squish",
    "strip_accents",
]
