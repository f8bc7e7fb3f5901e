"""Text normalisation helpers used on labels, paths and sheet headers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented Latin letters and their ASCII transliteration.
ACCENTED = "áéíóúüñÁÉÍÓÚÜÑàèìòùÀÈÌÒÙâêîôûÂÊÎÔÛäëïöÄËÏÖãõÃÕçÇ"
PLAIN = "aeiouunAEIOUUNaeiouAEIOUaeiouAEIOUaeioAEIOaoAOcC"
# Whitespace: ASCII blanks and every Unicode space separator (no-break
# space included), as the reference's regular-expression engine treats them.
WHITESPACE = r"[\s\p{Z}]+"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def squish(x: Column | str) -> Column:
    """Trim and collapse internal whitespace runs to one space."""
    return F.trim(F.regexp_replace(_c(x), WHITESPACE, " "))


# Sentence breaks as in Unicode sentence segmentation, for the cases labels
# contain: after '?' or '!' plus spaces always; after '.' plus spaces only
# when the next letter is upper-case (a lower-case letter continues the
# sentence, and '10.1' has no space).  A marker character splits sentences.
_MARK = "\u0001"
_SENTENCE_FIRST_LETTER = r"(?s)^([^\p{L}]*)(\p{L})(.*)$"


def _title_first_letter(s: Column) -> Column:
    pre = F.regexp_extract(s, _SENTENCE_FIRST_LETTER, 1)
    first = F.regexp_extract(s, _SENTENCE_FIRST_LETTER, 2)
    rest = F.regexp_extract(s, _SENTENCE_FIRST_LETTER, 3)
    return F.when(s.rlike(r"\p{L}"), F.concat(pre, F.upper(first), F.lower(rest))).otherwise(F.lower(s))


def sentence_case(x: Column | str) -> Column:
    """Sentence case: in every sentence the first letter is upper-case and
    all other letters lower-case (not title case of every word)."""
    c = _c(x)
    marked = F.regexp_replace(c, r"([?!] +)", "$1" + _MARK)
    marked = F.regexp_replace(marked, r"(\. +)([^\p{L}]*\p{Lu})", "$1" + _MARK + "$2")
    return F.array_join(F.transform(F.split(marked, _MARK), _title_first_letter), "")


def first_number(x: Column | str) -> Column:
    """First run of digits as a number; NULL when there is none."""
    return F.nullif(F.regexp_extract(_c(x), r"\d+", 0), F.lit("")).try_cast("int")


def strip_accents(x: Column | str) -> Column:
    return F.translate(_c(x), ACCENTED, PLAIN)


def remove_first_suffix(x: Column | str) -> Column:
    """Remove the first ``_word`` run (Unicode-aware word characters)."""
    return F.regexp_replace(_c(x), r"(?U)^(.*?)_\w+", "$1")


def remove_first_dot(x: Column | str) -> Column:
    """Remove the first literal dot only."""
    return F.regexp_replace(_c(x), r"^([^.]*)\.", "$1")
