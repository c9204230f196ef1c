"""Cleaning of extracted text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"(?U)[\s\x1c-\x1f]+"
# Sequences left where an accent was torn off its letter.
ENCODING_ERRORS = ("´ı", "c¸˜a", "´o", "´e", "˜a", "˜o", "¸c", "´a", "´i", "´u")


def strip(text: Column) -> Column:
    """Without white space of any kind at either end; null stays null."""
    return F.regexp_replace(text, rf"^{SPACE}|{SPACE}$", "")


def basic_clean(text: Column) -> Column:
    """White space runs become one blank, control characters go, ends are trimmed.

    A control character between blanks leaves two blanks, as deletion comes second.
    """
    return F.trim(F.regexp_replace(F.regexp_replace(text, SPACE, " "), r"[\x00-\x1f\x7f]", ""))


def has_encoding_error(text: Column) -> Column:
    """Whether any sequence of ENCODING_ERRORS occurs; null counts as no."""
    return F.coalesce(text.rlike("|".join(ENCODING_ERRORS)), F.lit(False))


def clean(text: Column, repaired: Column | None = None) -> Column:
    """'' for null and empty; the repaired text as it is where flagged; else the basic cleaning."""
    plain = basic_clean(text)
    kept = plain if repaired is None else F.when(has_encoding_error(text), repaired).otherwise(plain)
    return F.when(F.coalesce(text, F.lit("")) == "", "").otherwise(kept)
