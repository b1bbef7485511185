"""Token patterns and text column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's tokenisation:
#   words: runs of ASCII letters and apostrophes, case preserved
#   tags:  one or more '#'/'@' followed by ASCII letters and apostrophes
WORD = "[A-Za-z']+"
TAG = "[#@]+[A-Za-z']+"


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text: str | Column, pattern: str = WORD) -> Column:
    """All matches of ``pattern`` in ``text`` as an array (null text -> empty array)."""
    arr = F.regexp_extract_all(col_of(text), F.lit(pattern), F.lit(0))
    return F.coalesce(arr, F.array().cast("array<string>"))


def strip(text: str | Column) -> Column:
    """Remove leading and trailing whitespace (``trim`` only drops spaces)."""
    return F.regexp_replace(col_of(text), r"^\s+|\s+$", "")


def is_blank(text: str | Column) -> Column:
    return ~col_of(text).rlike(r"\S")


def contains_ci(text: str | Column, keyword: str) -> Column:
    """Case-insensitive substring test; null text is no match."""
    return F.coalesce(F.contains(F.lower(col_of(text)), F.lit(keyword.lower())), F.lit(False))
