"""F1-F5 filters and the key-presence classifier (A4 tallies)."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brook.functions.json import has_key
from brook.functions.text import contains_ci, is_blank


def keyword_filter(df: DataFrame, text: str, keyword: str) -> DataFrame:
    """rows whose ``text`` contains ``keyword`` case-insensitively (null text: dropped)."""
    return df.where(contains_ci(text, keyword))


def drop_blank(df: DataFrame, line: str = "value") -> DataFrame:
    """drop null, empty and whitespace-only lines."""
    return df.where(F.col(line).isNotNull() & ~is_blank(line))


def lang_filter(df: DataFrame, langs: Sequence[str], lang: str = "lang") -> DataFrame:
    """language allow-list (a plain IN, pushed to the parquet scan)."""
    return df.where(F.col(lang).isin(list(langs)))


def any_keyword(text: str, keywords: Sequence[str]) -> Column:
    """One match over the lower-cased text against the keywords' prefix tree.

    A plain alternation tries every keyword at every place of the text.  In the tree, keywords with a
    common start share it, so a place costs as many steps as there are first letters, and
    further ones only where a keyword goes on: hardly more for 2,000 keywords than for 40.
    """
    kws = sorted({k.lower() for k in keywords if k})
    if not kws:
        return F.lit(False)
    return F.lower(F.col(text)).rlike(prefix_tree(kws))


def prefix_tree(keywords: Sequence[str]) -> str:
    """A regular expression that is found where one of ``keywords`` stands."""
    return _subtree(sorted(keywords), 0)


def _subtree(kws: list[str], at: int) -> str:
    """What follows the first ``at`` characters, common to the sorted ``kws``."""
    if len(kws[0]) == at:  # a keyword ends here; longer ones add nothing to the search
        return ""
    common = at
    while common < min(len(kws[0]), len(kws[-1])) and kws[0][common] == kws[-1][common]:
        common += 1
    start = _quoted(kws[0][at:common])
    if common == len(kws[0]):
        return start
    branches = [_subtree(list(group), common) for _, group in groupby(kws, key=lambda k: k[common])]
    return f"{start}(?:{'|'.join(branches)})"


def _quoted(keyword: str) -> str:
    """``keyword`` as a regular expression that matches just itself."""
    return "".join(c if c.isalnum() else f"\\x{{{ord(c):x}}}" for c in keyword)


def track_filter(df: DataFrame, text: str, topics: Sequence[str]) -> DataFrame:
    """rows whose text contains any of ``topics`` (case-insensitive substring)."""
    return df.where(any_keyword(text, topics))


def classify_by_key(df: DataFrame, payload: str, key: str, out: str = "is_extended") -> DataFrame:
    """boolean column telling whether the JSON payload has top-level ``key``."""
    return df.withColumn(out, has_key(payload, key))


def class_counts(classified: DataFrame, flag: str = "is_extended", out: str = "n") -> DataFrame:
    """A4: number of records per class (the ``+``/``-`` tallies)."""
    return classified.groupBy(flag).agg(F.count(F.lit(1)).alias(out))
