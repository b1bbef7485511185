"""Flat-map text into word or tag tokens."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brook.functions.text import WORD, tokens


def explode_tokens(
    df: DataFrame,
    text: str,
    pattern: str = WORD,
    keep: Sequence[str] = (),
    out: str = "token",
    pos: str | None = None,
) -> DataFrame:
    """One row per regex match of ``pattern`` in ``text``, keeping ``keep`` columns.

    ``pos`` (optional) names a column with the 0-based position of the token in the
    text, so arrival order inside a record is reproducible.  Null or token-free text
    yields no rows.  The explode stays inside the scan's codegen stage: no shuffle.
    """
    arr = tokens(text, pattern)
    cols = [F.col(c) for c in keep]
    if pos is None:
        return df.select(*cols, F.explode(arr).alias(out))
    return df.select(*cols, F.posexplode(arr).alias(pos, out)).withColumn(pos, F.col(pos).cast("long"))
