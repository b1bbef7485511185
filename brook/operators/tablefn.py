"""A table function of the user's own, joined laterally to the records.

Functions that built-in expressions cover (tokens, lines) stay column expressions; this is for the
others: a Python class whose ``eval`` yields any number of rows per record, fed in Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brook.functions.text import WORD


def apply_table_function(df: DataFrame, function: type, returns: str, args: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` and the rows that ``function().eval(*args)`` yields, for every record of a batch.

    ``returns`` is the DDL schema of the yielded rows; its names must differ from ``keep``.  A record without rows is
    left out.  Spark makes one instance per task: what is costly to load belongs into
    :func:`brook.operators.sentiment.worker_model`, called in ``__init__``.
    """
    fn = F.udtf(function, returnType=returns, useArrow=True)
    given = [f"_arg{i}" for i in range(len(args))]
    records = df.select(*keep, *[F.col(a).alias(g) for a, g in zip(args, given, strict=True)])
    return records.lateralJoin(fn(*[F.col(g).outer() for g in given])).drop(*given)


class WordSpans:
    """Word tokens with their place: ``pos`` among the words, ``start`` and ``stop`` in code points."""

    returns = "pos int, word string, start int, stop int"

    def __init__(self):
        from brook.operators.sentiment import worker_model

        self.pattern = worker_model("brook.words", lambda: re.compile(WORD))

    def eval(self, text: str) -> Iterator[tuple]:
        for pos, m in enumerate(self.pattern.finditer(text or "")):
            yield pos, m.group(), m.start(), m.end()
