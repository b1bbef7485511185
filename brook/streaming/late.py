"""Rows behind the watermark, set aside instead of dropped.

Spark's windowed aggregates drop late rows without a trace.  Here every row passes a stateful
operator that only reads the watermark of its micro-batch (it stores nothing) and is marked with
it, so late rows become a table of their own and the rows in time are counted without loss.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from brook.functions.time import as_instant, epoch_micros, instant_to_local, is_ntz
from brook.operators.windows import duration_micros

_TIME, _BUCKET, _MARK = "_event_time", "_bucket", "_watermark_ms"


def mark_late(
    stream: DataFrame, ts: str, delay: str, size: str = "5 seconds", buckets: int = 256, watermark: str = "watermark", out: str = "is_late"
) -> DataFrame:
    """Every row of ``stream`` with the ``watermark`` of its micro-batch and whether it comes too late.

    A row is late when its window of ``size`` had been closed before its micro-batch: the window's end isn't after the
    largest event time of all earlier micro-batches less ``delay``.  The first micro-batch has no watermark (null) and
    no late rows; a null ``ts`` is never late.  Rows are spread over ``buckets`` groups by a hash of the whole row and
    stream through Python in Arrow batches, so no group is held.  Append mode; columns of plain types.
    """
    width = duration_micros(size)
    if not width:
        raise ValueError(f"not a window size: {size!r}")
    columns = stream.columns
    # pandas has no nullable 64-bit numbers: they travel as text
    longs = {f.name for f in stream.schema.fields if isinstance(f.dataType, T.LongType)}
    carried = [F.col(c).cast("string").alias(c) if c in longs else F.col(c) for c in columns]
    bucket = F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")
    timed = stream.select(*carried, as_instant(stream, ts).alias(_TIME), bucket.alias(_BUCKET)).withWatermark(_TIME, delay)

    def mark(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        at = state.getCurrentWatermarkMs()
        for batch in batches:
            yield batch[columns].assign(**{_MARK: at})

    fields = [T.StructField(f.name, T.StringType() if f.name in longs else f.dataType) for f in stream.schema.fields]
    schema = T.StructType([*fields, T.StructField(_MARK, T.LongType())])
    marked = timed.groupBy(_BUCKET).applyInPandasWithState(mark, schema, "none int", "append", GroupStateTimeout.NoTimeout)
    instant = F.timestamp_millis(F.when(F.col(_MARK) > 0, F.col(_MARK)))
    mark_of = instant_to_local(instant) if is_ntz(stream, ts) else instant
    rows = marked.select(*[F.col(c).cast("long").alias(c) if c in longs else F.col(c) for c in columns], mark_of.alias(watermark))
    # not by F.window, which drops rows without a time
    at, mark_at = epoch_micros(rows, ts), epoch_micros(rows, watermark)
    late = at - F.pmod(at, F.lit(width)) + F.lit(width) <= mark_at
    return rows.withColumn(out, F.coalesce(late, F.lit(False)))
