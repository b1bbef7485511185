"""Time-zone independent conversions between local (NTZ) and instant timestamps.

Spark's watermark needs an instant (``timestamp``) column while the fixture tables
carry ``timestamp_ntz``.  Converting through epoch microseconds keeps the wall
clock value exact whatever ``spark.sql.session.timeZone`` is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brook.functions.text import col_of

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def is_ntz(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.TimestampNTZType)


def epoch_micros(df: DataFrame, name: str) -> Column:
    if is_ntz(df, name):
        return F.expr(f"timestampdiff(MICROSECOND, {_EPOCH_NTZ}, `{name}`)")
    return F.unix_micros(F.col(name))


def epoch_seconds(df: DataFrame, name: str) -> Column:
    """Fractional epoch seconds as double (the reference's ``float(timestamp)``)."""
    return epoch_micros(df, name) / F.lit(1_000_000.0)


def as_instant(df: DataFrame, name: str) -> Column:
    """The column as ``timestamp``, reading an NTZ wall clock as UTC."""
    if is_ntz(df, name):
        return F.timestamp_micros(epoch_micros(df, name))
    return F.col(name)


def instant_to_local(c: str | Column) -> Column:
    """An instant as ``timestamp_ntz`` UTC wall clock (inverse of ``as_instant``)."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(col_of(c)), F.expr(_EPOCH_NTZ))
