"""Broadcast only behind a size check.

A side is broadcast when it provably has at most ``max_rows`` rows *and* at most
``max_bytes`` of estimated row data.  Both are partial sums over the side's partitions (give it
as a stored table), so no rows move for the check.  Beyond either bound the join is left to Spark: a
shuffle join, which AQE may still turn into a broadcast from measured sizes and whose
hot keys AQE's skew-join handling splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField

# Fixed bounds for a broadcast side (token dictionaries, lexicons): well under the
# executors' broadcast memory and spark.sql.maxBroadcastTableSize.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 256 * 1024 * 1024

# Per-row and per-variable-length-field overheads of the estimate (bytes).
_ROW_OVERHEAD = 16
_VAR_OVERHEAD = 8
_FIXED_WIDTH = 8


def _field_bytes(f: StructField) -> Column:
    c = F.col(f"`{f.name}`")
    if isinstance(f.dataType, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + F.lit(_VAR_OVERHEAD)
    if f.dataType.typeName() in ("array", "map", "struct", "variant"):
        return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + F.lit(_VAR_OVERHEAD)
    return F.lit(_FIXED_WIDTH)


def row_bytes(df: DataFrame) -> Column:
    """Estimated in-memory bytes of one row of ``df`` (strings by their UTF-8 length)."""
    total = F.lit(_ROW_OVERHEAD)
    for f in df.schema.fields:
        total = total + _field_bytes(f)
    return total.cast("long")


def is_bounded(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` estimated bytes."""
    n, size = df.agg(F.count(F.lit(1)), F.sum(row_bytes(df))).first()
    return n <= max_rows and (size or 0) <= max_bytes


def broadcast_if_bounded(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """``broadcast(df)`` when ``df`` passes :func:`is_bounded`, else ``df`` unchanged."""
    return F.broadcast(df) if is_bounded(df, max_rows, max_bytes) else df
