"""Window assignment, tumbling and sliding counts (batch and streaming).

Event time may be ``timestamp`` or ``timestamp_ntz``.  Batch windows are computed on
the column as is.  When a watermark delay is given (required for append-mode
streaming), an NTZ column is read as UTC to get the instant Spark's watermark needs
and window bounds are returned as NTZ again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brook.functions.time import as_instant, instant_to_local, is_ntz

_ET = "_event_time"

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def duration_micros(text: str) -> int | None:
    """Microseconds of a simple duration such as ``"5 seconds"``; None if not of that form."""
    parts = text.strip().lower().split()
    if len(parts) != 2:
        return None
    try:
        n = int(parts[0])
    except ValueError:
        return None
    unit = parts[1].rstrip("s")
    return n * _UNIT_MICROS[unit] if unit in _UNIT_MICROS else None


def _event_time(df: DataFrame, ts: str, delay: str | None) -> tuple[DataFrame, str, bool]:
    if delay is None:
        return df, ts, False
    ntz = is_ntz(df, ts)
    df = df.withColumn(_ET, as_instant(df, ts)).withWatermark(_ET, delay)
    return df, _ET, ntz


def _bounds(win: str, ntz: bool, start: str, end: str | None) -> list:
    s, e = F.col(f"{win}.start"), F.col(f"{win}.end")
    if ntz:
        s, e = instant_to_local(s), instant_to_local(e)
    cols = [s.alias(start)]
    if end:
        cols.append(e.alias(end))
    return cols


def assign_window(df: DataFrame, ts: str, size: str = "5 seconds", start: str = "ws", end: str | None = None) -> DataFrame:
    """Tag each row with its fixed window (no aggregation, no shuffle)."""
    w = F.window(F.col(ts), size)
    out = df.withColumn(start, w.start)
    return out.withColumn(end, w.end) if end else out


def _windowed_counts(df, ts, keys, size, slide, delay, start, end, out):
    src, et, ntz = _event_time(df, ts, delay)
    win = F.window(F.col(et), size, slide) if slide else F.window(F.col(et), size)
    agg = src.groupBy(win.alias("_w"), *keys).agg(F.count(F.lit(1)).alias(out))
    return agg.select(*_bounds("_w", ntz, start, end), *keys, out)


def tumbling_counts(
    df: DataFrame,
    ts: str,
    keys: Sequence[str],
    size: str = "5 seconds",
    delay: str | None = None,
    start: str = "ws",
    end: str | None = None,
    out: str = "n",
) -> DataFrame:
    """W1 (+W5 with ``delay``): rows per (fixed window, keys)."""
    return _windowed_counts(df, ts, list(keys), size, None, delay, start, end, out)


def sliding_counts(
    df: DataFrame,
    ts: str,
    keys: Sequence[str],
    size: str = "60 seconds",
    slide: str = "5 seconds",
    delay: str | None = None,
    start: str = "ws",
    end: str | None = None,
    out: str = "n",
    preaggregate: bool = False,
) -> DataFrame:
    """W2 (+W5): rows per (sliding window, keys); each row counts in size/slide windows.

    Default: Spark's sliding ``window`` — each row is expanded into its size/slide
    windows and combined by the map-side partial aggregate, one shuffle.

    ``preaggregate=True`` (batch, ``size`` a multiple of ``slide``): rows are first
    counted per slide-wide bucket, and only the bucket counts are expanded into the
    covering windows.  That saves size/slide hash updates per raw row when a bucket
    holds many rows per key (dense event streams at scale), at the price of a second
    shuffle.  With about one row per bucket and key, as in the fixtures, it is slower
    (2.0 s vs 0.9 s at sf0.1).
    """
    keys = list(keys)
    size_us, slide_us = duration_micros(size), duration_micros(slide)
    plain = not preaggregate or delay is not None or df.isStreaming
    if plain or not size_us or not slide_us or size_us % slide_us:
        return _windowed_counts(df, ts, keys, size, slide, delay, start, end, out)
    k = size_us // slide_us
    buckets = df.groupBy(F.window(F.col(ts), slide).start.alias("_b"), *keys).agg(F.count(F.lit(1)).alias("_c"))
    spread = buckets.select(F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_i"), "_b", *keys, "_c")
    ws = F.timestamp_add("MICROSECOND", F.col("_i") * F.lit(-slide_us), F.col("_b"))
    res = spread.groupBy(ws.alias(start), *keys).agg(F.sum("_c").cast("long").alias(out))
    if end:
        res = res.withColumn(end, F.timestamp_add("MICROSECOND", F.lit(size_us), F.col(start)))
        return res.select(start, end, *keys, out)
    return res.select(start, *keys, out)
