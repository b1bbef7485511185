"""S4 circular, paced replay of a line table as file events.

The reference re-reads a file in a circle on a one-second timer, skipping blank
lines and stripping the rest, and publishes ``{"event_time", "data"}``.  Here the
non-blank lines are numbered once (a distributed dense index), and the tick source
picks line ``tick % n_lines``: Spark's ``rate`` source for a live stream, or a
``range`` of ticks for a whole cycle in batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brook.functions.text import strip
from brook.operators.filters import drop_blank
from brook.operators.running import blocks_of, global_index
from brook.session import materialize


def indexed_lines(lines: DataFrame, line: str, order: Sequence[str]) -> DataFrame:
    """``(line_idx, data)``: stripped non-blank lines numbered 0.. in ``order``."""
    # counted here, so that no text is written only to be counted; stripped after the shuffle, which samples its input
    kept = drop_blank(lines, line).select(*dict.fromkeys([*order, line]))
    numbered = global_index(kept, list(order), "line_idx", n_blocks=blocks_of(kept.count()))
    return numbered.select("line_idx", strip(line).alias("data"))


def replay_cycle(
    lines: DataFrame, line: str, order: Sequence[str], start_epoch: int = 0, rows_per_second: int = 1
) -> DataFrame:
    """Batch form: one full replay cycle, ``tick, event_time, data`` (event_time in epoch s)."""
    idx = indexed_lines(lines, line, order)
    return idx.select(
        F.col("line_idx").alias("tick"),
        (F.lit(start_epoch) + F.floor(F.col("line_idx") / F.lit(rows_per_second))).cast("long").alias("event_time"),
        "data",
    )


def replay_lines(
    spark: SparkSession, lines: DataFrame, line: str, order: Sequence[str], rows_per_second: int = 1
) -> DataFrame:
    """Streaming form: ``event_time, data`` at ``rows_per_second``, cycling forever.

    Stream-static join on ``tick % n``; Spark broadcasts the line table when it is
    small and shuffles otherwise.
    """
    idx = materialize(indexed_lines(lines, line, order), "replay-lines")
    ticks = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return replay_ticks(ticks, idx, idx.count()).select("event_time", "data")


def replay_ticks(ticks: DataFrame, idx: DataFrame, n: int) -> DataFrame:
    """``tick, event_time, data``: the line of each tick of a stream ``(timestamp, value)``, cycling over the ``n`` stored
    lines ``idx`` of :func:`indexed_lines`; ``event_time`` is the tick's own time in epoch seconds."""
    if n == 0:
        raise ValueError("no non-blank line to replay")
    keyed = ticks.select((F.col("value") % F.lit(n)).alias("line_idx"), F.col("value").alias("tick"), "timestamp")
    return keyed.join(idx, "line_idx").select("tick", F.unix_timestamp("timestamp").alias("event_time"), "data")


def replay_batch(ticks: DataFrame, idx: DataFrame, n: int) -> DataFrame:
    """:func:`replay_ticks` for one micro-batch: only the stretch of lines between its first and last tick is joined,
    not the whole table (stored in order by :func:`indexed_lines`, so the scan skips the rest of its files)."""
    first, last = ticks.agg(F.min("value"), F.max("value")).first()
    if first is not None and first >= 0 and last - first + 1 < n:
        at, a, b = F.col("line_idx"), first % n, last % n
        idx = idx.where((at >= a) & (at <= b) if a <= b else (at >= a) | (at <= b))
    return replay_ticks(ticks, idx, n)


def staged_ticks(spark: SparkSession, rows_per_batch: int, start_epoch: int = 0, advance_ms: int = 1000, partitions: int = 8) -> DataFrame:
    """A reproducible tick stream: every micro-batch has ``rows_per_batch`` ticks of one time, ``advance_ms`` after the
    one before, whatever the wall clock says (``availableNow`` runs one such batch)."""
    source = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch).option("numPartitions", partitions)
    return source.option("startTimestamp", start_epoch * 1000).option("advanceMillisPerBatch", advance_ms).load()
