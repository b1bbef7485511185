"""A2/O1 on a stream: ranked ``(n, token)`` list per event-time window.

Two chained stateful aggregations in append mode: counts per (window, token), then
one list per window.  Both are closed by the same watermark, so each window's list
is emitted once, when the window can no longer change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brook.functions.time import as_instant, instant_to_local, is_ntz
from brook.operators.aggregate import ranked_pages
from brook.operators.windows import tumbling_counts
from brook.streaming.runner import batches_to_table

_ET = "_event_time"


def windowed_ranked_lists(
    stream: DataFrame,
    ts: str,
    token: str,
    size: str = "5 seconds",
    delay: str = "10 seconds",
    k: int | None = None,
    start: str = "ws",
    out: str = "ranked",
) -> DataFrame:
    """``(ws, ranked)`` per closed window; ``ranked`` is ``array<struct<n, token>>``
    sorted by count descending then token.  The list length is the number of distinct
    tokens in the window (``k`` keeps the first ``k``)."""
    ntz = is_ntz(stream, ts)
    src = stream.withColumn(_ET, as_instant(stream, ts)).withWatermark(_ET, delay)
    counts = src.groupBy(F.window(_ET, size).alias("window"), F.col(token).alias("_tok")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    entry = F.struct((-F.col("_n")).alias("_neg"), F.col("_tok").alias("token"), F.col("_n").alias("n"))
    lists = counts.groupBy("window").agg(F.sort_array(F.collect_list(entry)).alias("_l"))
    ranked = F.transform(F.col("_l"), lambda e: F.struct(e["n"].alias("n"), e["token"].alias("token")))
    if k is not None:
        ranked = F.slice(ranked, 1, k)
    ws = instant_to_local(F.col("window.start")) if ntz else F.col("window.start")
    return lists.select(ws.alias(start), ranked.alias(out))


def windowed_ranked_pages(
    stream: DataFrame,
    ts: str,
    token: str,
    name: str,
    size: str = "5 seconds",
    delay: str = "10 seconds",
    page_size: int = 1000,
    checkpoint: str | None = None,
    path: str | None = None,
    trigger: dict | None = None,
) -> DataFrame:
    """``(ws, page, ranked)`` of every closed window, drained into a table: the lists of :func:`windowed_ranked_lists` in pages.

    The counts per window and token are the only state.  The watermark gives out a window whole,
    in one micro-batch, whose counts are then ranked and cut by :func:`ranked_pages`.
    """
    counts = tumbling_counts(stream, ts, [token], size, delay=delay)
    kind = counts.schema
    schema = f"ws {kind['ws'].dataType.simpleString()}, page long, ranked array<struct<n: bigint, token: {kind[token].dataType.simpleString()}>>"
    each = lambda batch: ranked_pages(batch, token=token, by=["ws"], page_size=page_size)
    return batches_to_table(counts, name, each, schema, checkpoint, path, trigger)
