"""K1 log sink: every element as one line of a log folder; a preview on the console."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rendered(df: DataFrame) -> Column:
    """One row as a JSON line, nulls included."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})


def log_sink(df: DataFrame, path: str, checkpoint: str | None = None, mode: str = "append", trigger: dict | None = None):
    """Write every row, rendered as one JSON line, into the text folder ``path``.

    Batch: writes and returns None.  Streaming: starts the query (exactly once per row through the
    file sink) and returns it.
    """
    lines = df.select(rendered(df).alias("value"))
    if not df.isStreaming:
        lines.write.mode(mode).text(path)
        return None
    w = lines.writeStream.format("text").outputMode("append").option("path", path)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def preview(df: DataFrame, n: int = 20, truncate: bool = False) -> None:
    """Print the first ``n`` rows of a batch frame (a look at the data, not a sink)."""
    df.show(n, truncate=truncate)
