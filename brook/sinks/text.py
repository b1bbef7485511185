"""K2 text-file sink (sharded, one file per task)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_lines(df: DataFrame, path: str, col: str = "value", mode: str = "overwrite", checkpoint: str | None = None, **options):
    """Write one line per row of string column ``col``; streaming needs a checkpoint folder."""
    out = df.select(df[col].cast("string").alias("value"))
    if df.isStreaming:
        return (
            out.writeStream.format("text")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .options(**options)
            .start()
        )
    out.write.mode(mode).options(**options).text(path)
    return None
