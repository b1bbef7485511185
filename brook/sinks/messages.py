"""K3 JSON envelope publish and K4 raw pass-through publish."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brook.functions.time import as_instant
from brook.schemas import HEADER


def json_envelope(
    df: DataFrame, fields: Mapping[str, str | Column], out: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """P10: one compact JSON object per row, fields in the given order; null fields are written as ``null``."""
    cols = [(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in fields.items()]
    return df.select(*[F.col(c) for c in keep], F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias(out))


def _write(df: DataFrame, fmt: str, path: str | None, checkpoint: str | None, mode: str, options):
    if df.isStreaming:
        w = df.writeStream.format(fmt).options(**options)
        if checkpoint:
            w = w.option("checkpointLocation", checkpoint)
        return w.start(path) if path else w.start()
    w = df.write.format(fmt).mode(mode).options(**options)
    if path:
        w.save(path)
    else:
        w.save()
    return None


def _messages(df: DataFrame, value: Column, fmt: str, headers: Mapping[str, str | Column] | None, timestamp: str | None) -> DataFrame:
    """The columns a sink of ``fmt`` takes."""
    if fmt not in ("kafka", "parquet"):
        if headers:
            raise ValueError(f"messages of format {fmt!r} have no attributes")
        return df.select(value.cast("string").alias("value"))
    pair = lambda k, v: F.struct(F.lit(k).alias("key"), (F.col(v) if isinstance(v, str) else v).cast("string").cast("binary").alias("value"))
    all_headers = F.array(*[pair(k, v) for k, v in headers.items()]) if headers else F.array().cast(f"array<{HEADER.simpleString()}>")
    columns = [value.cast("binary").alias("value"), F.filter(all_headers, lambda h: h["value"].isNotNull()).alias("headers")]
    if fmt == "parquet":  # a topic stamps its messages itself
        columns.append((as_instant(df, timestamp) if timestamp else F.current_timestamp()).alias("timestamp"))
    return df.select(*columns)


def publish_json(
    df: DataFrame,
    fields: Mapping[str, str | Column],
    fmt: str = "text",
    path: str | None = None,
    checkpoint: str | None = None,
    mode: str = "append",
    headers: Mapping[str, str | Column] | None = None,
    timestamp: str | None = None,
    **options,
):
    """K3: publish ``to_json(struct(fields))`` as the message value (UTF-8).

    ``fmt="kafka"`` writes the topic named in ``options``; ``"parquet"`` appends to the message log at ``path``;
    ``"text"`` writes one JSON message per line.  ``headers`` are the messages' attributes (a null one is left
    out), ``timestamp`` the log's publish time (now, if not given).
    """
    cols = [(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in fields.items()]
    value = F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    return _write(_messages(df, value, fmt, headers, timestamp), fmt, path, checkpoint, mode, options)


def publish_raw(
    df: DataFrame,
    payload: str = "value",
    fmt: str = "text",
    path: str | None = None,
    checkpoint: str | None = None,
    mode: str = "append",
    headers: Mapping[str, str | Column] | None = None,
    timestamp: str | None = None,
    **options,
):
    """K4: publish the original payload unchanged, whatever class the record is in.

    A topic and the message log (``"parquet"``) take any bytes and null; a text folder can't hold a
    line break or a null, so such payloads need one of the others.
    """
    return _write(_messages(df, F.col(payload), fmt, headers, timestamp), fmt, path, checkpoint, mode, options)
