"""Decode JSON payloads, set bad records aside, reshape messages.

A payload is good when it is exactly one JSON object.  Empty and blank payloads, null ones, arrays
and scalars, several documents in one payload and text after the document are bad, as is an object that
names a key twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brook.functions.json import as_text, is_object, only_element
from brook.functions.time import epoch_seconds
from brook.schemas import CORRUPT, TWEET, with_corrupt


def decode_json(df: DataFrame, payload: str = "value", schema: T.StructType = TWEET, out: str = "msg") -> DataFrame:
    """Parse ``payload`` into struct ``out`` with the declared ``schema`` (PERMISSIVE).

    A record that is not one JSON object, or whose fields don't fit the schema, keeps its raw text in
    column ``_corrupt`` (empty for a null payload).  Use :func:`split_bad` to route the two kinds of
    rows.  Fields absent from the JSON come back null (the reference's ``dict.get``).
    """
    text = as_text(payload)
    good = F.coalesce(is_object(text), F.lit(False))
    # the parser only ever sees objects: it fails on blank texts and stops after the first document
    parsed = F.from_json(
        F.when(good, text),
        with_corrupt(schema),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    fields = [parsed[f.name].alias(f.name) for f in schema.fields]
    bad = F.when(good, parsed[CORRUPT]).otherwise(F.coalesce(text, F.lit("")))
    return df.withColumn(out, F.struct(*fields)).withColumn(CORRUPT, bad)


def decode_variant(df: DataFrame, payload: str = "value", out: str = "msg") -> DataFrame:
    """Parse ``payload`` into VARIANT column ``out``: objects of any shape and nesting, without a schema.

    Bad payloads (see the module's text) have a null ``out`` and keep their raw text in ``_corrupt``,
    as in :func:`decode_json`.  Read fields with :func:`field`.
    """
    text = as_text(payload)
    good = F.coalesce(is_object(text), F.lit(False))
    parsed = F.when(good, only_element(text))
    return df.withColumn(out, parsed).withColumn(CORRUPT, F.when(~good, F.coalesce(text, F.lit(""))))


def field(msg: str, path: str, kind: str = "string") -> Column:
    """The value at ``path`` (``$.user.tags[0]``) of VARIANT column ``msg``; null where it is absent or of another kind."""
    return F.try_variant_get(F.col(msg), path, kind)


def split_bad(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows) of a :func:`decode_json` result; both lazy, same scan."""
    good = decoded.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = decoded.where(F.col(CORRUPT).isNotNull())
    return good, bad


def format_tweet(df: DataFrame, msg: str = "msg", ts: str = "timestamp", keep: Sequence[str] = ()) -> DataFrame:
    """``{text, created_at, timestamp}`` where timestamp is the element time as float seconds."""
    return df.select(
        *[F.col(c) for c in keep],
        F.col(f"{msg}.text").alias("text"),
        F.col(f"{msg}.created_at").alias("created_at"),
        epoch_seconds(df, ts).alias("timestamp"),
    )


def format_line_event(df: DataFrame, msg: str = "msg", keep: Sequence[str] = ()) -> DataFrame:
    """``{data, timestamp=float(event_time)}`` from a decoded file event."""
    return df.select(
        *[F.col(c) for c in keep],
        F.col(f"{msg}.data").alias("data"),
        F.col(f"{msg}.event_time").cast("double").alias("timestamp"),
    )

