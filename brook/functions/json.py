"""JSON column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from brook.functions.text import col_of


def has_key(payload: str | Column, key: str) -> Column:
    """Top-level key presence (true also when the value is JSON null); null for invalid JSON."""
    return F.array_contains(F.json_object_keys(col_of(payload)), F.lit(key))


def is_object(text: Column) -> Column:
    """Whether ``text`` is one JSON object and nothing else (null for null).

    The parser stops after the first document.  So the text is parsed as the one element of an array and as the
    one value of an object: what follows a document would have to close both, which no text can.
    """
    starts = F.ltrim(text, F.lit(" \t\r\n")).startswith("{")
    return starts & only_element(text).isNotNull() & F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}"))).isNotNull()


def only_element(text: Column) -> Column:
    """``text`` parsed as a VARIANT (null where it is no JSON); for a text that passes :func:`is_object`."""
    return F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$[0]", "variant")


def as_text(payload: str | Column) -> Column:
    """Binary payloads (topic ``value``) are UTF-8 decoded; strings pass through."""
    return col_of(payload).cast("string")
