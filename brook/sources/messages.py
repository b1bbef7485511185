"""S2/S3 topic sources.

With a Kafka connector on the classpath, ``fmt="kafka"`` reads the topic as is:
``value`` (binary payload), ``timestamp`` (publish time) and, with attributes,
``headers``.  Two folder formats stand in for a message bus.  ``"parquet"`` is a message log:
rows ``value, headers, timestamp`` as the message sinks write them, any bytes and null payloads unchanged, batch
and stream.  ``"text"`` holds one message per line, and the file's modification time is the publish time, so
it takes no payload with a line break, no null and no attributes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brook.schemas import ENVELOPE as MESSAGE
from brook.schemas import HEADER, LINE


def read_messages(
    spark: SparkSession,
    fmt: str,
    path: str | None = None,
    with_attributes: bool = False,
    streaming: bool = True,
    **options,
) -> DataFrame:
    """Message envelope ``value, timestamp[, headers]`` from a topic or a message folder."""
    reader = spark.readStream if streaming else spark.read
    if fmt == "kafka":
        if with_attributes:
            options.setdefault("includeHeaders", "true")
        df = reader.format("kafka").options(**options).load()
        cols = ["value", "timestamp"] + (["headers"] if with_attributes else [])
        return df.select(*cols)
    if fmt == "parquet":
        df = reader.schema(MESSAGE).options(**options).parquet(path)
        return df.select("value", "timestamp", *(["headers"] if with_attributes else []))
    if fmt not in ("text", "json"):
        raise ValueError(f"unsupported message format {fmt!r}")
    if streaming:
        reader = reader.schema(LINE)
    df = reader.options(**options).format("text").load(path)
    cols = [F.col("value").cast("binary").alias("value"), F.col("_metadata.file_modification_time").alias("timestamp")]
    if with_attributes:
        cols.append(F.array().cast(f"array<{HEADER.simpleString()}>").alias("headers"))
    return df.select(*cols)


def attribute(name: str, headers: str = "headers") -> Column:
    """The text of a message's first attribute ``name``; null where it has none."""
    found = F.filter(F.col(headers), lambda h: h["key"] == name)
    return F.get(found, F.lit(0))["value"].cast("string")
