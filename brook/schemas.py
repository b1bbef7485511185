"""Explicit schemas for the records the operators read and write (see FIXTURES.md)."""

from pyspark.sql import types as T

CORRUPT = "_corrupt"

# one text line
LINE = T.StructType([T.StructField("value", T.StringType(), True)])

# replayed file line as published: epoch seconds (truncated) + stripped line
FILE_EVENT = T.StructType(
    [T.StructField("event_time", T.LongType(), True), T.StructField("data", T.StringType(), True)]
)

# social post: only these fields are ever read; the raw payload is kept as is
TWEET = T.StructType(
    [
        T.StructField("text", T.StringType(), True),
        T.StructField("created_at", T.StringType(), True),
        T.StructField("lang", T.StringType(), True),
    ]
)

# the fixture events' JSON payload
PROPS = T.StructType([T.StructField("k", T.LongType(), True)])

# message envelope of a topic source
HEADER = T.StructType([T.StructField("key", T.StringType(), True), T.StructField("value", T.BinaryType(), True)])
ENVELOPE = T.StructType(
    [
        T.StructField("value", T.BinaryType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
        T.StructField("headers", T.ArrayType(HEADER), True),
    ]
)

# ranked list entry
RANKED = T.ArrayType(
    T.StructType([T.StructField("n", T.LongType(), False), T.StructField("token", T.StringType(), True)])
)


def with_corrupt(schema: T.StructType) -> T.StructType:
    """Schema plus the string column that receives records which fail to parse."""
    if CORRUPT in schema.fieldNames():
        return schema
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)])
