"""Maps over texts in small slices of Arrow batches, so that a worker holds few texts as Python objects at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, StructField, StructType

ROWS = 256
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def batches_of(spark: SparkSession, size: str) -> Iterator[None]:
    """Jobs started inside send Arrow batches of at most about ``size`` to Python: for rows of a megabyte, which would
    otherwise come by the dozen, in the JVM and in the worker at once."""
    before = spark.conf.get(_BATCH_BYTES)
    spark.conf.set(_BATCH_BYTES, size)
    try:
        yield
    finally:
        spark.conf.set(_BATCH_BYTES, before)


def map_slices(df: DataFrame, make: Callable[[pd.DataFrame], Iterable[pd.DataFrame]], schema: str, rows: int = ROWS) -> DataFrame:
    """``make`` over slices of at most ``rows`` rows; it gives any number of frames of ``schema``."""
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, rows):
                for out in make(batch.slice(k, rows).to_pandas(integer_object_nulls=True)):
                    yield pa.RecordBatch.from_pandas(out, schema=target, preserve_index=False)

    return df.mapInArrow(run, schema)


def map_text(df: DataFrame, text: str, make: Callable[[list], list], out: str, kind: DataType, rows: int = ROWS) -> DataFrame:
    """``df`` with column ``out`` (new, or ``text`` itself) = ``make`` of the texts; other columns pass through as they are."""
    replaced = out in df.columns
    field = StructField(out, kind)
    schema = StructType([field if f.name == out else f for f in df.schema.fields] + ([] if replaced else [field]))
    source = df.columns.index(text)
    at = df.columns.index(out) if replaced else len(df.columns)
    arrow = to_arrow_schema(StructType([field])).field(0).type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, rows):
                part = batch.slice(k, rows)
                columns = list(part.columns)
                columns[at : at + 1] = [pa.array(make(columns[source].to_pylist()), type=arrow)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.mapInArrow(run, schema)
