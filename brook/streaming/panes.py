"""W4 on a stream, fired by every element: the running count of its key after each record.

Spark's streaming aggregates fire once per micro-batch.  Here the count per key is a value in the
RocksDB state store (``transformWithStateInPandas``): a key's records of a micro-batch come out in
their order, each with the count after it, and the last count is stored for the next batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Panes(StatefulProcessor):
    def __init__(self, order: list[str], columns: list[str], out: str):
        self.order, self.columns, self.out = order, columns, out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        stored = self.count.get()
        before = int(stored[0]) if stored else 0
        batch = pd.concat(list(rows), ignore_index=True).sort_values(self.order, kind="stable")
        batch = batch[self.columns].assign(**{self.out: range(before + 1, before + 1 + len(batch))})
        self.count.update((before + len(batch),))
        yield batch

    def close(self) -> None:
        pass


def running_panes(stream: DataFrame, key: str, order: Sequence[str], out: str = "n") -> DataFrame:
    """Every record of ``stream`` with the number of records of its ``key`` up to and including it.

    Inside a micro-batch records count in ``order``, later batches after earlier ones: for a stream that arrives in
    order this is :func:`brook.operators.running.running_counts_batch`.  A worker holds one
    key's records of one micro-batch at a time, which the source's rate limit bounds.  Append mode; start it
    through :func:`with_rocksdb`.  Null keys count together.
    """
    columns = stream.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema.fields) + f", `{out}` long"
    return stream.groupBy(key).transformWithStateInPandas(
        statefulProcessor=_Panes(list(order), columns, out), outputStructType=schema, outputMode="Append", timeMode="None"
    )


def with_rocksdb(spark: SparkSession, start: Callable):
    """``start()`` a streaming query whose state is in RocksDB: a query keeps the setting it is started with."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return start()
    finally:
        spark.conf.set(PROVIDER, before)
