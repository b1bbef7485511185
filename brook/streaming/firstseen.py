"""T1 on a stream: first-seen ids from keyed state.

The dictionary's tokens live in Spark's state store, keyed by token: a streaming aggregate keeps
each token's least position and the times of the first and the last micro-batch that saw it.  Only tokens of
the current micro-batch leave the aggregate, and those first seen in it are new: both times are
the batch's own (Spark fixes it in the offset log, so a repeated batch has the same one), and so is the position.
The new tokens are numbered by that position after the count that the batch before stored.

Spark aggregates by hashing only while every aggregate's value has a fixed width; the least of a struct makes it
sort all occurrences.  So a position of an integer and an ``int`` is packed into one decimal; other
positions of several columns stay structs.

So a micro-batch costs what it brings, however large the vocabulary: the dictionary is written,
never read.  A vocabulary larger than the executors' memory needs the RocksDB store
(``local_session(rocksdb=True)`` shows the settings).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType, StructType

from brook.operators.running import global_index
from brook.session import materialize


def position(schema: StructType, order: Sequence[str]) -> Column:
    """One column that sorts as the columns ``order`` do (nulls first), of fixed width where they allow it."""
    small, kinds = (ByteType, ShortType, IntegerType), [schema[c].dataType for c in order]
    if len(order) == 1:
        return F.col(order[0])
    if len(order) == 2 and isinstance(kinds[0], (*small, LongType)) and isinstance(kinds[1], small):
        # null comes before the least value of its type; the second column counts from its null on, below 2^33
        high = F.coalesce(F.col(order[0]).cast("decimal(20,0)"), F.lit(str(-(2**63) - 1)).cast("decimal(20,0)"))
        low = F.coalesce(F.col(order[1]).cast("long") + F.lit(2**31 + 1), F.lit(0)).cast("decimal(10,0)")
        return (high * F.lit(2**33).cast("decimal(10,0)") + low).cast("decimal(32,0)")
    return F.struct(*[F.col(c).alias(f"_f_{c}") for c in order])


class FirstSeenState:
    """The first-seen dictionary of a token stream, kept by one streaming query.

    ``path`` gets ``parts/batch_id=`` (the new tokens and their ids) and ``counts/batch_id=`` (ids given out so
    far), each overwritten by a repeated batch.  Null tokens have no id.
    """

    def __init__(self, path: str, token: str = "token", order: Sequence[str] = ("ord",), out: str = "idx"):
        self.path = path.rstrip("/")
        self.token, self.order, self.out = token, list(order), out

    def firsts(self, stream: DataFrame) -> DataFrame:
        """(token, _at, first, last): the aggregate; ``_at`` is the least position, ``first`` and ``last`` are batch times."""
        at = position(stream.schema, self.order).alias("_at")
        timed = stream.where(F.col(self.token).isNotNull()).select(self.token, at, F.current_timestamp().alias("_batch"))
        return timed.groupBy(self.token).agg(F.min("_at").alias("_at"), F.min("_batch").alias("first"), F.max("_batch").alias("last"))

    def process_batch(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = 0
        if batch_id > 0:
            before = spark.read.parquet(f"{self.path}/counts/batch_id={batch_id - 1}").first()["n"]
        # one read of the aggregate: its state must not be updated twice
        new = materialize(batch.where(F.col("first") == F.col("last")).select(self.token, "_at"), "new-tokens")
        ids = global_index(new, ["_at", self.token], self.out)
        ids = ids.select(self.token, (F.col(self.out) + before).alias(self.out))
        ids.write.mode("overwrite").parquet(f"{self.path}/parts/batch_id={batch_id}")
        total = spark.range(1).select(F.lit(before + new.count()).cast("long").alias("n"))
        total.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/counts/batch_id={batch_id}")

    def start(self, stream: DataFrame, checkpoint: str, trigger: dict | None = None):
        """Start the query on ``stream``, which has the token and order columns."""
        writer = self.firsts(stream).writeStream.outputMode("update").option("checkpointLocation", checkpoint)
        return writer.foreachBatch(self.process_batch).trigger(**(trigger or {"availableNow": True})).start()

    def dictionary(self, spark: SparkSession) -> DataFrame:
        """``(token, idx)`` for every token seen so far."""
        return spark.read.parquet(f"{self.path}/parts").select(self.token, self.out)
