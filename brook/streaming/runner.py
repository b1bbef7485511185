"""Run a streaming query to completion into a table, and replay a table as a stream.

Results are written to a file sink in the shared checkpoint folder (exactly-once via
the sink's metadata log), never collected in driver memory.  ``availableNow`` drains
what is there and stops, which is how tests and the registered queries drive a
stream; a live deployment passes its own trigger.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from brook.session import scratch_path


def run_to_table(
    df: DataFrame,
    name: str,
    mode: str = "append",
    checkpoint: str | None = None,
    path: str | None = None,
    trigger: dict | None = None,
    timeout_s: float | None = None,
    keys: list[str] | None = None,
    no_data_batches: bool = True,
) -> DataFrame:
    """Start ``df`` (streaming) with sink ``path``, wait until it has drained, read the result.

    ``append``: file sink.  ``complete``: each batch's whole table into its own
    ``batch_id=`` folder, the last one is the result.  ``update`` (needs ``keys``): each
    batch writes only the keys it changed, and the result is the latest row per key,
    so no batch rewrites the whole table.
    """
    if mode == "update" and not keys:
        raise ValueError("update mode needs the key columns")
    spark = df.sparkSession
    path = path or scratch_path(spark, f"{name}-out")
    checkpoint = checkpoint or scratch_path(spark, f"{name}-ckpt")
    trig = trigger or {"availableNow": True}
    w = df.writeStream.queryName(f"{name}_{abs(hash(path)) % 10**8}").option("checkpointLocation", checkpoint)
    if mode == "append":
        w = w.format("parquet").outputMode("append").trigger(**trig)
        q = _start(spark, lambda: w.start(path), no_data_batches)
    else:
        # complete/update results are whole tables or changed keys per batch: overwrite
        # a folder per batch id so a retried batch rewrites the same files.
        def write(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

        w = w.outputMode(mode).foreachBatch(write).trigger(**trig)
        q = _start(spark, w.start, no_data_batches)
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"streaming query {name} had not drained after {timeout_s} s")
    if q.exception() is not None:
        raise RuntimeError(f"streaming query {name} failed: {q.exception()}")
    if mode == "append":
        return spark.read.schema(df.schema).parquet(path)
    if mode == "update":
        return latest_per_key(spark, path, df.schema, keys)
    return latest_batch(spark, path, df.schema)


def batches_to_table(
    df: DataFrame,
    name: str,
    each: Callable[[DataFrame], DataFrame],
    schema,
    checkpoint: str | None = None,
    path: str | None = None,
    trigger: dict | None = None,
) -> DataFrame:
    """Every micro-batch of ``df`` through the batch function ``each``, its rows (of ``schema``) into folder
    ``batch_id=`` of ``path``, which a repeated batch overwrites; the drained stream's rows.

    For operators that need more than one pass or a join back to the record, such as model scores."""
    spark = df.sparkSession
    path = path or scratch_path(spark, f"{name}-out")

    def write(batch: DataFrame, batch_id: int) -> None:
        each(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    checkpoint = checkpoint or scratch_path(spark, f"{name}-ckpt")
    q = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).trigger(**(trigger or {"availableNow": True})).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"streaming query {name} failed: {q.exception()}")
    rows = read_if_written(spark, path)
    return spark.createDataFrame([], schema) if rows is None else rows.drop("batch_id")


def replay_batches_to_table(df: DataFrame, order: str, n_splits: int, name: str, each: Callable[[DataFrame], DataFrame], schema) -> DataFrame:
    """Replay ``df`` as ``n_splits`` micro-batches through the batch function ``each`` (see :func:`batches_to_table`)."""
    spark = df.sparkSession
    checkpoint, out = scratch_path(spark, f"{name}-ckpt"), scratch_path(spark, f"{name}-out")
    result = None
    for source in replay_splits(df, order, n_splits, name):
        result = batches_to_table(spark.readStream.schema(df.schema).parquet(source), name, each, schema, checkpoint, out)
    return result


_NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"


def _start(spark: SparkSession, start: Callable, no_data_batches: bool):
    """Start a query; without ``no_data_batches`` it runs only batches that have new data
    (windows closed by the watermark are then emitted by the next data batch).  A query
    copies the session configuration when it starts, so the setting is only changed
    around ``start``."""
    if no_data_batches:
        return start()
    before = spark.conf.get(_NO_DATA, "true")
    spark.conf.set(_NO_DATA, "false")
    try:
        return start()
    finally:
        spark.conf.set(_NO_DATA, before)


def read_if_written(spark: SparkSession, path: str) -> DataFrame | None:
    """The parquet table at ``path``; None where nothing was ever written.  Any other failure is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def latest_per_key(spark: SparkSession, path: str, schema, keys: list[str]) -> DataFrame:
    """Current table of an update-mode result: per key, the row of the highest batch id."""
    changes = read_if_written(spark, path)
    if changes is None:  # empty input
        return spark.createDataFrame([], schema)
    values = [c for c in schema.fieldNames() if c not in keys]
    latest = F.max_by(F.struct(*values), F.col("batch_id")).alias("_v")
    return changes.groupBy(*keys).agg(latest).select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values])


def latest_batch(spark: SparkSession, path: str, schema) -> DataFrame:
    """The last written ``batch_id`` folder of a complete-mode result."""
    all_batches = read_if_written(spark, path)
    if all_batches is None:  # empty input
        return spark.createDataFrame([], schema)
    last = all_batches.agg(F.max("batch_id")).first()[0]
    return all_batches.where(F.col("batch_id") == last).drop("batch_id")


#: A task reads whole row groups; writers' default of 128 MB would leave a range of the replay to a few tasks.
ROW_GROUP_BYTES = 8 * 1024 * 1024


def replay_splits(df: DataFrame, order: str, n_splits: int, name: str) -> Iterator[str]:
    """Append ``df`` to a source folder in ``n_splits`` ascending ``order`` ranges.

    Yields the folder after each range is written (a normal, parallel write: any number
    of files; row groups of ``ROW_GROUP_BYTES``, so that many tasks read a range that few wrote).  Draining a file stream over the folder with ``availableNow`` from one
    checkpoint after every step processes exactly the new range.  So the table is
    replayed one whole range per micro-batch, in event-time order, and every step is also
    a restart from the checkpoint.  Test and replay scaffolding: a production stream
    arrives from its own source.
    """
    path = scratch_path(df.sparkSession, f"{name}-source")
    lo, hi = df.agg(F.min(order), F.max(order)).first()
    kind = df.schema[order].dataType
    # literal bounds on the column itself reach the scan; rows without order come first
    at = lambda k: lo + ((hi - lo + 1) * k // n_splits if isinstance(lo, int) else (hi - lo) * k / n_splits)
    cuts = [] if lo is None else [F.lit(at(k)).cast(kind) for k in range(n_splits)]
    for k in range(n_splits):
        part = df.limit(0)
        if not cuts:
            part = df if k == 0 else part  # no row has an order
        else:
            inside = (F.col(order) >= cuts[k]) & ((F.col(order) < cuts[k + 1]) if k < n_splits - 1 else F.lit(True))
            part = df.where(inside | F.col(order).isNull() if k == 0 else inside)
        part.write.mode("append").option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
        yield path


def replay_to_table(
    df: DataFrame,
    order: str,
    n_splits: int,
    name: str,
    build: Callable[[DataFrame], DataFrame],
    mode: str = "append",
    keys: list[str] | None = None,
) -> DataFrame:
    """Replay ``df`` as a stream of ``n_splits`` micro-batches through ``build`` and
    return the drained result (see :func:`replay_splits` and :func:`run_to_table`)."""
    spark = df.sparkSession
    checkpoint, out = scratch_path(spark, f"{name}-ckpt"), scratch_path(spark, f"{name}-out")
    result = None
    for i, source in enumerate(replay_splits(df, order, n_splits, name)):
        stream = spark.readStream.schema(df.schema).parquet(source)
        # only the last run needs the closing no-data batch: earlier closed windows are
        # emitted by the following data batch, so the final table is the same
        last = i == n_splits - 1
        result = run_to_table(
            build(stream), name, mode=mode, checkpoint=checkpoint, path=out, keys=keys, no_data_batches=last
        )
    return result
