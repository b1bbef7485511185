"""T1 streaming: the first-seen dictionary maintained with ``foreachBatch``.

The reference holds every distinct token in one bag under a constant key, so all
work runs serially on one worker.  Here each micro-batch:

1. finds the first occurrence of each token in the batch (partial aggregate);
2. drops tokens already in the dictionary (anti join against the partitions written
   by earlier batches only);
3. numbers the new tokens by first occurrence (distributed dense index) after the
   current dictionary size;
4. overwrites the dictionary partition ``batch_id=<id>``.

A retried batch reads the same earlier partitions and rewrites its own partition with
the same ids, so ids are exactly-once without a transactional store.  Only new
distinct tokens are ever numbered; nothing passes through the driver.

Layout under the dictionary folder: ``parts/batch_id=<id>`` (the new tokens of each
batch) and, every ``compact_every`` batches, ``snapshots/through=<id>`` (all tokens up
to that batch).  A batch reads the latest snapshot plus the few ``parts`` folders after
it by explicit path, so its cost grows with the vocabulary, not with the number of batches run.
Snapshots are rewritten identically on retry.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brook.operators.index import first_seen
from brook.operators.running import global_index
from brook.streaming.runner import read_if_written


class FirstSeenIndexer:
    """Maintain the first-seen dictionary of a token stream (see module docstring).

    With ``occurrences_path``, every micro-batch also writes its occurrences as
    ``'{token}_{idx}'`` (column ``token_idx``) with the ``carry`` columns, into the
    folder ``batch_id=<id>`` (overwritten on retry) — the reference's indexed output,
    ready for windowed counting.
    """

    def __init__(
        self,
        dictionary_path: str,
        token: str = "token",
        order: Sequence[str] = ("ord",),
        out: str = "idx",
        occurrences_path: str | None = None,
        carry: Sequence[str] = (),
        compact_every: int = 32,
    ):
        self.path = dictionary_path.rstrip("/")
        self.parts = f"{self.path}/parts"
        self.snapshots = f"{self.path}/snapshots"
        self.compact_every = max(1, compact_every)
        self.token = token
        self.order = list(order)
        self.out = out
        self.occurrences = occurrences_path.rstrip("/") if occurrences_path else None
        self.carry = list(carry)

    def _latest_snapshot(self, spark: SparkSession, before: int) -> int | None:
        snaps = read_if_written(spark, self.snapshots)
        if snaps is None:
            return None
        return snaps.select("through").where(F.col("through") < before).agg(F.max("through")).first()[0]

    def _known(self, spark: SparkSession, before: int) -> DataFrame | None:
        """Dictionary rows of all batches with id < ``before`` (token, idx, first-seen keys).

        Every part since the latest snapshot must be there: a missing one would give its
        ids away again, so it is an error.
        """
        if before <= 0:
            return None
        through = self._latest_snapshot(spark, before)
        first = 0 if through is None else through + 1
        frames = []
        if through is not None:
            frames.append(spark.read.parquet(f"{self.snapshots}/through={through}").drop("through"))
        for b in range(first, before):
            part = read_if_written(spark, f"{self.parts}/batch_id={b}")
            if part is None:
                raise RuntimeError(f"the dictionary lacks the part of batch {b} in {self.parts}")
            frames.append(part)
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    def _compact(self, spark: SparkSession, through: int) -> None:
        known = self._known(spark, through + 1)
        if known is not None:
            known.write.mode("overwrite").parquet(f"{self.snapshots}/through={through}")

    def process_batch(self, batch: DataFrame, batch_id: int) -> None:
        if self.occurrences:
            batch = batch.persist()
        try:
            self._index(batch, batch_id)
            if self.occurrences:
                self._emit(batch, batch_id)
        finally:
            if self.occurrences:
                batch.unpersist()

    def _emit(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = self._known(spark, batch_id + 1).select(self.token, self.out)
        tagged = batch.join(known, self.token).select(
            *self.carry, F.concat_ws("_", F.col(self.token), F.col(self.out).cast("string")).alias("token_idx")
        )
        # a repeated batch has the same rows: files that are there in full stay, as a reader downstream
        # would take new ones for new input
        path = f"{self.occurrences}/batch_id={batch_id}"
        done = read_if_written(spark, path)
        if done is None or done.count() != tagged.count():
            tagged.write.mode("overwrite").parquet(path)

    def _index(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        firsts = first_seen(batch, self.token, self.order)
        earlier = self._known(spark, batch_id)
        offset = 0
        if earlier is not None:
            firsts = firsts.join(earlier.select(self.token), self.token, "left_anti")
            offset = earlier.agg(F.coalesce(F.max(self.out) + 1, F.lit(0))).first()[0]
        keys = [f"_f_{c}" for c in self.order]
        ids = global_index(firsts, keys + [self.token], self.out)
        ids = ids.withColumn(self.out, F.col(self.out) + F.lit(offset))
        ids.select(self.token, self.out, *keys).write.mode("overwrite").parquet(f"{self.parts}/batch_id={batch_id}")
        if (batch_id + 1) % self.compact_every == 0:
            self._compact(spark, batch_id)

    def dictionary(self, spark: SparkSession) -> DataFrame:
        """``(token, idx)`` for every token seen so far."""
        return spark.read.parquet(self.parts).select(self.token, self.out)

    def start(self, stream: DataFrame, checkpoint: str, trigger: dict | None = None):
        """Start the indexing query on ``stream`` (which must carry token and order columns)."""
        return (
            stream.writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(self.process_batch)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )
