"""Order-dependent numbering without a single-task window.

A ``Window`` with ``orderBy`` but no (or a skewed) ``partitionBy`` moves every row of
a group into one task.  Both helpers here cut the order into *blocks*: the partitions of a
range partitioning by the order columns, of any types.  A row's block is stored beside it in a
table in the shared checkpoint folder, so every branch of the plan, and every recomputation
after a lost executor, reads the same blocks.  Rows are numbered inside their block,
plus an offset from a prefix sum over block sizes.

The number of blocks follows the number of rows (about ``ROWS_PER_BLOCK`` each).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brook.session import materialize

BLOCK = "_blk"
PLACE = "_nth"
ROWS_PER_BLOCK = 1_000_000


def blocks_of(rows: int) -> int:
    """The number of blocks for ``rows`` rows."""
    return max(1, -(-rows // ROWS_PER_BLOCK))


def _sized(df: DataFrame, n_blocks: int | None) -> tuple[DataFrame, int]:
    if n_blocks is None:
        df = materialize(df, "numbered")  # counted from its footers, read once more to be ranged
        n_blocks = blocks_of(df.count())
    return df, n_blocks


def with_blocks(df: DataFrame, order: Sequence[str], n_blocks: int | None = None) -> DataFrame:
    """``df`` as a stored table with integer column ``_blk``, which never decreases along ``order``.

    Rows with equal order columns share a block; nulls sort first.
    """
    df, n_blocks = _sized(df, n_blocks)
    ranged = df.repartitionByRange(n_blocks, *order).withColumn(BLOCK, F.spark_partition_id())
    return materialize(ranged, "blocks")


def global_index(df: DataFrame, order: Sequence[str], out: str = "idx", n_blocks: int | None = None) -> DataFrame:
    """Dense 0-based position of each row in the order ``order`` (ties: any order).

    Equivalent to ``row_number() OVER (ORDER BY order) - 1`` for order columns of any types.  The blocks are
    stored sorted, each row with its place, so the rows are shuffled and written once.  The offset table has one
    row per block, so broadcasting it is bounded by the block count (rows / ``ROWS_PER_BLOCK``), not by the data.
    """
    order = list(order)
    df, n_blocks = _sized(df, n_blocks)
    place = F.monotonically_increasing_id()  # partition << 33 | place in the partition
    blocked = materialize(df.repartitionByRange(n_blocks, *order).sortWithinPartitions(*order).withColumn(PLACE, place), "blocks")
    block = F.shiftright(PLACE, 33).alias(BLOCK)
    sizes = blocked.groupBy(block).agg(F.count(F.lit(1)).alias("_c"))
    before = Window.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)  # one row per block
    offsets = sizes.select(BLOCK, F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    return (
        blocked.withColumn(BLOCK, block)
        .join(F.broadcast(offsets), BLOCK)
        .withColumn(out, (F.col("_off") + F.col(PLACE).bitwiseAND(F.lit(2**33 - 1))).cast("long"))
        .drop(BLOCK, "_off", PLACE)
    )


def running_counts_batch(
    df: DataFrame,
    key: str,
    order: Sequence[str] | str,
    out: str = "n",
    n_blocks: int | None = None,
) -> DataFrame:
    """W4 batch view: for each row, the number of rows with the same ``key`` up to and
    including it in ``order`` — the value of the reference's accumulating pane after
    that element.  Equivalent to ``count(*) OVER (PARTITION BY key ORDER BY order ROWS
    UNBOUNDED PRECEDING)``, without sending a hot key to one task: rows are grouped by
    (key, order block), so a key holding a third of the data is spread over all blocks.

    One shuffle by ranges into a stored table and one by (key, block), shared by the offset
    join and the window; the per-(key, block) counts are aggregated map-side first.
    """
    order = [order] if isinstance(order, str) else list(order)
    # struct(key) is never null, so null keys form one group under plain equality and
    # the offset join stays an equi-join on the window's own partitioning.
    blocked = with_blocks(df, order, n_blocks).withColumn("_k", F.struct(F.col(key)))
    per_block = blocked.groupBy("_k", BLOCK).agg(F.count(F.lit(1)).alias("_c"))
    earlier = Window.partitionBy("_k").orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_block.select("_k", BLOCK, F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_off"))
    local = Window.partitionBy("_k", BLOCK).orderBy(*order)
    return (
        blocked.withColumn("_rn", F.row_number().over(local))
        .join(offsets, ["_k", BLOCK], "left")
        .withColumn(out, (F.coalesce(F.col("_off"), F.lit(0)) + F.col("_rn")).cast("long"))
        .drop(BLOCK, "_k", "_rn", "_off")
    )
