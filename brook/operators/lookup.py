"""Sums of a large table's values over the tokens of each record.

A plain join of the exploded tokens with the table sends every occurrence of a token to one
task, and a common word is in nearly every record.  So the tokens of the records are counted first: the
most common ones (a bounded number) with their values are broadcast and summed where the record is,
only the occurrences of rare tokens are shuffled to the table.  The cut changes where a token is looked
up, never what is found.

The tokens left for the shuffle have no heavy one among them: the bound is reached by the tokens of count
``2^b`` and more only when there are that many, so a rarer token has at most about one in
``MAX_COMMON / 2`` of all occurrences.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brook.operators.sizing import is_bounded, row_bytes
from brook.session import materialize

MAX_COMMON = 200_000
MAX_COMMON_BYTES = 64 * 1024 * 1024


def common_tokens(counts: DataFrame, token: str, max_rows: int = MAX_COMMON, max_bytes: int = MAX_COMMON_BYTES) -> DataFrame:
    """The tokens of ``counts`` (``token``, ``n``) with ``n >= 2^b``, for the least ``b`` that keeps them within the bounds."""
    power = F.floor(F.log2(F.col("n").cast("double"))).cast("int")
    sizes = counts.groupBy(power.alias("b")).agg(F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(counts)).alias("bytes")).collect()
    least, rows, size = 64, 0, 0  # one row per power of two
    for r in sorted(sizes, key=lambda r: -r["b"]):
        rows, size = rows + r["rows"], size + r["bytes"]
        if rows > max_rows or size > max_bytes:
            break
        least = r["b"]
    return counts.where(power >= least).select(token)


def token_sums(
    records: DataFrame,
    table: DataFrame,
    values: Sequence[str],
    id_col: str = "_id",
    tokens: str = "_tok",
    token: str = "token",
    max_common: int = MAX_COMMON,
    broadcast_table: bool | None = None,
) -> DataFrame:
    """``id_col`` and the sums of ``values`` over the record's tokens that ``table`` (unique ``token``) has, repeats
    counted; records without such a token have no row.  Give ``records`` as a stored table, it is read
    several times.  ``broadcast_table``: whether the whole table is broadcast (None: if it passes the size check)."""
    pairs = records.select(id_col, F.explode(tokens).alias(token))
    table = table.select(token, *values)
    sums = [F.sum(v).alias(v) for v in values]
    if is_bounded(table) if broadcast_table is None else broadcast_table:
        return pairs.join(F.broadcast(table), token).groupBy(id_col).agg(*sums)
    counts = materialize(pairs.groupBy(token).agg(F.count(F.lit(1)).alias("n")), "token-counts")
    # a common token that the table lacks has null values: it is found to be unknown here, not by a shuffle
    common = common_tokens(counts, token, max_common).join(table, token, "left").withColumn("_common", F.lit(True))
    common = F.broadcast(materialize(common, "common-tokens"))
    # one look at each occurrence: a record's common tokens become one row of sums, its rare ones a row each
    rare = F.when(F.col("_common").isNull(), F.col(token)).alias(token)
    seen = pairs.join(common, token, "left").groupBy(id_col, rare).agg(*sums, F.count(F.lit(1)).alias("_n"))
    seen = materialize(seen, "looked-up")
    near = seen.where(F.col(token).isNull() & F.coalesce(*[F.col(v) for v in values]).isNotNull()).select(id_col, *values)
    far = seen.where(F.col(token).isNotNull()).select(id_col, token, "_n").join(table, token)
    far = far.select(id_col, *[(F.col(v) * F.col("_n")).alias(v) for v in values])
    return near.unionByName(far).groupBy(id_col).agg(*sums)
