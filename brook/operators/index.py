"""T1 stateful first-seen index and T2 windowed counts of indexed tokens (batch).

The reference keeps one dictionary of distinct tokens under a constant key and
gives each new token the current counter value.  Here the dictionary is the
distinct tokens with their first position in an explicit order, numbered densely
by that position (:func:`brook.operators.running.global_index`).  The streaming form
is :class:`brook.streaming.index.FirstSeenIndexer`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brook.functions.text import TAG
from brook.operators.aggregate import ranked_list
from brook.operators.running import global_index
from brook.operators.sizing import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS, is_bounded
from brook.operators.tokens import explode_tokens
from brook.operators.windows import tumbling_counts
from brook.session import materialize as materialize_table


def first_seen(df: DataFrame, token: str, order: Sequence[str]) -> DataFrame:
    """Distinct tokens with the order columns of their first occurrence (``_f_<col>``)."""
    order = list(order)
    if len(order) == 1:
        agg = [F.min(order[0]).alias(f"_f_{order[0]}")]
        firsts = df.where(F.col(token).isNotNull()).groupBy(token).agg(*agg)
    else:
        key = F.min(F.struct(*[F.col(c).alias(f"_f_{c}") for c in order])).alias("_f")
        firsts = df.where(F.col(token).isNotNull()).groupBy(token).agg(key).select(token, "_f.*")
    return firsts


def _number(firsts: DataFrame, token: str, order: Sequence[str], out: str, n_blocks: int | None) -> DataFrame:
    keys = [f"_f_{c}" for c in order]
    return global_index(firsts, keys + [token], out, n_blocks=n_blocks).select(token, out)


def first_seen_index(
    df: DataFrame,
    token: str,
    order: Sequence[str],
    out: str = "idx",
    materialize: bool = True,
    n_blocks: int | None = None,
) -> DataFrame:
    """``(token, idx)``: idx = rank of the token's first occurrence in ``order``, from 0.

    Partial aggregation collapses repeats map-side, so a token that is a third of all
    rows costs one row per input partition before the shuffle.  The distinct-token
    table is written once (``materialize``) as parquet in the shared checkpoint folder, so the
    full scan and aggregation run once for the range bounds and the numbering.
    """
    order = list(order)
    firsts = first_seen(df, token, order)
    if materialize:
        firsts = materialize_table(firsts, "first-seen")
    return _number(firsts, token, order, out, n_blocks)


def indexed_counts(
    df: DataFrame,
    token: str,
    order: Sequence[str],
    ts: str,
    size: str = "5 seconds",
    out: str = "n",
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``'{token}_{idx}'`` per occurrence, counted per fixed window.

    The index (one row per distinct token) is joined back by token: broadcast when
    its ``(token, idx)`` rows pass the row and byte bounds (measured on the
    materialized distinct-token table), else a shuffle join in which AQE splits a hot
    token's partition.
    """
    order = list(order)
    firsts = materialize_table(first_seen(df, token, order), "first-seen")
    idx = _number(firsts, token, order, "idx", None)
    sized = firsts.select(token, F.lit(0).cast("long").alias("idx"))
    if is_bounded(sized, max_broadcast_rows, max_broadcast_bytes):
        idx = F.broadcast(idx)
    tagged = df.join(idx, token).withColumn("token_idx", F.concat_ws("_", F.col(token), F.col("idx").cast("string")))
    return tumbling_counts(tagged, ts, ["token_idx"], size=size, out=out)


def indexed_tag_counts(
    df: DataFrame,
    text: str,
    ts: str,
    order: Sequence[str],
    size: str = "5 seconds",
    k: int | None = None,
    pattern: str = TAG,
) -> DataFrame:
    """E3 in batch: tags of ``text`` -> first-seen index (by ``order`` then position in
    the text) -> ``'{tag}_{idx}'`` counted per fixed window -> ranked list per window."""
    order = list(order)
    toks = explode_tokens(df, text, pattern, keep=[*order, ts], out="token", pos="_pos")
    counts = indexed_counts(toks, "token", [*order, "_pos"], ts, size)
    return ranked_list(counts, token="token_idx", by=["ws"], k=k)
