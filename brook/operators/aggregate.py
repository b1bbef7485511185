"""A1 count by key, A2 ranked lists, O1 ranking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brook.operators.running import running_counts_batch


def count_by(df: DataFrame, keys: Sequence[str | Column], out: str = "n") -> DataFrame:
    """A1: rows per key.  Planned as partial (map-side) + final hash aggregate, so a hot
    key costs one row per input partition in the shuffle, not one per record."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def rank_counts(counts: DataFrame, token: str = "token", n: str = "n") -> DataFrame:
    """O1 as rows: count descending, ties by token ascending (a total, reproducible order).

    A distributed range sort: the full ranked list without gathering it anywhere.
    """
    return counts.orderBy(F.col(n).desc(), F.col(token).asc())


def ranked_list(
    counts: DataFrame,
    token: str = "token",
    n: str = "n",
    by: Sequence[str] = (),
    k: int | None = None,
    out: str = "ranked",
) -> DataFrame:
    """A2+O1: one ``array<struct<n, token>>`` per group of ``by`` (or one overall).

    The list holds one entry per distinct token of the group, so it is bounded by the
    group's key cardinality, not by its row count (counts are aggregated first).  With
    ``k`` only the top ``k`` entries are kept (a top-k report).  An empty input gives
    no row (a global combine without a default value).
    """
    src = counts
    if k is not None:
        if by:
            w = Window.partitionBy(*by).orderBy(F.col(n).desc(), F.col(token).asc())
            src = src.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r")
        else:
            src = src.orderBy(F.col(n).desc(), F.col(token).asc()).limit(k)
    entry = F.struct((-F.col(n)).alias("_neg"), F.col(token).alias("token"), F.col(n).cast("long").alias("n"))
    ordered = F.sort_array(F.collect_list(entry))
    as_pairs = F.transform(ordered, lambda e: F.struct(e["n"].alias("n"), e["token"].alias("token")))
    group = [F.col(c) for c in by] if by else [F.lit(1).alias("_all")]
    res = src.groupBy(*group).agg(as_pairs.alias(out))
    return res if by else res.drop("_all")


def ranked_pages(counts: DataFrame, token: str = "token", n: str = "n", by: Sequence[str] = (), page_size: int = 1000, out: str = "ranked") -> DataFrame:
    """A2+O1 in pages: ``(by.., page, ranked)``, the list of :func:`ranked_list` cut into rows of ``page_size`` entries.

    An entry's rank inside its group is its place in its block of the order (count descending, token) plus
    the sizes of the group's earlier blocks, so neither a group with most of the tokens nor
    the one overall list (no ``by``) is ever gathered: no row holds more than a page.  Pages
    count from 0; an empty input gives no row.  Batch; on a stream page every micro-batch of closed windows
    (:func:`brook.streaming.ranked.windowed_ranked_pages`).
    """
    by = list(by)
    group = F.struct(*by) if by else F.struct(F.lit(1).alias("_all"))
    rows = counts.select(group.alias("_g"), (-F.col(n)).alias("_neg"), F.col(token).alias("_token"))
    ranked = running_counts_batch(rows, "_g", ["_g", "_neg", "_token"], out="_rank")
    page = F.floor((F.col("_rank") - 1) / page_size).cast("long")
    entry = F.struct("_rank", F.col("_token").alias("token"), (-F.col("_neg")).cast("long").alias("n"))
    pages = ranked.groupBy("_g", page.alias("page")).agg(F.sort_array(F.collect_list(entry)).alias("_l"))
    as_pairs = F.transform("_l", lambda e: F.struct(e["n"].alias("n"), e["token"].alias("token")))
    return pages.select(*[F.col(f"_g.{c}").alias(c) for c in by], "page", as_pairs.alias(out))


def render_ranked(ranked: str | Column, sep: str = ",") -> Column:
    """``token:n`` entries joined by ``sep`` in list order (for logs and value hashing)."""
    c = F.col(ranked) if isinstance(ranked, str) else ranked
    return F.array_join(F.transform(c, lambda e: F.concat(e["token"], F.lit(":"), e["n"].cast("string"))), sep)
