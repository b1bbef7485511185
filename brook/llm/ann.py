"""Approximate nearest neighbours: low-dimensional stable projections indexed by a kd-tree.

Unit vectors are projected by ``dims`` Gaussian (2-stable) directions; a pair's squared projected
distance over its squared distance then follows a chi-square law with ``dims`` degrees of freedom.

1. Equal vectors become one point with its ``k`` + 1 smallest ids, combined batch by batch
   before the shuffle, so a vector that a third of the rows share is one row.
2. A kd-tree of at most ``max_leaves`` leaves is fitted on the projections of a bounded sample
   (``sample_rows`` points in hash order); every point is put into its leaf.  Leaves with more than
   ``block_rows`` points are dealt over several blocks, and the queries that visit a leaf over blocks of
   ``block_queries``: a task compares one block of each.
3. Round one searches a query's own leaf; round two every leaf that can still hold a neighbour.  In
   both, the projected neighbours of a block come nearest first and are verified on the original
   vectors until the next one's squared projected distance exceeds the chi-square quantile
   ``confidence`` times the squared distance of the neighbours found so far; a leaf's box
   is tested the same way before it is visited at all.

A true neighbour is missed with probability of at most 1 - ``confidence``.  The tree (leaf bounds) is the only thing sent
to all tasks; it is bounded by ``max_leaves``.  On the check tables, where vectors have no structure
(the 5th neighbour's cosine is 0.4), most leaves must be visited; the pruning gains on clustered data.

Defined cases: null vectors, vectors holding null or non-finite components and zero vectors take no
part, nor do vectors of another length than the most frequent one (the larger on a tie); null ids take no part; repeated
rows of one id are one candidate per different vector; ties go to the smaller id; fewer candidates
than ``k`` give fewer rows; an empty table gives an empty result;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brook.session import materialize


def chi_square_quantile(p: float, df: int) -> float:
    """By bisection on the distribution function's series."""

    def cdf(x: float) -> float:
        a, z = df / 2, x / 2
        term = total = 1.0 / a
        n = a
        while term > total * 1e-15:
            n += 1
            term *= z / n
            total += term
        return float(total * np.exp(a * np.log(z) - z - _log_gamma(a)))

    lo, hi = 1e-9, 10.0 * df + 200
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if cdf(mid) < p else (lo, mid)
    return (lo + hi) / 2


def _log_gamma(x: float) -> float:
    from math import lgamma

    return lgamma(x)


def directions(size: int, dims: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(size, dims))


@dataclass
class Tree:
    """A kd-tree as arrays: split axis and value per inner node (heap order), and the leaves' boxes."""

    axis: np.ndarray
    value: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def fit(cls, points: np.ndarray, dims: int, depth: int) -> Tree:
        inner = 2**depth - 1
        axis, value = np.zeros(inner, dtype=np.int64), np.zeros(inner)
        low, high = np.full((2 * inner + 1, dims), -np.inf), np.full((2 * inner + 1, dims), np.inf)
        held = {0: points}
        for node in range(inner):
            own = held.pop(node)
            if len(own):
                axis[node] = int(np.ptp(own, axis=0).argmax())
                value[node] = float(np.median(own[:, axis[node]]))
            right = own[:, axis[node]] > value[node]
            for child, part in ((2 * node + 1, own[~right]), (2 * node + 2, own[right])):
                low[child], high[child] = low[node], high[node]
                held[child] = part
            high[2 * node + 1, axis[node]] = low[2 * node + 2, axis[node]] = value[node]
        return cls(axis, value, low[inner:], high[inner:])

    def leaf(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), dtype=np.int64)
        while len(points) and node[0] < len(self.axis):
            node = 2 * node + 1 + (points[np.arange(len(points)), self.axis[node]] > self.value[node])
        return node - len(self.axis)

    def box_distances(self, point: np.ndarray) -> np.ndarray:
        """Squared distance of a point to every leaf's box."""
        gap = np.maximum(0, np.maximum(self.low - point, point - self.high))
        return (gap * gap).sum(axis=1)


def _usable(vector: str, size: int) -> Column:
    v = F.col(vector)
    numbers = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    return v.isNotNull() & (F.size(v) == size) & numbers & F.exists(v, lambda x: x != 0)


def _vectors(rows: pd.Series, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(rows), dtype=np.float64).reshape(-1, size)


def points(table: DataFrame, vec_id: str, vector: str, size: int, p: np.ndarray, keep: int) -> tuple[DataFrame, DataFrame]:
    """Rows (vec_id, key) and distinct points (key, vec, proj, ids), both stored; ``ids`` are the ``keep`` smallest."""
    rows = table.filter(F.col(vec_id).isNotNull() & _usable(vector, size)).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")
    )

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            vec = [(np.asarray(v, dtype=np.float64) + 0.0).tobytes() for v in batch["v"]]
            yield pd.DataFrame({"vec_id": batch["vec_id"], "key": [hashlib.md5(v).digest() for v in vec], "vec": vec})

    rows = materialize(rows.mapInPandas(encode, "vec_id long, key binary, vec binary"), "ann-rows")

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.drop_duplicates(["vec_id", "key"]).sort_values("vec_id")
            ids = batch.groupby("key", sort=False).agg(vec=("vec", "first"), ids=("vec_id", lambda x: x.tolist()[:keep])).reset_index()
            x = _vectors(ids["vec"], size)
            x = x / np.sqrt((x * x).sum(axis=1))[:, None] if len(x) else x
            yield ids.assign(proj=list(x @ p))

    part = rows.mapInPandas(combine, "key binary, vec binary, ids array<long>, proj array<double>")
    ids = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep)
    return rows, materialize(part.groupBy("key").agg(F.first("vec").alias("vec"), ids.alias("ids"), F.first("proj").alias("proj")), "ann-points")


def _search(size: int, keep: int, quantile: float):
    """Cogrouped search of one block: its points against the queries that visit it."""

    def nearest(found: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(found) and len(asked):
            x, y = _vectors(found["vec"], size), np.stack(found["proj"].to_list())
            lengths = np.sqrt((x * x).sum(axis=1))
            lowest = found["ids"].map(lambda i: i[0]).to_numpy()
            asked = asked.drop_duplicates("key")
            for key, vec, proj, bound in zip(asked["key"], asked["vec"], asked["proj"], asked["bound"], strict=True):
                q = np.frombuffer(vec, dtype=np.float64)
                length = np.sqrt((q * q).sum())
                gap = ((y - np.asarray(proj)) ** 2).sum(axis=1)
                order = np.argsort(gap, kind="stable")
                best = np.full(0, 0, dtype=np.int64)
                score = np.zeros(0)
                at, step = 0, 64
                while at < len(order):
                    # projected neighbours nearest first, in growing batches, until the test holds
                    if gap[order[at]] > quantile * (bound + 1e-9):
                        break
                    new = order[at : at + step]
                    at, step = at + step, step * 2
                    s = (x[new] * q).sum(axis=1) / (lengths[new] * length)
                    best, score = np.r_[best, new], np.r_[score, s]
                    top = np.lexsort((lowest[best], -score))[:keep]
                    best, score = best[top], score[top]
                    if len(best) == keep:
                        bound = min(bound, max(0.0, 2 - 2 * score[-1]))
                out += [(key, found["ids"].iat[b], s) for b, s in zip(best, score, strict=True)]
        return pd.DataFrame(out, columns=["key", "ids", "score"])

    return nearest


def nearest_neighbours(
    table: DataFrame, queries: Column, vec_id: str = "vec_id", vector: str = "embedding", k: int = 5, dims: int = 10, confidence: float = 0.98,
    sample_rows: int = 20_000, leaf_rows: int = 1024, max_leaves: int = 1024, block_rows: int = 2048, block_queries: int = 2048, seed: int = 11,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest by cosine of every row that ``queries`` marks (a condition on ``vec_id``)."""
    lengths = table.filter(F.col(vector).isNotNull()).groupBy(F.size(vector).alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    size = lengths["size"] if lengths else 1
    keep = k + 1
    rows, known = points(table, vec_id, vector, size, directions(size, dims, seed), keep)
    n = known.count()
    leaves = min(max_leaves, max(1, n // leaf_rows))
    depth = int(np.log2(leaves))
    sample = known.orderBy("key").select("proj").limit(sample_rows).toPandas()["proj"]
    tree = Tree.fit(np.stack(sample.to_list()) if len(sample) else np.zeros((0, dims)), dims, depth)
    quantile = chi_square_quantile(confidence, dims)

    @F.pandas_udf("int")
    def leaf_of(proj: pd.Series) -> pd.Series:
        return pd.Series(tree.leaf(np.stack(proj.to_list())) if len(proj) else [], dtype="int32")

    known = known.withColumn("leaf", leaf_of("proj"))
    blocks = known.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))
    blocks = materialize(blocks, "ann-blocks")  # one row per leaf
    placed = materialize(known.join(F.broadcast(blocks), "leaf").withColumn("blk", F.pmod(F.xxhash64("key"), "blocks")).drop("blocks"), "ann-placed")
    asked = rows.filter(queries).select("vec_id", "key")
    asked_points = materialize(placed.join(asked.select("key").distinct(), "key", "left_semi").select("key", "vec", "proj", "leaf"), "ann-queries")

    def visit(visits: DataFrame) -> DataFrame:
        """Search the leaves of ``visits`` (key, vec, proj, leaf, bound), all their blocks."""
        asking = visits.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / block_queries).cast("int").alias("asking"))
        asking = materialize(blocks.join(asking, "leaf"), "ann-asking")  # one row per leaf
        every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - F.lit(1).cast("long")))
        each = visits.join(F.broadcast(asking), "leaf").withColumn("ask", F.pmod(F.xxhash64("key"), "asking")).withColumn("blk", every("blocks"))
        held = placed.join(F.broadcast(asking), "leaf").withColumn("ask", every("asking")).drop("blocks", "asking")
        found = held.groupBy("leaf", "blk", "ask").cogroup(each.drop("blocks", "asking").groupBy("leaf", "blk", "ask"))
        return found.applyInPandas(_search(size, keep, quantile), "key binary, ids array<long>, score double")

    def best(found: DataFrame) -> DataFrame:
        """(key, near): the ``keep`` best (score, ids) of each query; Spark limits each task's share of a query before the shuffle."""
        near = F.struct((-F.col("score")).alias("cost"), F.element_at("ids", 1).alias("low"), "ids")
        place = F.row_number().over(Window.partitionBy("key").orderBy("x"))
        ordered = found.select("key", near.alias("x")).withColumn("place", place).filter(F.col("place") <= keep)
        return ordered.groupBy("key").agg(F.array_sort(F.collect_list("x")).alias("near"))

    first = materialize(best(visit(asked_points.withColumn("bound", F.lit(float("inf"))))), "ann-first")
    bound = F.when(F.size("near") == keep, F.greatest(F.lit(0.0), 2 + 2 * F.element_at("near", keep)["cost"])).otherwise(F.lit(float("inf")))
    bounded = asked_points.join(first, "key").withColumn("bound", bound).drop("near")

    @F.pandas_udf("array<int>")
    def more_leaves(proj: pd.Series, leaf: pd.Series, bound: pd.Series) -> pd.Series:
        out = []
        for x, own, b in zip(proj, leaf, bound, strict=True):
            near = np.flatnonzero(tree.box_distances(np.asarray(x)) <= quantile * (b + 1e-9))
            out.append(near[near != own].astype("int32"))
        return pd.Series(out, dtype=object)

    second = visit(bounded.withColumn("leaf", F.explode(more_leaves("proj", "leaf", "bound"))))
    both = first.select("key", F.explode("near").alias("x")).select("key", "x.ids", (-F.col("x.cost")).alias("score")).union(second)
    # ids of a point share its score; the query's own id goes, ties are in order of ids
    pairs = F.flatten(F.transform("near", lambda x: F.transform(x["ids"], lambda i: F.struct(x["cost"].alias("cost"), i.alias("id")))))
    result = asked.distinct().join(best(both), "key").select("vec_id", F.array_sort(F.filter(pairs, lambda x: x["id"] != F.col("vec_id"))).alias("near"))
    result = result.select(F.col("vec_id").alias("query_id"), F.posexplode(F.slice("near", 1, k)).alias("place", "x"))
    return result.select("query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.cost")).alias("score"))
