"""Mixing sources to target weights: multivariate-hypergeometric splitting tree (DataFrame functions only).

Every source is a line of words: its documents in the order of a seeded hash, end to end.
The line is cut into at most ``blocks`` equal blocks, which are the unit of the draw:

1. *Targets*: the sources' weights share ``share`` times all words.  A target stops at
   ``cap`` times its source's size and the excess is shared again by weight
   (water-filling, solved in closed form over one row per source).
2. *Quotas*: a target is whole passes over the line plus a rest.  The rest takes blocks
   in a permuted order; the last one is trimmed, so the quota holds to the word.
3. *Splitting tree*: the quotas (blocks per source) of the root are halved again and again
   until one node per output shard is left.  A node draws its left half by a
   multivariate hypergeometric (a chain of conditional draws over the sources), so the
   shards get exact, disjoint and randomly mixed quotas.
4. *Draw*: the permuted blocks of a source go to the shards in runs of their quotas.  A document's part
   in one block is a row of its own with a hash to shuffle by inside its shard, so shards
   hold exactly what the tree drew.  Shards and the shuffled parts of a shard follow from the words taken.

Scale: documents are placed on the line with a two-level prefix sum keyed by
(source, hash bucket), so a source that holds a third of all rows is spread over all
buckets.  Only sums per (source, bucket) and rows per source or block are moved
besides the documents' own row.

Defined cases: null text has size 0 and is never taken; null source is a source of its
own, last in order; repeated and null doc_ids are placed by their texts too, so reruns agree; equal rows take
places of their own (and are alike); an empty table gives an empty result; extra columns are
ignored or carried under their name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brook.session import materialize

WORD, SPACE = r"[^\x20\x09-\x0D]+", r"[\x20\x09-\x0D]"
#: Rows per source are broadcast up to this many sources (about 4 KB each), beyond it they are joined by shuffle.
MAX_BROADCAST_SOURCES = 10_000
#: Words of an output shard and of a part of it that is shuffled at once, and the least number of shards.
SHARD_WORDS, SLICE_WORDS, MIN_SHARDS = 1 << 26, 1 << 20, 16


def word_count(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: int) -> DataFrame:
    """(sk, source, source_size) -> plus ``target``: one row per source throughout."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    weighted = sizes.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(float(cap)))
    fill = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(0, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(Window.partitionBy()) * F.lit(share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    ) / F.sum("w").over(after)
    # the level after the sources with the smallest cap / weight are full; the first that isn't full sets it for all
    first = F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct("place", "level"))).over(Window.partitionBy())
    return (
        weighted.withColumn("level", level)
        .withColumn("place", F.row_number().over(fill))
        .withColumn("first", first)
        .withColumn(
            "target",
            F.when(F.col("first").isNull() | (F.col("place") < F.col("first.place")), F.col("cap")).otherwise(
                F.col("first.level") * F.col("w")
            ),
        )
        .select("sk", "source", "source_size", "target")
    )


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def hypergeometric(n_all: Column, n_kind: Column, draws: Column, u: Column) -> Column:
    """How many of ``draws`` from ``n_all`` blocks are of the kind with ``n_kind``: the quantile of ``u``.

    The probabilities relative to the mode follow a ratio; those beyond 12 standard
    deviations (and 12 steps) are zero in double precision.
    """

    def bounds(p: Column) -> Column:
        mode = F.floor((p["d"] + 1.0) * (p["k"] + 1.0) / (p["n"] + 2.0))
        sd = F.sqrt(p["d"] * (p["k"] / p["n"]) * (1 - p["k"] / p["n"]) * (p["n"] - p["d"]) / F.greatest(p["n"] - 1.0, F.lit(1.0)))
        lo, hi = F.greatest(F.lit(0.0), p["d"] + p["k"] - p["n"]), F.least(p["d"], p["k"])
        m = F.least(F.greatest(mode.cast("double"), lo), hi)
        reach = F.ceil(sd * 12) + 12.0
        return F.struct(
            p["n"].alias("n"), p["k"].alias("k"), p["d"].alias("d"), m.cast("long").alias("m"),
            F.greatest(lo, m - reach).cast("long").alias("lo"), F.least(hi, m + reach).cast("long").alias("hi"),
        )

    def relative(p: Column, steps: Column, ratio) -> Column:
        start = F.struct(F.lit(1.0).alias("w"), F.array().cast("array<double>").alias("all"))
        return F.aggregate(
            steps, start, lambda a, x: F.struct((a["w"] * ratio(x)).alias("w"), F.concat(a["all"], F.array(a["w"])).alias("all"))
        )["all"]

    def pick(p: Column) -> Column:
        up = relative(p, F.sequence(p["m"], p["hi"]), lambda x: (p["k"] - x) * (p["d"] - x) / ((x + 1.0) * (p["n"] - p["k"] - p["d"] + x + 1.0)))
        down = relative(p, F.sequence(p["m"], p["lo"], F.lit(-1).cast("long")), lambda x: x * (p["n"] - p["k"] - p["d"] + x) / ((p["k"] - x + 1.0) * (p["d"] - x + 1.0)))
        weights = F.concat(F.reverse(F.slice(down, F.lit(2), F.size(down))), up)

        def choose(ws: Column) -> Column:
            need = u * F.aggregate(ws, F.lit(0.0), lambda a, x: a + x)
            start = F.struct(F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("below"))
            return F.aggregate(
                ws, start,
                lambda a, x: F.struct((a["sum"] + x).alias("sum"), (a["below"] + F.when(a["sum"] + x < need, 1).otherwise(0)).alias("below")),
            )["below"]

        return F.least(p["lo"] + _let(weights, choose), p["hi"])

    p = F.struct(n_all.cast("double").alias("n"), n_kind.cast("double").alias("k"), draws.cast("double").alias("d"))
    drawn = _let(p, lambda q: _let(bounds(q), pick))
    return F.when((n_kind <= 0) | (draws <= 0), F.lit(0).cast("long")).when(n_kind >= n_all, draws).otherwise(drawn)


def _unit(*parts: Column) -> Column:
    """A uniform number in (0, 1) from a hash of ``parts``."""
    return (F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 8), 16, 10).cast("double") + 0.5) / float(2**32)


def splitting_tree(quotas: DataFrame, shards: int, seed: str) -> DataFrame:
    """(sk, draws) per source -> (sk, bounds): after how many draws of the source each shard ends.

    One row per tree node with the quotas of all sources; ``log2(shards)`` levels.
    """
    if shards < 1 or shards & (shards - 1):
        raise ValueError("shards must be a power of two")
    nodes = quotas.agg(F.sort_array(F.collect_list(F.struct("sk", "draws"))).alias("kinds")).select(
        F.lit(0).alias("node"), F.transform("kinds", lambda x: x["sk"]).alias("sks"), F.transform("kinds", lambda x: x["draws"]).alias("n")
    )
    for level in range(int(math.log2(shards))):
        total = F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x)
        start = F.struct(
            total.alias("n"), F.floor((total + F.pmod(F.col("node"), F.lit(2))) / 2).cast("long").alias("d"), F.array().cast("array<bigint>").alias("out")
        )

        stream = F.lit(f"{seed}:{level}")

        def split(a, x, stream=stream):
            u = _unit(stream, F.col("node"), F.size(a["out"]))
            got = hypergeometric(a["n"], x, a["d"], u)
            return _let(got, lambda g: F.struct((a["n"] - x).alias("n"), (a["d"] - g).alias("d"), F.concat(a["out"], F.array(g)).alias("out")))

        left = F.aggregate("n", start, lambda a, x: split(a, x), lambda a: a["out"])
        nodes = (
            nodes.withColumn("left", left)
            .withColumn("right", F.zip_with("n", "left", lambda a, b: a - b))
            .select("node", "sks", F.posexplode(F.array("left", "right")).alias("side", "n"))
            .select((F.col("node") * 2 + F.col("side")).alias("node"), "sks", "n")
        )
    leaves = nodes.select("node", F.explode(F.arrays_zip("sks", "n")).alias("x")).select("node", F.col("x.sks").alias("sk"), F.col("x.n").alias("n"))
    ends = leaves.withColumn("end", F.sum("n").over(Window.partitionBy("sk").orderBy("node")))
    by_shard = ends.groupBy("sk").agg(F.sort_array(F.collect_list(F.struct("node", "end"))).alias("e"))
    return by_shard.select("sk", F.transform("e", lambda x: x["end"]).alias("bounds"))


def draw_plan(sizes: DataFrame, weights, share, cap, blocks: int, shards: int, seed: str) -> DataFrame:
    """One row per source: target, block length, words taken of each block in the last pass, and shards.

    ``take[b]`` is what the last, partial pass takes of block ``b``; ``place[b]`` is the
    block's place in the permuted order; ``bounds`` maps draw numbers to shards.
    """
    s = source_targets(sizes, weights, share, cap).withColumn(
        "passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    )
    s = s.withColumn("rest", F.round(F.col("target") - F.col("passes") * F.col("source_size")).cast("long"))
    s = s.withColumn("block", F.greatest(F.ceil(F.col("source_size") / blocks), F.lit(1)).cast("long"))
    s = s.withColumn("n_blocks", F.ceil(F.col("source_size") / F.col("block")).cast("long"))
    of = Window.partitionBy("sk").orderBy("key", "b")
    b = s.filter("n_blocks > 0").select("sk", "source_size", "block", "rest", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)).alias("b"))
    b = b.withColumn("key", F.md5(F.concat_ws(":", F.lit(seed), "sk", "b"))).withColumn(
        "len", F.least(F.col("block"), F.col("source_size") - F.col("b") * F.col("block"))
    )
    b = b.withColumn("place", F.row_number().over(of) - 1).withColumn("sum", F.sum("len").over(of.rowsBetween(Window.unboundedPreceding, 0)))
    b = b.withColumn("take", F.greatest(F.lit(0), F.least(F.col("len"), F.col("rest") - F.col("sum") + F.col("len"))))
    arrays = b.groupBy("sk").agg(F.sort_array(F.collect_list(F.struct("b", "take", "place"))).alias("x"))
    s = s.join(arrays, "sk", "left").select(
        "sk", "source_size", "target", "passes", "block", "n_blocks",
        F.transform("x", lambda x: x["take"]).alias("take"), F.transform("x", lambda x: x["place"]).alias("place"),
    )
    drawn = F.coalesce(F.size(F.filter("take", lambda x: x > 0)), F.lit(0))
    quotas = s.select("sk", (F.col("passes") * F.col("n_blocks") + F.when(F.col("take").isNull(), 0).otherwise(drawn)).cast("long").alias("draws"))
    return s.join(splitting_tree(quotas, shards, seed), "sk", "left")


def mix(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
    carry: tuple[str, ...] = (),
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    cap: int = 2,
    blocks: int = 256,
    shards: int | None = None,
    seed: str = "mix",
) -> DataFrame:
    """One row per document with its part of the mix.

    Columns: ``doc_id, source, <carry>, size, source_size, target, passes`` (whole times it
    is taken), ``segments`` (array of ``shard, epoch, block, from_word, n_words`` over all passes,
    in order; words of the document from 0), ``taken`` (words, repeats counted), ``slices`` (parts a
    shard is shuffled in).  ``shards`` (a power of two) follows from the words taken where not given.
    """
    # by the text too: rows of one id, or of none, have places that don't depend on how they arrive
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))))
    sized = docs.select(
        F.struct(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), *[F.col(c).alias(f"carry_{c}") for c in carry]).alias("row"),
        F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n")).alias("sk"),
        word_count(text).alias("size"),
        key.alias("h"),
    )
    small = materialize(sized if not carry else sized.select("sk", F.struct("row.doc_id", "row.source").alias("row"), "size", "h"), "mix-sizes")
    if not carry:
        sized = small
    counts = small.groupBy("sk").agg(F.first("row.source").alias("source"), F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    counts = materialize(counts, "mix-sources")  # one row per source
    n, n_sources, n_words = counts.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.sum("source_size"), F.lit(0))).first()
    shards = shards or max(MIN_SHARDS, 1 << math.ceil(math.log2(max(1.0, share * n_words / SHARD_WORDS))))
    slices = max(1, math.ceil(share * n_words / shards / SLICE_WORDS))
    buckets = max(256, math.ceil(n / 1024))
    bucket = F.floor(F.conv(F.substring("h", 1, 8), 16, 10).cast("double") * (buckets / 2.0**32)).cast("int")
    sized = sized.withColumn("bucket", bucket)
    plan = materialize(draw_plan(counts.drop("rows"), weights, share, cap, blocks, shards, seed), "mix-plan")
    offsets = small.withColumn("bucket", bucket).groupBy("sk", "bucket").agg(F.sum("size").alias("bucket_size"))
    before = Window.partitionBy("sk").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = offsets.select("sk", "bucket", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("sk", "bucket").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    placed = sized.join(offsets, ["sk", "bucket"]).withColumn("start", F.col("offset") + F.sum("size").over(inside) - F.col("size"))
    rows = placed.join(F.broadcast(plan) if n_sources <= MAX_BROADCAST_SOURCES else plan, "sk")
    rows = rows.withColumn("segments", F.when(F.col("size") > 0, _segments()).otherwise(F.expr("filter(array(named_struct('shard', 0, 'epoch', 0L, 'block', 0L, 'from_word', 0L, 'n_words', 0L)), x -> false)")))
    return rows.select(
        "row.doc_id", "row.source", *[F.col(f"row.carry_{c}").alias(c) for c in carry], "size", "source_size", "target", "passes", "segments",
        F.aggregate("segments", F.lit(0).cast("long"), lambda a, x: a + x["n_words"]).alias("taken"), F.lit(slices).alias("slices"),
    )


def _segments() -> Column:
    """The document's parts of the blocks drawn, for every pass over its source's line."""
    first = F.floor(F.col("start") / F.col("block")).cast("long")
    last = F.floor((F.col("start") + F.col("size") - 1) / F.col("block")).cast("long")

    def part(epoch: Column, b: Column) -> Column:
        at = b.cast("int") + 1
        whole = F.least(F.col("block"), F.col("source_size") - b * F.col("block"))
        length = F.when(epoch < F.col("passes"), whole).otherwise(F.element_at("take", at))
        lo = F.greatest(F.col("start"), b * F.col("block"))
        hi = F.least(F.col("start") + F.col("size"), b * F.col("block") + length)
        draw = epoch * F.col("n_blocks") + F.element_at("place", at)
        return F.struct(
            F.size(F.filter("bounds", lambda x: x <= draw)).alias("shard"),
            epoch.alias("epoch"), b.alias("block"), (lo - F.col("start")).alias("from_word"), (hi - lo).alias("n_words"),
        )

    epochs = F.sequence(F.lit(0).cast("long"), F.col("passes"))
    parts = F.flatten(F.transform(epochs, lambda e: F.transform(F.sequence(first, last), lambda b: part(e, b))))
    return F.filter(parts, lambda x: x["n_words"] > 0)


def mixed_texts(mixed: DataFrame, text: str, columns: list[str], seed: str = "mix") -> DataFrame:
    """Rows of the mix with the taken words as text: one per document, pass and block (``mixed`` carries ``columns``).

    A part that takes the whole document keeps its text as it is; any other is cut out of it from its first word on, with the
    white space behind its words.  ``shard``, ``slice`` and ``shuffle_key`` give the place in the output.
    """
    words = F.regexp_extract_all(F.col(text), F.lit(f"({WORD}{SPACE}*)"), 1)
    whole = F.forall("segments", lambda p: p["n_words"] == F.col("size"))
    part = lambda p, t: F.struct(p.alias("at"), t.alias("text"))
    cut = _let(words, lambda ws: F.transform("segments", lambda p: part(p, F.array_join(F.slice(ws, p["from_word"].cast("int") + 1, p["n_words"].cast("int")), ""))))
    parts = F.when(whole, F.transform("segments", lambda p: part(p, F.col(text)))).otherwise(cut)
    rows = mixed.select(*[F.col(c) for c in columns if c != text], "size", "slices", F.explode(parts).alias("part"))
    at = lambda name: F.col(f"part.at.{name}")
    key = F.md5(F.concat_ws(":", F.lit(seed), at("shard"), at("block"), at("epoch"), at("from_word"), "size", F.md5(F.col("part.text").cast("binary"))))
    return rows.select(
        *[F.col("part.text").alias(text) if c == text else F.col(c) for c in columns],
        at("shard").alias("shard"), F.pmod(F.xxhash64(key), F.col("slices")).alias("slice"), key.alias("shuffle_key"),
    )


def shuffled(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of ``mixed_texts`` in shards, each in parts by hash, shuffled inside a part."""
    return rows.repartition("shard", "slice").sortWithinPartitions("shard", "slice", "shuffle_key").select(*columns)
