"""Document fingerprints: threshold-scaled sketches (DataFrame functions only).

A text's shingles are its distinct runs of five words (with fewer words the whole sequence is one).
A shingle's hash is the first 32 bits of its MD5.  The sketch keeps *every* hash below a fixed
fraction of the hash space, so its size follows the text's and any two sketches are comparable:
the sketch of a union of texts is the union of their sketches, and the share of the smaller
sketch found in the larger estimates containment, however unequal the texts are.  A text with no hash
below the fraction keeps its smallest one; a union drops such a stand-in as soon as it has a hash
below.  The fingerprint writes the sorted hashes as eight hexadecimal digits each.

Likeness of two fingerprints: shared hashes / hashes of the smaller one; equal ones (both empty
included) 1, otherwise an empty one 0.

*The next document.*  ``with_next`` gives each document the one after it by doc_id without a
single-task window.  Documents go to blocks by cut points, quantiles of the ids; an id that
fills several blocks (null ids, say) is split by text hash, its second order.  The first row of every block
is also sent to the block before as a guest, the first row of all to the last block; so inside
its block each row finds its successor by ``lead``.  Texts are shuffled once.

Defined cases: null text is empty; wordless texts have the empty fingerprint; null doc_ids come first;
rows with equal ids are ordered by text hash, equal rows in any order (they are alike); a single
document follows itself; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from itertools import pairwise

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brook.session import materialize

SPACE = r"[\x20\x09-\x0D]+"
#: Digits of a hash, and the share of the hash space that sketches keep.
DIGITS, FRACTION = 8, 0.25
#: Rows of a block and the largest number of blocks (their cut points are part of the plan).
BLOCK_ROWS, MAX_BLOCKS = 4096, 10_000
#: Parts an id that fills several blocks may be split into, at most.
_PARTS = 1 << 20
_FIRST_ID = -(1 << 63)


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def shingle_hashes(ws: Column, size: int = 5) -> Column:
    """Hash of every run of ``size`` words of the array ``ws``; of all words where there are fewer."""
    whole = lambda x: F.substring(F.md5(x.cast("binary")), 1, DIGITS)
    run = lambda i: whole(F.concat_ws(" ", *[ws[i + k] for k in range(size)]))
    n = F.size(ws)
    return (
        F.when(n >= size, F.transform(F.sequence(F.lit(0), n - size), run))
        .when(n > 0, F.array(whole(F.array_join(ws, " "))))
        .otherwise(F.array().cast("array<string>"))
    )


def retained(hashes: Column, fraction: float = FRACTION) -> Column:
    """The distinct hashes below the fraction, sorted; where there is none, the smallest."""
    bound = f"{int(fraction * 16**DIGITS):0{DIGITS}x}"
    below = F.array_sort(F.array_distinct(F.filter(hashes, lambda h: h < bound) if fraction < 1 else hashes))
    return F.when(F.size(below) > 0, below).when(F.size(hashes) > 0, F.array(F.array_min(hashes))).otherwise(F.array().cast("array<string>"))


def with_sketch(df: DataFrame, text: str, out: str, size: int = 5, fraction: float = FRACTION) -> DataFrame:
    """``df`` with the sketch of column ``text``; each step is a projection of its own, so none is computed twice."""
    hashed = df.withColumn(f"{out}_words", words(F.col(text))).withColumn(f"{out}_all", shingle_hashes(F.col(f"{out}_words"), size))
    return hashed.drop(f"{out}_words").withColumn(out, retained(F.col(f"{out}_all"), fraction)).drop(f"{out}_all")


def likeness(a: Column, b: Column) -> Column:
    """Share of the smaller sketch that is in the other."""
    smaller = F.least(F.size(a), F.size(b))
    return F.when(a == b, F.lit(1.0)).when(smaller == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / smaller)


def _block(cuts: list[int], order: Column, tie: Column) -> Column:
    """Block of a row: how many cut points don't exceed its order; rows of a cut point that stands
    several times are dealt to that many parts by ``tie``, later rows of the block follow the last part."""
    times: dict[int, int] = {}
    for c in cuts:
        times[c] = times.get(c, 0) + 1
    points = sorted(times)
    if not points:
        return F.lit(0).cast("long")
    step = max(1, round(len(points) ** 0.5))
    groups = [points[k : k + step] for k in range(0, len(points), step)]
    array = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    # two levels: the group by its first point, then the place inside it
    group = F.size(F.filter(array([g[0] for g in groups]), lambda c: c <= order))
    inside = F.size(F.filter(F.element_at(F.array(*[array(g) for g in groups]), F.greatest(group, F.lit(1))), lambda c: c <= order))
    place = F.when(group == 0, F.lit(0)).otherwise((group - 1) * step + inside).cast("long")
    hot = {p: m for p, m in times.items() if m > 1}
    part = F.lit(0).cast("long")
    if hot:
        share = tie / F.lit(2.0**64) + 0.5
        at = {p: k + 1 for k, p in enumerate(points)}
        parts = F.create_map(*[F.lit(x).cast("long") for p, m in hot.items() for x in (at[p], m)])
        is_cut = F.array_contains(array(sorted(hot)), order)
        n = F.coalesce(F.element_at(parts, place), F.lit(1).cast("long"))
        part = F.when(is_cut, F.least(F.floor(share * n), n - 1)).otherwise(n - 1)
    return place * _PARTS + part


def with_next(docs: DataFrame, text: str, doc_id: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(doc_id, text, block, guest, o, h): every document in its block, and the blocks' first rows as guests before them."""
    order = F.coalesce(F.col("doc_id"), F.lit(_FIRST_ID).cast("long"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", order.alias("o"), F.xxhash64("text").alias("h"))
    thin = materialize(rows.select("o", "h"), "fingerprint-order")
    n_blocks = min(MAX_BLOCKS, -(-thin.count() // block_rows))
    cuts: list[int] = []
    if n_blocks > 1:
        shares = [k / n_blocks for k in range(1, n_blocks)]
        cuts = thin.agg(F.percentile_approx("o", shares, max(10_000, 20 * n_blocks))).first()[0]
    block = _block(cuts, F.col("o"), F.col("h"))
    # one row per block
    heads = thin.groupBy(block.alias("block")).agg(F.min(F.struct("o", "h")).alias("head")).orderBy("block").collect()
    guests = [(nxt["head"]["o"], nxt["head"]["h"], b["block"]) for b, nxt in pairwise(heads)]
    if heads:
        guests.append((heads[0]["head"]["o"], heads[0]["head"]["h"], heads[-1]["block"]))
    known = docs.sparkSession.createDataFrame(guests, "o long, h long, host long").groupBy("o", "h").agg(F.collect_set("host").alias("hosts"))
    homes = F.concat(
        F.array(F.struct(block.alias("block"), F.lit(False).alias("guest"))),
        F.transform(F.coalesce("hosts", F.array().cast("array<bigint>")), lambda b: F.struct(b.alias("block"), F.lit(True).alias("guest"))),
    )
    placed = rows.join(F.broadcast(known), ["o", "h"], "left").select("doc_id", "text", "o", "h", F.explode(homes).alias("home"))
    return placed.select("doc_id", "text", "o", "h", "home.block", "home.guest").repartition("block")


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", fraction: float = FRACTION, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per document: its fingerprint, that of an edited text (the last quarter replaced by as much of the next
    document's start), and its likeness to the edited and to the next one."""
    rows = with_sketch(with_next(docs, text, doc_id, block_rows), "text", "sketch", fraction=fraction)
    following = Window.partitionBy("block").orderBy("guest", "o", "h")
    rows = rows.withColumn("next", F.lead(F.struct("text", "sketch")).over(following)).filter(~F.col("guest"))
    rows = rows.withColumn("n_chars", F.char_length("text").cast("long"))
    rows = rows.withColumn("cut", F.floor(F.col("n_chars") / 4).cast("int"))
    kept = F.substring("text", F.lit(1), F.col("n_chars").cast("int") - F.col("cut"))
    rows = rows.withColumn("edited", F.concat(kept, F.substring(F.col("next.text"), F.lit(1), F.col("cut"))))
    rows = rows.select("doc_id", "n_chars", "sketch", F.col("next.sketch").alias("next_sketch"), "edited")
    rows = with_sketch(rows, "edited", "edited_sketch", fraction=fraction)
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        F.array_join("sketch", "").alias("fingerprint"), F.array_join("edited_sketch", "").alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"), likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
