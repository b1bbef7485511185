"""MinHash near-duplicates: signature-coordinate inverted join, with links confirmed on full shingle sets.

1. One map over the text hashes every document's set of 5-word shingles (64 bit) to its
   size, a 128-bit fingerprint and ``K`` signature coordinates.  Documents with equal sets form a
   class, which stands for all its copies from here on.
2. Classes are posted under each (coordinate, value) pair.  Values that occur once can't
   collide and are dropped.  *Prefix*: with a class's pairs in order of frequency, two
   classes that agree in at least ``T`` of ``K`` coordinates share one of the first
   K - T + 1, so only those are posted; the frequent values stay out of the lists.
3. *Skip*, round one: each list only pairs its members with its most central class (the hub,
   whose values are the most frequent).  Pairs with at least ``T`` collisions are
   confirmed on their full sets, and confirmed links merge classes into components.
4. *Skip*, round two: a list whose members are all in one component is done.  In the other lists
   the members of different components are compared - every pair that round one left open, none
   inside a component.  A list's members are dealt into blocks of about ``BLOCK`` and meet block by
   block: a pair is taken up in its first common list only, its collisions are counted,
   its sizes and own shingles must allow a link (with u of a class's n shingles its own, the similarity is at
   most min(na - ua, nb - ub) / max(na + ub, nb + ua)), and its sets, cut to 32 bits (which can
   only raise the overlap), must reach the threshold.  Only pairs that pass leave the block and are
   confirmed as before, so a large group of near copies is never expanded into its pairs.

A pair of similarity 0.75 passes 19 of 40 collisions with probability 1 - 5e-5, more
similar ones more surely; the confirmation makes every link exact up to 64-bit hash
collisions.  Confirmation reads the documents of the pairs once more and sends each set to
its hub's group; a hub's members are dealt over groups of about 64.

Defined cases: null, empty and wordless texts have no shingles and are linked with nothing; fewer
than five words are one shingle; every row is a document of its own by a stored row key, so rows
with a null doc_id, with one doc_id and repeated rows are linked by their texts; a component's id is its smallest
doc_id, null if no row has one; ``drop_near_duplicates`` keeps one row of each component and every row without
shingles, whatever their ids; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brook.llm.slices import map_slices
from brook.session import materialize

SHINGLE = 5
K, T = 40, 19
#: Members of a list that meet at once in round two.
BLOCK = 512
#: Routes (documents and the groups that want their sets, about 30 bytes each) up to which the second read finds its documents by a broadcast.
MAX_BROADCAST_ROUTES = 1_000_000
#: Dropped rows whose keys are broadcast at most (8 bytes each).
MAX_BROADCAST_IDS = 1_000_000
#: Column of the stored row key.
ROW = "dup_row_key"
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_STEPS = _mix(np.arange(1, SHINGLE + 1, dtype=np.uint64) * _GOLD) | np.uint64(1)
_XOR = _mix(np.arange(1001, 1001 + K, dtype=np.uint64) * _GOLD)
_MUL = _mix(np.arange(5001, 5001 + K, dtype=np.uint64) * _GOLD) | np.uint64(1)


class WordHashes(dict):
    """64-bit hashes of words; the store starts anew beyond ``limit`` words."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, only ASCII blanks part
        if len(self) > self.limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingle_set(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    h = hashes.of(text or "")
    if not len(h):
        return h
    n = max(1, len(h) - SHINGLE + 1)
    parts = [h[k : k + n] * _STEPS[k] for k in range(min(SHINGLE, len(h)))]
    total = sum(parts[1:], parts[0].copy()) if len(h) >= SHINGLE else np.array([sum(int(p[0]) for p in parts) + len(h) & 0xFFFFFFFFFFFFFFFF], np.uint64)
    return np.unique(_mix(total))


def signature(shingles: np.ndarray) -> np.ndarray:
    """``K`` (coordinate, value) pairs as 64-bit numbers, the coordinate mixed in."""
    best = np.full(K, np.iinfo(np.uint64).max, dtype=np.uint64)
    for k in range(0, len(shingles), 1024):
        part = (shingles[k : k + 1024, None] ^ _XOR) * _MUL
        best = np.minimum(best, part.min(axis=0))
    return _mix(best + _XOR)


def fingerprint(shingles: np.ndarray) -> bytes:
    return np.array([shingles.sum(dtype=np.uint64), _mix(shingles + _GOLD).sum(dtype=np.uint64)]).tobytes()


def with_row_keys(docs: DataFrame) -> DataFrame:
    """``docs``, stored with a key per row: rows can be equal in all else."""
    if ROW in docs.columns:
        raise ValueError(f"column {ROW} is taken")
    return materialize(docs.withColumn(ROW, F.monotonically_increasing_id()), "dup-rows")


def signatures(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(row_key, doc_id, n, fp, sig) per row; without shingles ``sig`` is null."""
    hashes = WordHashes()

    def sign(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        n, fps, sigs = [], [], []
        for body in rows["text"]:
            s = shingle_set(body, hashes)
            n.append(len(s))
            fps.append(fingerprint(s))
            sigs.append(signature(s).view(np.int64) if len(s) else None)
        yield pd.DataFrame({"row_key": rows["row_key"], "doc_id": rows["doc_id"].astype("Int64"), "n": n, "fp": fps, "sig": sigs})

    rows = docs.select(F.col(ROW).alias("row_key"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_slices(rows, sign, "row_key long, doc_id long, n long, fp binary, sig array<long>")


def postings(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(fp, n, shared) of the classes that can reach ``T`` collisions, and their prefix postings (tok, fp, weight)."""
    pairs = classes.select("fp", "n", F.explode("sig").alias("tok"))
    frequent = pairs.groupBy("tok").agg(F.count(F.lit(1)).alias("f")).filter("f > 1")
    shared = (
        pairs.join(frequent, "tok")
        .groupBy("fp", "n")
        .agg(F.sort_array(F.collect_list(F.struct("f", "tok"))).alias("s"))  # at most K
        .filter(F.size("s") >= T)
        .select("fp", "n", F.transform("s", lambda x: x["tok"]).alias("shared"), F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + x["f"]).alias("weight"))
    )
    shared = materialize(shared, "dup-shared")
    # K - size(shared) pairs are unique to the class and come first in the order of frequency
    prefix = F.slice("shared", F.lit(1), F.size("shared") - F.lit(T - 1))
    return shared, materialize(shared.select("fp", "weight", F.explode(prefix).alias("tok")), "dup-postings")


def colliding(pairs: DataFrame, shared: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that agree in at least ``T`` coordinates and whose sizes allow a link."""
    a = shared.select(F.col("fp").alias("a"), F.col("n").alias("na"), F.col("shared").alias("sa"))
    b = shared.select(F.col("fp").alias("b"), F.col("n").alias("nb"), F.col("shared").alias("sb"))
    both = pairs.join(a, "a").join(b, "b").filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    return both.filter(F.size(F.array_intersect("sa", "sb")) >= T).select("a", "b")


def with_sets(routes: DataFrame, docs: DataFrame, text: str, schema: str, make) -> DataFrame:
    """Read the texts of ``routes`` (route_id, fp, ...) again: ``make(row, set)`` frames."""
    texts = docs.select(F.col(ROW).alias("route_id"), F.col(text).alias("text"))
    entries = routes.agg(F.sum(F.size("goals") + 1) if "goals" in routes.columns else F.count(F.lit(1))).first()[0] or 0
    sent = texts.join(F.broadcast(routes) if entries <= MAX_BROADCAST_ROUTES else routes, "route_id")
    hashes = WordHashes()

    def again(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        frames, held = [], 0
        for row in rows.itertuples(index=False):
            shingles = shingle_set(row.text, hashes)
            frames.append(make(row, shingles))
            held += len(frames[-1]) * max(1, len(shingles))
            if held > 1_000_000:  # keep what a worker holds small
                yield pd.concat(frames)
                frames, held = [], 0
        if frames:
            yield pd.concat(frames)

    return map_slices(sent, again, schema)


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, text: str, percent: int) -> DataFrame:
    """Links among the pairs (a, b), by their documents' full sets."""
    degree = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / 64).alias("groups"))
    dealt = pairs.join(degree, "a").select("a", "b", F.pmod(F.xxhash64("b"), "groups").alias("grp"))
    member = dealt.select("a", "grp", F.col("b").alias("fp"))
    hub = dealt.select("a", "grp", F.col("a").alias("fp")).distinct()
    # a text goes out once for up to about 256 of the groups that want its set
    goals = member.union(hub)
    parts = goals.groupBy("fp").agg(F.ceil(F.count(F.lit(1)) / 256).alias("parts"))
    goals = goals.join(parts, "fp").groupBy("fp", F.pmod(F.xxhash64("a", "grp"), "parts").alias("part")).agg(F.collect_list(F.struct("a", "grp")).alias("goals"))
    routes = goals.join(classes.select("fp", "lead.row_key"), "fp").select(F.col("row_key").alias("route_id"), "fp", "goals")

    def send(row, shingles: np.ndarray) -> pd.DataFrame:
        of = [(g["a"], g["grp"]) for g in row.goals]
        return pd.DataFrame({"a": [x for x, _ in of], "grp": [x for _, x in of], "fp": [row.fp] * len(of), "shingles": [shingles.tobytes()] * len(of)})

    def link(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        hub = bytes(key[0])
        by = {bytes(f): np.frombuffer(s, np.uint64) for f, s in zip(rows["fp"], rows["shingles"], strict=True)}
        own = by.pop(hub)
        out = []
        for fp, s in by.items():
            common = len(np.intersect1d(own, s, assume_unique=True))
            if 100 * common >= percent * (len(own) + len(s) - common):
                out.append((hub, fp))
        return pd.DataFrame(out, columns=["a", "b"])

    sets = with_sets(materialize(routes, "dup-routes"), docs, text, "a binary, grp long, fp binary, shingles binary", send)
    return materialize(sets.groupBy("a", "grp").applyInPandas(link, "a binary, b binary"), "dup-links")


def components(links: DataFrame) -> DataFrame:
    """(fp, comp) of all classes with a link: every class hooks to its smallest neighbour, and hooked classes contract.

    Labels are hashes, so the graph shrinks by a constant factor a round.
    """
    mapping = None
    while True:
        both = links.select("a", "b").union(links.select("b", "a"))
        hooks = both.groupBy(F.col("a").alias("fp")).agg(F.min("b").alias("low")).select("fp", F.least("fp", "low").alias("comp"))
        hooks = materialize(hooks, "dup-hooks")
        if mapping is None:
            mapping = hooks
        else:
            step = hooks.select(F.col("fp").alias("comp"), F.col("comp").alias("to"))
            mapping = mapping.join(step, "comp", "left").select("fp", F.coalesce("to", "comp").alias("comp"))
            mapping = materialize(mapping, "dup-components")
        ha = hooks.select(F.col("fp").alias("a"), F.col("comp").alias("ca"))
        hb = hooks.select(F.col("fp").alias("b"), F.col("comp").alias("cb"))
        links = links.join(ha, "a").join(hb, "b").filter("ca <> cb")
        links = links.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct()
        links = materialize(links, "dup-contracted")
        if links.isEmpty():
            return mapping


def hub_pairs(posted: DataFrame) -> DataFrame:
    """Each list's most central class with each other member."""
    hubs = posted.groupBy("tok").agg(F.max(F.struct("weight", "fp")).alias("hub"), F.count(F.lit(1)).alias("f")).filter("f > 1")
    pairs = posted.withColumnRenamed("fp", "b").join(hubs.select("tok", F.col("hub.fp").alias("a")), "tok")
    return pairs.filter("a <> b").select("a", "b").distinct()


def open_postings(posted: DataFrame, comps: DataFrame) -> DataFrame:
    """(tok, fp, comp) of the lists with members of several components."""
    own = posted.join(comps, "fp", "left").select("tok", "fp", F.coalesce("comp", "fp").alias("comp"))
    lists = own.groupBy("tok").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("tok")
    return own.join(lists, "tok")


def open_sets(classes: DataFrame, docs: DataFrame, text: str, percent: int) -> DataFrame:
    """(fp, n, u, cut) of the classes that can have a link to another of them.

    ``u``: how many of its ``n`` shingles no other of them has; ``cut``: the shingles' last 32 bits.
    """

    def rows(row, shingles: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"fp": [row.fp], "n": [row.n], "shingles": [shingles.view(np.int64)]})

    sets = materialize(with_sets(classes, docs, text, "fp binary, n long, shingles array<long>", rows).dropDuplicates(["fp"]), "dup-sets")
    owner = F.xxhash64("fp").alias("owner")
    once = sets.select(owner, F.explode("shingles").alias("sh")).groupBy("sh").agg(F.count(F.lit(1)).alias("f"), F.min("owner").alias("owner")).filter("f = 1")
    u = once.groupBy("owner").agg(F.count(F.lit(1)).alias("u"))
    cut = F.transform("shingles", lambda x: x.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")).alias("cut")
    able = sets.withColumn("owner", owner).join(u, "owner", "left").withColumn("u", F.coalesce("u", F.lit(0)))
    return able.filter(100 * (F.col("n") - F.col("u")) >= percent * F.col("n")).select("fp", "n", "u", cut)


def _meet(percent: int):
    """Compare the members of one list's two blocks; gives the pairs that seem linked."""

    def incidence(lists: list[np.ndarray], vocabulary: dict[int, int]) -> np.ndarray:
        out = np.zeros((len(lists), len(vocabulary)), dtype=np.float32)
        for k, tokens in enumerate(lists):
            out[k, [vocabulary[t] for t in tokens]] = 1
        return out

    def words(tokens) -> dict[int, int]:
        return {t: k for k, t in enumerate(sorted({x for y in tokens for x in y}))}

    def meet(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        tok, lo, hi = (int(x) for x in key)
        first, second = rows[rows["blk"] == lo], rows[rows["blk"] == hi]
        n, u, comp = (lambda d: d["n"].to_numpy(float)), (lambda d: d["u"].to_numpy(float)), (lambda d: d["comp"].map(bytes).to_numpy(object))
        na, nb, ua, ub = n(first)[:, None], n(second)[None], u(first)[:, None], u(second)[None]
        open_ = comp(first)[:, None] != comp(second)[None]
        open_ &= 100 * np.minimum(na - ua, nb - ub) >= percent * np.maximum(na + ub, nb + ua)
        if lo == hi:
            open_ &= np.tri(len(first), len(second), -1, dtype=bool)
        if open_.any():
            shared = words(rows["shared"])
            open_ &= incidence(list(first["shared"]), shared) @ incidence(list(second["shared"]), shared).T >= T
        if open_.any():  # the pair's first common list takes it up
            earlier = [[[t for t in tokens if t < tok] for tokens in d["posted"]] for d in (first, second)]
            seen = words(earlier[0] + earlier[1])
            open_ &= incidence(earlier[0], seen) @ incidence(earlier[1], seen).T == 0
        a, b = np.nonzero(open_)
        cuts = {}
        out = []
        for i, j in zip(a.tolist(), b.tolist(), strict=True):
            sides = []
            for d, k, side in ((first, i, 0), (second, j, 1)):
                if (side, k) not in cuts:
                    cuts[side, k] = np.unique(d["cut"].iat[k])
                sides.append(cuts[side, k])
            x, y = float(na[i, 0]), float(nb[0, j])
            common = len(np.intersect1d(*sides, assume_unique=True)) + x - len(sides[0]) + y - len(sides[1])
            if 100 * common >= percent * (x + y - common):
                out.append(tuple(sorted((bytes(first["fp"].iat[i]), bytes(second["fp"].iat[j])))))
        return pd.DataFrame(out, columns=["a", "b"])

    return meet


def open_pairs(lists: DataFrame, able: DataFrame, shared: DataFrame, percent: int) -> DataFrame:
    """Pairs of one list in different components that seem linked, from ``lists`` (tok, fp, comp)."""
    sizes = lists.groupBy("tok").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    posted = lists.groupBy("fp").agg(F.collect_list("tok").alias("posted"))  # at most K
    about = able.join(shared.select("fp", "shared"), "fp").join(posted, "fp")
    dealt = lists.join(sizes, "tok").withColumn("blk", F.pmod(F.xxhash64("fp"), "blocks"))
    sent = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - F.lit(1).cast("long"))))
    sent = sent.select("tok", "fp", "comp", "blk", F.least("blk", "other").alias("lo"), F.greatest("blk", "other").alias("hi")).join(about, "fp")
    return sent.groupBy("tok", "lo", "hi").applyInPandas(_meet(percent), "a binary, b binary").distinct()


def linked(docs: DataFrame, text: str, doc_id: str, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows (row_key, doc_id, n, fp) and their classes (fp, lead), of stored ``docs`` with row keys.

    ``lead``: the component's first row (no_id, doc_id, row_key), by doc_id with nulls last, then by key.
    """
    signed = materialize(signatures(docs, text, doc_id), "dup-signatures")
    usable = signed.filter("sig is not null")
    lead = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")).alias("lead")
    classes = usable.groupBy("fp").agg(lead, F.first("n").alias("n"), F.first("sig").alias("sig"))
    classes = materialize(classes, "dup-classes")

    shared, posted = postings(classes)
    first = materialize(colliding(hub_pairs(posted), shared, percent), "dup-pairs")
    links = confirmed(first, classes, docs, text, percent)
    comps = components(links)

    left = open_postings(posted, comps).select("fp").distinct().join(classes, "fp").select("fp", "n", F.col("lead.row_key").alias("route_id"))
    left = materialize(left, "dup-open")
    if not left.isEmpty():
        able = materialize(open_sets(left, docs, text, percent), "dup-able")
        lists = materialize(open_postings(posted.join(able.select("fp"), "fp"), comps), "dup-lists")
        rest = materialize(open_pairs(lists, able, shared, percent), "dup-rest")
        if not rest.isEmpty():
            comps = components(links.union(confirmed(rest, classes, docs, text, percent)))

    ids = classes.select("fp", "lead").join(comps, "fp")
    lowest = ids.groupBy("comp").agg(F.min("lead").alias("lowest"))
    of_class = classes.select("fp", "lead").join(ids.select("fp", "comp").join(lowest, "comp"), "fp", "left")
    return signed.select("row_key", "doc_id", "n", "fp"), of_class.select("fp", F.coalesce("lowest", "lead").alias("lead"))


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``; ``kept``: the row has its component's id."""
    stored = with_row_keys(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    signed, of_class = linked(stored, "text", "doc_id", percent)
    known = F.when(F.col("n") > 0, F.col("fp"))  # rows without shingles meet no class
    out = signed.select("doc_id", "n", known.alias("fp")).join(of_class.select("fp", F.col("lead.doc_id").alias("class_id")), "fp", "left")
    component = F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = 75) -> DataFrame:
    """``docs`` with one row of each component: of the rows with the smallest id the first; rows without shingles stay."""
    stored = with_row_keys(docs)
    signed, of_class = linked(stored, text, doc_id, percent)
    leads = of_class.select(F.col("lead.row_key").alias("row_key")).distinct()
    out = signed.filter("n > 0").join(leads, "row_key", "left_anti").select(F.col("row_key").alias("dropped_key"))
    out = materialize(out, "dup-dropped")
    small = out.count() <= MAX_BROADCAST_IDS
    return stored.join(F.broadcast(out) if small else out, F.col(ROW) == F.col("dropped_key"), "left_anti").drop(ROW)
