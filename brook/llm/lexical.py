"""Ranked lexical search over bit-sliced Bloom signatures.

*Index* (``build_index``).  Documents come in blocks of similar length.  A document's signature is a Bloom
filter of its (term, level) keys, a key for every level up to the term's count (1, 2, 3, 4, 6, 8, 12, ...).
A block is stored bit-sliced: one bitmap over the block's documents per signature position.  Beside it
stand the documents' lengths and exact terms.

*Search* (``search``).  For every block and term the AND of the key's slices is a bitmap that holds each
document with the term, and some others: presence is only overestimated.  The highest level present
bounds a term's count from above, and so its part of the score; the weighted sum of the bitmaps over an
item's terms is an upper bound of the document's score.  A document is left out only where
its bound is below the score of the ``k``-th best document known; all others are rescored from their
exact terms.  A first round over one block in ``SEED_LOTS`` finds scores to start from (real documents'
scores, so any of them are valid); the second covers all blocks, and a task sends on at most
``k`` documents an item.

Items are a stated query set, taken in blocks of ``items_per_block`` against all documents.
Counts over the corpus (documents, terms, document frequencies) are exact, from the index.

Defined cases: null or termless texts are in no index and count nowhere; items that are null or have no
terms have no rows; repeated items and repeated documents are ranked each on its own; null doc_ids rank
after others of their score; very long documents make blocks of fewer documents; an empty table gives
no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from brook.llm.slices import batches_of
from brook.operators.running import global_index
from brook.session import materialize

#: Letters A-Z to lower case, digits, letters and all bytes of non-ASCII characters as they are, the rest to blanks.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: Signature positions of a key, and signature length per key of a block's largest document.
HASHES, BITS_PER_KEY = 4, 16
#: Bounds of a block: documents, and signature positions times documents.
BLOCK_DOCS, BLOCK_BITS = 128, 1 << 23
#: Documents (and their distinct terms) a task sorts by length at a time.
POOL_DOCS, POOL_TERMS = 1024, 500_000
SEED_LOTS = 16
#: Blocks (and texts) come to a worker in batches of this size.
BATCH = "8m"
#: Sorts after every doc_id.
_LAST = np.iinfo(np.int64).max

#: A block: its bounds, signature, and flat arrays over its documents and their terms (terms as bytes, a line per document).
INDEX = (
    "lot int, m int, top int, n_docs long, n_terms long, slices binary, doc_ids binary, n binary, distinct binary, terms binary, tfs binary"
)


def terms_of(text: str | None) -> list[bytes]:
    """All terms of a text, in order."""
    return text.encode().translate(_FOLD).split() if text else []


def levels(top: int) -> list[int]:
    """1, 2, 3, 4, 6, 8, 12, 16, ... up to ``top``."""
    return [x for p in range(top.bit_length() + 1) for x in ((1 << p,) if p < 1 else (1 << p, 3 << (p - 1))) if x <= top]


@functools.lru_cache(maxsize=1 << 18)
def term_hash(term: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(term)


def positions(hashes: np.ndarray, level: int, j: int, m: int) -> np.ndarray:
    """The ``j``-th signature position of each (term, level) key in a signature of ``m``."""
    x = hashes + np.uint64((level * 0x9E3779B97F4A7C15 + j * 0xD1B54A32D192ED03) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return (((x >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)).astype(np.int64)


def _block_row(docs: list[tuple]) -> dict:
    """One index row of documents ``(n_keys, doc_id, n, terms, tfs, hashes)``."""
    width = -(-len(docs) // 8)
    m = BITS_PER_KEY * max(d[0] for d in docs)
    top = int(max(d[4].max() for d in docs))
    hashes, tfs = np.concatenate([d[5] for d in docs]), np.concatenate([d[4] for d in docs])
    column = np.repeat(np.arange(len(docs)), [len(d[4]) for d in docs])
    bits = np.zeros((m, width * 8), dtype=bool)
    for level in levels(top):
        has = tfs >= level
        hashes, tfs, column = hashes[has], tfs[has], column[has]
        for j in range(HASHES):
            bits[positions(hashes, level, j, m), column] = True
    slices = np.packbits(bits, axis=1).tobytes()
    return {
        "lot": zlib.crc32(slices) % SEED_LOTS, "m": m, "top": top, "n_docs": len(docs), "n_terms": sum(d[2] for d in docs), "slices": slices,
        "doc_ids": _flat([_LAST if d[1] is None else d[1] for d in docs], "<i8"), "n": _flat([d[2] for d in docs], "<i8"),
        "distinct": _flat([len(d[3]) for d in docs], "<i8"), "terms": b"\n".join(b" ".join(d[3]) for d in docs),
        "tfs": _flat(np.concatenate([d[4] for d in docs]), "<u4"),
    }


def _flat(values: list | np.ndarray, kind: str) -> bytes:
    return np.asarray(values, dtype=kind).tobytes()


def _blocks(pool: list[tuple]) -> Iterator[dict]:
    """Blocks of documents with a similar number of keys."""
    pool.sort(key=lambda d: d[0])
    while pool:
        # from the longest down, so that the first one sets the signature's length
        fit = max(8, BLOCK_BITS // (BITS_PER_KEY * pool[-1][0]) // 8 * 8)
        size = min(BLOCK_DOCS, fit)
        yield _block_row(pool[-size:])
        del pool[-size:]


def build_index(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The stored index of all documents that have a term: one row per block (columns ``INDEX``)."""
    target = to_arrow_schema(StructType.fromDDL(INDEX))

    def rows(pool: list[tuple]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(pool):
            yield pa.RecordBatch.from_pylist([block], schema=target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool: list[tuple] = []
        held = 0
        for batch in batches:
            for doc, body in zip(batch.column(0), batch.column(1), strict=True):
                counts = Counter(terms_of(body.as_py()))
                if not counts:
                    continue
                tfs = np.fromiter(counts.values(), dtype=np.int64, count=len(counts))
                hashes = np.fromiter(map(term_hash, counts), dtype=np.uint64, count=len(counts))
                n_keys = sum(int((tfs >= level).sum()) for level in levels(int(tfs.max())))
                pool.append((n_keys, doc.as_py(), int(tfs.sum()), list(counts), tfs, hashes))
                held += len(counts)
                if len(pool) >= POOL_DOCS or held >= POOL_TERMS:
                    yield from rows(pool)
                    held = 0
        yield from rows(pool)

    with batches_of(docs.sparkSession, BATCH):
        return materialize(docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(run, INDEX), "lexical-index")


class Items:
    """A block of items: their distinct terms, and each item's terms as places in that list."""

    def __init__(self, rows: list[tuple]) -> None:
        found = [(no, sorted(set(terms_of(text)))) for no, text in rows]
        found = [(no, ts) for no, ts in found if ts]
        self.numbers = [no for no, _ in found]
        self.vocabulary = {t: i for i, t in enumerate(sorted({t for _, ts in found for t in ts}))}
        self.hashes = np.array([term_hash(t) for t in self.vocabulary], dtype=np.uint64)
        self.places = np.array([self.vocabulary[t] for _, ts in found for t in ts], dtype=np.int64)
        self.starts = np.cumsum([0, *[len(ts) for _, ts in found[:-1]]]) if found else np.zeros(0, dtype=np.int64)

    def sums(self, parts: np.ndarray) -> np.ndarray:
        """(terms, documents) -> (items, documents)."""
        return np.add.reduceat(parts[self.places], self.starts, axis=0)


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], dtype=np.int64)


def lengths_norm(n: bytes, n_docs: int, n_terms: int) -> np.ndarray:
    return np.array([50 + (50 * x * n_docs) // n_terms for x in np.frombuffer(n, dtype="<i8").tolist()], dtype=np.int64)


def term_parts(tf: np.ndarray, weight: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 20 * norm))


def upper_bounds(items: Items, weight: np.ndarray, norm: np.ndarray, m: int, top: int, slices: bytes) -> np.ndarray:
    """(items, documents): no document's score is above."""
    grid = np.frombuffer(slices, dtype=np.uint8).reshape(m, -1)
    n_docs = len(norm)
    most = np.zeros((len(items.hashes), n_docs), dtype=np.int64)
    active = np.arange(len(items.hashes))
    steps = [*levels(top), top + 1]
    present = None
    below = 0
    for level, after in zip(steps, steps[1:], strict=False):
        bits = grid[positions(items.hashes[active], level, 0, m)]
        for j in range(1, HASHES):
            bits = bits & grid[positions(items.hashes[active], level, j, m)]
        if present is not None:
            bits &= present
        some = bits.any(axis=1)
        active, present = active[some], bits[some]
        if not len(active):
            break
        # counts from this level on are at most one less than the next
        most[active] += np.unpackbits(present, axis=1, count=n_docs) * np.int64(after - 1 - below)
        below = after - 1
    t, d = np.nonzero(most)
    parts = np.zeros_like(most)
    parts[t, d] = term_parts(most[t, d], weight[t], norm[d])
    return items.sums(parts)


def exact_scores(items: Items, weight: np.ndarray, norm: np.ndarray, docs: np.ndarray, distinct: bytes, terms: bytes, tfs: bytes) -> np.ndarray:
    """(items, ``docs`` of a block) from the documents' own terms."""
    parts = np.zeros((len(items.hashes), len(docs)), dtype=np.int64)
    ends = np.cumsum(np.frombuffer(distinct, dtype="<i8"))
    counts, lines = np.frombuffer(tfs, dtype="<u4"), terms.split(b"\n")
    for column, d in enumerate(docs.tolist()):
        places = list(map(items.vocabulary.get, lines[d].split(b" ")))
        hit = [i for i, p in enumerate(places) if p is not None]
        at = np.array([places[i] for i in hit], dtype=np.int64)
        tf = counts[ends[d] - len(places) + np.array(hit, dtype=np.int64)].astype(np.int64)
        parts[at, column] = term_parts(tf, weight[at], norm[d])
    return items.sums(parts)


def document_frequencies(index: DataFrame, items: Items) -> np.ndarray:
    """Exact document frequency of each of the items' terms: one vector per task, summed."""
    vocabulary = items.vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(vocabulary), dtype=np.int64)
        for batch in batches:
            for block in batch.column(0):
                for line in block.as_py().split(b"\n"):
                    for t in vocabulary.keys() & line.split(b" "):
                        df[vocabulary[t]] += 1
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(df[seen])], names=["term", "df"])

    out = np.zeros(len(vocabulary), dtype=np.int64)
    for r in index.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r["term"]] = r["df"]  # at most a row per term of the items
    return out


def _best(index: DataFrame, items: Items, weight: np.ndarray, n_docs: int, n_terms: int, k: int, floor: np.ndarray) -> DataFrame:
    """(item, doc_id, score): per task the best ``k`` of each item, leaving out documents bounded below ``floor``."""

    used = ("m", "top", "slices", "doc_ids", "n", "distinct", "terms", "tfs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = np.maximum(floor, 1)  # scores above 0 only
        ids = [np.zeros(0, dtype=np.int64) for _ in items.numbers]
        scores = [np.zeros(0, dtype=np.int64) for _ in items.numbers]
        for batch in batches:
            for at in range(batch.num_rows):
                block = {c: batch.column(c)[at].as_py() for c in used}
                norm = lengths_norm(block["n"], n_docs, n_terms)
                candidate = upper_bounds(items, weight, norm, block["m"], block["top"], block["slices"]) >= least[:, None]
                docs = np.flatnonzero(candidate.any(axis=0))
                if not len(docs):
                    continue
                exact = exact_scores(items, weight, norm, docs, block["distinct"], block["terms"], block["tfs"])
                doc_ids = np.frombuffer(block["doc_ids"], dtype="<i8")[docs]
                good = candidate[:, docs] & (exact >= least[:, None])
                for i in np.flatnonzero(good.any(axis=1)):
                    score, doc = np.concatenate([scores[i], exact[i][good[i]]]), np.concatenate([ids[i], doc_ids[good[i]]])
                    first = np.lexsort((doc, -score))[:k]
                    scores[i], ids[i] = score[first], doc[first]
                    if len(first) == k:
                        least[i] = max(least[i], score[first[-1]])
        item = np.repeat(np.array(items.numbers, dtype=np.int64), [len(x) for x in ids])
        doc = np.concatenate([np.zeros(0, dtype=np.int64), *ids])
        columns = [pa.array(item), pa.array(doc, mask=doc == _LAST), pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *scores]))]
        yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

    found = index.select(*used).mapInArrow(run, "item long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(
    index: DataFrame, items: DataFrame, item_id: str = "item_id", text: str = "text", k: int = 50, items_per_block: int = 500
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item, over all documents of the index."""
    spark = index.sparkSession
    result = spark.createDataFrame([], "item long, rank int, doc_id long, score long")
    keyed = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    keyed = materialize(global_index(keyed, ["item_id", "text"], out="item"), "items")
    n_docs, n_terms = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    for lo in range(0, keyed.count() if n_docs else 0, items_per_block):
        rows = keyed.filter((F.col("item") >= lo) & (F.col("item") < lo + items_per_block)).select("item", "text").collect()
        block = Items([tuple(r) for r in rows])
        if not block.numbers:
            continue
        with batches_of(spark, BATCH):
            weight = weights(document_frequencies(index, block), n_docs)
            floor = np.zeros(len(block.numbers), dtype=np.int64)
            seeds = _best(index.filter(F.col("lot") == 0), block, weight, n_docs, n_terms, k, floor)
            known = {r["item"]: r["score"] for r in seeds.filter(F.col("rank") == k).select("item", "score").collect()}
            floor = np.array([known.get(no, 0) for no in block.numbers], dtype=np.int64)
            best = _best(index, block, weight, n_docs, n_terms, k, floor)
            result = result.unionByName(materialize(best.select("item", F.col("rank").cast("int"), "doc_id", "score"), "ranked"))
    return result.join(keyed.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
