"""Cross-tokenizer alignment: two tokenizers' tokens of a text linked by their bytes, with corpus-wide pair counts.

Token A ends and token B ends that fall on the same byte cut a text into groups.  Most groups hold
one token of each kind with the same bytes, so an identity map, built once per worker, gives the B
id of the same bytes for every A id.  A group that the map explains is *regular*:

1. One map over the texts encodes both ways and stores per document its counts, the digest of its
   groups, the distinct A ids of its regular groups and the distinct id pairs of the others.
2. Regular groups are counted in vectors as long as the A vocabulary, one per task, and summed; only
   pairs of irregular groups enter a shuffle by pair, pre-aggregated in every task.
3. Both counts together give a pair's count and its B id's highest.  Regular groups look theirs up in
   two vectors (vocabulary-sized, so they go to every task); irregular pairs join the pair table,
   broadcast where its checked size allows, else by a shuffle whose hot pairs AQE splits.

A link is a pair of token occurrences whose byte ranges overlap.  Between two neighbouring token ends
of either kind lies exactly one link, so a text has as many links as it has distinct token ends.

Defined cases: null or empty text, and texts whose pieces don't join to a space and the text (the B
model changes some characters), have no tokens: zeros and an empty digest.  Null or repeated doc_ids
and repeated rows are documents of their own (rows get a stored key).  Very long texts are encoded in
parts for A (see ``packing``) and whole for B.  An empty table gives no rows.  Other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from brook.llm.packing import encode_plain, encoder, rank_file
from brook.operators.sizing import broadcast_if_bounded
from brook.session import materialize

COUNTS = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
ALIGNED = COUNTS + ", a_ids array<int>, a_n array<int>, pairs array<long>, pair_n array<int>"
RESULT = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
#: Texts are aligned together up to this many rows or characters.
SLICE_ROWS, SLICE_CHARS = 256, 2_000_000

_VOCABULARIES: dict[tuple[str, str], Vocabularies] = {}


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabularies:
    """Both encoders, their tokens' bytes and the identity map of A ids to B ids of the same bytes (-1: none)."""

    def __init__(self, ranks: str, model: str) -> None:
        import sentencepiece

        self.a = encoder(ranks)
        self.b = sentencepiece.SentencePieceProcessor(model_file=model)
        bytes_a = [self.a.decode_single_token_bytes(i) for i in range(self.a.n_vocab)]
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.len_a = np.array([len(x) for x in bytes_a], dtype=np.int64)
        self.len_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        first: dict[bytes, int] = {}
        for i, x in enumerate(self.bytes_b):
            # a piece comes before the byte token of the same byte
            if x and (x not in first or self.b.is_byte(first[x])):
                first[x] = i
        self.identity = np.array([first.get(x, -1) for x in bytes_a], dtype=np.int64)
        # the text of an id with the mark that follows it: inside a group, at its end
        self.text_a = np.array([f"{i}," for i in range(len(bytes_a))] + [f"{i}|" for i in range(len(bytes_a))], dtype=object)
        self.text_b = np.array([f"{i}," for i in range(len(self.bytes_b))] + [f"{i};" for i in range(len(self.bytes_b))], dtype=object)

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return b"" if self.b.is_control(i) or self.b.is_unknown(i) else piece.replace("▁", " ").encode()

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both tokenizers; none where the pieces don't give the text back."""
        none = np.zeros(0, dtype=np.int64)
        if not text:
            return none, none
        spaced = " " + text
        raw = spaced.encode()
        ids_b = self.b.encode(text)
        if b"".join(map(self.bytes_b.__getitem__, ids_b)) != raw:
            return none, none
        ids_a = encode_plain(self.a, spaced).astype(np.int64)
        return (ids_a, np.array(ids_b, dtype=np.int64)) if self.len_a[ids_a].sum() == len(raw) else (none, none)


def vocabularies(ranks: str, model: str) -> Vocabularies:
    """Loaded once per worker."""
    if (ranks, model) not in _VOCABULARIES:
        _VOCABULARIES[ranks, model] = Vocabularies(ranks, model)
    return _VOCABULARIES[ranks, model]


def _distinct(doc: np.ndarray, value: np.ndarray, base: int, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per document its distinct values and how often each occurs, as one run: values, counts, run ends."""
    key, n = np.unique(doc * base + value, return_counts=True)
    return key % base, n.astype(np.int32), np.searchsorted(key // base, np.arange(n_docs), side="right")


def align_texts(texts: list[str | None], voc: Vocabularies) -> dict[str, list]:
    """Columns of ``ALIGNED`` but ``row`` and ``doc_id`` for a slice of texts, all texts at once."""
    ids = [voc.encode(t) for t in texts]
    k = len(texts)
    n_a, n_b = np.array([len(a) for a, _ in ids]), np.array([len(b) for _, b in ids])
    a, b = np.concatenate([x for x, _ in ids]), np.concatenate([x for _, x in ids])
    doc_a, doc_b = np.repeat(np.arange(k), n_a), np.repeat(np.arange(k), n_b)
    # byte offsets run on over the texts: a text has as many bytes in A as in B
    end_a, end_b = np.cumsum(voc.len_a[a]), np.cumsum(voc.len_b[b])
    cut_a, cut_b = np.isin(end_a, end_b, assume_unique=True), np.isin(end_b, end_a, assume_unique=True)
    group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
    ends = np.union1d(end_a, end_b)
    at_a, at_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
    link_a, link_b, link_doc, group = a[at_a], b[at_b], doc_a[at_a], group_a[at_a]
    single = (np.bincount(group_a) == 1) & (np.bincount(group_b) == 1)
    regular = single[group] & (voc.identity[link_a] == link_b)
    base = len(voc.bytes_b)
    ids_r, n_r, to_r = _distinct(link_doc[regular], link_a[regular], len(voc.len_a), k)
    odd = ~regular
    ids_p, n_p, to_p = _distinct(link_doc[odd], link_a[odd] * base + link_b[odd], len(voc.len_a) * base, k)
    # a group's A ids, then its B ids
    written = np.empty(len(a) + len(b), dtype=object)
    size_a, size_b = np.bincount(group_a, minlength=len(single)), np.bincount(group_b, minlength=len(single))
    before_b, until_a = np.cumsum(size_b) - size_b, np.cumsum(size_a)
    written[np.arange(len(a)) + before_b[group_a]] = voc.text_a[a + cut_a * len(voc.len_a)]
    written[np.arange(len(b)) + until_a[group_b]] = voc.text_b[b + cut_b * base]
    to_text = np.cumsum(n_a + n_b)
    digests = [
        hashlib.sha256("".join(written[end - n : end])[:-1].encode()).hexdigest() if n else ""
        for end, n in zip(to_text.tolist(), (n_a + n_b).tolist(), strict=True)
    ]
    count = lambda doc: np.bincount(doc, minlength=k)
    parts = lambda values, to: np.split(values, to[:-1]) if k else []
    return {
        "n_a": n_a, "n_b": n_b, "n_groups": count(doc_a[cut_a]), "n_links": count(link_doc), "groups_sha256": digests,
        "a_ids": parts(ids_r.astype(np.int32), to_r), "a_n": parts(n_r, to_r), "pairs": parts(ids_p, to_p), "pair_n": parts(n_p, to_p),
    }


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows up to the bounds of a slice."""
    chars = [len(t) if t else 0 for t in batch.column("text").to_pylist()]
    start = held = 0
    for i, n in enumerate(chars):
        if i > start and (i - start >= SLICE_ROWS or held + n > SLICE_CHARS):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(chars):
        yield batch.slice(start)


def align_documents(docs: DataFrame, text: str, doc_id: str, ranks: str, model: str) -> DataFrame:
    """One row of ``ALIGNED`` per document."""
    target = to_arrow_schema(StructType.fromDDL(ALIGNED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = vocabularies(ranks, model)
        for batch in batches:
            for part in _slices(batch):
                found = align_texts(part.column("text").to_pylist(), voc)
                made = {name: pa.array(values, type=target.field(name).type) for name, values in found.items()}
                kept = {"row": part.column("row"), "doc_id": part.column("doc_id")}
                yield pa.RecordBatch.from_arrays([(kept | made)[name] for name in target.names], schema=target)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, ALIGNED)


def _numpy(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False)


def regular_counts(aligned: DataFrame, size: int) -> DataFrame:
    """(a_id, n): occurrences of each A id in regular groups, summed from one vector per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = np.zeros(size, dtype=np.int64)
        for batch in batches:
            np.add.at(vector, _numpy(batch, "a_ids"), _numpy(batch, "a_n"))
        seen = np.flatnonzero(vector)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(vector[seen])], names=["a_id", "n"])

    return aligned.select("a_ids", "a_n").mapInArrow(run, "a_id long, n long").groupBy("a_id").agg(F.sum("n").alias("n"))


def align(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", ranks: str | None = None, model: str | None = None) -> DataFrame:
    """Per document (columns ``RESULT``): tokens, groups and links, the links whose pair is their B id's most
    frequent, the sum of the links' pair counts and the digest of the groups."""
    ranks, model = ranks or rank_file(), model or piece_model()
    voc = vocabularies(ranks, model)
    size_a, size_b = len(voc.len_a), len(voc.len_b)
    aligned = materialize(align_documents(docs, text, doc_id, ranks, model), "aligned")

    odd = aligned.select("row", F.explode(F.arrays_zip("pairs", "pair_n")).alias("p")).select("row", F.col("p.pairs").alias("pair"), F.col("p.pair_n").alias("times"))
    regular = materialize(regular_counts(aligned, size_a), "regular")  # at most a row per A id
    identity = aligned.sparkSession.createDataFrame([(i, int(j)) for i, j in enumerate(voc.identity.tolist()) if j >= 0], "a_id long, b_id long")
    as_pairs = regular.join(F.broadcast(identity), "a_id").select((F.col("a_id") * size_b + F.col("b_id")).alias("pair"), "n")
    counts = odd.groupBy("pair").agg(F.sum("times").alias("n")).unionByName(as_pairs).groupBy("pair").agg(F.sum("n").alias("n"))
    counts = materialize(counts.withColumn("b_id", F.col("pair") % size_b), "pairs")
    highest = counts.groupBy("b_id").agg(F.max("n").alias("top"))  # at most a row per B id
    scored = counts.join(F.broadcast(highest), "b_id").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    scored = materialize(scored, "scored-pairs")

    of_regular = as_pairs.select("pair").join(scored, "pair").select((F.col("pair") / size_b).cast("long").alias("a_id"), "n", "best").collect()
    total, best = np.zeros(size_a, dtype=np.int64), np.zeros(size_a, dtype=np.int64)
    for r in of_regular:
        total[r["a_id"]], best[r["a_id"]] = r["n"], r["best"]
    summed = _with_regular(aligned, total, best)
    sums = odd.join(broadcast_if_bounded(scored), "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("odd_best"), F.sum(F.col("times") * F.col("n")).alias("odd_sum")
    )
    plus = lambda x, y: (F.col(x) + F.coalesce(F.col(y), F.lit(0))).cast("long").alias(x)
    return summed.join(sums, "row", "left").select(
        *RESULT[:5], plus("n_best", "odd_best"), plus("count_sum", "odd_sum"), "groups_sha256"
    )


def _with_regular(aligned: DataFrame, total: np.ndarray, best: np.ndarray) -> DataFrame:
    """Per document its counts and the sums over its regular links."""
    schema = COUNTS + ", n_best long, count_sum long"
    kept = [f.name for f in StructType.fromDDL(COUNTS).fields]
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n = _numpy(batch, "a_ids"), _numpy(batch, "a_n").astype(np.int64)
            lengths = batch.column("a_ids").value_lengths().to_numpy(zero_copy_only=False)
            ends = np.cumsum(lengths)
            sums = []
            for weights in (best, total):
                run_sums = np.concatenate([[0], np.cumsum(n * weights[ids])])
                sums.append(pa.array(run_sums[ends] - run_sums[ends - lengths]))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *sums], schema=target)

    return aligned.select(*kept, "a_ids", "a_n").mapInArrow(run, schema)
