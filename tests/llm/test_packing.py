import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from brook.llm import packing

DOCS = "doc_id long, text string, source string, length long, offset string"


def reference_ids(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [*tok.encode(text, add_special_tokens=False).ids, 2]


def sample(spark):
    texts = [None, "", "one two three", "word " * 3000, "émoji 😀 \n\n tabs\t  x", "<|endoftext|> as text", "a" * 5000, "one two three"]
    rows = [(k, t, "s", 1, "x") for k, t in enumerate(texts)] + [(2, "one two three", "s", 1, "x"), (None, "no id", None, None, None)]
    return rows, spark.createDataFrame(rows, DOCS)


def test_pieces_and_layout(spark):
    rows, docs = sample(spark)
    got = packing.pack_documents(docs, size=64).toPandas()
    want = []
    for doc, text, *_ in rows:
        ids = np.array(reference_ids(text or ""), dtype="<u4")
        first = len(ids) % 64 or 64
        cuts = [0, *range(first, len(ids) + 1, 64)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want.append((-1 if doc is None else doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    have = got.assign(doc_id=got["doc_id"].fillna(-1).astype(int))[["doc_id", "piece", "start", "length", "ids_crc32"]]
    assert sorted(map(tuple, have.to_numpy().tolist())) == sorted(want)
    for _, seq in got.groupby("sequence_id"):
        seq = seq.sort_values("offset")
        assert seq["offset"].tolist() == [0, *seq["length"].cumsum().tolist()[:-1]]
        assert seq["length"].sum() <= 64


def test_empty_table(spark):
    got = packing.pack_documents(spark.createDataFrame([], DOCS))
    assert got.count() == 0 and got.columns[:5] == ["doc_id", "piece", "start", "length", "ids_crc32"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=300))
def test_bins_hold_and_are_few(lengths):
    x = np.sort(np.array(lengths, dtype=np.int64))[::-1]
    bins, offsets = packing.sum_of_squares(x, 40)
    spans = sorted(zip(bins, offsets, x, strict=True))
    for a, b in zip(spans, spans[1:], strict=False):
        assert b[1] == (a[1] + a[2] if a[0] == b[0] else 0)
    if len(x):
        assert np.bincount(bins, x).max() <= 40
        assert bins.max() + 1 <= 1.25 * -(-x.sum() // 40) + (x > 20).sum() / 2 + 2


def test_picks_the_smallest_sum_of_squares():
    # gaps 4 (two bins) and 3 (one bin): a piece of 1 leaves N(4)=1, N(3)=2 or N(4)=2, N(2)=1; both sums are 5, tightest wins
    bins, _ = packing.sum_of_squares(np.array([7, 6, 6, 1]), 10)
    assert bins[3] == bins[0]


@pytest.mark.parametrize("limit", [1, 7, 50])
def test_long_texts_encode_alike_in_parts(limit):
    text = "It's  a  test, don't 12 345 \n\n split ; here… " * 9
    parts = list(packing.text_parts(text, limit))
    assert "".join(parts) == text and len(parts) > 1
    enc = packing.encoder(packing.rank_file())
    assert [i for p in parts for i in enc.encode_ordinary(p)] == enc.encode_ordinary(text)


def test_added_tokens_as_in_the_unmodified_file():
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    mark = "<|endoftext|>"
    texts = [f"a {mark} b", mark, f"{mark}{mark}\n\n{mark} x", f"one  {mark}  two<|endoftext |>", f"é{mark}é", "none <|end", "", f"it's {mark}'s " * 50]
    for text in texts:
        assert packing.token_ids(text, packing.rank_file(), 2).tolist() == [*tok.encode(text, add_special_tokens=False).ids, 2]
    assert 50256 in packing.token_ids(texts[0], packing.rank_file(), 2)


def test_white_space_of_any_length():
    """Ids of the unmodified tokenizers file, where the pattern's own matching runs out of stack."""
    texts = ["a" + " " * 3_000_000 + "b", "\n" * 2_000_000, "x \t" + "\r\n\u3000" * 40_000 + " end", " " * 20_000, "q" + " " * 20_000 + "\x1c" + " " * 20_000]
    for text in texts:
        assert packing.token_ids(text, packing.rank_file(), 2).tolist() == reference_ids(text)


def test_equal_rows_spread_over_all_groups(spark):
    docs = spark.createDataFrame([(1, "the same words")] * 10_000, "doc_id long, text string").repartition(4)
    pieces = packing.materialize(packing.token_pieces(docs, "text", "doc_id", 64, packing.rank_file(), 2), "pieces")
    got = packing.pack_pieces(pieces, 64, group_rows=1000).toPandas()
    sizes = got.groupby(got["sequence_id"] // 2**36).size()
    assert len(got) == 10_000 and len(sizes) == 10 and sizes.max() < 1300
