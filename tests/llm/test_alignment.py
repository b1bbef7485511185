"""Token alignment against a plain loop over the files' own encoders."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from brook.llm import alignment


def _byte_level() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@pytest.fixture(scope="module")
def encoders():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return a, b


def brute_force(docs, encoders):
    a, b = encoders
    alphabet = _byte_level()
    bytes_a = {i: bytes(alphabet[c] for c in t) for t, i in a.get_vocab().items() if all(c in alphabet for c in t)}

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    per_doc, pairs = [], Counter()
    for doc_id, text in docs:
        xs, ys = [], []
        if text:
            xs, ys = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            raw = (" " + text).encode()
            if b"".join(bytes_a[x] for x in xs) != raw or b"".join(piece(y) for y in ys) != raw:
                xs, ys = [], []
        ra, rb, at = [], [], 0
        for x in xs:
            ra.append((at, at + len(bytes_a[x]), x))
            at = ra[-1][1]
        at = 0
        for y in ys:
            rb.append((at, at + len(piece(y)), y))
            at = rb[-1][1]
        links = [(x, y) for s, e, x in ra for t, f, y in rb if s < f and t < e]
        cuts = sorted({e for _, e, _ in ra} & {e for _, e, _ in rb})
        groups, lo = [], 0
        for cut in cuts:
            left = ",".join(str(x) for s, e, x in ra if lo < e <= cut)
            right = ",".join(str(y) for s, e, y in rb if lo < e <= cut)
            groups.append(f"{left}|{right}")
            lo = cut
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        per_doc.append((doc_id, len(xs), len(ys), len(groups), links, digest))
        pairs.update(links)
    top = Counter()
    for (_, y), n in pairs.items():
        top[y] = max(top[y], n)
    return sorted(
        ((d, na, nb, g, len(ls), sum(pairs[x] == top[x[1]] for x in ls), sum(pairs[x] for x in ls), h) for d, na, nb, g, ls, h in per_doc),
        key=str,
    )


CASES = [
    (1, "Licensed under the Apache License, Version 2.0"),
    (2, None),
    (3, ""),
    (4, "naïve café — 日本語 \U0001f600 ciónñas\n\n\tindent   x"),
    (5, "<|endoftext|> </s> <s> <0x41> are plain text"),
    (6, "a piece ▁ mark changes the bytes"),
    (7, " leading and trailing "),
    (7, "the the the the"),
    (7, "the the the the"),
    (None, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaab ababab"),
    (8, "\x00\x01 control \x7f\x85"),
    (9, "x" * 300 + " " * 200 + "y"),
]


def _rows(df):
    return sorted((tuple(r[c] for c in alignment.RESULT) for r in df.collect()), key=str)


def test_equals_a_plain_loop(spark, encoders):
    docs = spark.createDataFrame([(d, t, "clash", 0) for d, t in CASES], "doc_id long, text string, row string, pairs int").repartition(3)
    assert _rows(alignment.align(docs)) == brute_force(CASES, encoders)


def test_equals_a_plain_loop_on_the_fixture(spark, encoders):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(40)
    data = [(r["doc_id"], r["text"]) for r in docs.collect()]
    again = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    assert _rows(alignment.align(again)) == brute_force(data, encoders)


def test_empty_table(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_shuffled_pairs_equal_broadcast_pairs(spark, encoders, monkeypatch):
    monkeypatch.setattr(alignment, "broadcast_if_bounded", lambda df: df)
    docs = spark.createDataFrame(CASES, "doc_id long, text string")
    assert _rows(alignment.align(docs)) == brute_force(CASES, encoders)


def test_identity_map_and_very_long_white_space():
    voc = alignment.vocabularies(alignment.rank_file(), alignment.piece_model())
    for a in range(0, len(voc.len_a), 997):
        b = int(voc.identity[a])
        assert b < 0 or voc.bytes_b[b] == voc.a.decode_single_token_bytes(a)
    found = alignment.align_texts(["a" + " " * 1_500_000 + "b"], voc)
    assert found["n_a"][0] > 0 and found["n_links"][0] == found["n_a"][0] + found["n_b"][0] - found["n_groups"][0]
