import random
import re

import numpy as np
import pytest

from brook.llm import neardup

DOCS = "doc_id long, text string, fp string, n int, tok string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, percent=75):
    """(n_shingles, component) per row by comparing all pairs of rows."""
    sets = []
    for doc, text, *_ in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            usable = a and b and rows[i][0] is not None and rows[j][0] is not None
            if usable and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    low = {}
    for i, (doc, *_) in enumerate(rows):
        if doc is not None:
            low[find(i)] = min(low.get(find(i), doc), doc)
    return [(doc, len(sets[i]), low[find(i)] if doc is not None else None) for i, (doc, *_) in enumerate(rows)]


def corpus(seed):
    """Chains, hubs and groups whose members pass the count without being links."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = [(None, "a b c d e f g", "x", 1, "y"), (900, None, "x", 1, "y"), (901, "", "x", 1, "y"), (902, " \t\n", "x", 1, "y"), (903, "Two Words", "x", 1, "y"), (904, "two words", "x", 1, "y")]
    ident = 0
    for _ in range(6):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([7, 40, 150]))]
        for _ in range(14):
            words = list(base)
            for _ in range(rng.randrange(0, 6)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((ident, " ".join(words), "x", 1, "y"))
            ident += rng.randrange(1, 3)
            base = words if rng.random() < 0.3 else base
    rows += rows[6:12]  # repeated rows
    rows.append((2000, "unicode É é  x " * 30, "x", 1, "y"))
    rows.append((2001, "unicode É é  x " * 3000, "x", 1, "y"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1])
def test_components_match_all_pairs(spark, seed):
    rows = corpus(seed)
    got = neardup.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    key = lambda t: tuple((v is not None, v) for v in t)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=key) == sorted(brute(rows), key=key)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_empty_and_pipeline_form(spark):
    empty = spark.createDataFrame([], DOCS)
    assert neardup.near_duplicates(empty).count() == 0
    docs = spark.createDataFrame([(5, "one two three four five six", "x", 1, "y"), (3, "ONE two three four five six", "x", 1, "y"), (9, None, "x", 1, "y")], DOCS)
    kept = neardup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [3, 9]


def test_one_row_of_each_component_stays(spark):
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(40)) for x in "abcd")
    near = " ".join([*b.split()[:-1], "other"])
    rows = [(1, a), (1, a), (1, a.upper()), (2, b), (3, near), (3, c), (None, c), (None, d), (None, d), (None, near), (4, None), (4, None), (None, "")]
    docs = spark.createDataFrame([(k, t, "x", 1, "y") for k, t in rows], DOCS)
    kept = sorted((r["doc_id"] or 0, (r["text"] or "").lower()) for r in neardup.drop_near_duplicates(docs).collect())
    assert kept == sorted([(1, a), (2, b), (3, c), (0, d), (4, ""), (4, ""), (0, "")])
    found = neardup.near_duplicates(docs).collect()
    got = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0) for r in found)
    assert got == sorted([(1, 36, 1)] * 3 + [(2, 36, 2), (3, 36, 2), (3, 36, 3), (0, 36, 3), (0, 36, 0), (0, 36, 0), (0, 36, 2), (4, 0, 4), (4, 0, 4), (0, 0, 0)])


def test_ids_match_sql(spark):
    import duckdb

    from brook.llm import oracle

    a, b = (" ".join(f"{x}{k}" for k in range(30)) for x in "ab")
    rows = [(5, a), (5, a), (5, b), (None, a), (None, b), (7, b), (None, "c d"), (None, "C d"), (8, None)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = sorted(map(str, con.execute(oracle.NEAR_DUPLICATES).fetchall()))
    got = neardup.near_duplicates(spark.createDataFrame([(k, t, "x", 1, "y") for k, t in rows], DOCS)).collect()
    assert sorted(str(tuple(r)) for r in got) == want


def test_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(bytes([k]), bytes([k + 1])) for k in range(60)], "a binary, b binary")
    comps = neardup.components(links).collect()
    assert len(comps) == 61 and {bytes(r["comp"]) for r in comps} == {bytes([0])}


def test_signature_agrees_as_often_as_sets_are_similar():
    rng = np.random.default_rng(3)
    same = []
    for _ in range(200):
        x = rng.integers(0, 2**63, 400).astype(np.uint64)
        a, b = np.unique(x[:350]), np.unique(x[50:])  # similarity 300 / 400
        same.append((neardup.signature(a) == neardup.signature(b)).mean())
    assert abs(np.mean(same) - 0.75) < 0.02
