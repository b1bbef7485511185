"""Sketches and the next document against a plain loop."""

import hashlib
import re

from brook.llm import fingerprint

SCHEMA = "doc_id long, text string, block string, sketch int"


def sketch(text, fraction=fingerprint.FRACTION):
    ws = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    runs = [" ".join(ws[i : i + 5]) for i in range(len(ws) - 4)] if len(ws) >= 5 else [" ".join(ws)] if ws else []
    hashes = {hashlib.md5(r.encode()).hexdigest()[:8] for r in runs}
    return sorted(h for h in hashes if int(h, 16) < fraction * 2**32) or sorted(hashes)[:1]


def likeness(a, b):
    if a == b:
        return 1.0
    return len(set(a) & set(b)) / min(len(a), len(b)) if a and b else 0.0


def brute_force(docs):
    """For unique doc_ids."""
    docs = sorted(((d, t or "") for d, t in docs), key=lambda x: (x[0] is not None, x[0]))
    out = []
    for i, (d, t) in enumerate(docs):
        nxt = docs[(i + 1) % len(docs)][1]
        k = len(t) // 4
        edited = t[: len(t) - k] + nxt[:k]
        a, b, c = sketch(t), sketch(edited), sketch(nxt)
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), "".join(a), "".join(b), likeness(a, b), likeness(a, c)))
    return out


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is not None, r[0]))


def _texts(n):
    words = "alpha beta gamma delta épsilon zeta eta theta iota kappa \U0001f600 mu".split()
    return [(7 * i % 101, " ".join(words[(i * 5 + j * j * (i + 3)) % 12] for j in range(i % 90)) or None) for i in range(n)]


def test_equals_a_plain_loop_over_many_blocks(spark):
    data = [*_texts(100), (None, "the first of all is null"), (1000, ""), (1001, " \n\t "), (1002, "x"), (-5, "w " * 30_000)]
    docs = spark.createDataFrame([(d, t, "clash", 1) for d, t in data], SCHEMA).repartition(5)
    for block_rows in (7, 10_000):
        assert _rows(fingerprint.fingerprints(docs, block_rows=block_rows)) == brute_force(data)


def test_a_hot_id_is_split_into_blocks(spark):
    data = [(7, f"same id with another text number {i} of many") for i in range(90)] + [(3, "before"), (9, "after all the others")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    placed = fingerprint.with_next(docs, "text", "doc_id", block_rows=10).filter("not guest")
    sizes = [r["count"] for r in placed.groupBy("block").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 40
    rows = fingerprint.fingerprints(docs, block_rows=10).collect()
    assert len(rows) == len(data) and sum(r["doc_id"] == 7 for r in rows) == 90
    # every row but those before another id is followed by a row of its id, so its edited text ends like one
    ends = {hashlib.sha256((t[: len(t) - len(t) // 4] + u[: len(t) // 4]).encode()).hexdigest() for _, t in data for _, u in data if t != u}
    assert all(r["edited_sha256"] in ends for r in rows)


def test_repeated_rows_and_null_ids(spark):
    data = [(None, "one two three four five six")] * 3 + [(4, "one two three four five six")] * 2
    rows = fingerprint.fingerprints(spark.createDataFrame(data, "doc_id long, text string"), block_rows=1).collect()
    assert len(rows) == 5 and len({r["fingerprint"] for r in rows}) == 1 and {r["near_next"] for r in rows} == {1.0}


def test_single_document_and_empty_table(spark):
    one = fingerprint.fingerprints(spark.createDataFrame([(1, "a b c d e f g h")], "doc_id long, text string")).first()
    assert one["near_next"] == 1.0 and one["n_chars"] == 15
    assert fingerprint.fingerprints(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_containment_of_unequal_documents_and_union(spark):
    import random

    rng = random.Random(5)
    long = [f"w{rng.randrange(9000)}" for _ in range(6000)]
    part, other = long[1000:1600], [f"v{rng.randrange(9000)}" for _ in range(600)]
    docs = spark.createDataFrame([(1, " ".join(long)), (2, " ".join(part)), (3, " ".join(other))], "doc_id long, text string")
    got = {r["doc_id"]: set(r["sketch"]) for r in fingerprint.with_sketch(docs, "text", "sketch").collect()}
    assert got[2] <= got[1] and not got[3] & got[1]
    both = fingerprint.with_sketch(spark.createDataFrame([(1, " ".join(long + other))], "doc_id long, text string"), "text", "s").first()["s"]
    # a union has the hashes of its parts, but for those across the seam
    assert got[1] | got[3] <= set(both) and len(set(both) - got[1] - got[3]) <= 4


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    plan = fingerprint.fingerprints(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
