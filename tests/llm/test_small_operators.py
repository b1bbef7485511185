"""Quality rules, licences, HTML and toxicity on small and odd inputs."""

import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brook.llm import htmltext, licenses, quality, secrets, toxicity

DOCS = "doc_id long, text string, quality string, license string, score string"


def frame(spark, texts):
    return spark.createDataFrame([(k, t, "q", "l", "s") for k, t in enumerate(texts)], DOCS)


def judged(spark, texts):
    rows = quality.judge_documents(frame(spark, texts).select("doc_id", "text")).orderBy("doc_id").collect()
    return [r["quality"] for r in rows]


PROSE = "\n".join(" ".join(f"w{i}x{k}" for k in range(12)) + "." for i in range(8))


def test_quality_counts_and_verdicts(spark):
    texts = [None, "", PROSE, PROSE + "\n" + "\n".join(f"a{i} | b{i} | c{i} | d{i}" for i in range(30)), "a b a b a b c", "x y z x y z " * 200_00, "l1 one\nl1 one\n\n l1 one"]
    got = judged(spark, texts)
    assert [q["n_words"] for q in got[:3]] == [0, 0, 96] and got[0]["base_failed"] and not got[0]["kept"]
    assert got[2]["kept"] and got[2]["clean_text"] == PROSE and got[2]["lost_chars"] == 0
    assert not got[3]["kept"] and not got[3]["base_failed"] and got[3]["clean_text"] == PROSE  # too much lost
    assert got[4]["n_repeat_words"] == 6  # a b a and b a b twice: all words but c
    assert got[5]["n_repeat_words"] == got[5]["n_words"] == 120_000
    assert got[6]["n_dup_lines"] == 1
    assert quality.judge_documents(frame(spark, []).drop("quality")).count() == 0


def test_lines_end_in_the_marks_of_their_script(spark):
    ends = [".", "।", "؟", "۔", "。", "։", "።", "។", "။", ""]
    texts = ["\n".join(" ".join(f"क{i}x{k}" for k in range(12)) + end for i in range(8)) for end in ends]
    got = judged(spark, texts)
    assert [q["kept"] for q in got] == [True] * 9 + [False]
    assert not got[9]["base_failed"] and got[9]["clean_text"] == "" and got[9]["lost_chars"] == got[9]["word_chars"]


def brute_repeats(words):
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 3)}
    return len(hit)


def test_repeated_words_match_brute_force(spark):
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(list("abcd"), rng.integers(0, 30))) for _ in range(150)]
    assert [q["n_repeat_words"] for q in judged(spark, texts)] == [brute_repeats(t.split()) for t in texts]


def test_licences(spark):
    texts = [None, "", "Licensed under the Apache License, Version 2.0.", "x CC BY-NC 4.0 Licensed under CC BY-NC 4.0!", "the Apache tribe and a license", "All rights\nreserved. é All Rights Reserved", "w " * 100_000 + "general public license"]
    texts += ["plain words"] * 200
    rows = licenses.scan_licenses(frame(spark, texts), out="found").select("doc_id", *licenses.digest("found")).orderBy("doc_id").collect()
    labels = [r["labels"] for r in rows]
    assert labels[:7] == ["", "", "apache-2.0", "cc-by,cc-by-nc", "", "reserved", "gpl"]
    assert rows[5]["n_base"] == 2 and rows[5]["first_word"] == 0 and rows[5]["last_word"] == 4 and rows[5]["n_words"] == 7
    assert rows[2]["score"] == 1.0 and rows[2]["first_word"] is None and rows[6]["first_word"] == 100_000
    assert licenses.scan_licenses(frame(spark, []), out="found").count() == 0


def labels_of(spark, texts):
    rows = licenses.scan_licenses(frame(spark, texts), out="found").select("doc_id", *licenses.digest("found")).orderBy("doc_id").collect()
    return [(r["labels"], r["score"]) for r in rows]


def test_licences_of_small_tables_and_common_headers(spark):
    whole = [(text, label) for label, text, _ in licenses.TEMPLATES]
    got = labels_of(spark, [text for text, _ in whole[:9]] + ["plain words"])
    assert all(label in labels.split(",") and score == 1.0 for (_, label), (labels, score) in zip(whole[:9], got, strict=False)) and got[9] == ("", 0.0)
    header = "Licensed under the Apache License, Version 2.0.\nfrom x import y"
    got = labels_of(spark, [header if k % 3 == 0 else "plain words" for k in range(300)])
    assert got == [("apache-2.0", 1.0) if k % 3 == 0 else ("", 0.0) for k in range(300)]


def test_licence_lines(spark):
    lines = {  # the first five are the licence lines of documents
        "This work is licensed under the GNU General Public License, version 3.": "gpl",
        "All rights reserved.": "reserved",
        "Released under the MIT License.": "mit",
        "Licensed under CC BY-NC 4.0.": "cc-by,cc-by-nc",
        "Licensed under the Apache License, Version 2.0.": "apache-2.0",
        "Released under the BSD License.": "bsd",
        "Released under the BSD 3-Clause License.": "bsd",
        "Released under the ISC License.": "isc",
        "Released under the Mozilla Public License, version 2.0.": "mpl-2.0",
        "Released under the MPL 2.0.": "mpl-2.0",
        "Released under the Unlicense.": "unlicense",
        "The mit of a license, a bsd system and the unlicense.": "",
    }
    got = labels_of(spark, [*lines, *[f"Some words.\n{line} More words." for line in lines]])
    assert [labels for labels, _ in got] == [*lines.values()] * 2
    assert all((score > 0) == (labels != "") for labels, score in got) and got[2][1] == 1.0


def test_every_key_phrase_has_enough_index_words():
    assert all(len(set(words[a:b]) - licenses.FUNCTION_WORDS) >= licenses.LOOKED_UP for _, words, a, b in licenses.template_words())


PAGES = "page_id long, url string, html string, host string, paths string"


def test_html(spark):
    shell = "<html><body><nav><a href='/'>home</a></nav><div class=ad>buy</div><div class='post p{k}'><h2>Title {k}</h2><p>First &amp; one,\n two <b>bold<br></p><p>Second</div><footer>f</footer>"
    rows = [(k, "http://h.example/a", shell.replace("{k}", str(k)), "x", "y") for k in range(4)]
    rows += [(9, "http://h.example/b", None, "x", "y"), (10, None, "", "x", "y"), (11, "no url", "just text <script>var a='<p>no</p>'</script> here", "x", "y"), (11, "no url", "just text <script>var a='<p>no</p>'</script> here", "x", "y")]
    rows.append((12, "http://h.example/long", "<article>" + "<p>word</p>" * 20_000, "x", "y"))
    got = {r["page_id"]: r["text"] for r in htmltext.extract_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[0] == "Title 0\nFirst & one, two bold\nSecond"
    assert got[9] == got[10] == "" and got[11] == "just text here"
    assert got[12] == "\n".join(["word"] * 20_000)
    assert htmltext.extract_text(spark.createDataFrame([], PAGES)).count() == 0


def test_host_consensus_beats_a_page_of_its_own(spark):
    side = "<div class=box><p>{}</p></div><div class=main><p>{}</p></div>"
    rows = [(k, "http://h/x", side.format("short", "the long and main text, of every page, " * 5), "x", "y") for k in range(5)]
    rows.append((7, "http://h/y", side.format("a very long box on one page, with commas, and words, " * 9, "little"), "x", "y"))
    got = {r["page_id"]: r["text"] for r in htmltext.extract_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[7] == "little"


def labelled(n=150, seed=1):
    rng = np.random.default_rng(seed)
    clean = ["river", "stone", "window", "garden", "letter", "music", "number", "green", "table", "paper", "winter", "street"]
    texts, toxic = [], []
    for k in range(n):
        words = list(rng.choice(clean, 60))
        if k % 3 == 0:
            for at in rng.integers(0, 60, 3):
                words[at] = rng.choice(["horrible", "horribly", "scumbag", "scumbags"])
        texts.append(" ".join(words))
        toxic.append(int(k % 3 == 0))
    return texts, np.array(toxic)


@pytest.fixture(scope="module")
def model():
    return toxicity.train(*labelled())


def test_toxicity_on_held_out_texts_and_misspellings(model):
    texts, toxic = labelled(90, seed=2)
    scores = toxicity.WordScores(model)
    p = model.probability(np.array([scores.score(t) for t in texts]))
    assert ((p >= 0.5) == toxic).mean() > 0.95
    clean = texts[1] + " window"
    assert scores.score(clean + " horriblle scumbagz horrible") > scores.score(clean)
    diluted = " ".join(texts[1::3][:20]) + " horrible scumbag horribly"
    assert model.probability(scores.score(diluted)) >= 0.5


def test_toxicity_of_odd_rows(spark, model):
    texts = [None, "", "...", "horrible scumbag " * 20_000, "horrible scumbag " * 20_000]
    got = toxicity.score_documents(frame(spark, texts), model, score="toxic_score").orderBy("doc_id").collect()
    p = [r["toxic_score"] for r in got]
    assert all(0 <= x <= 1 for x in p) and max(p[:3]) < 0.5 and p[3] == p[4] >= 0.5
    assert toxicity.score_documents(frame(spark, []), model, score="toxic_score").count() == 0


def test_training_leaves_out_held_out_rows(spark):
    import zlib

    texts, toxic = labelled(60)
    docs = frame(spark, texts)
    labels = spark.createDataFrame([*[(k, None, int(x)) for k, x in enumerate(toxic)], (None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    got, y = toxicity.training_rows(docs, labels, "text", "doc_id", 1000, 20_000)
    want = [t for k, t in enumerate(texts) if zlib.crc32(str(k).encode()) % 5]
    assert sorted(got) == sorted(want) and len(y) == len(want)
    none = toxicity.fit_model(docs, labels.limit(0))
    assert none.probability(none.bias) < 0.5


def test_windows_of_long_words_hash_alike():
    a, starts = toxicity.bags(["word", "longer", "ab"], 1 << 16)
    for k, w in enumerate(["word", "longer", "ab"]):
        alone, _ = toxicity.bags([w], 1 << 16)
        end = starts[k + 1] if k + 1 < len(starts) else len(a)
        assert sorted(a[starts[k] : end]) == sorted(alone)


def test_an_output_replaces_a_column_of_its_name(spark, model):
    docs = frame(spark, [PROSE, None]).withColumn("findings", F.lit("old"))
    made = {
        "quality": quality.judge_documents(docs), "license": licenses.scan_licenses(docs),
        "findings": secrets.find_secrets(docs), "score": toxicity.score_documents(docs, model),
    }
    for name, df in made.items():
        assert sorted(df.columns) == sorted(docs.columns)
        old = docs.schema[name].dataType
        assert df.schema[name].dataType != old and df.count() == 2
        assert all(df.schema[c].dataType == docs.schema[c].dataType for c in docs.columns if c != name)


def test_long_texts_dont_use_up_the_training_limit(spark):
    ids = [k for k in range(200) if zlib.crc32(str(k).encode()) % 5]
    docs = spark.createDataFrame([(k, "w " * (2 if k % 4 == 0 else 5_000)) for k in ids], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 8 // 4) for k in ids], "doc_id long, toxic int")
    texts, toxic = toxicity.training_rows(docs, labels, "text", "doc_id", 5, 100)
    assert len(texts) == 10 and sorted(toxic) == [0] * 5 + [1] * 5 and set(texts) == {"w w "}


def test_licence_sql_finds_common_headers_in_small_tables(spark):
    import duckdb

    from brook.llm import oracle

    texts = [text for _, text, _ in licenses.TEMPLATES] + ["Released under the MIT License."] * 9 + [None, "", "cc by nc", "x by the terms of the gnu general public license"]
    docs = pd.DataFrame({"doc_id": range(len(texts)), "text": texts})
    con = duckdb.connect()
    con.register("documents", docs)
    got = con.execute(f"SELECT labels, score FROM ({oracle.LICENSES}) ORDER BY doc_id").fetchall()
    assert [(x, round(y, 9)) for x, y in got] == [(x, round(y, 9)) for x, y in labels_of(spark, texts)]
