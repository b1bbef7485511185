"""Quality rules, line first: judge every line, drop the failing ones, reject documents that lose too much (DataFrame functions only).

A line fails if

* marks or menu separators (``#*$%&|<>``) stand in at least 30 % of its words (navigation, symbol junk),
* at least half of its words carry ``!!`` (shouting),
* it has 8 words or more and no sentence punctuation of any script at all,
* it has at most 30 words and a boilerplate phrase (cookie notices, terms, lorem ipsum ...),
* it equals an earlier line of the document.

A document is rejected if failing lines hold more than 30 % of its word characters, or by the
base rules: fewer than 50 words, or more than half of its words in 3-word windows found
twice or more.  Everything is computed inside the row, in one map over the text.

Defined cases: null text counts as empty (no words: base rules fail, the cleaned text is
empty); repeated rows and null ids are judged row by row; very long texts need one sort
of their windows' hashes (64 bit); an empty table gives an empty result; other columns are kept as they are,
but one named like the output is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: The rules' patterns and phrases.
MARK = r"[#*$%&|<>]"
MARKED_WORD = r"[^\x20\x09-\x0D#*$%&|<>]*[#*$%&|<>][^\x20\x09-\x0D]*"
SHOUTED_WORD = r"[^\x20\x09-\x0D!]*(?:![^\x20\x09-\x0D!]+)*!![^\x20\x09-\x0D]*"
# sentence marks: Latin, CJK, Devanagari, Arabic and Urdu, Armenian, Ethiopic, Khmer, Myanmar
SENTENCE = r"[.!?…。！？｡।॥؟۔։።፧។။]"
BOILERPLATE = r"cookie|javascript|all rights reserved|click here|subscribe|terms of (use|service)|privacy policy|lorem ipsum"


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def chars_of(words: Column) -> Column:
    return F.char_length(F.array_join(words, "")).cast("long")


def repeated_words(words: Column) -> Column:
    """Words in 3-word windows found twice or more: sort the windows by hash, mark equal neighbours, add up their spans."""

    def marked(z: Column) -> Column:
        same = lambda x, i: F.coalesce(x["h"] == F.get(z, i - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(z, i + 1)["h"], F.lit(False))
        return F.array_sort(F.transform(F.filter(z, same), lambda x: x["i"]))

    def covered(at: Column) -> Column:
        span = F.transform(at, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - x, F.lit(3))))
        return F.aggregate(span, F.lit(0), lambda a, x: a + x)

    def windows(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        placed = lambda x: F.transform(x, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        # without two equal windows, the usual case of short texts, no sort is needed
        return _let(
            hashes,
            lambda x: F.when(F.size(F.array_distinct(x)) == F.size(x), F.lit(0)).otherwise(
                _let(F.array_sort(placed(x)), lambda z: _let(marked(z), covered))
            ),
        )

    return _let(words, lambda w: F.when(F.size(w) < 4, F.lit(0)).otherwise(windows(w))).cast("long")


def line_fails(line: Column) -> Column:
    count = lambda pattern: F.regexp_count(line, F.lit(pattern))
    # marked and shouted words are only counted in lines that hold a mark or ``!!``
    return _let(
        F.size(words_of(line)),
        lambda n: (line.rlike(MARK) & (100 * count(MARKED_WORD) >= 30 * n))
        | (line.contains("!!") & (100 * count(SHOUTED_WORD) >= 50 * n))
        | ((n >= 8) & ~line.rlike(SENTENCE))
        | ((n <= 30) & F.lower(line).rlike(BOILERPLATE)),
    )


def judge_documents(docs: DataFrame, text: str = "text", min_words: int = 50, max_repeat: int = 50, max_loss: int = 30) -> DataFrame:
    """``docs`` plus a struct ``quality``.

    Fields: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed, kept
    (boolean), lost_chars (long, word characters of failing lines) and clean_text (the lines that pass).
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(WORD))

    def of_lines(all_lines: Column) -> Column:
        # a copy of an earlier line fails: only first occurrences are judged
        distinct = F.array_distinct(all_lines)
        passing = F.filter(distinct, lambda x: ~line_fails(x))
        return _let(
            passing,
            lambda ok: F.struct(
                (F.size(all_lines) - F.size(distinct)).cast("long").alias("dups"),
                chars_of(words_of(F.array_join(ok, "\n"))).alias("chars"),
                F.array_join(ok, "\n").alias("text"),
            ),
        )

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n"), chars_of(w).alias("chars"), repeated_words(w).alias("repeats"))

    counted = docs.withColumn(
        "quality",
        F.struct(
            _let(words_of(body), of_words).alias("w"),
            _let(lines, of_lines).alias("l"),
            F.char_length(F.regexp_replace(body, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        ),
    )

    def verdict(q: Column) -> Column:
        failed = (q["w"]["n"] < min_words) | (100 * q["w"]["repeats"] > max_repeat * q["w"]["n"])
        word_chars = q["w"]["chars"]
        lost = word_chars - q["l"]["chars"]
        return F.struct(
            q["w"]["n"].alias("n_words"), word_chars.alias("word_chars"), q["n_symbols"].alias("n_symbols"), q["l"]["dups"].alias("n_dup_lines"),
            q["w"]["repeats"].alias("n_repeat_words"), failed.alias("base_failed"), (~failed & (100 * lost <= max_loss * word_chars)).alias("kept"),
            lost.alias("lost_chars"), q["l"]["text"].alias("clean_text"),
        )

    return counted.withColumn("quality", _let(F.col("quality"), verdict))
