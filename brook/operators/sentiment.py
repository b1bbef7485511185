"""M1 sentiment scores (``positive, neutral, negative``) and U5 model scoring.

The reference unpickles a third-party model that is not in its tree (only a git-lfs
pointer), so two stand-ins are offered:

* :func:`lexicon_sentiment` — token shares by class from a word lexicon, pure SQL;
* :func:`train_naive_bayes` / :func:`naive_bayes_sentiment` — naive Bayes as tables: token
  counts per class become weights, a record's score is a join and a sum, so its results can be
  checked by SQL;
* :func:`train_sentiment` / :func:`model_sentiment` — a Spark ML pipeline
  (tokenizer, hashed term frequencies, multinomial naive Bayes) fitted on labelled
  documents; scoring stays in the JVM.

:func:`score_with_model` is the generic "load once per worker, score per batch" hook
for any Python model.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brook.functions.text import WORD, tokens
from brook.operators.lookup import token_sums
from brook.session import materialize

CLASSES = ("positive", "neutral", "negative")


#: Lexicon words that become literals of the expression; a larger lexicon is joined.
MAX_LITERAL_WORDS = 20_000


def lexicon_sentiment(
    df: DataFrame,
    id_col: str,
    text: str,
    lexicon: DataFrame,
    word: str = "w",
    cls: str = "cls",
    keep: Sequence[str] = (),
    max_literal_words: int = MAX_LITERAL_WORDS,
) -> DataFrame:
    """Per record: token count, positive/negative lexicon hits and their shares.

    Tokens are the reference's word tokens of the lower-cased text.  A lexicon of up to
    ``max_literal_words`` words becomes part of a column expression: one map over the records, batch or
    stream, in which equal ids stay records of their own.  A larger one is joined to the
    exploded tokens of a batch frame, whose records then get a key of their own; a stream scores each of its
    micro-batches that way (:func:`brook.streaming.runner.batches_to_table`).  Beyond the broadcast bounds common
    tokens are still looked up by a broadcast, rare ones by a shuffle (:func:`brook.operators.lookup.token_sums`).
    ``keep`` carries further record columns, the text too if named.
    """
    classes = lexicon.groupBy(F.col(word).alias("_w")).agg(F.min(cls).alias("_cls"))
    if lexicon.limit(max_literal_words + 1).count() > max_literal_words:
        classes = materialize(classes, "classes")  # read several times
    found = classes.limit(max_literal_words + 1).collect()
    columns = list(dict.fromkeys([id_col, *keep]))
    toks = tokens(F.lower(F.col(text)), WORD)
    if len(found) <= max_literal_words:
        of = {c: [r["_w"] for r in found if r["_cls"] == c and r["_w"] is not None] for c in ("positive", "negative")}
        hits = lambda c: F.size(F.filter("_tok", lambda w: w.isin(of[c]) if of[c] else F.lit(False)))
        agg = df.select(*columns, toks.alias("_tok")).select(
            *columns,
            F.size("_tok").cast("long").alias("n_tokens"),
            hits("positive").cast("long").alias("pos_hits"),
            hits("negative").cast("long").alias("neg_hits"),
        )
    elif df.isStreaming:
        raise ValueError(f"a lexicon of more than {max_literal_words} words is joined: score each micro-batch (batches_to_table)")
    else:
        agg = _joined_hits(df, columns, toks, classes)
    nt = F.col("n_tokens")
    share = lambda c: F.when(nt == 0, F.lit(0.0)).otherwise(c / nt)
    return agg.select(
        *columns,
        "n_tokens",
        "pos_hits",
        "neg_hits",
        share(F.col("pos_hits")).alias("positive"),
        F.when(nt == 0, F.lit(1.0)).otherwise((nt - F.col("pos_hits") - F.col("neg_hits")) / nt).alias("neutral"),
        share(F.col("neg_hits")).alias("negative"),
    )


def _joined_hits(df: DataFrame, columns: Sequence[str], toks, classes: DataFrame) -> DataFrame:
    # stored once, so that a record's key is the same wherever the plan reads it
    records = materialize(df.select(F.monotonically_increasing_id().alias("_id"), *columns, toks.alias("_tok")), "records")
    is_cls = {c: (F.col("_cls") == c).cast("long").alias(c) for c in ("positive", "negative")}
    signed = classes.where(F.col("_w").isNotNull() & F.col("_cls").isin(*is_cls)).select(F.col("_w").alias("token"), *is_cls.values())
    hits = token_sums(records, signed, [*is_cls]).select("_id", F.col("positive").alias("pos_hits"), F.col("negative").alias("neg_hits"))
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("pos_hits", "neg_hits")]
    found = records.select("_id", *columns, F.size("_tok").cast("long").alias("n_tokens")).join(hits, "_id", "left")
    return found.select(*columns, "n_tokens", *counts)


def sentiment_labels(labels: DataFrame) -> DataFrame:
    """Class index from the fixture's labels: toxic -> negative, quality -> positive, else neutral."""
    label = (
        F.when(F.col("toxic") == 1, F.lit(2.0))
        .when(F.col("quality") == 1, F.lit(0.0))
        .otherwise(F.lit(1.0))
    )
    return labels.select("doc_id", label.alias("label"))


def train_sentiment(docs: DataFrame, labels: DataFrame, text: str = "text", num_features: int = 1 << 18):
    """Fit tokenizer -> hashed TF -> multinomial naive Bayes on ``docs`` joined to labels."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import HashingTF, RegexTokenizer

    train = docs.select("doc_id", text).join(sentiment_labels(labels), "doc_id")
    stages = [
        RegexTokenizer(inputCol=text, outputCol="_tok", pattern=WORD, gaps=False, toLowercase=True),
        HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=num_features),
        NaiveBayes(featuresCol="_tf", labelCol="label", modelType="multinomial", smoothing=1.0),
    ]
    return Pipeline(stages=stages).fit(train)


def model_sentiment(df: DataFrame, model, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Score ``df`` with a fitted :func:`train_sentiment` model; JVM-side, no Python rows."""
    from pyspark.ml.functions import vector_to_array

    # the model reads a copy of the text, so that the record can keep its own
    scored = model.transform(df.select(F.struct(*[F.col(c) for c in keep]).alias("_keep"), F.coalesce(F.col(text), F.lit("")).alias(text)))
    prob = vector_to_array(F.col("probability"))
    cols = [F.when(F.size(prob) > i, prob[i]).otherwise(F.lit(0.0)).alias(name) for i, name in enumerate(CLASSES)]
    return scored.select(*[F.col(f"_keep.{c}").alias(c) for c in keep], *cols)


#: Log-probabilities are kept as whole millionths, so that sums don't depend on their order.
LOG_UNIT = 1_000_000


@dataclass(frozen=True)
class NaiveBayes:
    """Multinomial naive Bayes: a weight per token and class (stored table ``token, w0, w1, ..``) and the
    classes' priors (None for a class without training records)."""

    weights: DataFrame
    priors: tuple[int | None, ...]


def train_naive_bayes(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", n_classes: int = len(CLASSES), smoothing: float = 1.0
) -> NaiveBayes:
    """Count the tokens of the labelled ``docs`` per class (``labels``: ``doc_id``, ``label`` from 0).

    ``weight = ln((count + smoothing) / (tokens of the class + smoothing * vocabulary))`` in whole
    ``LOG_UNIT`` parts.  One partial + final aggregate over (token), whose classes are columns; the
    vocabulary stays a distributed table.
    """
    # the join carries the text, and only labelled texts are cut into tokens
    train = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text")).join(labels.select("doc_id", "label"), "doc_id")
    is_class = [F.col("label") == i for i in range(n_classes)]
    counted = train.select("label", F.explode(tokens(F.lower("_text"), WORD)).alias("token")).groupBy("token")
    counts = materialize(counted.agg(*[F.count_if(c).alias(f"c{i}") for i, c in enumerate(is_class)]), "token-counts")
    sums = counts.agg(F.count(F.lit(1)).alias("v"), *[F.coalesce(F.sum(f"c{i}"), F.lit(0)).alias(f"c{i}") for i in range(n_classes)]).first()
    records = train.agg(*[F.count_if(c).alias(f"d{i}") for i, c in enumerate(is_class)]).first()
    total = sum(records)
    priors = tuple(round(math.log(d / total) * LOG_UNIT) if d else None for d in records)
    weight = lambda i: F.round(
        F.ln((F.col(f"c{i}") + smoothing) / F.lit(float(sums[f"c{i}"] + smoothing * sums["v"]))) * LOG_UNIT
    ).cast("long")
    return NaiveBayes(materialize(counts.select("token", *[weight(i).alias(f"w{i}") for i in range(n_classes)]), "token-weights"), priors)


def naive_bayes_sentiment(
    df: DataFrame, model: NaiveBayes, text: str = "text", keep: Sequence[str] = ("doc_id",), classes: Sequence[str] = CLASSES, digits: int = 6
) -> DataFrame:
    """Class probabilities of every record of a batch, rounded to ``digits``; on a stream score each
    micro-batch (:func:`brook.streaming.runner.batches_to_table`).

    Tokens are looked up in their weights by :func:`brook.operators.lookup.token_sums`: by a broadcast when the table
    passes the size check, else common tokens by a broadcast and only rare ones by a shuffle.  Tokens unknown to the model add
    nothing; a null or tokenless text has the priors, and a model without training records gives nulls.
    """
    stored = df.select(F.monotonically_increasing_id().alias("_id"), F.struct(*keep).alias("_keep"), tokens(F.lower(F.col(text)), WORD).alias("_tok"))
    records = materialize(stored, "records")
    n = len(model.priors)
    sums = token_sums(records, model.weights, [f"w{i}" for i in range(n)])
    score = [F.coalesce(F.col(f"w{i}"), F.lit(0)) + F.lit(p) for i, p in enumerate(model.priors)]
    scored = records.select("_id", "_keep").join(sums, "_id", "left").select("_keep", *[s.cast("long").alias(f"s{i}") for i, s in enumerate(score)])
    best = F.greatest(*[F.col(f"s{i}") for i in range(n)])  # ignores classes without a prior
    scored = scored.select("_keep", *[F.exp((F.col(f"s{i}") - best) / float(LOG_UNIT)).alias(f"e{i}") for i in range(n)])
    parts = [F.coalesce(F.col(f"e{i}"), F.lit(0.0)) for i in range(n)]
    whole = sum(parts[1:], parts[0])
    shares = [F.round(p / F.nullif(whole, F.lit(0.0)), digits).alias(c) for p, c in zip(parts, classes, strict=True)]
    return scored.select(*[F.col(f"_keep.{c}").alias(c) for c in keep], *shares)


_MODELS: dict = {}


def worker_model(key: str, loader: Callable[[], object]) -> object:
    """The model of ``key`` in this Python worker, loaded at its first use."""
    if key not in _MODELS:
        _MODELS[key] = loader()
    return _MODELS[key]


#: Characters of text that a model scores at once: what it makes of them is held in the Python worker together.
SCORE_CHARS = 1 << 20


def text_slices(texts, most: int = SCORE_CHARS):
    """(start, stop) of consecutive runs of ``texts`` with at most ``most`` characters each, or one longer text."""
    start, held = 0, 0
    for i, value in enumerate(texts):
        size = len(value) if isinstance(value, (str, bytes)) else 1
        if i > start and held + size > most:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(texts):
        yield start, len(texts)


def score_with_model(
    df: DataFrame,
    text: str,
    loader: Callable[[], object],
    score: Callable[[object, "pd.Series"], "pd.DataFrame"],  # noqa: F821
    cache_key: str,
    out_schema: str = "positive double, neutral double, negative double",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Apply a Python model to the texts of each Arrow batch, loading it once per Python worker.

    ``loader()`` builds the model (the reference's ``setup``); ``score(model, texts)``
    returns a pandas frame matching ``out_schema`` for a batch of texts: a stretch of the Arrow batch of at most
    ``SCORE_CHARS`` characters, so that a worker's memory doesn't follow the rows' lengths.  ``cache_key`` names
    the model: two models need two keys.  ``keep`` may name the text.
    """
    import pandas as pd

    keep = list(keep)
    out_fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields)
    schema = f"{out_fields}, {out_schema}" if out_fields else out_schema

    def run(batches):
        # imported, not shipped: the store must be the worker's own module
        from brook.operators.sentiment import text_slices, worker_model

        model = worker_model(cache_key, loader)
        for pdf in batches:
            for start, stop in text_slices(pdf[text]):
                part = pdf.iloc[start:stop]
                res = score(model, part[text])
                res.index = part.index
                yield pd.concat([part[keep], res], axis=1)

    return df.select(*dict.fromkeys([*keep, text])).mapInPandas(run, schema)
