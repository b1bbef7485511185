"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the bag of itself and its character 3- to 5-grams, hashed to ``buckets`` vectors,
so a misspelling that was never seen shares most vectors with the word it comes from.  A
window of ``window`` words is the average of its words, and a softmax over two classes
scores it.  Vectors and softmax are learned together by Adam on minibatches.

Labels mark documents while the toxic words are few, so learning goes in two rounds: first
every window has its document's label; then only the windows of toxic documents that
the first model puts above those of clean documents (at least the best one) stay positive.
A document's score is that of its highest window, put on a probability scale by a logistic
fit on the training documents, so that long texts aren't diluted.

Training takes at most ``per_class`` documents of each label with at most ``train_chars``
characters (a bounded sample in hash order, fetched by a broadcast of its ids); everything
else is one map over the text.  Averaging and softmax are linear in the bag, so scoring
needs one number per bucket.

Defined cases: null and empty texts and texts without a word get the score of an empty
bag, below 0.5; rows keep their own result, so repeated rows and ids and null ids are
fine; with labels of one class only every score is the same side of 0.5; an empty table gives an empty result;
other columns are kept, but one named like the output is replaced by it.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from brook.llm.slices import map_text

WORD = re.compile(r"[^\W_]+")
GRAMS = (3, 4, 5)
#: Minibatches a round of learning takes at least, for small training sets.
MIN_STEPS = 300
#: Words whose score a worker keeps; beyond it the store starts anew.
MAX_KEPT_WORDS = 200_000


def words_of(text: str) -> list[str]:
    """Lower-cased words, a run of the same word once: repeating a word doesn't make it worse."""
    words = WORD.findall(text.lower())
    return [w for w, before in zip(words, [None, *words], strict=False) if w != before]


def bags(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket ids of all words' bags, and where each word's bag starts."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # every word as <word>, end to end; the whole word is one gram of its own
    codes = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(words)), lengths)
    mixed = (codes + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    place = np.arange(len(codes)) - starts[owner]
    whole = np.add.reduceat(mixed * (place.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * np.uint64(0x94D049BB133111EB), starts)
    ids, owners = [whole ^ np.uint64(0xA5A5)], [np.arange(len(words))]
    for n in GRAMS:
        if len(codes) < n:
            continue
        h = np.zeros(len(codes) - n + 1, dtype=np.uint64)
        for k in range(n):
            h = h * np.uint64(0x100000001B3) + mixed[k : len(codes) - n + 1 + k]
        inside = place[: len(h)] + n <= lengths[owner[: len(h)]]
        ids.append(h[inside] + np.uint64(n))
        owners.append(owner[: len(h)][inside])
    h = np.concatenate(ids)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    of = np.concatenate(owners)
    order = np.argsort(of, kind="stable")
    return ((h[order] >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64), np.searchsorted(of[order], np.arange(len(words)))


@dataclass
class Model:
    """``weight``: the logit each bucket adds to a word that is its only gram; ``slope, shift``: logistic of the best window."""

    weight: np.ndarray
    bias: float
    window: int
    slope: float
    shift: float

    def word_logits(self, words: list[str]) -> np.ndarray:
        ids, starts = bags(words, len(self.weight))
        if not len(ids):
            return np.zeros(0)
        sums = np.add.reduceat(self.weight[ids].astype(np.float64), starts)
        return sums / np.diff(np.r_[starts, len(ids)])

    def best_window(self, logits: np.ndarray) -> float:
        """The highest average logit of ``window`` consecutive words (of all of them in a shorter text)."""
        if not len(logits):
            return self.bias
        sums = np.r_[0.0, np.cumsum(logits)]
        w = min(self.window, len(logits))
        return float((sums[w:] - sums[:-w]).max()) / max(w, self.window // 2) + self.bias

    def probability(self, best: np.ndarray | float) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * np.asarray(best) + self.shift, -60, 60)))


class WordScores(dict):
    """Scores of the words seen, filled a batch at a time."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def score(self, text: str | None) -> float:
        words = words_of(text or "")
        if len(self) > MAX_KEPT_WORDS:
            self.clear()
        new = [w for w in set(words) if w not in self]
        if new:
            new.sort()
            self.update(zip(new, self.model.word_logits(new).tolist(), strict=True))
        logits = np.fromiter(map(self.__getitem__, words), np.float64, len(words))
        return self.model.best_window(logits)


def _windows(texts: list[str], window: int) -> tuple[list[str], list[np.ndarray], np.ndarray]:
    """Vocabulary, windows of word numbers (half overlapping) and the document of each window."""
    number: dict[str, int] = {}
    out, doc = [], []
    for k, text in enumerate(texts):
        ws = np.array([number.setdefault(w, len(number)) for w in words_of(text)], dtype=np.int64)
        for at in range(0, max(1, len(ws) - window // 2), window // 2):
            if len(ws):
                out.append(ws[at : at + window])
                doc.append(k)
    return list(number), out, np.array(doc, dtype=np.int64)


def train(
    texts: list[str], toxic: np.ndarray, window: int = 16, buckets: int = 1 << 16, dim: int = 8, epochs: int = 2, batch: int = 512, min_docs: int = 5, clean_weight: float = 4.0, seed: int = 7
) -> Model:
    """Learn vectors and softmax from labelled texts.

    Buckets seen in fewer than ``min_docs`` documents stay zero.  A fifth of the texts is left out of a
    first model to fit the logistic; the model itself then learns from all of them.
    """
    aside = np.arange(len(texts)) % 5 == 4
    how = {"window": window, "buckets": buckets, "dim": dim, "epochs": epochs, "batch": batch, "min_docs": min_docs, "seed": seed}
    model = _learn(texts, toxic, **how)
    if 0 < toxic[aside].sum() < aside.sum() and 0 < toxic[~aside].sum() < (~aside).sum():
        first = _learn([t for t, a in zip(texts, aside, strict=True) if not a], toxic[~aside], **how)
        x, y = np.array([WordScores(first).score(t) for t, a in zip(texts, aside, strict=True) if a]), toxic[aside]
    else:
        scores = WordScores(model)
        x, y = np.array([scores.score(t) for t in texts]), toxic
    model.slope, model.shift = _logistic(x, y.astype(float), clean_weight)
    if model.probability(model.bias) >= 0.5 and not (len(y) and y.min() == 1):  # an empty bag is clean
        model.shift = -model.slope * model.bias - 1e-6
    return model


def _documents_with(ids, sizes, windows, doc, buckets: int) -> np.ndarray:
    """In how many documents each bucket occurs."""
    n = np.zeros(buckets, dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    for k in np.split(np.arange(len(windows)), np.flatnonzero(np.diff(doc)) + 1) if len(windows) else []:
        words = np.unique(np.concatenate([windows[i] for i in k]))
        size = sizes[words]
        n[np.unique(ids[np.repeat(starts[words] - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())])] += 1
    return n


def _learn(texts: list[str], toxic: np.ndarray, window: int, buckets: int, dim: int, epochs: int, batch: int, min_docs: int, seed: int) -> Model:
    rng = np.random.default_rng(seed)
    vocabulary, windows, doc = _windows(texts, window)
    ids, starts = bags(vocabulary, buckets)
    sizes = np.diff(np.r_[starts, len(ids)])
    seen = _documents_with(ids, sizes, windows, doc, buckets) >= min_docs
    e = rng.normal(0, 0.1, (buckets, dim)) * seen[:, None]
    w = rng.normal(0, 0.1, (dim, 2))
    b = np.zeros(2)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (e, w, b)]
    step = 0

    def batch_bags(which: np.ndarray):
        words = np.concatenate([windows[i] for i in which])
        n = np.fromiter((len(windows[i]) for i in which), np.int64, len(which))
        size = sizes[words]
        at = np.repeat(starts[words] - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
        row = np.repeat(np.arange(len(which)), n)
        return ids[at], np.repeat(row, size), np.repeat(1.0 / (size * n[row]), size)

    def averages(bag, row, share, rows):
        return np.stack([np.bincount(row, share * e[bag, d], rows) for d in range(dim)], axis=1)

    def fit(which: np.ndarray, label: np.ndarray, weight: np.ndarray, rounds: int):
        nonlocal step
        for _ in range(max(rounds, math.ceil(MIN_STEPS * batch / max(len(which), 1)))):
            order = rng.permutation(len(which))
            for k in range(0, len(order), batch):
                part = order[k : k + batch]
                bag, row, share = batch_bags(which[part])
                x = averages(bag, row, share, len(part))
                z = x @ w + b
                p = np.exp(z - z.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                p[np.arange(len(part)), label[part]] -= 1
                p *= weight[part, None] / weight[part].sum()
                gx = p @ w.T
                ge = np.stack([np.bincount(bag, share * gx[row, d], buckets) for d in range(dim)], axis=1) * seen[:, None]
                step += 1
                for value, grad, (m, v) in zip((e, w, b), (ge, x.T @ p, p.sum(axis=0)), state, strict=True):
                    m *= 0.9
                    m += 0.1 * grad
                    v *= 0.999
                    v += 0.001 * grad * grad
                    value -= 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)

    def logits(which: np.ndarray) -> np.ndarray:
        out = [np.zeros(0)]
        for k in range(0, len(which), 4096):
            part = which[k : k + 4096]
            x = averages(*batch_bags(part), len(part))
            out.append(x @ (w[:, 1] - w[:, 0]) + b[1] - b[0])
        return np.concatenate(out)

    if len(windows):
        every = np.arange(len(windows))
        label = toxic[doc].astype(np.int64)
        fit(every, label, np.where(label == 1, 1.0, max(label.mean(), 1e-9) / max(1 - label.mean(), 1e-9)), epochs)
        z = logits(every)
        clean = z[label == 0]
        level = np.quantile(clean, 0.999) if len(clean) else -np.inf
        best = np.full(len(texts), -np.inf)
        np.maximum.at(best, doc, z)
        keep = (label == 0) | (z >= level) | (z >= best[doc])
        label2 = label[keep]
        fit(every[keep], label2, np.where(label2 == 1, 1.0, max(label2.mean(), 1e-3) * 3), epochs)
    return Model((e @ (w[:, 1] - w[:, 0])).astype(np.float32), float(b[1] - b[0]), window, 1.0, 0.0)


def _logistic(x: np.ndarray, y: np.ndarray, clean_weight: float) -> tuple[float, float]:
    """Slope and shift of a regularised logistic fit, the clean class weighing ``clean_weight`` times the toxic one; one class alone: a constant."""
    if not len(y) or y.min() == y.max():
        return 0.0, 4.0 if len(y) and y[0] else -4.0
    mean, sd = x.mean(), x.std() + 1e-9
    u, weight = (x - mean) / sd, np.where(y == 1, 1 / y.sum(), clean_weight / (1 - y).sum()) / (1 + clean_weight)
    a = c = 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * u + c, -40, 40)))
        r, d = weight * (p - y), weight * p * (1 - p) + 1e-9
        grad = np.array([(r * u).sum() + 1e-3 * a, r.sum()])
        hess = np.array([[(d * u * u).sum() + 1e-3, (d * u).sum()], [(d * u).sum(), d.sum()]])
        da, dc = np.linalg.solve(hess + 1e-6 * np.eye(2), grad)
        a, c = a - np.clip(da, -2, 2), c - np.clip(dc, -2, 2)
    return float(a / sd), float(c - a * mean / sd)


def held_out(doc_id):
    """The rows that training leaves out."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(5)) == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, text: str, doc_id: str, per_class: int, train_chars: int) -> tuple[list[str], np.ndarray]:
    """At most ``per_class`` texts of each label outside the held-out rows, of at most ``train_chars`` characters, in hash order."""
    known = labels.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).filter(~held_out("doc_id"))
    # texts that are too long to train on are left out before the limit, so that they don't use it up
    fits = docs.filter(F.length(text) <= train_chars).select(F.col(doc_id).alias("doc_id")).distinct()
    known = known.join(fits, "doc_id", "left_semi")
    by_class = [known.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    chosen = by_class[0].union(by_class[1]).select(F.col("doc_id").alias("chosen_id"), "toxic")
    rows = (
        docs.select(F.col(doc_id).alias("chosen_id"), F.col(text).alias("body"))
        .filter(F.length("body") <= train_chars)
        .join(F.broadcast(chosen), "chosen_id")
        .groupBy("chosen_id", "toxic")
        .agg(F.min("body").alias("body"))
        .collect()
    )
    rows.sort(key=lambda r: (r["chosen_id"], r["toxic"]))
    return [r["body"] for r in rows], np.array([r["toxic"] for r in rows], dtype=np.int64)


def fit_model(docs: DataFrame, labels: DataFrame, text="text", doc_id="doc_id", per_class: int = 1000, train_chars: int = 20_000, **how) -> Model:
    return train(*training_rows(docs, labels, text, doc_id, per_class, train_chars), **how)


def score_documents(docs: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with a column ``score`` (0 to 1, higher: toxic likelier)."""
    words = WordScores(model)
    return map_text(docs, text, lambda texts: model.probability(np.array([words.score(t) for t in texts], dtype=np.float64)), score, DoubleType())
