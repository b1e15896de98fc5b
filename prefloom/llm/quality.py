"""Quality classifier from trusted positives and unlabelled text.

Only documents labelled good are trusted; everything else is unlabelled, and so is
the share of good text in it. Three steps:

1. A first logistic model tells trusted from unlabelled documents. On rows it was
   not fitted to, the class prior is estimated from the best bin of its scores:
   the smallest ratio of the unlabelled to the trusted share above a cut,
   with bounds for the error of both shares.
2. The classifier minimises the non-negative unbiased risk
   ``prior * R_p+ + max(0, R_u- - prior * R_p-)`` with the logistic loss; where the
   difference falls below 0 its gradient is walked back instead.
3. The score is the sigmoid of the margin.

Inputs are shares of character classes, word ends, case, repetition and shape of
lines, all from the whole text. The model is fitted on at most ``TRUSTED`` and
``UNLABELLED`` documents, chosen by a hash of doc_id; every document is scored.

Defined results: a null text scores like an empty one; labels that are null, not 1 or
without a document teach nothing; of several rows with one doc_id one is learned
from; without any trusted document every score is 0.5; an empty table gives an
empty result. labels, lang, source and doc_id are never inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefloom.llm.folds import remainder
from prefloom.llm.words import slices, split_words, text_bytes

TRUSTED = 8_000
UNLABELLED = 16_000
CUT = 0.3
STEPS = 400
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
CLASSES = len(MARKS) + 8  # marks, then digit, upper, lower, space, line end, other white, control, beyond ASCII


def byte_classes() -> np.ndarray:
    table = np.full(256, len(MARKS) + 6)
    table[list(MARKS)] = np.arange(len(MARKS))
    for k, group in enumerate([range(48, 58), range(65, 91), range(97, 123), [32], [10], [9, 11, 12, 13]]):
        table[list(group)] = len(MARKS) + k
    table[128:] = len(MARKS) + 7
    return table


def features(texts: pa.Array) -> np.ndarray:
    """One row per text: roots of shares, so that rare signs count."""
    n = len(texts)
    data, offsets = text_bytes(texts)
    words = split_words(texts)
    table = byte_classes()
    kinds, doc = table[data], np.repeat(np.arange(n), np.diff(offsets))
    hist = np.bincount(doc * CLASSES + kinds, minlength=n * CLASSES).reshape(n, CLASSES).astype(float)
    size = np.maximum(hist.sum(axis=1, keepdims=True), 1)

    count = np.diff(words.first)
    some = np.maximum(count, 1).astype(float)
    at = np.repeat(np.arange(n), count)
    last = table[data[words.ends - 1]] if len(words.ends) else np.zeros(0, int)
    ends = np.bincount(at * CLASSES + last, minlength=n * CLASSES).reshape(n, CLASSES) / some[:, None]

    def share(flags: np.ndarray, of: np.ndarray) -> np.ndarray:
        return np.bincount(of[flags], minlength=n) / some

    same = np.zeros(len(at), dtype=bool)
    same[1:] = (words.hashes[1:] == words.hashes[:-1]) & (at[1:] == at[:-1])
    order = np.lexsort((words.hashes, at))
    new = np.ones(len(at), dtype=bool)
    new[1:] = (words.hashes[order][1:] != words.hashes[order][:-1]) | (at[order][1:] != at[order][:-1])
    first = table[data[words.starts]] if len(words.starts) else np.zeros(0, int)
    upper, lower = len(MARKS) + 1, len(MARKS) + 2
    length = words.ends - words.starts
    capital = (first == upper) & (length > 1)
    capital[capital] = table[data[words.starts[capital] + 1]] == upper
    lines = hist[:, len(MARKS) + 4] + 1
    more = np.stack(
        [
            share(same, at),
            share(new, at[order]),
            share(first == upper, at),
            share(first == lower, at),
            share(capital, at),
            share(length == 1, at),
            np.log1p(count) / 10,
            np.bincount(at, weights=length, minlength=n) / some / 10,
            np.log1p(count / lines) / 5,
        ],
        axis=1,
    )
    return np.concatenate([np.sqrt(hist / size), np.sqrt(ends), np.sqrt(more)], axis=1).astype(np.float32)


def _minimise(gradient, width: int, steps: int = STEPS, rate: float = 0.05) -> np.ndarray:
    """Adam with full batches from zero."""
    w, m, v = np.zeros(width), np.zeros(width), np.zeros(width)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def estimate_prior(trusted: np.ndarray, unlabelled: np.ndarray, confidence: float = 0.1) -> float:
    """Share of good rows among the unlabelled: each half is fitted, the best bin
    of the other half read off, and both are averaged."""
    found = []
    for half in (0, 1):
        p, u = trusted[half::2], unlabelled[half::2]
        other_p, other_u = trusted[1 - half :: 2], unlabelled[1 - half :: 2]
        if min(len(p), len(u), len(other_p), len(other_u)) == 0:
            return 0.5
        w = _tell_apart(p, u)
        cuts, margins = np.sort(other_p @ w), np.sort(other_u @ w)
        share_p = 1 - np.arange(len(cuts)) / len(cuts)
        share_u = 1 - np.searchsorted(margins, cuts, side="left") / len(margins)
        slack = sum(np.sqrt(np.log(4 / confidence) / (2 * n)) for n in (len(cuts), len(margins)))
        best = np.argmin((share_u + slack) / share_p)
        found.append(share_u[best] / share_p[best])
    return float(np.clip(np.mean(found), 0.01, 0.99))


def _tell_apart(p: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Logistic weights, trusted against unlabelled, both sides equally heavy."""

    def gradient(w):
        return 1e-3 * w - p.T @ (1 - sigmoid(p @ w)) / len(p) + u.T @ sigmoid(u @ w) / len(u)

    return _minimise(gradient, p.shape[1], STEPS // 2)


def fit(trusted: np.ndarray, unlabelled: np.ndarray, prior: float, decay: float = 1e-3) -> np.ndarray:
    """Weights that minimise the non-negative unbiased risk."""

    def gradient(w):
        good_p, good_u = sigmoid(trusted @ w), sigmoid(unlabelled @ w)
        as_good = -trusted.T @ (1 - good_p) / len(trusted)  # of R_p+
        as_bad = unlabelled.T @ good_u / len(unlabelled) - prior * (trusted.T @ good_p) / len(trusted)
        zp, zu = np.clip(trusted @ w, -60, 60), np.clip(unlabelled @ w, -60, 60)
        rest = np.log1p(np.exp(zu)).mean() - prior * np.log1p(np.exp(zp)).mean()
        return (prior * as_good + as_bad if rest >= 0 else -as_bad) + decay * w

    return _minimise(gradient, trusted.shape[1])


class Model:
    def __init__(self, middle: np.ndarray, spread: np.ndarray, weights: np.ndarray, prior: float):
        self.middle, self.spread, self.weights, self.prior = middle, spread, weights, prior

    def inputs(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.middle) / self.spread, -6, 6)
        return np.concatenate([z, np.ones((len(z), 1))], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.inputs(x) @ self.weights)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole):
            x = features(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("trusted"), pa.array(list(x), pa.list_(pa.float32()))],
                names=["doc_id", "trusted", "x"],
            )


def _some(ids: DataFrame, limit: int, seed: int) -> DataFrame:
    """At most ``limit`` ids, those with the smallest hashes. A bound on the hash leaves
    half as many again, so that no task gets ``limit`` rows from every other."""
    share = min(1.0, 1.5 * limit / max(1, ids.count()))
    order = F.xxhash64("doc_id", F.lit(seed))
    near = ids.filter(order <= int(-(2**63) + share * (2**64 - 1)) if share < 1 else F.lit(True))
    return near.orderBy(order, "doc_id").limit(limit)


def train(docs: DataFrame, labels: DataFrame, trusted: int = TRUSTED, unlabelled: int = UNLABELLED) -> Model | None:
    """A model from ``docs`` (doc_id, text) and the labels (doc_id, quality) of
    some of them; at most ``trusted`` and ``unlabelled`` documents are looked at."""
    good = labels.filter("quality = 1 and doc_id is not null").select("doc_id").distinct()
    good = _some(good.join(docs.select("doc_id").distinct(), "doc_id", "left_semi"), trusted, 0)
    other = _some(docs.filter("doc_id is not null").select("doc_id").distinct(), unlabelled, 1)
    # bounded by the two limits, so it can be broadcast
    chosen = (
        good.withColumn("t", F.lit(True))
        .join(other.withColumn("u", F.lit(True)), "doc_id", "full")
        .select("doc_id", F.coalesce("t", F.lit(False)).alias("trusted"), F.coalesce("u", F.lit(False)).alias("unlabelled"))
    )
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .select("doc_id", "text", (F.col("trusted").cast("int") + 2 * F.col("unlabelled").cast("int")).alias("trusted"))
        .mapInArrow(_feature_rows, "doc_id long, trusted int, x array<float>")
        .dropDuplicates(["doc_id"])
        .toArrow()
    )
    if not rows.num_rows:
        return None
    order = np.argsort(rows.column("doc_id").to_numpy(), kind="stable")
    x = np.stack(rows.column("x").to_numpy())[order]
    role = rows.column("trusted").to_numpy()[order]
    if not (role & 1).any() or not (role & 2).any():
        return None
    u = x[role >= 2]
    model = Model(u.mean(axis=0), u.std(axis=0) + 0.01, np.zeros(0), 0.5)
    p, u = model.inputs(x[(role & 1) > 0]), model.inputs(u)
    model.prior = estimate_prior(p, u)
    model.weights = fit(p, u, model.prior)
    return model


def score(docs: DataFrame, model: Model | None, *keep: str, cut: float = CUT) -> DataFrame:
    """The columns ``keep`` of ``docs`` with score and predicted for ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # the inputs are renamed, so that a column called score or predicted can be kept out of the way
    source = docs.select(*keep, F.col("text").alias("_text"))
    schema = source.drop("_text").schema.add("score", "double").add("predicted", "integer")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for batch in slices(whole, "_text"):
                texts = batch.column("_text")
                value = model.score(features(texts)) if model else np.full(len(texts), 0.5)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(value), pa.array((value >= cut).astype(np.int32))],
                    names=[*keep, "score", "predicted"],
                )

    return source.mapInArrow(rows, schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; learned from the
    documents and labels whose fold is not 0."""
    docs = docs.select("doc_id", "text", (remainder(5) == 0).alias("held_out"))
    return score(docs, _model(docs, labels), "doc_id", "held_out")


def _model(docs: DataFrame, labels: DataFrame) -> Model | None:
    seen = remainder(5) != 0
    return train(docs.filter(seen).select("doc_id", "text"), labels.filter(seen))


def keep_good(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The documents predicted good, all columns as given."""
    columns = docs.columns
    rows = docs.select(F.struct(*[F.col(c) for c in columns]).alias("_row"), "text")
    return score(rows, _model(docs, labels), "_row", cut=cut).filter("predicted = 1").select("_row.*")
