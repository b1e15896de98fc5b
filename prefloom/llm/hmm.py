"""Language model scores from a hidden Markov model.

Tokens are the words of a text with A-Z in lower case, and one end. Their counts over
all training documents give the base score, with one added to every count and one
unit for all unseen words. The model itself:

* Every word that occurs in training has emissions of its own; a word that does not is the
  class of its last two bytes. One is added to the expected count of every word and
  of every class of unseen words.
* Baum-Welch over all training documents, ``ROUNDS`` rounds: tasks run forward and backward over
  whole texts side by side, and expected counts are summed over partitions. Texts over ``LONG``
  tokens are cut into pieces: the transfer matrices of the pieces give the exact state
  before and after each, so no transition and no context is lost.
* In all rounds but the last, words beyond the ``SYMBOLS`` most frequent are tied: a class shares
  the differences between its words' states. The last round counts (word, state) for all
  words apart. Those of words beyond the ``TABLE`` most frequent stay a distributed table,
  and come back to the texts through a join.
* Score: the scaled forward recursion over the whole text, exact.

What is broadcast is bounded by ``TABLE`` (a cache, not a cut), so what a task holds does not grow
with the corpus. Words are compared by 64-bit hashes.

Defined results: a null text is empty and has the end alone; a null doc_id counts as
empty text for the fold; repeated rows count as often as they occur; with nothing to learn
from, the base score is 0 and all words are unseen ones; an empty table gives an empty result; columns other than
doc_id and text are not used.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefloom.llm.folds import remainder
from prefloom.llm.tables import drop, most_frequent, stored
from prefloom.llm.words import Words, slices, split_words

STATES = 6
SYMBOLS = 16_384
CLASSES = 64
TABLE = 200_000
ROUNDS = 4
LONG = 16_384
PIECE = 512
CHUNK = 500_000  # tokens that are worked on side by side
FLUSH = 1_000_000  # words a task holds while counting
END = 1  # hash that stands for the end; its class is the one after all others
FIRST = -(1 << 63)  # keys from here on are rows of the model; a word has such a hash with a chance of 10^-14


def classes(words: Words) -> np.ndarray:
    """The class of every word if it is not a symbol."""
    last = words.data[words.ends - 1].astype(np.int64)
    before = np.where(words.ends - words.starts > 1, words.data[np.maximum(words.ends - 2, 0)], 0).astype(np.int64)
    return (before * 31 + last) % CLASSES


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, class, n) of the words of one task."""
    held: list[tuple] = []

    def add(parts: list[tuple]) -> tuple:
        h, c, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(h, kind="stable")
        h, c, n = h[order], c[order], n[order]
        new = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, int)
        return h[new], c[new], np.add.reduceat(n, new) if len(new) else n

    def rows(part: tuple) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(part[0].view(np.int64)), pa.array(part[1].astype(np.int32)), pa.array(part[2])], names=["h", "class", "n"]
        )

    size = 0
    for whole in batches:
        for batch in slices(whole):
            words = split_words(batch.column("text"), lower=True)
            end = (np.array([END], np.uint64), np.array([CLASSES]), np.array([batch.num_rows], np.int64))
            held.append(add([(words.hashes, classes(words), np.ones(len(words.hashes), np.int64)), end]))
            size += len(held[-1][0])
            if size > FLUSH:
                held = [add(held)]
                size = len(held[0][0])
                if size > FLUSH // 2:
                    yield rows(held[0])
                    held, size = [], 0
    if held:
        yield rows(add(held))


class Vocabulary:
    """The most frequent words, most frequent first, and how all words are tied to classes.

    A symbol is the place of a word in the table, or ``len(table)`` + its class."""

    def __init__(self, table: pa.Table, class_words: np.ndarray, class_tokens: np.ndarray):
        self.hashes = table.column("h").to_numpy().view(np.uint64)
        self.counts = table.column("n").to_numpy()
        kinds = table.column("class").to_numpy().astype(np.int64)
        self.tokens, self.distinct = int(class_tokens.sum()), int(class_words.sum())
        own = min(SYMBOLS, len(kinds))
        every = np.arange(CLASSES + 1)
        self.tie = np.concatenate([np.arange(own), own + kinds[own:], own + every])
        # one is added to every word and to each class of unseen ones
        left_words = class_words - np.bincount(kinds[:own], minlength=CLASSES + 1)
        left_tokens = class_tokens - np.bincount(kinds[:own], weights=self.counts[:own], minlength=CLASSES + 1)
        self.tied_units = np.concatenate([np.ones(own), left_words + 1])
        self.tied_weights = np.concatenate([self.counts[:own], left_tokens]) + self.tied_units
        self.weights = np.concatenate([self.counts, np.zeros(CLASSES + 1)]) + 1.0
        self.total = float(self.tokens + self.distinct + CLASSES + 1)  # of all weights

    def shipped(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes in ascending order, their counts and symbols."""
        order = np.argsort(self.hashes)
        return self.hashes[order], self.counts[order], order


def places(hashes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of ``wanted`` in ascending ``hashes``, -1 where they are not there."""
    if not len(hashes):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(hashes, wanted), len(hashes) - 1)
    return np.where(hashes[at] == wanted, at, -1)


def packed(symbols: np.ndarray) -> bytes:
    """Low 16 bits of all symbols, then their high 8 bits, which are mostly zeros."""
    return (symbols & 0xFFFF).astype("<u2").tobytes() + (symbols >> 16).astype(np.uint8).tobytes()


def unpacked(raw: list[bytes]) -> np.ndarray:
    """Symbols of many texts, one text after another."""
    low = np.frombuffer(b"".join([r[: len(r) // 3 * 2] for r in raw]), "<u2").astype(np.int64)
    return low | np.frombuffer(b"".join([r[len(r) // 3 * 2 :] for r in raw]), np.uint8).astype(np.int64) << 16


ENCODED = (
    "doc_id long, held_out boolean, rid long, n_tokens long, n_known long, base double, symbols binary, others array<long>"
)


def _encode_rows(shared):
    """Symbols of every document, sums over the words of the table, and the hashes of
    its words beyond the table in their order."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts, symbols = shared.value
        for whole in batches:
            for batch in slices(whole):
                words = split_words(batch.column("text"), lower=True)
                n = batch.num_rows
                sizes = np.diff(words.first)
                # every text's words, then its end
                place = np.arange(len(words.hashes)) + np.repeat(np.arange(n), sizes)
                total = len(words.hashes) + n
                kind, found = np.full(total, CLASSES), np.full(total, END, np.uint64)
                kind[place], found[place] = classes(words), words.hashes
                doc = np.repeat(np.arange(n), sizes + 1)
                at = places(hashes, found)
                known = at >= 0
                symbol, log = len(hashes) + kind, np.zeros(total)
                symbol[known], log[known] = symbols[at[known]], np.log10(counts[at[known]] + 1.0)
                cuts = np.append(0, np.cumsum(sizes + 1))
                other_cuts = np.append(0, np.cumsum(np.bincount(doc[~known], minlength=n)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        batch.column("held_out"),
                        batch.column("rid"),
                        pa.array(sizes + 1),
                        pa.array(np.bincount(doc[known], minlength=n)),
                        pa.array(np.bincount(doc, weights=log, minlength=n)),
                        pa.array([packed(symbol[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(other_cuts.astype(np.int32)), pa.array(found[~known].view(np.int64))),
                    ],
                    names=[c.split()[0] for c in ENCODED.split(", ")],
                )

    return rows


class Model(NamedTuple):
    """Initial, transition and emission probabilities; emission has a row per symbol."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def first_model(weights: np.ndarray, states: int = STATES, seed: int = 7) -> Model:
    """Token shares with fixed random differences between the states."""
    rng = np.random.default_rng(seed)
    emit = weights[:, None] * rng.uniform(0.5, 1.5, (len(weights), states))
    move = rng.uniform(0.5, 1.5, (states, states)) + 4 * np.eye(states)
    return Model(np.full(states, 1 / states), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


Look = Callable[[np.ndarray], np.ndarray]  # emissions of tokens given by their places, a row each


class Rows(NamedTuple):
    """Texts and pieces of texts, in order: how long each is, whether it begins its text, the state
    before it (of the token before, or the start) and the chances of what comes after it."""

    length: np.ndarray
    first: np.ndarray
    before: np.ndarray
    after: np.ndarray

    def blocks(self) -> Iterator[tuple[int, int, int, int]]:
        """Ranges of rows and of their tokens."""
        ends = np.cumsum(self.length)
        i = 0
        while i < len(ends):
            a = int(ends[i] - self.length[i])
            j = max(i + 1, int(np.searchsorted(ends, a + CHUNK, side="right")))
            yield i, j, a, int(ends[j - 1])
            i = j


def cut_rows(model: Model, look: Look, sizes: np.ndarray) -> Rows:
    """Rows of texts of ``sizes`` tokens (none is 0); long ones are cut."""
    states = len(model.start)
    long = sizes > LONG
    parts = np.where(long, -(-sizes // PIECE), 1)
    doc = np.repeat(np.arange(len(sizes)), parts)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
    length = np.where(long[doc], np.minimum(PIECE, sizes[doc] - number * PIECE), sizes[doc])
    rows = Rows(length, number == 0, np.tile(model.start, (len(doc), 1)), np.ones((len(doc), states)))
    for d in np.flatnonzero(long):
        own = np.arange(np.searchsorted(doc, d), np.searchsorted(doc, d, side="right"))
        matrices = _transfers(model, look, int(sizes[:d].sum()), length[own])
        for i, m in zip(own[:-1], matrices, strict=False):
            v = rows.before[i] @ m
            rows.before[i + 1] = v / v.sum()
        for i, m in zip(own[:0:-1], matrices[::-1], strict=False):
            w = m @ rows.after[i]
            rows.after[i - 1] = w / w.sum()
    return rows


def _transfers(model: Model, look: Look, begin: int, length: np.ndarray) -> np.ndarray:
    """Matrices of the pieces of one text, up to a factor; the first has no move before it."""
    states, out = len(model.start), []
    many = max(1, CHUNK // PIECE // states)
    for i in range(0, len(length), many):
        some = length[i : i + many]
        seen = np.ones((len(some), PIECE, states))
        flat = look(begin + i * PIECE + np.arange(some.sum()))
        seen.reshape(-1, states)[: len(flat)] = flat
        matrix = np.broadcast_to(np.eye(states), (len(some), states, states))
        for t in range(PIECE):
            moved = matrix @ model.move
            if t == 0 and i == 0:
                moved[0] = np.eye(states)
            if t >= some[-1]:  # the text has ended
                moved[-1] = matrix[-1]
            matrix = moved * seen[:, t][:, None, :]
            matrix = matrix / matrix.sum(axis=(1, 2), keepdims=True)
        out.append(matrix)
    return np.concatenate(out)


class _Steps(NamedTuple):
    """Rows longest first, their tokens step by step: ``active`` rows have step t, from ``begin`` on."""

    order: np.ndarray
    active: np.ndarray
    begin: np.ndarray
    tokens: np.ndarray  # their places in the texts


def _steps(length: np.ndarray) -> _Steps:
    order = np.argsort(-length, kind="stable")
    active = np.searchsorted(-length[order], -np.arange(length.max()), side="left")
    begin = np.cumsum(active) - active
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    step = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    tokens = np.empty(len(step), np.int64)
    tokens[begin[step] + np.repeat(rank, length)] = np.arange(len(step))
    return _Steps(order, active, begin, tokens)


def _forward(model: Model, seen: np.ndarray, steps: _Steps, prior: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scaled states and scales of all tokens, step by step."""
    alpha, scale = np.empty_like(seen), np.empty(len(seen))
    last = prior
    for a, k in zip(steps.begin.tolist(), steps.active.tolist(), strict=True):
        here = (last if a == 0 else last[:k] @ model.move) * seen[a : a + k]
        total = here.sum(axis=1)
        last = here / total[:, None]
        alpha[a : a + k], scale[a : a + k] = last, total
    return alpha, scale


def _prior(model: Model, rows: Rows, i: int, j: int, order: np.ndarray) -> np.ndarray:
    return np.where(rows.first[i:j, None], rows.before[i:j], rows.before[i:j] @ model.move)[order]


def expected_counts(model: Model, look: Look, sizes: np.ndarray, add: Callable[[np.ndarray, np.ndarray], None]):
    """One E-step over whole texts. ``add`` gets places of tokens and the chances of their states;
    returned are expected transitions, starts of texts, and the log likelihood."""
    states = len(model.start)
    moves, starts, log = np.zeros((states, states)), np.zeros(states), 0.0
    rows = cut_rows(model, look, sizes)
    for i, j, a, b in rows.blocks():
        steps = _steps(rows.length[i:j])
        seen = look(a + steps.tokens)
        alpha, scale = _forward(model, seen, steps, _prior(model, rows, i, j, steps.order))
        log += float(np.log(scale).sum())
        first, before = rows.first[i:j][steps.order], rows.before[i:j][steps.order]
        ends = steps.begin[rows.length[i:j][steps.order] - 1] + np.arange(j - i)
        beta = rows.after[i:j][steps.order]
        beta /= (alpha[ends] * beta).sum(axis=1, keepdims=True)
        seen /= scale[:, None]
        gammas = np.empty_like(seen)
        for at, k in zip(steps.begin[::-1].tolist(), steps.active[::-1].tolist(), strict=True):
            gammas[at : at + k] = alpha[at : at + k] * beta[:k]
            seen[at : at + k] *= beta[:k]
            beta[:k] = seen[at : at + k] @ model.move.T
        # states before the tokens, met with what comes from them on
        n = len(steps.order)
        moves += alpha[np.arange(n, b - a) - np.repeat(steps.active[:-1], steps.active[1:])].T @ seen[n:]
        moves += before[~first].T @ seen[:n][~first]
        starts += gammas[:n][first].sum(axis=0)
        add(a + steps.tokens, gammas)
    return moves * model.move, starts, log


def log10_likelihood(model: Model, look: Look, sizes: np.ndarray) -> np.ndarray:
    """Exact log10 probability of every text."""
    rows = cut_rows(model, look, sizes)
    logs = np.zeros(len(rows.length))
    for i, j, a, _ in rows.blocks():
        steps = _steps(rows.length[i:j])
        _, scale = _forward(model, look(a + steps.tokens), steps, _prior(model, rows, i, j, steps.order))
        row = np.repeat(np.arange(j - i), rows.length[i:j])[steps.tokens]
        logs[i:j] = np.bincount(row, weights=np.log10(scale), minlength=j - i)
    return np.bincount(np.cumsum(rows.first) - 1, weights=logs, minlength=len(sizes))


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Ranges of documents with their symbols and numbers of tokens."""
    raw = batch.column("symbols").to_pylist()
    sizes = np.array([len(r) // 3 for r in raw], np.int64)
    group = (np.cumsum(sizes) - 1) // CHUNK
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(raw)]
    for i, j in zip(cuts, cuts[1:], strict=False):
        if j > i:
            yield i, j, unpacked(raw[i:j]), sizes[i:j]


def _names(states: int) -> list[str]:
    return [f"s{s}" for s in range(states)]


def _expect_rows(shared, states: int, apart: bool):
    """Expected counts of one task: rows of symbols, then of states left, the starts
    and (in the first column) the log likelihood, with keys from the smallest integer on;
    any other key is the hash of a word beyond the table. Without ``apart`` symbols are tied."""

    def words(parts: list[tuple]) -> tuple:
        h, g = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(h, kind="stable")
        h, g = h[order], g[order]
        new = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, int)
        return (h[new], np.add.reduceat(g, new)) if len(new) else (h, g)

    def out(key, sums) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(key), *(pa.array(sums[:, s]) for s in range(states))], names=["key", *_names(states)])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, tie = Model(*shared.value[0]), shared.value[1]
        table = len(tie) - CLASSES - 1
        size = len(tie) if apart else len(model.emit)
        total = np.zeros((states, size + states + 2))
        held: list[tuple] = []
        for batch in batches:
            for i, j, symbols, sizes in _parts(batch):
                tied = tie[symbols]
                counted = symbols if apart else tied
                # words beyond the table, in the order of the texts
                place = np.cumsum(symbols >= table) - 1 if apart else None
                found = batch.column("others").slice(i, j - i).flatten().to_numpy() if apart else None

                def add(tokens, gammas):
                    own = counted[tokens]
                    for s in range(states):
                        total[s, :size] += np.bincount(own, weights=gammas[:, s], minlength=size)
                    if apart:
                        beyond = own >= table
                        held.append(words([(found[place[tokens[beyond]]], gammas[beyond])]))

                moves, starts, log = expected_counts(model, lambda tokens: model.emit[tied[tokens]], sizes, add)
                total[:, size:-2] += moves.T
                total[:, -2] += starts
                total[0, -1] += log
                if sum(len(h[0]) for h in held) > FLUSH:
                    held[:] = [words(held)]
                    if len(held[0][0]) > FLUSH // 2:
                        yield out(*held.pop())
        if held:
            yield out(*words(held))
        at = np.flatnonzero(total.any(axis=0))
        yield out(FIRST + at, total.T[at])

    return rows


def _expected(texts: DataFrame, model: Model, tie: np.ndarray, apart: bool) -> DataFrame:
    """(key, s0, ...) of one E-step, summed."""
    states = len(model.start)
    shared = texts.sparkSession.sparkContext.broadcast((tuple(model), tie))
    schema = "key long, " + ", ".join(f"{n} double" for n in _names(states))
    counted = texts.select("symbols", *(["others"] if apart else [])).mapInArrow(_expect_rows(shared, states, apart), schema)
    return counted.groupBy("key").agg(*[F.sum(n).alias(n) for n in _names(states)])


def _totals(rows: DataFrame, size: int, states: int) -> np.ndarray:
    """The counts of symbols, states left, starts and the likelihood: bounded by the table."""
    total = np.zeros((size + states + 2, states))
    got = rows.filter(F.col("key") < FIRST + len(total)).toArrow()
    total[got.column("key").to_numpy() - FIRST] = np.stack([got.column(n).to_numpy() for n in _names(states)], axis=1)
    return total


def _chances(total: np.ndarray, states: int) -> tuple[np.ndarray, np.ndarray]:
    move, start = total[-states - 2 : -2] + 0.1, total[-2] + 0.1
    return start / start.sum(), move / move.sum(axis=1, keepdims=True)


def baum_welch(
    texts: DataFrame, tie: np.ndarray, weights: np.ndarray, units: np.ndarray, rounds: int, states: int = STATES
) -> tuple[Model, list[float]]:
    """A model of tied ``texts`` (symbols), and the log likelihood before every round."""
    model, logs = first_model(weights, states), []
    for _ in range(rounds):
        total = _totals(_expected(texts, model, tie, False), len(weights), states)
        logs.append(float(total[-1, 0]))
        # no symbol becomes impossible
        emit = total[: len(weights)] + (units / states + states * weights / weights.sum())[:, None]
        model = Model(*_chances(total, states), emit / emit.sum(axis=0))
    return model, logs


def all_words(texts: DataFrame, words: Vocabulary, model: Model) -> tuple[Model, np.ndarray, DataFrame]:
    """The round that counts all words apart: a model with a row per symbol, the norm of its
    emissions, and the expected counts of the words beyond the table (h, s0, ...)."""
    states = len(model.start)
    rows = stored(_expected(texts, model, words.tie, True), "expected")
    total = _totals(rows, len(words.tie), states)
    size = len(words.tie)
    # classes hold the sums of their words here, which are counted in the norm
    norm = total[:size].sum(axis=0) + (words.distinct + CLASSES + 1) / states + states
    counts = total[:size].copy()
    counts[len(words.hashes) :] = 0
    emit = (counts + (1 / states + states * words.weights / words.total)[:, None]) / norm
    beyond = rows.filter(F.col("key") >= FIRST + len(total)).withColumnRenamed("key", "h")
    return Model(*_chances(total, states), emit), norm, beyond


def _score_rows(shared, states: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, norm, weight = Model(*shared.value[0]), *shared.value[1:]
        table = len(model.emit) - CLASSES - 1
        for batch in batches:
            n_known, base, score = (np.zeros(batch.num_rows) for _ in range(3))
            for i, j, symbols, sizes in _parts(batch):
                joined = batch.column("beyond").slice(i, j - i).flatten()
                h, first = np.unique(joined.field("h").to_numpy(), return_index=True)
                emit = np.stack([joined.field(c).to_numpy()[first] for c in _names(states)], axis=1)
                n = np.rint(emit.sum(axis=1))  # the states of a word sum to its count
                emit = (emit + (1 / states + states * (n + 1) / weight)[:, None]) / norm
                # a word beyond the table has a row after the model's if it was seen
                place = np.flatnonzero(symbols >= table)
                at = places(h, batch.column("others").slice(i, j - i).flatten().to_numpy())
                place, at = place[at >= 0], at[at >= 0]
                symbols[place] = len(model.emit) + at
                every = np.concatenate([model.emit, emit])
                score[i:j] = log10_likelihood(model, lambda tokens: every[symbols[tokens]], sizes)
                doc = np.repeat(np.arange(j - i), sizes)[place]
                n_known[i:j] = np.bincount(doc, minlength=j - i)
                base[i:j] = np.bincount(doc, weights=np.log10(n[at] + 1.0), minlength=j - i)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in SCORED), pa.array(n_known.astype(np.int64)), pa.array(base), pa.array(score)],
                names=[*SCORED, "more_known", "more", "score"],
            )

    return rows


SCORED = ("doc_id", "held_out", "n_tokens", "n_known", "base")


def vocabulary(docs: DataFrame) -> Vocabulary:
    """Of the training documents (text)."""
    counts = stored(
        docs.select("text").mapInArrow(_count_rows, "h long, class int, n long").groupBy("h").agg(F.first("class").alias("class"), F.sum("n").alias("n")),
        "counts",
    )
    by_class = counts.groupBy("class").agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("tokens")).collect()
    words, tokens = np.zeros(CLASSES + 1, np.int64), np.zeros(CLASSES + 1, np.int64)
    for r in by_class:
        words[r["class"]], tokens[r["class"]] = r["words"], r["tokens"]
    table = most_frequent(counts, TABLE, "h").toArrow()
    # every text ends: the end is in the table however rare it is
    end = counts.filter(F.col("h") == int(np.array([END], np.uint64).view(np.int64)[0])).toArrow()
    if end.num_rows and not pc.is_in(end["h"], table["h"].combine_chunks())[0].as_py():
        table = pa.concat_tables([table, end.select(table.column_names).cast(table.schema)])
    drop(counts)
    return Vocabulary(table, words, tokens)


def score_texts(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of
    every document; learned from those whose fold is not 2, in one round at least."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (remainder(7) == 2).alias("held_out"))
    words = vocabulary(docs.filter("not held_out"))
    shared = spark.sparkContext.broadcast(words.shipped())
    encoded = stored(docs.withColumn("rid", F.monotonically_increasing_id()).mapInArrow(_encode_rows(shared), ENCODED), "encoded")
    train = encoded.filter("not held_out")
    tied, _ = baum_welch(train, words.tie, words.tied_weights, words.tied_units, max(rounds, 1) - 1)
    model, norms, beyond = all_words(train, words, tied)

    # words beyond the table: their expected counts come through a join, once per document and word
    names = ["h", *_names(STATES)]
    joined = (
        encoded.select("rid", F.explode(F.array_distinct("others")).alias("h"))
        .join(beyond, "h")
        .groupBy("rid")
        .agg(F.collect_list(F.struct(*names)).alias("beyond"))
    )
    scored = (
        encoded.join(joined, "rid", "left")
        .select(*SCORED, "symbols", "others", "beyond")
        .mapInArrow(
            _score_rows(spark.sparkContext.broadcast((tuple(model), norms, words.total)), STATES),
            "doc_id long, held_out boolean, n_tokens long, n_known long, base double, more_known long, more double, score double",
        )
    )
    norm = float(np.log10(words.tokens + words.distinct + 1.0))
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.col("more_known")).alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("more") - F.col("n_tokens") * F.lit(norm)).alias("base_score"),
        "score",
    )
