"""Language identification: known words first, then shorter and shorter n-grams.

A word is a run of letters, in lower case. Words and the character n-grams of all
words (with marks at both ends) are counted per language over all labelled
training documents, pre-aggregated in every task; all counts are the model. The
``WORDS`` most frequent words and the ``GRAMS`` most frequent n-grams are broadcast
(a bound, not a cut: the counts of all others come through a join). A known word adds
its log frequency per language. A word not known is
taken in n-grams of ``LONGEST`` characters; if the model knows none of them, of
one character less, and so on. The language with the largest sum wins, ties go to
the first name; ``score`` is its posterior probability.

Defined results: ``und`` with score 0 for a null text, a text without a letter, or
where nothing could be learned; rows without lang or text train nothing; repeated rows
count as often as they occur; other columns are carried by ``predict`` only where
named. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefloom.llm.folds import remainder
from prefloom.llm.tables import most_frequent, stored
from prefloom.llm.words import slices

WORDS = 150_000
GRAMS = 40_000
LONGEST = 5
SMOOTH = 0.5
FLUSH = 200_000  # distinct (language, word) pairs a task holds while counting
LETTERS = r"[^\W\d_]+"


class _Held:
    """Counts per language of one task, given out when there are many."""

    def __init__(self, name: str):
        self.name, self.held = name, defaultdict(Counter)

    def full(self) -> bool:
        return sum(map(len, self.held.values())) > FLUSH

    def flush(self) -> pa.RecordBatch:
        lang = [k for k, c in self.held.items() for _ in c]
        unit = [u for c in self.held.values() for u in c]
        n = [x for c in self.held.values() for x in c.values()]
        self.held.clear()
        columns = [pa.array(lang, pa.string()), pa.array(unit, pa.string()), pa.array(n, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["lang", self.name, "n"])


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n) of the rows of one task."""
    find, counts = re.compile(LETTERS).findall, _Held("word")
    for whole in batches:
        for batch in slices(whole):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                counts.held[lang].update(find(text.lower()))
            if counts.full():
                yield counts.flush()
    yield counts.flush()


def grams_of(word: str, n: int) -> list[str]:
    marked = f"<{word}>" if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def _gram_counts(longest: int):
    """(lang, gram, n) of the counted words of one task."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Held("gram")
        for batch in batches:
            for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "word", "n")), strict=True):
                held = counts.held[lang]
                for size in range(1, longest + 1):
                    for gram in grams_of(word, size):
                        held[gram] += n
            if counts.full():
                yield counts.flush()
        yield counts.flush()

    return rows


class Model:
    """Log frequencies per language of the known words and n-grams. ``rest`` has the stored
    counts where not all fit in here; ``norms`` the denominators of words and n-grams."""

    def __init__(self, langs: list[str], words: list[str], word_logs: np.ndarray, grams: list[str], gram_logs: np.ndarray, norms: tuple[np.ndarray, np.ndarray], rest: tuple[DataFrame, DataFrame] | None):
        self.langs, self.words, self.word_logs = langs, words, word_logs
        self.grams, self.gram_logs = grams, gram_logs
        self.norms, self.rest, self.whole = norms, rest, rest is None

    def __getstate__(self) -> dict:
        """Tasks get all but the tables."""
        return self.__dict__ | {"rest": None}


def _logs(table: pa.Table | pa.RecordBatch, langs: list[str], norm: np.ndarray) -> np.ndarray:
    """Logs per language of the rows (lang list, n list)."""
    counts = np.zeros((table.num_rows, len(langs)))
    place = {lang: i for i, lang in enumerate(langs)}
    for i, (ls, ns) in enumerate(zip(table.column("langs").to_pylist(), table.column("ns").to_pylist(), strict=True)):
        counts[i, [place[x] for x in ls]] = ns
    return np.log((counts + SMOOTH) / norm).astype(np.float32)


def _units(counted: DataFrame, name: str) -> DataFrame:
    """All units with their counts per language, stored."""
    by_lang = counted.repartition(name).groupBy("lang", name).agg(F.sum("n").alias("n"))
    units = by_lang.groupBy(name).agg(F.sum("n").alias("n"), F.collect_list("lang").alias("langs"), F.collect_list("n").alias("ns"))
    return stored(units, f"{name}s")


def _by_lang(units: DataFrame, name: str) -> DataFrame:
    return units.select(name, F.inline(F.arrays_zip("langs", "ns"))).toDF(name, "lang", "n")


def train(docs: DataFrame, words: int = WORDS, grams: int = GRAMS, longest: int = LONGEST) -> Model:
    """A model of all documents (text, lang) that have both."""
    labelled = docs.filter("text is not null and lang is not null").select("lang", "text")
    counts = _units(labelled.mapInArrow(_word_counts, "lang string, word string, n long"), "word")
    parts = _units(_by_lang(counts, "word").select("lang", "word", "n").mapInArrow(_gram_counts(longest), "lang string, gram string, n long"), "gram")
    totals = {r.lang: r.n for r in _by_lang(counts, "word").groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs, found = sorted(totals), []
    for units, name, keep in ((counts, "word", words), (parts, "gram", grams)):
        sizes = totals if name == "word" else {r.lang: r.n for r in _by_lang(units, name).groupBy("lang").agg(F.sum("n").alias("n")).collect()}
        distinct = units.count()
        norm = np.array([sizes.get(lang, 0) for lang in langs], dtype=float) + SMOOTH * (distinct + 1)
        table = most_frequent(units, keep, name).select(name, "langs", "ns").toArrow()
        found.append((table.column(name).to_pylist(), _logs(table, langs, norm), norm, distinct > table.num_rows))
    (known, word_logs, word_norm, more), (pieces, gram_logs, gram_norm, more_grams) = found
    return Model(langs, known, word_logs, pieces, gram_logs, (word_norm, gram_norm), (counts, parts) if more or more_grams else None)


class Scorer:
    """Scores of texts; the unseen words of a slice are backed off together, or
    left for the join if the model is not whole."""

    def __init__(self, model: Model, longest: int = LONGEST):
        self.langs, self.longest, self.whole = model.langs, longest, model.whole
        self.grams = {g: i for i, g in enumerate(model.grams)}
        self.place = {w: i for i, w in enumerate(model.words)}
        self.word_logs, self.gram_logs = model.word_logs, model.gram_logs
        self.find = re.compile(LETTERS).findall

    def backoff(self, words: list[str]) -> np.ndarray:
        """Per word the mean of its longest known n-grams, 0 if there are none."""
        out = np.zeros((len(words), len(self.langs)))
        flat, sizes, rows = [], [], []
        get = self.grams.get
        for row, word in enumerate(words):
            for n in range(self.longest, 0, -1):
                found = [g for g in map(get, grams_of(word, n)) if g is not None]
                if found:
                    flat += found
                    sizes.append(len(found))
                    rows.append(row)
                    break
        if rows:
            size = np.array(sizes)
            sums = np.add.reduceat(self.gram_logs[flat].astype(float), np.cumsum(size) - size)
            out[rows] = sums / size[:, None]
        return out

    def sums(self, texts: list[str | None]) -> tuple[list[bool], np.ndarray, tuple[np.ndarray, list[str], np.ndarray]]:
        """Whether a text has letters, its sums per language, and what is left for the
        join: text, word and times."""
        words = [self.find(t.lower()) if t and self.langs else [] for t in texts]
        flat = [w for own in words for w in own]
        unseen: dict[str, int] = {}
        known = len(self.place)
        get = self.place.get
        at = np.fromiter((p if (p := get(w)) is not None else known + unseen.setdefault(w, len(unseen)) for w in flat), np.int64, len(flat))
        logs = np.zeros((len(flat), len(self.langs)))
        seen = at < known
        logs[seen] = self.word_logs[at[seen]]
        doc = np.repeat(np.arange(len(texts)), [len(own) for own in words])
        left = (np.zeros(0, np.int64), [], np.zeros(0, np.int64))
        if self.whole:
            logs[~seen] = self.backoff(list(unseen))[at[~seen] - known]
        elif unseen:
            pairs, times = np.unique(doc[~seen] * len(unseen) + at[~seen] - known, return_counts=True)
            names = list(unseen)
            left = pairs // len(unseen), [names[i] for i in pairs % len(unseen)], times
        total = np.zeros((len(texts), len(self.langs)))
        for i in range(len(self.langs)):
            total[:, i] = np.bincount(doc, weights=logs[:, i], minlength=len(texts))
        return [any(c.isalpha() for w in own for c in w) for own in words], total, left

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out = []
        letters, total, _ = self.sums(texts)
        for i, has in enumerate(letters):
            if not has:
                out.append(("und", 0.0))
                continue
            best = int(total[i].argmax())
            out.append((self.langs[best], float(1 / np.exp(total[i] - total[i][best]).sum())))
        return out


def _lists(values: np.ndarray) -> pa.ListArray:
    """Every row of a table of numbers as a list."""
    rows, n = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * n), pa.array(np.ascontiguousarray(values, dtype=float).ravel()))


def _sum_rows(shared, keep: tuple[str, ...]):
    """Sums over the words of the model, and the other words of every document."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for whole in batches:
            for batch in slices(whole):
                letters, total, (doc, words, times) = scorer.sums(batch.column("text").to_pylist())
                cuts = np.searchsorted(doc, np.arange(batch.num_rows + 1)).astype(np.int32)
                items = pa.StructArray.from_arrays([pa.array(words, pa.string()), pa.array(times, pa.int64())], names=["word", "times"])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in keep), batch.column("rid"), pa.array(letters, pa.bool_()), _lists(total), pa.ListArray.from_arrays(pa.array(cuts), items)],
                    names=[*keep, "rid", "letters", "sums", "others"],
                )

    return rows


def _log_rows(langs: list[str], norm: np.ndarray, *keep: str):
    """The columns ``keep`` of counted units, and the logs per language."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), _lists(_logs(batch, langs, norm))], names=[*keep, "logs"])

    return rows


def _backoff_rows(shared, longest: int):
    """(word, size, gram, times, logs) of words not known: the n-grams to look up, and in one row
    without gram those of the model with the sum of their logs. Sizes below one that is known are not needed."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        get = scorer.grams.get
        for batch in batches:
            out: list[tuple] = []
            for word in batch.column("word").to_pylist():
                for size in range(longest, 0, -1):
                    own = grams_of(word, size)
                    found = [g for g in map(get, own) if g is not None]
                    out += [(word, size, g, n, None) for g, n in Counter(own).items() if get(g) is None]
                    if found:
                        out.append((word, size, None, len(found), scorer.gram_logs[found].astype(float).sum(axis=0)))
                        break
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = (pa.string(), pa.int32(), pa.string(), pa.int64(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["word", "size", "gram", "times", "logs"])

    return rows


def _added(langs: list[str], times: str | None = None) -> Column:
    """Sum of the lists ``logs``, each taken ``times``."""
    return F.array(*[F.sum(F.col("logs")[i] * (F.col(times) if times else F.lit(1))) for i in range(len(langs))])


def _word_logs(words: DataFrame, model: Model, shared, longest: int) -> DataFrame:
    """(word, logs) of words beyond the broadcast ones: from the stored counts, or backed off to n-grams."""
    counts, parts = model.rest
    counted = stored(words.join(counts.select("word", "langs", "ns"), "word", "left"), "others")
    known = counted.filter("langs is not null").mapInArrow(_log_rows(model.langs, model.norms[0], "word"), "word string, logs array<double>")
    pieces = counted.filter("langs is null").select("word").mapInArrow(
        _backoff_rows(shared, longest), "word string, size int, gram string, times long, logs array<double>"
    )
    pieces = stored(pieces, "pieces")
    looked = (
        pieces.filter("gram is not null").select("word", "size", "gram", "times")
        .join(parts.select("gram", "langs", "ns"), "gram")
        .mapInArrow(_log_rows(model.langs, model.norms[1], "word", "size", "times"), "word string, size int, times long, logs array<double>")
        .withColumn("logs", F.transform("logs", lambda x: x * F.col("times")))
    )
    sizes = (
        looked.unionByName(pieces.filter("gram is null").select("word", "size", "times", "logs"))
        .groupBy("word", "size").agg(F.sum("times").alias("times"), _added(model.langs).alias("logs"))
    )
    longer = sizes.groupBy("word").agg(F.max_by(F.struct("times", "logs"), "size").alias("x"))
    return known.unionByName(longer.select("word", F.transform("x.logs", lambda x: x / F.col("x.times")).alias("logs")))


def predict(docs: DataFrame, model: Model, *keep: str, longest: int = LONGEST) -> DataFrame:
    """The columns ``keep`` of ``docs`` with lang_pred and score for ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(*keep, "text")
    schema = source.drop("text").schema.add("lang_pred", "string").add("score", "double")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value, longest)
        for whole in batches:
            for batch in slices(whole):
                found = scorer.predict(batch.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in keep), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                    names=[*keep, "lang_pred", "score"],
                )

    if model.whole:
        return source.mapInArrow(rows, schema)

    summed = source.drop("text").schema.add("rid", "long").add("letters", "boolean").add("sums", T.ArrayType(T.DoubleType()))
    summed = summed.add("others", T.ArrayType(T.StructType().add("word", "string").add("times", "long")))
    numbered = source.withColumn("rid", F.monotonically_increasing_id())
    encoded = stored(numbered.mapInArrow(_sum_rows(shared, keep), summed), "sums")
    others = encoded.select("rid", F.inline("others"))
    logs = _word_logs(others.select("word").distinct(), model, shared, longest)
    more = others.join(logs, "word").groupBy("rid").agg(_added(model.langs, "times").alias("more"))
    nothing = F.array_repeat(F.lit(0.0), len(model.langs))
    total = encoded.join(more, "rid", "left").select(
        *keep, "letters", F.zip_with("sums", F.coalesce("more", nothing), lambda x, y: x + y).alias("total")
    )
    best = total.withColumn("best", F.array_max("total"))
    lang = F.element_at(F.array(*map(F.lit, model.langs)), F.array_position("total", F.col("best")).cast("int"))
    score = 1 / F.aggregate("total", F.lit(0.0), lambda held, x: held + F.exp(x - F.col("best")))
    return best.select(
        *keep, F.when(F.col("letters"), lang).otherwise("und").alias("lang_pred"), F.when(F.col("letters"), score).otherwise(0.0).alias("score")
    )


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document; learned from
    those whose fold is not 1."""
    docs = docs.select("doc_id", "text", "lang", (remainder(3) == 1).alias("held_out"))
    return predict(docs, train(docs.filter("not held_out")), "doc_id", "held_out")
