"""Substring deduplication with suffix automata over shards of reference passages.

A window is ``window`` consecutive words. Every word is removed that a window
covers whose word sequence starts anywhere else, in another document or the same.

Streaming every document through an automaton of everything else grows with the
square of the corpus, so the reference is first cut down to passages that can
repeat and dealt into shards, and a document meets only the shards it can match:

1. Anchors. Of the ``window - ANCHOR + 1`` runs of ``ANCHOR`` words in a window
   the one with the smallest hash is its anchor. Equal windows have equal
   anchors, so a window without a repeated anchor is not repeated. Only anchors,
   about two in thirty words, are counted over the corpus.
2. Passages. The consecutive windows of a document with one anchor make a
   passage. Equal passages are counted, one of them gives its words. Anchors so
   frequent that their passages would crowd one shard (at most ``HOT_LIST`` of
   them) are taken window by window instead; equal windows collapse in partial
   aggregation.
3. Shards. Passages are dealt by anchor and packed into shards of about
   ``SHARD_WORDS`` words. Each shard builds one suffix automaton whose states
   count occurrences, and streams its passages for matching statistics capped at
   the window: an end where the state of the last ``window`` words occurs twice
   ends a repeated window.
4. The maximal spans go back to all documents that hold the passage.

Words are compared by 64-bit hashes. Defined results: a null or empty text has no
words and keeps the empty text; repeated rows (also with one doc_id) are
occurrences of their own and give one result row each; a null doc_id stays null;
an empty table gives an empty result. Columns other than doc_id and text are not
used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefloom.llm.tables import stored
from prefloom.llm.words import ODD, Words, gram_hashes, mix, powers, slices, split_words

WINDOW = 35
ANCHOR = 8
SHARD_WORDS = 200_000
HOT_LIST = 20_000  # an anchor with over a 20,000th of all anchors is hot, so this many at most
HOT_LEAST = 1_000


class SuffixAutomaton:
    """All substrings of the words added; every state knows how often it occurs."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def _state(self, length: int, edges: dict, link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        self.count.append(0)
        return len(self.next) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        """The state of exactly one word more than ``p``, taken out of ``q``."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words: Iterable[int], weight: int = 1) -> None:
        """A passage that occurs ``weight`` times."""
        last = 0
        for word in words:
            if word in self.next[last]:
                last = self._split(last, word, self.next[last][word])
            else:
                new = self._state(self.length[last] + 1, {}, 0)
                p = last
                while p >= 0 and word not in self.next[p]:
                    self.next[p][word] = new
                    p = self.link[p]
                if p >= 0:
                    self.link[new] = self._split(p, word, self.next[p][word])
                last = new
            self.count[last] += weight

    def close(self) -> SuffixAutomaton:
        """Occurrences of a state include those of all longer ones that end in it."""
        count, link = self.count, self.link
        for state in sorted(range(1, len(count)), key=self.length.__getitem__, reverse=True):
            count[link[state]] += count[state]
        return self

    def repeated_ends(self, words: Iterable[int], window: int, least: int = 2) -> list[int]:
        """Ends (exclusive) of windows that occur ``least`` times: matching
        statistics, with matches cut to the last ``window`` words."""
        edges, link, length, count = self.next, self.link, self.length, self.count
        state, matched, ends = 0, 0, []
        for end, word in enumerate(words, 1):
            while state and word not in edges[state]:
                state = link[state]
                matched = length[state]
            state = edges[state].get(word, 0)
            matched = matched + 1 if state else 0
            while state and length[link[state]] >= window:
                state = link[state]
                matched = min(matched, length[state])
            if matched >= window and count[state] >= least:
                ends.append(end)
        return ends


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Per start the place of the leftmost smallest of ``width`` values."""
    at, size = np.arange(len(values)), 1
    while size < width:
        step = min(size, width - size)
        left, right = at[:-step], at[step:]
        at = np.where(values[right] < values[left], right, left)
        size += step
    return at


class Passages:
    """Per slice: the runs of windows that share an anchor."""

    def __init__(self, words: Words, window: int = WINDOW):
        sizes = np.diff(words.first)
        starts = np.maximum(sizes - window + 1, 0)
        self.doc = np.zeros(0, dtype=np.int64)
        if not starts.any():
            self.anchor = np.zeros(0, dtype=np.uint64)
            self.begin = self.end = self.doc
            return
        grams = gram_hashes(words.hashes, ANCHOR)
        at = sliding_argmin(grams, window - ANCHOR + 1)
        doc = np.repeat(np.arange(len(sizes)), starts)
        start = np.arange(len(doc)) - np.repeat(np.cumsum(starts) - starts, starts) + words.first[:-1][doc]
        place = at[start]
        new = np.ones(len(place), dtype=bool)
        new[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])
        cut = np.flatnonzero(new)
        self.doc, self.anchor = doc[cut], grams[place[cut]]
        self.begin = start[cut]  # first word of the run's first window
        self.end = start[np.append(cut[1:], len(start)) - 1] + window  # behind its last window


def _hash_runs(words: Words, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of runs of words of any length, from differences of one running sum."""
    n = len(words.hashes)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words.hashes * powers(n), dtype=np.uint64)])
    back = powers(n, pow(ODD, -1, 1 << 64))  # ODD ** -begin moves every run to the front
    return mix((total[end] - total[begin]) * back[begin] + (end - begin).astype(np.uint64))


def _anchor_rows(window: int):
    schema = pa.schema([("h", pa.int64()), ("rid", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                found = Passages(split_words(batch.column("text")), window)
                rid = batch.column("rid").to_numpy(zero_copy_only=False)[found.doc]
                yield pa.RecordBatch.from_arrays([pa.array(found.anchor.view(np.int64)), pa.array(rid)], schema=schema)

    return rows


DONE = "doc_id long, n_words long, n_removed long, kept_sha256 string"
HELD = DONE + ", key binary, text string, anchors array<long>"


def _kept(doc_id, text: str | None, spans: list) -> tuple:
    """The result row of one document without the words of ``spans``."""
    words = (text or "").encode().split()  # white space of bytes is exactly x20, x09-x0D
    keep = np.ones(len(words), dtype=bool)
    for begin, end in spans:
        keep[begin:end] = False
    kept = [w for w, k in zip(words, keep, strict=True) if k] if spans else words
    return doc_id, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()


def _hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents without a repeated anchor are finished, the others are held."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]
        + [("key", pa.binary()), ("text", pa.string()), ("anchors", pa.list_(pa.int64()))]
    )
    for whole in batches:
        for batch in slices(whole):
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            held = batch.column("anchors").is_valid().to_pylist()
            done = [
                (i, None, None, None, t) if h else (*_kept(i, t, []), None)
                for i, t, h in zip(ids, texts, held, strict=True)
            ]
            columns = [pa.array([d[j] for d in done], schema.field(j).type) for j in range(4)]
            yield pa.RecordBatch.from_arrays(
                [
                    *columns,
                    batch.column("key"),
                    pa.array([d[4] for d in done], pa.string()),
                    pa.array(batch.column("anchors").to_pylist(), pa.list_(pa.int64())),
                ],
                schema=schema,
            )


def _passage_rows(window: int, hot: np.ndarray):
    """(h, passage, key, begin, size) of every passage with a repeated anchor; of a
    hot anchor every window for itself, under its own hash."""
    schema = pa.schema([(n, pa.int64()) for n in ("h", "passage")] + [("key", pa.binary())] + [(n, pa.int32()) for n in ("begin", "size")])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                words = split_words(batch.column("text"))
                found = Passages(words, window)
                keys = batch.column("key").to_pylist()
                wanted = [np.array(a, dtype=np.int64).view(np.uint64) for a in batch.column("anchors").to_pylist()]
                whole_hash = _hash_runs(words, found.begin, found.end)
                out: list[tuple] = []
                cuts = np.searchsorted(found.doc, np.arange(len(keys) + 1))
                for i, key in enumerate(keys):
                    own = slice(cuts[i], cuts[i + 1])
                    hit = np.isin(found.anchor[own], wanted[i])
                    h, begin, end = found.anchor[own][hit], found.begin[own][hit], found.end[own][hit]
                    runs = whole_hash[own][hit]
                    busy, one = np.isin(h, hot), np.zeros(0, dtype=np.uint64)
                    if busy.any():
                        runs = runs[~busy]  # a window taken alone is its own passage
                        single = np.concatenate([np.arange(b, e - window + 1) for b, e in zip(begin[busy], end[busy], strict=True)])
                        one = gram_hashes(words.hashes[words.first[i] : words.first[i + 1]], window)[single - words.first[i]]
                        h = np.concatenate([h[~busy], one])
                        begin = np.concatenate([begin[~busy], single])
                        end = np.concatenate([end[~busy], single + window])
                    if len(h):
                        out.append((h, np.concatenate([runs, one]), [key] * len(h), begin - words.first[i], end - begin))
                if out:
                    h, p, k, b, s = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate(h).view(np.int64)),
                            pa.array(np.concatenate(p).view(np.int64)),
                            pa.array([x for part in k for x in part], pa.binary()),
                            pa.array(np.concatenate(b).astype(np.int32)),
                            pa.array(np.concatenate(s).astype(np.int32)),
                        ],
                        schema=schema,
                    )

    return rows


def _words_of_passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The word hashes of the passages that stand for all their equals."""
    schema = pa.schema([(n, pa.int64()) for n in ("h", "passage", "n")] + [("words", pa.list_(pa.int64()))])
    for whole in batches:
        for batch in slices(whole):
            words = split_words(batch.column("text"))
            for i, wanted in enumerate(batch.column("wanted").to_pylist()):
                own = words.hashes[words.first[i] : words.first[i + 1]].view(np.int64)
                rows = [
                    {"h": w["h"], "passage": w["passage"], "n": w["n"], "words": own[w["begin"] : w["begin"] + w["size"]]}
                    for w in wanted
                ]
                yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _shards(window: int, shard_words: int):
    """Sorted passages with words, packed into shards; repeated windows of each."""
    schema = pa.schema([("h", pa.int64()), ("passage", pa.int64()), ("spans", pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())])))])

    def judge(shard: list[tuple]) -> Iterator[pa.RecordBatch]:
        automaton = SuffixAutomaton()
        for _, _, n, words in shard:
            automaton.add(words, n)
        automaton.close()
        out = []
        for h, passage, _, words in shard:
            spans: list[dict] = []
            for end in automaton.repeated_ends(words, window):
                if spans and end - window <= spans[-1]["to"]:
                    spans[-1]["to"] = end
                else:
                    spans.append({"from": end - window, "to": end})
            if spans:
                out.append({"h": h, "passage": passage, "spans": spans})
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, size, last = [], 0, None
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                for row in batch.slice(k, 1000).to_pylist():
                    if size >= shard_words and row["h"] != last:  # all passages of an anchor share a shard
                        yield from judge(shard)
                        shard, size = [], 0
                    if shard and (row["h"], row["passage"]) == shard[-1][:2]:
                        continue
                    shard.append((row["h"], row["passage"], row["n"], row["words"]))
                    size, last = size + len(row["words"]), row["h"]
        if shard:
            yield from judge(shard)

    return rows


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in DONE.split(", ")]
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "spans")), strict=True)
        done = [_kept(i, t, [(s["from"], s["to"]) for s in spans or []]) for i, t, spans in rows]
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[j] for d in done], pa.string() if j == 3 else pa.int64()) for j in range(4)], names=names
        )


def remove_repeats(docs: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Per document the words left after removing all repeated windows: doc_id,
    n_words, n_removed and the digest of the kept text (see the module)."""
    if window < ANCHOR:
        raise ValueError(f"a window needs at least {ANCHOR} words")
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.xxhash64("text").alias("rid"),  # may collide: it only chooses candidates
        F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("key"),
    )
    found = stored(docs.select("rid", "text").mapInArrow(_anchor_rows(window), "h long, rid long"), "anchors")
    repeated = stored(found.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "repeated")
    limit = max(HOT_LEAST, found.count() // HOT_LIST)
    hot = np.array([r.h for r in repeated.filter(F.col("n") > limit).collect()], dtype=np.int64).view(np.uint64)

    wanted = found.join(repeated.select("h"), "h").groupBy("rid").agg(F.collect_set("h").alias("anchors"))
    held = stored(
        docs.join(wanted, "rid", "left").select("doc_id", "text", "key", "anchors").mapInArrow(_hold, HELD), "held"
    )
    names = [c.split()[0] for c in DONE.split(", ")]
    some = held.filter(F.col("anchors").isNotNull())

    passages = stored(
        some.select("key", "text", "anchors")
        .mapInArrow(_passage_rows(window, hot), "h long, passage long, key binary, begin int, size int")
        .groupBy("h", "passage", "key", "begin", "size")
        .agg(F.count(F.lit(1)).alias("n")),
        "passages",
    )
    distinct = passages.groupBy("h", "passage").agg(F.sum("n").alias("n"), F.min(F.struct("key", "begin", "size")).alias("at"))
    distinct = distinct.filter("n > 1 or passage <> h")  # a window taken alone repeats as a whole or not at all
    per_text = distinct.groupBy(F.col("at.key").alias("key")).agg(
        F.collect_list(F.struct("h", "passage", "n", F.col("at.begin").alias("begin"), F.col("at.size").alias("size"))).alias("wanted")
    )
    texts = some.select("key", "text").dropDuplicates(["key"])
    verdict = stored(
        texts.join(per_text, "key")
        .mapInArrow(_words_of_passages, "h long, passage long, n long, words array<long>")
        .repartition("h")
        .sortWithinPartitions("h", "passage")
        .mapInArrow(_shards(window, shard_words), "h long, passage long, spans array<struct<from: int, to: int>>"),
        "verdict",
    )
    spans = (
        passages.join(verdict, ["h", "passage"])
        .select("key", F.explode(F.transform("spans", lambda s: F.struct((s["from"] + F.col("begin")).alias("from"), (s["to"] + F.col("begin")).alias("to")))).alias("span"))
        .groupBy("key")
        .agg(F.collect_list("span").alias("spans"))
    )
    cut = some.select("doc_id", "text", "key").join(spans, "key", "left").mapInArrow(_cut, DONE)
    return held.filter(F.col("anchors").isNull()).select(*names).union(cut)
