"""Document fingerprints by one-permutation MinHash.

The shingles of a text (five words; a shorter text is one shingle) are hashed
once. The leading bits of a hash choose its bin, the smallest hash of a bin is
kept, and an empty bin takes the value of the first filled bin in an order of
bins that is its own and the same for all texts (densification in which every
filled bin is equally likely). Of each bin's value, mixed with the bin's number, the
``BITS`` low-order bits are packed into a hexadecimal string. Two random bins agree in them with probability
``2 ** -BITS``, which the likeness takes out again.

Defined results: a null text is an empty one, an empty text (no word) has the
fingerprint ``""``; two empty fingerprints have likeness 1, one empty one 0.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from prefloom.llm.tables import stored
from prefloom.llm.words import ODD, mix, shingles, slices, split_words

BINS = 512
BITS = 4
SHINGLE = 5


def bin_orders(bins: int = BINS) -> np.ndarray:
    """For every bin the order in which it looks at the bins."""
    keys = mix(np.arange(bins * bins, dtype=np.uint64) * np.uint64(ODD)).reshape(bins, bins)
    return np.argsort(keys, axis=1, kind="stable").astype(np.int16)


def fingerprints(texts: pa.Array, orders: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """One row of BINS small values per text; the first is -1 where there is no word."""
    hashes, first = shingles(split_words(texts), SHINGLE)
    hashes = mix(hashes ^ np.uint64(ODD))
    n, bins = len(first) - 1, orders.shape[0]
    shift = np.uint64(64 - (bins - 1).bit_length())
    least = np.zeros((n, bins), dtype=np.uint64)
    for i in range(n):
        own = np.sort(hashes[first[i] : first[i + 1]])
        if not len(own):
            continue
        at = (own >> shift).astype(np.int64)
        new = np.ones(len(at), dtype=bool)
        new[1:] = at[1:] != at[:-1]
        filled, row = at[new], least[i]
        row[filled] = own[new]
        has = np.zeros(bins, dtype=bool)
        has[filled] = True
        empty = np.flatnonzero(~has)
        if len(filled) <= 48:  # the filled bin that comes first in each empty bin's order
            if len(empty):
                row[empty] = row[filled[ranks[empty[:, None], filled[None, :]].argmin(axis=1)]]
            continue
        for step in range(bins):
            if not len(empty):
                break
            donor = orders[empty, step]
            hit = has[donor]
            row[empty[hit]] = row[donor[hit]]
            empty = empty[~hit]
    # bits depend on the bin too, else two values that agree in them by chance would do
    # so in every bin they were copied to
    salt = mix(np.arange(1, bins + 1, dtype=np.uint64))
    out = (mix(least ^ salt) & np.uint64((1 << BITS) - 1)).astype(np.int16)
    out[first[1:] == first[:-1]] = -1
    return out


def to_hex(values: np.ndarray) -> list[str]:
    """Packed low-order bits as hexadecimal text, four bits a digit."""
    digits = np.frombuffer(b"0123456789abcdef", dtype=np.uint8)
    text = digits[np.clip(values, 0, 15)]
    return ["" if v[0] < 0 else t.tobytes().decode() for v, t in zip(values, text, strict=True)]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of rows, without the chance agreement of few bits."""
    chance = 2.0**-BITS
    share = (a == b).mean(axis=1)
    value = np.clip((share - chance) / (1 - chance), 0.0, 1.0)
    empty_a, empty_b = a[:, 0] < 0, b[:, 0] < 0
    return np.where(empty_a | empty_b, (empty_a & empty_b).astype(float), value)


def _edited(text: str, after: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string,"
    " edited_fingerprint string, near_edited double, near_next double"
)
EDGES = RESULT + ", kind int, pid int, text string"
OWN, FIRST, LAST = 0, 1, 2  # a finished row; the first and the last row of a task


class _Compare:
    """Fingerprints of texts, of their edited forms and likenesses, batch by batch."""

    def __init__(self):
        self.orders = bin_orders()
        self.ranks = np.argsort(self.orders, axis=1).astype(np.int16)

    def prints(self, texts: list[str]) -> np.ndarray:
        return fingerprints(pa.array(texts, pa.large_string()), self.orders, self.ranks)

    def rows(self, ids: list, texts: list[str], own: np.ndarray) -> dict[str, list]:
        """Results for all rows but the last; each row's next document follows it."""
        edited = [_edited(t, a) for t, a in zip(texts, texts[1:], strict=False)]
        other = self.prints(edited)
        return {
            "doc_id": ids[:-1],
            "n_chars": [len(t) for t in texts[:-1]],
            "edited_sha256": [hashlib.sha256(e.encode()).hexdigest() for e in edited],
            "fingerprint": to_hex(own[:-1]),
            "edited_fingerprint": to_hex(other),
            "near_edited": likeness(own[:-1], other).tolist(),
            "near_next": likeness(own[:-1], own[1:]).tolist(),
        }


def _sorted_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of one sorted partition, and its first and last row."""
    compare, schema, pid = _Compare(), _arrow(EDGES), TaskContext.get().partitionId()
    ids, texts, prints = [], [], np.zeros((0, BINS), dtype=np.int16)
    for whole in batches:
        for batch in slices(whole):
            new = [t or "" for t in batch.column("text").to_pylist()]
            if not texts:
                yield _edge(schema, batch.column("doc_id")[0].as_py(), FIRST, pid, new[0])
            ids, texts = ids + batch.column("doc_id").to_pylist(), texts + new
            prints = np.concatenate([prints, compare.prints(new)])
            done = compare.rows(ids, texts, prints)
            n = len(done["doc_id"])
            done |= {"kind": [OWN] * n, "pid": [pid] * n, "text": [None] * n}
            yield pa.RecordBatch.from_pydict(done, schema=schema)
            ids, texts, prints = ids[-1:], texts[-1:], prints[-1:]
    if texts:
        yield _edge(schema, ids[0], LAST, pid, texts[0])


def _edge(schema: pa.Schema, doc_id, kind: int, pid: int, text: str) -> pa.RecordBatch:
    row = dict.fromkeys(schema.names) | {"doc_id": doc_id, "kind": kind, "pid": pid, "text": text}
    return pa.RecordBatch.from_pylist([row], schema=schema)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of rows that come with the text after theirs."""
    compare, schema = _Compare(), _arrow(RESULT)
    for batch in batches:
        for row in batch.to_pylist():
            texts = [row["text"], row["after"]]
            done = compare.rows([row["doc_id"], None], texts, compare.prints(texts))
            yield pa.RecordBatch.from_pydict(done, schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def compare_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of all documents (doc_id, text), of their edited texts and the
    likeness to the edited text and to the next document.

    The next document follows in descending doc_id (null last, equal ids by a hash of the text),
    after the last comes the first. Documents are dealt by ranges of doc_id, so
    neighbours meet without a window over all rows; only the first and last row of
    each partition are matched afterwards, one pair per partition. Equal rows give
    equal fingerprints; columns other than doc_id and text are not used. An empty
    table gives an empty result.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # ranges are found from samples of the key, which therefore holds no text
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    made = stored(
        narrow.repartitionByRange(*order).sortWithinPartitions(*order, "text").mapInArrow(_sorted_rows, EDGES),
        "fingerprints",
    )
    names = [c.split()[0] for c in RESULT.split(", ")]
    # one first and one last row per partition: the next partition's first row follows a last row
    edges = made.filter(F.col("kind") != OWN).select("kind", "pid", "doc_id", "text")
    order, everything = Window.orderBy("pid"), Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = edges.filter(F.col("kind") == FIRST).select(
        "pid", F.coalesce(F.lead("text").over(order), F.first("text").over(everything)).alias("after")
    )
    lasts = edges.filter(F.col("kind") == LAST).join(firsts, "pid").select("doc_id", "text", "after")
    return made.filter(F.col("kind") == OWN).select(*names).union(lasts.mapInArrow(_pairs, RESULT))
