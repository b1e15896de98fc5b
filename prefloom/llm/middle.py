"""Fill-in-middle: texts rearranged around two cuts, and rebuilt from the rearranged text.

A text is cut into units, a word with the white space before it, the white space at the
end being one more. Two of them, chosen by the checksum of ``seed:doc_id``, bound the
middle. The rearranged text (form ``psm`` or ``spm``) has a mark before each of its parts;
a ``plain`` one is the text itself.

Method: every text is emitted as pieces of at most ``UNITS`` units and ``PIECE`` bytes, keyed
by row and place in the output. One shuffle by row and a sort by place bring the pieces of a
text into one stream, which goes into an incremental digest while the marks are looked up in it
again. What lies between them gets its place in the text: up to ``HELD`` bytes of a text are put in order
and digested where they are; the parts of a longer one go through a second sort, within the same
partitions and so without a shuffle, which streams the restored text into the second digest. No task
holds more of a text than that and one batch of pieces.

Defined results: a null text is an empty one; an empty text is plain with 0 units; a null doc_id
counts as empty text in the checksum; equal rows are kept apart and give equal results; a
text without a space is one unit and travels in pieces all the same; an empty table gives an empty
result. Only doc_id and text are read, so other columns can have any name. Rows are told apart by
their place in the input, which therefore has to be a stored table or something else that gives
the same partitions when it is computed again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefloom.llm.words import slices, split_words, text_bytes

SEED = 42
RATE = 50  # per cent of the texts that are rearranged
SPM_RATE = 80  # per cent of these that begin with the suffix
UNITS = 4096  # units in one piece
PIECE = 1 << 18  # bytes in one piece
BATCH = 1 << 22  # bytes of pieces handed on at a time
HELD = 1 << 20  # bytes of a text that a task holds to restore it

PREFIX, MIDDLE, SUFFIX, END = range(4)  # order of the parts in the text; END follows them
MARKS = {PREFIX: b"<P>", SUFFIX: b"<S>", MIDDLE: b"<M>"}
FORMS = {"plain": (), "psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}

ABOUT = [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())]
PIECES = pa.schema([("rid", pa.int64()), ("place", pa.int32()), *ABOUT, ("data", pa.binary())])
PARTS = pa.schema([("rid", pa.int64()), ("part", pa.int32()), ("at", pa.int32()), *ABOUT, ("restored", pa.string()), ("data", pa.binary())])
TEXTS = pa.schema([*ABOUT, ("output", pa.string())])
RESULT = pa.schema([*ABOUT, ("output_sha256", pa.string()), ("restored_sha256", pa.string())])


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def _batches(rows: Iterator[tuple], schema: pa.Schema, data: int) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about ``BATCH`` bytes; ``data`` is the column that holds them."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + len(row[data] or b"")
        if size >= BATCH:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _pieces(text: bytes, ends: list[int], first: int, last: int) -> Iterator[bytes]:
    """Units ``first`` to ``last`` of a text, whose units end at ``ends``; never cut inside a character."""
    for u in range(first, last, UNITS):
        a, stop = (ends[u - 1] if u else 0), ends[min(u + UNITS, last) - 1]
        while a < stop:
            b = min(a + PIECE, stop)
            while b < stop and text[b] & 0xC0 == 0x80:
                b -= 1
            yield text[a:b]
            a = b


def _chars(text: np.ndarray) -> int:
    return int(np.count_nonzero((text & 0xC0) != 0x80))


def _emitted(rids, ids, texts: pa.Array, seed: int, rate: int, spm_rate: int) -> Iterator[tuple]:
    data, offsets = text_bytes(texts)
    words = split_words(texts, hashed=False)
    for k, (rid, doc_id) in enumerate(zip(rids, ids)):
        low, high = int(offsets[k]), int(offsets[k + 1])
        ends = (words.ends[words.first[k] : words.first[k + 1]] - low).tolist()
        if high > low and (not ends or ends[-1] < high - low):
            ends.append(high - low)
        text, n = data[low:high].tobytes(), len(ends)
        digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
        if not text or h[2] % 100 >= rate or any(mark in text for mark in MARKS.values()):
            form, about = "plain", (None, None)
            parts = [(b"", 0, n)]
        else:
            a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
            form = "spm" if h[3] % 100 < spm_rate else "psm"
            bounds = {PREFIX: (0, a), MIDDLE: (a, b), SUFFIX: (b, n)}
            parts = [(MARKS[p], *bounds[p]) for p in FORMS[form]]
            at = [low + (ends[u - 1] if u else 0) for u in (a, b)]
            about = _chars(data[low : at[0]]), _chars(data[at[0] : at[1]])
        place = 0
        for mark, first, last in parts:
            for piece in _pieces(text, ends, first, last) if last > first else [b""]:
                head = (doc_id, n, form, *about) if place == 0 else (None,) * 5
                yield (rid, place, *head, mark + piece)
                mark, place = b"", place + 1


def pieces(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """(rid, place, doc_id, n, form, prefix_chars, middle_chars, data): the pieces of every output,
    in no order; the first of each text says what the others leave null."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            row for batch in batches for part in slices(batch)
            for row in _emitted(part["rid"].to_pylist(), part["doc_id"].to_pylist(), part["text"], seed, rate, spm_rate)
        )
        yield from _batches(rows, PIECES, len(PIECES) - 1)

    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(emit, _ddl(PIECES))


def assembled(emitted: DataFrame) -> DataFrame:
    """The pieces of a text one after another, in one partition."""
    return emitted.repartition("rid").sortWithinPartitions("rid", "place")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        # a batch can be large: only a slice of it becomes Python objects at a time
        for part in slices(batch, "data"):
            yield from zip(*(c.to_pylist() for c in part.columns))


def transformed(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output): the rearranged texts as strings."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def texts() -> Iterator[tuple]:
            head, held = None, []
            for _, place, *about, data in _rows(batches):
                if place == 0:
                    if head is not None:
                        yield (*head, b"".join(held).decode())
                    head, held = about, []
                held.append(data)
            if head is not None:
                yield (*head, b"".join(held).decode())

        yield from _batches(texts(), TEXTS, len(TEXTS) - 1)

    return assembled(pieces(docs, **options)).mapInArrow(join, _ddl(TEXTS))


class Restorer:
    """Finds the parts of one output that arrives in pieces."""

    def __init__(self, form: str) -> None:
        self.coming = list(FORMS[form])
        self.part = PREFIX if form == "plain" else None
        self.tail = b""

    def feed(self, data: bytes) -> Iterator[tuple[int, bytes]]:
        data = self.tail + data
        while self.coming and (k := data.find(MARKS[self.coming[0]])) >= 0:
            if k:
                yield self.part, data[:k]
            mark = MARKS[self.coming[0]]
            self.part, data = self.coming.pop(0), data[k + len(mark) :]
        # the next mark may have begun in the last two bytes
        keep = min(len(data), 2) if self.coming else 0
        self.tail = data[len(data) - keep :]
        if len(data) > keep:
            yield self.part, data[: len(data) - keep]


def _to_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Outputs into their digests; texts of up to ``HELD`` bytes into their second digest, the
    bytes of longer ones under their places in the text."""

    def parts() -> Iterator[tuple]:
        rid, none = None, (None,) * (len(ABOUT) + 1)
        for row in _rows(batches):
            if row[1] == 0:
                if rid is not None:
                    yield ended(rid, about, digest, held)
                rid, about, digest, at, held, size = row[0], row[2:-1], hashlib.sha256(), 0, [], 0
                restorer = Restorer(row[4])
            digest.update(row[-1])
            for found in restorer.feed(row[-1]):
                size += len(found[1])
                ready = [found]
                if held is not None:
                    held.append(found)
                    ready, held = ([], held) if size <= HELD else (held, None)
                for part, data in ready:
                    yield (rid, part, at, *none, data)
                    at += 1
        if rid is not None:
            yield ended(rid, about, digest, held)

    def ended(rid, about, digest, held) -> tuple:
        restored = None
        if held is not None:
            in_order = sorted(held, key=lambda found: found[0])
            restored = hashlib.sha256(b"".join(data for _, data in in_order)).hexdigest()
        return (rid, END, 0, *about, restored, digest.hexdigest().encode())

    yield from _batches(parts(), PARTS, len(PARTS) - 1)


def _to_result(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def results() -> Iterator[tuple]:
        digest = hashlib.sha256()
        for row in _rows(batches):
            if row[1] != END:
                digest.update(row[-1])
                continue
            yield (*row[3:-2], row[-1].decode(), digest.hexdigest() if row[-2] is None else row[-2])
            digest = hashlib.sha256()

    yield from _batches(results(), RESULT, len(RESULT) - 1)


def middle_report(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """Per document its units, form, sizes of prefix and middle, and the digests of the
    output and of the text rebuilt from output and form."""
    parts = assembled(pieces(docs, seed, rate, spm_rate)).mapInArrow(_to_parts, _ddl(PARTS))
    # all pieces of a text are in one partition already
    return parts.sortWithinPartitions("rid", "part", "at").mapInArrow(_to_result, _ddl(RESULT))
