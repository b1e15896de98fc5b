"""Byte-pair encoding of whole texts, and decoding, with a public tokenizer file.

Ids are those the ``tokenizers`` library gives for the whole text with the same file.

Method for texts of more than ``LONG`` bytes: tree concatenation. A text is cut into leaves of
``LEAF`` bytes wherever that falls, the leaves are dealt over all tasks and encoded there, and ``FAN``
neighbours at a time are joined pairwise. Around a join, a window of tokens of both sides is encoded
again and doubled until it agrees with both: outside the window the sides stay as they are. What
agreement is proof of:

* where a pre-token begins in a side and in the window, everything after depends on what
  follows alone, since the splitting pattern never looks back and ahead by a few characters
  only (``MARGIN`` bytes stay between such a place and the end of what was encoded);
* inside one pre-token longer than the window, as in scripts without spaces, a sequence of
  byte-pair tokens is the encoding if each two neighbours are, so one token that window
  and side have in common at the same place, on each side, is enough.

A window that has grown over both sides is the encoding itself. Within a task, texts and leaves are
cut where a white-space byte follows a character that surely is none, which is always a
border of pre-tokens; each distinct stretch between is encoded once and remembered.

Defined results: a null text is an empty one and has no ids; rows are encoded one by one, so equal
rows, ties and other columns do not matter; the special token's string in a text becomes its id,
as in the library; an empty table gives an empty result. A text is one row, which bounds what the
last join of it holds.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefloom.llm.tables import per_group
from prefloom.llm.words import ranges, slices, text_bytes

FILE = "byte_bpe_50k.json"
LONG = 1 << 15  # bytes from which a text is encoded in leaves
LEAF = 1 << 13
FAN = 64  # leaves joined in one task; three rounds reach any string
ROUNDS = 3
WINDOW = 16  # tokens of each side in the first window
SLICE = 4 << 20  # bytes of text encoded at a time
JOINED = 10_000  # stretches encoded as one text
REMEMBERED = 32 << 20  # bytes, about, of remembered stretches
WHITE = " \t\n\v\f\r"


def tokenizer_file(path: str | None = None) -> str:
    """The text of a tokenizer file; the one this module is checked with by default."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(FILE)
    with open(path, encoding="utf-8") as f:
        return f.read()


class Decoder:
    """The bytes of every id of a byte-level tokenizer file."""

    def __init__(self, source: str) -> None:
        spec = json.loads(source)
        step, self.added = spec["pre_tokenizer"] or {}, spec["added_tokens"]
        if (step.get("type"), step.get("use_regex"), step.get("add_prefix_space")) != ("ByteLevel", True, False) or spec["normalizer"]:
            raise ValueError("a byte-level tokenizer with its pattern and no normaliser is needed")
        if any(a["lstrip"] or a["rstrip"] or a["single_word"] or any(c.isspace() for c in a["content"]) for a in self.added):
            raise ValueError("added tokens that take white space along are not supported")
        alphabet, vocab = _byte_alphabet(), spec["model"]["vocab"]
        self.table = [b""] * (1 + max([*vocab.values(), *(a["id"] for a in self.added)]))
        for token, i in vocab.items():
            self.table[i] = bytes([alphabet[c] for c in token])
        for a in self.added:
            self.table[a["id"]] = a["content"].encode()

        self.kind = np.dtype(np.uint16 if len(self.table) <= 1 << 16 else np.uint32)

    def bytes_of(self, ids) -> bytes:
        return b"".join([self.table[i] for i in ids])

    def text(self, ids) -> str:
        return self.bytes_of(ids).decode("utf-8", "replace")


class Encoder(Decoder):
    """Ids and pre-token borders of texts."""

    def __init__(self, source: str, borders: bool = True) -> None:
        super().__init__(source)
        self.borders = borders
        # Spark's tasks are the threads
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(source)
        self.model.no_truncation()
        self.model.no_padding()
        self.margin = 16 + max((len(a["content"].encode()) for a in self.added), default=0)
        self.sizes = np.array([len(t) for t in self.table], dtype=np.int64)
        # a token that begins inside a character
        self.inner = np.array([bool(t) and t[0] & 0xC0 == 0x80 for t in self.table])
        self.known: dict[str, int] = {}
        self.kept = np.zeros(0, self.kind), np.zeros(0, bool), np.zeros(1, np.int64)
        self.held = 0

    def whole(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and where a pre-token begins, of a text given to the library as it is."""
        return self._got(self.model.encode(text, add_special_tokens=False))

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts in a row, borders (if wanted) and where each text's ids begin."""
        data, offsets = text_bytes(texts)
        cut = _borders(data)
        cut[offsets[offsets < len(data)]] = True
        at = np.append(np.flatnonzero(cut), len(data))
        spans = pa.Array.from_buffers(
            pa.large_string(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
        ).dictionary_encode()
        flat, new, begins, place = self._remembered(spans.dictionary)
        index = place[spans.indices.to_numpy()]
        n = np.diff(begins)[index]
        places = ranges(begins[index], n)
        first = np.concatenate([[0], np.cumsum(n)])[np.searchsorted(at, offsets)]
        return flat[places].astype(np.int32), new[places] if self.borders else new[:0], first

    def _remembered(self, spans: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids and borders of remembered stretches, where each one's begin, and which of them the
        distinct ``spans`` are. The first ones, which the frequent are among, stay remembered."""
        texts = spans.to_pylist()
        place = np.array([self.known.get(t, -1) for t in texts], dtype=np.int64)
        fresh = np.flatnonzero(place < 0)
        if not len(fresh):
            return *self.kept, place
        flat, new, begins = self.kept
        ids, borders, counts = self._encoded([texts[i] for i in fresh], pc.binary_length(spans).to_numpy()[fresh])
        place[fresh] = np.arange(len(fresh)) + len(begins) - 1
        grown = (
            np.concatenate([flat, ids.astype(self.kind)]), np.concatenate([new, borders]),
            np.concatenate([begins, begins[-1] + np.cumsum(counts)]),
        )
        if self.held < REMEMBERED:
            self.kept = grown
            self.known.update(zip([texts[i] for i in fresh], place[fresh].tolist()))
            self.held += 200 * len(fresh) + sum(len(texts[i]) for i in fresh)
        return *grown, place

    def _encoded(self, texts: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids and borders of stretches in a row, and how many ids each has. Those that begin with
        white space and end surely without it can follow each other in one text."""
        joins = np.array([t[0] in WHITE and ("!" <= t[-1] <= "~" or "\xc0" <= t[-1] <= "\xff") for t in texts], dtype=bool)
        ids: list = [None] * len(texts)
        borders: list = [None] * len(texts)
        own, call = np.flatnonzero(joins), self.model.encode_batch if self.borders else self.model.encode_batch_fast
        for k in range(0, len(own), JOINED):
            part = own[k : k + JOINED]
            found, new = self._got(call(["".join([texts[i] for i in part])], add_special_tokens=False)[0])
            cuts = np.searchsorted(np.cumsum(self.sizes[found]), np.cumsum(sizes[part])) + 1
            for i, a, b in zip(part.tolist(), [0, *cuts[:-1].tolist()], cuts.tolist()):
                ids[i] = found[a:b]
                borders[i] = new[a:b]
        alone = np.flatnonzero(~joins).tolist()
        for i, got in zip(alone, call([texts[i] for i in alone], add_special_tokens=False)):
            ids[i], borders[i] = self._got(got)
        counts = np.array([len(x) for x in ids], dtype=np.int64)
        return np.concatenate(ids), np.concatenate(borders), counts

    def _got(self, got) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array(got.ids, dtype=np.int32)
        if not self.borders:
            return ids, np.zeros(0, dtype=bool)
        word = np.array([-1, *got.word_ids], dtype=np.int64)
        return ids, word[1:] != word[:-1]

    def packed(self, ids: np.ndarray, new: np.ndarray) -> tuple[bytes, bytes]:
        return ids.astype(self.kind).tobytes(), np.packbits(new).tobytes()

    def unpacked(self, ids: bytes, new: bytes) -> tuple[np.ndarray, np.ndarray]:
        found = np.frombuffer(ids, dtype=self.kind).astype(np.int32)
        return found, np.unpackbits(np.frombuffer(new, dtype=np.uint8), count=len(found)).astype(bool)

    def join(self, x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The encoding of two texts in a row from the encodings of both."""
        if not len(x[0]) or not len(y[0]):
            return x if len(x[0]) else y
        window = WINDOW
        while True:
            joined = self._agreed(x, y, self._left(x, window), self._right(y, window))
            if joined:
                return joined
            window *= 2

    def _left(self, x, window: int) -> int:
        """Where the window begins in the left side: at a pre-token if one is near, else
        at a character; never nearer to the join than the margin."""
        ids, new = x
        a = max(0, len(ids) - window)
        while a and self.sizes[ids[a:]].sum() < self.margin:
            a -= 1
        near = np.flatnonzero(new[max(0, a - window) : a + 1])
        if len(near):
            return max(0, a - window) + int(near[-1])
        while a and self.inner[ids[a]]:
            a -= 1
        return a

    def _right(self, y, window: int) -> int:
        ids = y[0]
        b = min(len(ids), window)
        while b < len(ids) and (self.inner[ids[b]] or self.sizes[ids[:b]].sum() < 2 * self.margin):
            b += 1
        return b

    def _agreed(self, x, y, a: int, b: int):
        """The joined sides if the window from token ``a`` of the left to token ``b`` of the right agrees with both."""
        (xi, xn), (yi, yn) = x, y
        before, after = xi[a:], yi[:b]
        join = int(self.sizes[before].sum())
        total = join + int(self.sizes[after].sum())
        ids, new = self.whole(self.bytes_of([*before.tolist(), *after.tolist()]).decode())
        ends = np.cumsum(self.sizes[ids])
        starts = ends - self.sizes[ids]
        # left: the window begins where a pre-token does, or inside the last one
        keep, low = a, 0
        if a and not xn[a]:
            borders = np.flatnonzero(new)
            first_end = total if len(borders) < 2 else int(starts[borders[1]])
            if xn[a:].any() or first_end < join:
                return None
            x_ends = np.cumsum(self.sizes[before])
            common = _common(x_ends - self.sizes[before], x_ends, before, starts, ends, ids, 0, join)
            if common is None:
                return None
            keep, low = a + common[0], common[1]
        between = new.copy()
        between[0] = xn[a]
        # right: a pre-token begins at the same place in both, or both lie inside one
        if b == len(yi):
            return np.concatenate([xi[:keep], ids[low:]]), np.concatenate([xn[:keep], between[low:]])
        y_ends = join + np.cumsum(self.sizes[after])
        y_starts = y_ends - self.sizes[after]
        both = np.intersect1d(starts[new & (starts >= join) & (starts <= total - self.margin)], y_starts[yn[:b]])
        if len(both):
            w, j = int(np.searchsorted(starts, both[0])), int(np.searchsorted(y_starts, both[0]))
        else:
            if starts[new][-1] >= join or yn[1:b].any():
                return None
            common = _common(y_starts, y_ends, after, starts, ends, ids, join, total)
            if common is None:
                return None
            j, w = common
        return np.concatenate([xi[:keep], ids[low:w], yi[j:]]), np.concatenate([xn[:keep], between[low : w + 1], yn[j + 1 :]])


def _common(s1, e1, ids1, s2, e2, ids2, low: int, high: int) -> tuple[int, int] | None:
    """Places of a token that both have at the same bytes within ``low`` to ``high``, the last
    one of the first half of what they share."""
    places = {(int(s), int(i)): k for k, (s, i) in enumerate(zip(s2, ids2))}
    found = [
        (k, places[int(s), int(i)]) for k, (s, e, i) in enumerate(zip(s1, e1, ids1))
        if s >= low and e <= high and (int(s), int(i)) in places
    ]
    return found[len(found) // 2] if found else None


def _byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies: itself
    where it is printable in Latin-1, else the next free one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def _borders(data: np.ndarray) -> np.ndarray:
    """Where an ASCII white-space byte follows a character that surely is none: printable
    ASCII or one of U+00C0 to U+00FF."""
    cut = np.zeros(len(data), dtype=bool)
    if len(data) < 2:
        return cut
    space = (data == 0x20) | ((data >= 9) & (data <= 13))
    sure = (data >= 0x21) & (data <= 0x7E)
    sure[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80)
    cut[1:] = space[1:] & sure[:-1]
    return cut


def tree(encoder: Encoder, parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The encoding of consecutive texts from theirs, joined pairwise."""
    while len(parts) > 1:
        pairs = [encoder.join(*parts[k : k + 2]) for k in range(0, len(parts) - 1, 2)]
        parts = pairs + parts[2 * len(pairs) :]
    return parts[0]


def leaves(text: bytes, size: int = LEAF) -> list[bytes]:
    """``text`` in stretches of about ``size`` bytes, cut between characters."""
    out, a = [], 0
    while a < len(text):
        b = min(a + size, len(text))
        while b < len(text) and text[b] & 0xC0 == 0x80:
            b += 1
        out.append(text[a:b])
        a = b
    return out


def _shared(spark: SparkSession, path: str | None) -> Broadcast:
    """The tokenizer file's text: of a fixed size, sent once per executor."""
    return spark.sparkContext.broadcast(tokenizer_file(path))


def encode(docs: DataFrame, *keep: str, path: str | None = None, long: int = LONG, leaf: int = LEAF) -> DataFrame:
    """The columns ``keep`` (doc_id without any) of ``docs``, and the ids of ``text`` as array ``ids``."""
    return _encoded(docs, keep or ("doc_id",), path, long, leaf, T.ArrayType(T.IntegerType()), lambda coder, ids, first: _lists(ids, first))


def _encoded(
    docs: DataFrame, names: Sequence[str], path: str | None, long: int, leaf: int, kind: T.DataType,
    made: Callable[[Decoder, np.ndarray, np.ndarray], pa.Array],
) -> DataFrame:
    """The columns ``names`` and ``ids``: what ``made`` makes of the ids, in the process that has them."""
    file = _shared(docs.sparkSession, path)
    rows = docs.select(F.struct(*[F.col(c) for c in names]).alias("kept"), F.coalesce("text", F.lit("")).alias("text"))
    # only the first leaf of a text carries the kept columns
    kept = T.StructType([T.StructField("kept", rows.schema["kept"].dataType, True)])
    is_long = F.octet_length("text") > long

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(file.value, borders=False)
        for batch in batches:
            for part in slices(batch, size=SLICE):
                ids, _, first = coder.batch(part["text"])
                yield pa.RecordBatch.from_arrays([part["kept"], made(coder, ids, first)], names=["kept", "ids"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, (rid, text) in enumerate(zip(batch["rid"].to_pylist(), batch["text"])):
                parts = leaves(text.as_buffer().to_pybytes(), leaf)
                n = len(parts)
                first = pa.concat_arrays([batch["kept"].slice(k, 1), pa.nulls(n - 1, batch["kept"].type)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([rid] * n), pa.array(range(n), pa.int32()), first, pa.array(parts, pa.binary())],
                    names=["rid", "leaf", "kept", "data"],
                )

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(file.value)
        for batch in batches:
            for part in slices(batch, "data"):
                ids, new, first = coder.batch(part["data"].cast(pa.string()))
                done = [coder.packed(ids[a:b], new[a:b]) for a, b in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *_binaries(done)], names=["rid", "leaf", "kept", "ids", "new"])

    held: list[Encoder] = []

    def join(group: pa.Table) -> pa.Table:
        if not held:
            held.append(Encoder(file.value))
        coder, group = held[0], group.sort_by("leaf")
        pairs = zip(group["ids"].to_pylist(), group["new"].to_pylist())
        if group.num_rows == 1:
            done = list(pairs)
        else:
            done = [coder.packed(*tree(coder, [coder.unpacked(*p) for p in pairs]))]
        return pa.table([group["rid"][:1], group["up"][:1], group["kept"][:1], *_binaries(done)], names=["rid", "leaf", "kept", "ids", "new"])

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Decoder(file.value)
        for batch in batches:
            ids = [np.frombuffer(i, dtype=coder.kind).astype(np.int32) for i in batch["ids"].to_pylist()]
            first = np.concatenate([[0], np.cumsum([len(i) for i in ids])])
            every = np.concatenate([*ids, np.zeros(0, np.int32)])
            yield pa.RecordBatch.from_arrays([batch["kept"], made(coder, every, first)], names=["kept", "ids"])

    row = T.StructType([T.StructField("rid", T.LongType()), T.StructField("leaf", T.IntegerType()), *kept.fields])
    out = T.StructType([*kept.fields, T.StructField("ids", kind)])
    coded = T.StructType([*row.fields, T.StructField("ids", T.BinaryType()), T.StructField("new", T.BinaryType())])
    long_rows = rows.filter(is_long).select(F.monotonically_increasing_id().alias("rid"), "kept", "text")
    parts = long_rows.mapInArrow(cut, T.StructType([*row.fields, T.StructField("data", T.BinaryType())]))
    # little data, much work: leaves go to all tasks
    parts = parts.repartition("rid", "leaf").mapInArrow(encoded, coded)
    for _ in range(ROUNDS):
        parts = per_group(parts.withColumn("up", F.floor(F.col("leaf") / FAN).cast("int")), ["rid", "up"], join, coded)
    done = rows.filter(~is_long).mapInArrow(short, out).union(parts.mapInArrow(finished, out))
    return done.select("kept.*", "ids")


def _binaries(pairs: list[tuple[bytes, bytes]]) -> list[pa.Array]:
    return [pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)]


def _lists(ids: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids, pa.int32()))


def decode(coded: DataFrame, *keep: str, path: str | None = None) -> DataFrame:
    """The columns ``keep`` of ``coded``, and the text of ``ids`` as ``decoded``; null ids are none."""
    file = _shared(coded.sparkSession, path)
    rows = coded.select(F.struct(*[F.col(c) for c in keep]).alias("kept"), F.col("ids"))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Decoder(file.value)
        for batch in batches:
            found = [coder.text(ids or ()) for ids in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["kept"], pa.array(found, pa.string())], names=["kept", "decoded"])

    schema = T.StructType([*rows.select("kept").schema.fields, T.StructField("decoded", T.StringType())])
    return rows.mapInArrow(texts, schema).select("kept.*", "decoded")


def report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, number of ids, digests of the ids in decimal and of the decoded text."""
    kind = T.StructType([
        T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
    ])

    def digests(coder: Decoder, ids: np.ndarray, first: np.ndarray) -> pa.Array:
        names, rows = [str(i) for i in range(len(coder.table))], []
        for a, b in zip(first[:-1], first[1:]):
            own = ids[a:b].tolist()
            rows.append({"n_tokens": len(own), "ids_sha256": _sha(",".join([names[i] for i in own])), "decoded_sha256": _sha(coder.text(own))})
        fields = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
        return pa.array(rows, pa.struct(fields))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _encoded(rows, ["doc_id"], path, LONG, LEAF, kind, digests).select("doc_id", "ids.*")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
