"""SentencePiece encoding and decoding by a max-plus parallel scan.

A text is cut into the pieces of a vocabulary whose scores sum to the most. Over
(max, +) the best scores through a stretch of text are a matrix from the characters that a
piece before it takes away (0 to ``reach - 1``) to those that its last piece takes from the
next. Matrices combine associatively, so a giant text is encoded in chunks:

1. Every chunk yields its matrix, in a task of its own.
2. Per text the matrices combine from the end into what is still to be gained
   from every state of every boundary.
3. With that, every chunk maps each state it may be entered in to the one it is left in; the
   maps compose to the states the best path passes.
4. Every chunk is traced independently between its two states.

Among equal sums the first piece is the longest possible, which does not depend on
how the text is cut. Scores are integers (multiples of 2**-20 where the model has fractions),
so sums are exact in any order. No piece runs across a place where a
word begins if the vocabulary has none such; of the stretches between, equal ones of a few
texts are encoded once, and all short ones side by side in numpy, by their distance from the end.

The model file is read on the driver and its pieces are broadcast: they are as many as the
vocabulary has. A file of the merge kind is used by its pieces and scores, as the
library does with the model type set to unigram; merges are not replayed.

Defined results: a null or empty text has no pieces and decodes to the empty text; a
character without a piece becomes its bytes (or the unknown id); a text with U+2581 decodes with
spaces there; repeated rows and other columns stay as they are; an empty table gives
an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefloom.llm.tables import per_group, stored
from prefloom.llm.words import mix, powers, ranges, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 65_536
CHUNKS_PER_TASK = 16
REMEMBERED = 200_000  # stretches a task keeps the pieces of
TOGETHER = 64  # characters of the longest stretches that are encoded side by side
SPACE = "▁"
NONE = -(1 << 62)
NORMAL, UNKNOWN, USER, BYTE = 1, 2, 4, 6  # fixed values: piece types of the model file


class Trie:
    """The pieces by their characters, in arrays: from node ``n`` the character ``c`` leads to
    ``go[n] + code[c]`` if ``came`` says there that it comes from ``n``."""

    def __init__(self, begins: dict[str, int | None], ids: dict[str, int]):
        alphabet = sorted({c for p in begins for c in p})
        self.code = np.zeros(max(map(ord, alphabet), default=0) + 2, np.int32)  # 0: in no piece
        self.code[[ord(c) for c in alphabet]] = np.arange(1, len(alphabet) + 1)
        code = {c: i for i, c in enumerate(alphabet, 1)}
        children: dict[str, list[str]] = {}
        for p in begins:
            children.setdefault(p[:-1], []).append(p)
        used = np.zeros(len(begins) + len(alphabet) + 1024, bool)
        used[0] = True
        base_of, place, low = {}, {"": 0}, 1
        # large families first within a level, each at the first place where it fits
        for parent in sorted(children, key=lambda p: (len(p), -len(children[p]), p)):
            codes = np.array([code[p[-1]] for p in children[parent]])
            while low < len(used) and used[low]:
                low += 1
            base, at = -1, max(low, int(codes.min()))
            while base < 0:
                if at + 512 + len(alphabet) > len(used):
                    used = np.append(used, np.zeros(len(used) + at + 512 + len(alphabet), bool))
                free = np.flatnonzero(~used[at : at + 512]) + at - codes.min()
                fits = ~used[free[:, None] + codes].any(axis=1)
                base, at = int(free[fits.argmax()]) if fits.any() else -1, at + 512
            used[base + codes] = True
            base_of[parent] = base
            for p, c in zip(children[parent], codes.tolist(), strict=True):
                place[p] = base + c
        room = max(base_of.values(), default=0) + len(alphabet) + 1
        self.go, self.came = np.zeros(room, np.int32), np.full(room, -1, np.int32)
        for parent, family in children.items():
            self.go[place[parent]] = base_of[parent]
            self.came[[place[p] for p in family]] = place[parent]
        self.score = np.full(room, NONE, np.int64)
        self.id = np.full(room, -1, np.int32)
        for p, n in place.items():
            if begins.get(p) is not None:
                self.score[n], self.id[n] = begins[p], ids[p]


class Vocabulary:
    """Pieces, their integer scores and ids, and what an unknown character becomes."""

    def __init__(self, pieces: list[tuple[str, float, int]], dummy_prefix: bool = True, byte_fallback: bool = True):
        usable = [(p, s, i) for i, (p, s, kind) in enumerate(pieces) if kind in (NORMAL, USER)]
        unit = 1 if all(float(s).is_integer() for _, s, _ in usable) else 1 << 20
        self.score = {p: round(s * unit) for p, s, _ in usable}
        self.ids = {p: i for p, _, i in usable}
        self.unknown = min(self.score.values(), default=0) - 10 * unit
        self.unknown_id = next((i for i, (_, _, kind) in enumerate(pieces) if kind == UNKNOWN), 0)
        self.bytes = {int(p[1:-1], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == BYTE} if byte_fallback else {}
        self.reach = max(map(len, self.score), default=1)
        self.dummy_prefix = dummy_prefix
        # scores of pieces, None for what only begins one
        self.begins = {p[:n]: None for p in self.score for n in range(1, len(p))} | self.score
        across = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.score)
        line_ends = any("\n" in p and len(p) > 1 for p in self.score)
        # stretches that no piece leaves: a word with the spaces before it, or a line end
        self.stretch = None if across or line_ends else f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n"
        self.memory: dict[str, tuple[list[int], int]] = {}
        self.surface = [self._surface(p, kind) for p, _, kind in pieces]

    @staticmethod
    def _surface(piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[1:-1], 16)])
        if kind == UNKNOWN:
            return " ⁇ ".encode()
        return piece.replace(SPACE, " ").encode() if kind in (NORMAL, USER) else b""

    def prepared(self, text: str) -> str:
        return (SPACE if self.dummy_prefix and text else "") + text.replace(" ", SPACE)

    def gains(self, text: str, after: np.ndarray | list, end: int) -> list:
        """Most that is still to be gained from every place of text[:end]; ``after`` has
        it for the places from ``end`` on."""
        best = [NONE] * end + list(after)
        get, reach, unknown, limit = self.begins.get, self.reach, self.unknown, len(best) - 1
        for at in range(end - 1, -1, -1):
            top = NONE
            for stop in range(at + 1, min(at + reach, limit, len(text)) + 1):
                s = get(text[at:stop], False)  # False: no piece begins so
                last = s is False
                if last or s is None:
                    if stop > at + 1:
                        if last:
                            break
                        continue
                    s = unknown
                if best[stop] > NONE and s + best[stop] > top:
                    top = s + best[stop]
                if last:
                    break
            best[at] = top
        return best

    def trace(self, text: str, best: list, at: int, end: int) -> tuple[list[int], int]:
        """Ids of the pieces from ``at`` to the first that reaches ``end``, and its end."""
        out: list[int] = []
        score = self.score
        while at < end:
            for stop in range(min(at + self.reach, len(best) - 1, len(text)), at, -1):
                piece = text[at:stop]
                s = score.get(piece)
                if s is None and stop == at + 1:
                    s = self.unknown
                if s is not None and best[stop] > NONE and s + best[stop] == best[at]:
                    break
            if piece in self.ids:
                out.append(self.ids[piece])
            else:
                out += [self.bytes[b] for b in piece.encode()] if self.bytes else [self.unknown_id]
            at = stop
        return out, at

    def stretches(self, text: str) -> list[str]:
        return re.findall(self.stretch, text) if self.stretch else [text] if text else []

    def gates(self, core: str) -> tuple[int, int] | None:
        """Two places of a long text that no piece crosses: one behind all states it
        may be entered in, and the last."""
        if not self.stretch or len(core) <= 4 * self.reach:
            return None
        cuts = [m.start() for m in re.finditer(self.stretch, core)]
        first = next((c for c in cuts if c >= self.reach), None)
        return (first, cuts[-1]) if first is not None and cuts[-1] > first else None

    def known(self, stretch: str) -> tuple[list[int], int]:
        """Ids and sum of scores of a stretch, remembered up to a bound."""
        found = self.memory.get(stretch)
        if found is None:
            if len(self.memory) >= REMEMBERED:
                self.memory.clear()
            best = self.gains(stretch, [0], len(stretch))
            found = self.memory[stretch] = self.trace(stretch, best, 0, len(stretch))[0], best[0]
        return found

    def encode(self, text: str) -> list[int]:
        """A prepared text in one go."""
        best = self.gains(text, [0], len(text))
        return self.trace(text, best, 0, len(text))[0]

    @cached_property
    def trie(self) -> Trie:
        return Trie(self.begins, self.ids)

    def _side_by_side(self, points: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the stretches points[first : first + size] one after another, and how many each has:
        ``gains`` and ``trace`` of all stretches at once, by the distance from their ends."""
        trie, n = self.trie, len(size)
        order = np.argsort(-size, kind="stable")
        size, first = size[order], first[order]
        longest = int(size[0]) if n else 0
        # place begin[d] + k is the character d before the end of stretch k
        live = np.searchsorted(-size, -np.arange(1, longest + 1), side="right")
        begin = np.concatenate([[0, 0], np.cumsum(live)])
        far = np.repeat(np.arange(1, longest + 1), live)
        own = np.arange(begin[-1]) - begin[far]
        text = points[first[own] + size[own] - far]
        code = trie.code[np.minimum(text, len(trie.code) - 1)]
        best, step, piece = np.full(len(text), NONE, np.int64), np.ones(len(text), np.int64), np.full(len(text), -1, np.int32)
        edges = []
        d, k, node = far, own, np.zeros(len(far), np.int32)
        for length in range(1, min(self.reach, longest) + 1):
            to = trie.go[node] + code[begin[d - length + 1] + k]
            found = trie.came[to] == node
            if length == 1:
                s, name = np.where(found, trie.score[to], NONE), trie.id[to]
                known = s > NONE
                edges.append((d, k, np.where(known, s, self.unknown), np.where(known, name, np.int32(-1))))
            d, k, node = d[found], k[found], to[found]
            if length > 1:
                some = trie.score[node] > NONE
                edges.append((d[some], k[some], trie.score[node[some]], trie.id[node[some]]))
            more = d > length
            d, k, node = d[more], k[more], node[more]
        cuts = [np.searchsorted(e[0], np.arange(1, longest + 2)) for e in edges]
        for d in range(1, longest + 1):
            at = begin[d]
            for length in range(1, min(len(edges), d) + 1):
                a, b = cuts[length - 1][d - 1], cuts[length - 1][d]
                if a == b:
                    continue
                _, k, s, name = (x[a:b] for x in edges[length - 1])
                sums = s + best[begin[d - length] + k] if length < d else s
                # of equal sums the longest piece
                top = sums >= best[at + k]
                here = at + k[top]
                best[here], step[here], piece[here] = sums[top], length, name[top]
        # characters without a piece become their bytes
        others, which = np.unique(text[piece < 0], return_inverse=True)
        spelled = [[self.bytes[b] for b in chr(c).encode()] if self.bytes else [self.unknown_id] for c in others.tolist()]
        width = np.ones(len(text), np.int64)
        width[piece < 0] = np.array([len(x) for x in spelled], np.int64)[which] if len(others) else 1
        passed, d, k = [], size.copy(), np.arange(n)
        total = np.zeros(n, np.int64)
        while len(k):
            here = begin[d] + k
            passed.append((here, k, total[k]))
            total[k] += width[here]
            d = d - step[here]
            k, d = k[d > 0], d[d > 0]
        count = np.empty(n, np.int64)
        count[order] = total
        starts = (np.cumsum(count) - count)[order]
        ids, number = np.empty(int(count.sum()), np.int32), np.full(len(text), -1, np.int64)
        number[piece < 0] = which
        for here, k, before in passed:
            to = starts[k] + before
            ids[to] = piece[here]
            for j in np.flatnonzero(piece[here] < 0).tolist():
                spelling = spelled[number[here[j]]]
                ids[to[j] : to[j] + len(spelling)] = spelling
        return ids, count

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all prepared texts one after another, and where each text's begin."""
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        ends = np.cumsum([0, *map(len, texts)])
        start = np.zeros(len(points) + 1, bool)
        start[ends] = True
        if self.stretch:
            space, line = points == ord(SPACE), points == 10
            start[:-1] |= line
            start[1:-1] |= line[:-1] | (space[1:] & ~space[:-1])
        cuts = np.flatnonzero(start)
        first, size = cuts[:-1], np.diff(cuts)
        # equal stretches once; a hash finds them, the characters decide
        place = np.arange(len(points)) - np.repeat(first, size)
        terms = mix(points.astype(np.uint64) + np.uint64(1)) * powers(int(size.max(initial=0)))[place]
        hashes = np.add.reduceat(terms, first) if len(first) else np.zeros(0, np.uint64)
        _, one, same = np.unique(hashes, return_index=True, return_inverse=True)
        like = first[one][same]
        if (size[one][same] != size).any() or (points[np.repeat(like, size) + place] != points).any():
            one = same = np.arange(len(first))
        short = size[one] <= TOGETHER
        ids, few = self._side_by_side(points, first[one][short], size[one][short])
        long = [self.known(points[a : a + n].tobytes().decode("utf-32-le"))[0] for a, n in zip(first[one][~short], size[one][~short], strict=True)]
        count = np.zeros(len(one), np.int64)
        count[short], count[~short] = few, [len(x) for x in long]
        begin = np.zeros(len(one), np.int64)
        begin[short] = np.cumsum(few) - few
        begin[~short] = len(ids) + np.cumsum(count[~short]) - count[~short]
        ids = np.concatenate([ids, *(np.array(x, np.int32) for x in long)])
        upto = np.concatenate([[0], np.cumsum(count[same])])
        return ids[ranges(begin[same], count[same])], upto[np.searchsorted(cuts, ends)]

    def decode_all(self, ids: pa.ListArray) -> list[str]:
        """The texts of lists of ids; null lists are empty."""
        flat = ids.flatten().to_numpy(zero_copy_only=False)
        data, first, size = self._surfaces
        lists = np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))
        upto = np.concatenate([[0], np.cumsum(size[flat])])[np.concatenate([[0], lists])].tolist()
        raw = data[ranges(first[flat], size[flat])].tobytes()
        texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(upto, upto[1:], strict=False)]
        return [t[1:] if t.startswith(" ") else t for t in texts] if self.dummy_prefix else texts

    @cached_property
    def _surfaces(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = np.array([len(s) for s in self.surface], np.int64)
        return np.frombuffer(b"".join(self.surface), np.uint8), np.cumsum(size) - size, size

    def matrix(self, core: str, ahead: str) -> np.ndarray:
        """Best scores from every state at the start of ``core`` to every state at its end;
        pieces may run into ``ahead``."""
        reach = self.reach
        if cut := self.gates(core):
            # all paths meet at both cuts: what lies between is one number
            head = self.matrix(core[: cut[0]], "")[:, :1]
            middle = sum(self.known(s)[1] for s in self.stretches(core[cut[0] : cut[1]]))
            tail = self.matrix(core[cut[1] :], ahead)[:1]
            return np.where((head > NONE) & (tail > NONE), head + middle + tail, NONE)
        text, n = core + ahead, len(core)
        best = np.full((n + reach + 1, reach), NONE, dtype=np.int64)
        for i in range(min(reach, n + 1)):
            best[i, i] = 0
        for at in range(n):
            row = best[at]
            live = row > NONE
            if not live.any():
                continue
            for stop in range(at + 1, min(at + reach, len(text)) + 1):
                s = self.score.get(text[at:stop], self.unknown if stop == at + 1 else None)
                if s is not None:
                    np.maximum(best[stop], np.where(live, row + s, NONE), out=best[stop])
        return best[n : n + reach].T.copy()


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Matrices of two stretches in a row -> that of both."""
    both = (a[:, :, None] > NONE) & (b[None, :, :] > NONE)
    return np.where(both, np.where(both, a[:, :, None], 0) + np.where(both, b[None, :, :], 0), NONE).max(axis=1)


def load(path: str = MODEL) -> Vocabulary:
    """The pieces of a model file, read on the driver."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    if model.normalizer_spec.name != "identity" or model.normalizer_spec.remove_extra_whitespaces:
        raise ValueError("only models that leave the text as it is are supported")
    return Vocabulary(
        [(p.piece, p.score, p.type) for p in model.pieces],
        model.normalizer_spec.add_dummy_prefix,
        model.trainer_spec.byte_fallback,
    )


def _short_rows(shared):
    """``ids`` of texts that are one chunk."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary: Vocabulary = shared.value
        for whole in batches:
            for batch in slices(whole, "_text"):
                flat, cuts = vocabulary.encode_all([vocabulary.prepared(t or "") for t in batch.column("_text").to_pylist()])
                ids = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column("_row"), ids], names=["_row", "ids"])

    return rows


def _chunk_rows(shared, chunk: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary: Vocabulary = shared.value
        for batch in batches:
            for rid, text in zip(batch.column("rid").to_pylist(), batch.column("_text").to_pylist(), strict=True):
                text = vocabulary.prepared(text)
                for k in range(0, len(text), chunk):
                    # whoever reads a chunk needs as much of the next as a piece can reach
                    core, ahead = text[k : k + chunk], text[k + chunk : k + chunk + vocabulary.reach - 1]
                    yield pa.RecordBatch.from_pylist([{"rid": rid, "chunk": k // chunk, "core": core, "ahead": ahead}], schema=schema)

    schema = pa.schema([("rid", pa.int64()), ("chunk", pa.int32()), ("core", pa.string()), ("ahead", pa.string())])
    return rows


def _matrix_rows(shared):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [shared.value.matrix(c, a).tobytes() for c, a in zip(batch.column("core").to_pylist(), batch.column("ahead").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("chunk"), pa.array(made, pa.binary())], names=["rid", "chunk", "matrix"])

    return rows


def _still_to_gain(reach: int):
    """Per text: for every chunk what is to be gained from each state at its end."""

    def work(text: pa.Table) -> pa.Table:
        text = text.sort_by([("chunk", "descending")])
        after = np.full((reach, 1), NONE, dtype=np.int64)
        after[0] = 0
        out = []
        for raw in text.column("matrix").to_pylist():
            out.append(after[:, 0].tobytes())
            after = combine(np.frombuffer(raw, dtype=np.int64).reshape(reach, reach), after)
        return pa.table({"rid": text.column("rid"), "chunk": text.column("chunk"), "after": pa.array(out, pa.binary())})

    return work


def _tail(vocabulary: Vocabulary, core: str, ahead: str, after: bytes) -> tuple[str, list, int]:
    """Text, gains and length of the end of a chunk, whose paths run into the next."""
    text = core + ahead
    return text, vocabulary.gains(text, np.frombuffer(after, dtype=np.int64).tolist(), len(core)), len(core)


def _exits(vocabulary: Vocabulary, core: str, ahead: str, after: bytes) -> list[int]:
    if cut := vocabulary.gates(core):
        text, best, end = _tail(vocabulary, core[cut[1] :], ahead, after)
        return [vocabulary.trace(text, best, 0, end)[1] - end] * vocabulary.reach
    text, best, end = _tail(vocabulary, core, ahead, after)
    out = []
    for entry in range(vocabulary.reach):
        if entry >= end:  # a piece that reaches past a short last chunk
            out.append(entry - end)
        else:
            out.append(vocabulary.trace(text, best, entry, end)[1] - end if best[entry] > NONE else 0)
    return out


def _exit_rows(shared):
    """Per chunk: the state it is left in for every state it may be entered in."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [_exits(shared.value, r["core"], r["ahead"], r["after"]) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("chunk"), pa.array(out, pa.list_(pa.int32()))], names=["rid", "chunk", "exits"])

    return rows


def _entries(text: pa.Table) -> pa.Table:
    """Per text: the state in which the best path enters every chunk."""
    text = text.sort_by("chunk")
    state, out = 0, []
    for exits in text.column("exits").to_pylist():
        out.append(state)
        state = exits[state]
    return pa.table({"rid": text.column("rid"), "chunk": text.column("chunk"), "entry": pa.array(out, pa.int32())})


def _traced(vocabulary: Vocabulary, core: str, ahead: str, after: bytes, entry: int) -> list[int]:
    ids: list[int] = []
    if cut := vocabulary.gates(core):
        head = core[: cut[0]]
        ids += vocabulary.trace(head, vocabulary.gains(head, [0], len(head)), entry, len(head))[0]
        for s in vocabulary.stretches(core[cut[0] : cut[1]]):
            ids += vocabulary.known(s)[0]
        core, entry = core[cut[1] :], 0
    text, best, end = _tail(vocabulary, core, ahead, after)
    return ids + vocabulary.trace(text, best, entry, end)[0]


def _trace_rows(shared):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [_traced(shared.value, r["core"], r["ahead"], r["after"], r["entry"]) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("chunk"), pa.array(out, pa.list_(pa.int32()))], names=["rid", "chunk", "ids"])

    return rows


def encode(docs: DataFrame, vocabulary: Vocabulary, chunk: int = CHUNK) -> DataFrame:
    """``docs`` with the ids of the pieces of ``text`` in a column ``ids``, which replaces a given one."""
    columns = [c for c in docs.columns if c != "ids"]
    vocabulary.trie  # made once, here
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.struct(*[F.col(c) for c in columns]).alias("_row"), F.col("text").alias("_text"))
    is_long = F.coalesce(F.length("_text"), F.lit(0)) >= chunk
    schema = rows.select("_row").schema.add("ids", T.ArrayType(T.IntegerType()))
    short = rows.filter(~is_long).mapInArrow(_short_rows(shared), schema)

    giant = stored(rows.filter(is_long).withColumn("rid", F.monotonically_increasing_id()), "giant")
    chunks = stored(giant.select("rid", "_text").mapInArrow(_chunk_rows(shared, chunk), "rid long, chunk int, core string, ahead string"), "chunks")
    # little data, much work: a few chunks per task, whatever their bytes
    chunks = chunks.repartition(max(1, chunks.count() // CHUNKS_PER_TASK), "rid", "chunk")
    reach = vocabulary.reach
    matrices = chunks.mapInArrow(_matrix_rows(shared), "rid long, chunk int, matrix binary")
    after = stored(per_group(matrices, ["rid"], _still_to_gain(reach), "rid long, chunk int, after binary"), "after")
    with_after = chunks.join(after, ["rid", "chunk"])
    exits = with_after.mapInArrow(_exit_rows(shared), "rid long, chunk int, exits array<int>")
    entries = per_group(exits, ["rid"], _entries, "rid long, chunk int, entry int")
    traced = with_after.join(entries, ["rid", "chunk"]).mapInArrow(_trace_rows(shared), "rid long, chunk int, ids array<int>")
    joined = traced.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("chunk", "ids"))).alias("parts"))
    long = giant.join(joined, "rid").select("_row", F.flatten(F.col("parts.ids")).alias("ids"))
    return short.union(long).select("_row.*", "ids")


def decode(coded: DataFrame, vocabulary: Vocabulary, *keep: str) -> DataFrame:
    """The columns ``keep`` and the text of ``ids`` as ``decoded``; null ids are none."""
    shared = coded.sparkSession.sparkContext.broadcast(vocabulary)
    source = coded.select(*keep, F.col("ids").alias("_ids"))
    schema = source.drop("_ids").schema.add("decoded", "string")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary: Vocabulary = shared.value
        for whole in batches:
            for k in range(0, whole.num_rows, 200):
                batch = whole.slice(k, 200)
                texts = vocabulary.decode_all(batch.column("_ids"))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*keep, "decoded"])

    return source.mapInArrow(rows, schema)


def report(docs: DataFrame, spark: SparkSession, path: str = MODEL) -> DataFrame:
    """doc_id, n_pieces, a digest of the ids, one of the decoded text, and whether that is
    the text again."""
    vocabulary = load(path)
    plain = docs.select("doc_id", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
    coded = encode(plain, vocabulary)
    # as text, so that any engine can make the digest
    digest = F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256)
    coded = coded.select("doc_id", "text_sha256", F.size("ids").cast("long").alias("n_pieces"), digest.alias("ids_sha256"), "ids")
    out = decode(coded, vocabulary, "doc_id", "text_sha256", "n_pieces", "ids_sha256")
    out = out.withColumn("decoded_sha256", F.sha2("decoded", 256))
    return out.select("doc_id", "n_pieces", "ids_sha256", "decoded_sha256", (F.col("decoded_sha256") == F.col("text_sha256")).alias("round_trip"))
