"""Source divergence: how the terms of the sources of a language differ, in exact integers.

A term is a run of letters (ASCII letters, A-Z lower-cased, and everything beyond ASCII). White
space separates terms, so the terms of a text are those of its white-space chunks.

Method: the chunks of every document are counted in blocks of about ``BLOCK`` bytes of text, each
block with its own list of chunks. One shuffle by chunk brings equal chunks of all blocks
together, where each is cut into terms once; a second one takes the terms back to the blocks that
asked for them. There the documents and occurrences of a term are counted per (lang, source), a
document once however many of its chunks hold the term, and Spark adds the blocks up. A chunk and a
(lang, term) come once per block, so neither a frequent word nor a large source makes a hot key. Pairs of sources are summed in buckets of terms with at most about
``CELLS`` (source, term) cells.

Defined results: null text, lang and source are ''; a document without terms counts for its (lang,
source) group only; repeated rows are documents of their own; a group without kept terms has value 0
with every other; a language with one source has no pairs; equal values are ranked by the UTF-8
bytes of the item; an empty table gives an empty result. Only text, lang and source are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefloom.llm.tables import per_group, stored
from prefloom.llm.words import ranges, split_words

BLOCK = 32 << 20
CELLS = 1 << 15
FLUSH = 200_000  # terms on their way back that a task holds
LEAST = 10  # documents of its language a term is kept from
RANKS = 10
SCALE = 1_000_000_000
SEPARATOR = "\x1f"  # between the sources of a row; one inside a source is escaped
ESCAPES = [("\x1e", "\x1ee"), (SEPARATOR, "\x1eu")]
TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

COUNTED = pa.schema([
    ("block", pa.int64()), ("lang", pa.string()), ("source", pa.string()), ("counts", pa.binary()),
    ("chunk", pa.string()), ("local", pa.int32()),
])
TERMS = pa.schema([("block", pa.int64()), ("terms", pa.binary())])
PARTIAL = pa.schema([
    ("lang", pa.string()), ("term", pa.string()), ("docs", pa.int64()), ("sources", pa.string()), ("counts", pa.string()),
])


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def _packed(*arrays: np.ndarray) -> bytes:
    """Integer arrays as one compressed value."""
    head = np.array([len(arrays), *(len(a) for a in arrays)], dtype=np.int64)
    data = head.tobytes() + b"".join(a.astype(np.int32).tobytes() for a in arrays)
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unpacked(value: bytes) -> list[np.ndarray]:
    data = pa.decompress(value[8:], int.from_bytes(value[:8], "little"), codec="zstd", asbytes=True)
    n = int(np.frombuffer(data, dtype=np.int64, count=1)[0])
    sizes = np.frombuffer(data, dtype=np.int64, count=n, offset=8)
    rest = np.frombuffer(data, dtype=np.int32, offset=8 * (n + 1))
    return np.split(rest, np.cumsum(sizes)[:-1])


def _chunks(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All chunks of the texts in a row, equal ones told by their bytes, and where each text's begin."""
    words = split_words(texts, hashed=False)
    sizes = words.ends - words.starts
    inside = np.zeros(len(words.data) + 1, dtype=np.int8)
    inside[words.starts] += 1
    inside[words.ends] -= 1
    data = words.data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    chunks = pa.Array.from_buffers(pa.large_string(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return chunks.dictionary_encode(), words.first


def _counted(batch: pa.Table, block: int) -> Iterator[pa.RecordBatch]:
    """A row per (lang, source) with the chunks and counts of its documents, and a row per
    distinct chunk of the block."""
    chunks, first = _chunks(batch["text"].combine_chunks())
    known = max(len(chunks.dictionary), 1)
    doc = np.repeat(np.arange(batch.num_rows, dtype=np.int64), np.diff(first))
    both, times = np.unique(doc * known + chunks.indices.to_numpy(), return_counts=True)
    doc, chunk = both // known, both % known
    # the chunks of a document ascend: their steps are small numbers
    step = chunk.copy()
    step[1:] -= np.where(doc[1:] == doc[:-1], chunk[:-1], 0)
    cuts = np.searchsorted(doc, np.arange(batch.num_rows + 1))
    groups, code = _codes(batch)
    order = np.argsort(code, kind="stable")
    ends = np.searchsorted(code[order], np.arange(len(groups) + 1))
    packed = []
    for a, b in zip(ends[:-1], ends[1:]):
        own = order[a:b]
        sizes = cuts[own + 1] - cuts[own]
        at = ranges(cuts[own], sizes)
        packed.append(_packed(sizes, step[at], times[at]))
    n, more = len(groups), len(chunks.dictionary)
    yield pa.RecordBatch.from_arrays(
        [pa.array([block] * n), pa.array([g[0] for g in groups], pa.string()), pa.array([g[1] for g in groups], pa.string()),
         pa.array(packed, pa.binary()), pa.nulls(n, pa.string()), pa.nulls(n, pa.int32())],
        schema=COUNTED,
    )
    for k in range(0, more, 100_000):
        part = chunks.dictionary.slice(k, 100_000).cast(pa.string())
        m = len(part)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(m, block)), pa.nulls(m, pa.string()), pa.nulls(m, pa.string()), pa.nulls(m, pa.binary()),
             part, pa.array(np.arange(k, k + m, dtype=np.int32))],
            schema=COUNTED,
        )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    block = (TaskContext.get().partitionId() << 32) - 1
    held, size = [], 0
    for batch in batches:
        length = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False), dtype=np.int64)
        cuts = [0, *(np.flatnonzero(np.diff((length + size) // BLOCK)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if held and a:
                yield from _counted(pa.Table.from_batches(held), block := block + 1)
                held = []
            held.append(batch.slice(a, b - a))
        size = (size + int(length[-1])) % BLOCK if batch.num_rows else size
    if held:
        yield from _counted(pa.Table.from_batches(held), block := block + 1)


def terms_of(chunk: bytes) -> dict[str, int]:
    found: dict[bytes, int] = {}
    for term in TERM.findall(chunk.translate(LOWER)):
        found[term] = found.get(term, 0) + 1
    return {t.decode(): n for t, n in found.items()}


def _tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks arrive sorted: each distinct one is cut into terms once. The terms go back to the
    blocks that have the chunk, many in one value."""
    last, terms = None, []
    held: dict[int, tuple[list[int], list[int], list[str]]] = {}
    size = 0
    for batch in batches:
        for block, local, chunk in zip(*(batch[c].to_pylist() for c in ("block", "local", "chunk"))):
            if chunk != last:
                last, terms = chunk, list(terms_of(chunk.encode()).items())
            for term, n in terms:
                to = held.get(block) or held.setdefault(block, ([], [], []))
                to[0].append(local)
                to[1].append(n)
                to[2].append(term)
                size += 1
        if size >= FLUSH:
            yield _to_blocks(held)
            held, size = {}, 0
    if held:
        yield _to_blocks(held)


def _to_blocks(held: dict[int, tuple[list[int], list[int], list[str]]]) -> pa.RecordBatch:
    # a term has no line end
    packed = [_packed(np.array(x), np.array(n), np.frombuffer(_padded("\n".join(t)), dtype=np.int32)) for x, n, t in held.values()]
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(packed, pa.binary())], schema=TERMS)


def _padded(text: str) -> bytes:
    data = text.encode()
    return data + b"\n" * (-len(data) % 4)


def _by_term(block: pa.Table) -> pa.Table | None:
    """Documents per (lang, term) of one block, and the occurrences in each of its sources."""
    docs = block.filter(pc.is_valid(block["counts"]))
    found = [_unpacked(v) for v in block["terms"].to_pylist() if v is not None]
    if not docs.num_rows or not found:
        return None
    local, times = (np.concatenate([f[k] for f in found]).astype(np.int64) for k in (0, 1))
    text = pa.array([t for f in found for t in f[2].tobytes().rstrip(b"\n").decode().split("\n")], pa.string())
    names = text.dictionary_encode()
    order = np.argsort(local, kind="stable")
    local, times, term = local[order], times[order], names.indices.to_numpy().astype(np.int64)[order]
    known = len(names.dictionary)
    keys, n, in_docs = [], [], []
    for group, packed in enumerate(docs["counts"].to_pylist()):
        sizes, step, count = (x.astype(np.int64) for x in _unpacked(packed))
        doc = np.repeat(np.arange(len(sizes)), sizes)
        # running sums of the steps begin anew with every document
        chunk = np.cumsum(step)
        before = np.concatenate([[0], chunk])[np.cumsum(sizes) - sizes]
        chunk -= np.repeat(before, sizes)
        # every chunk's terms beside it
        start, stop = np.searchsorted(local, chunk), np.searchsorted(local, chunk, side="right")
        at = ranges(start, stop - start)
        row = np.repeat(np.arange(len(chunk)), stop - start)
        # a document once per term
        key = np.unique(doc[row] * known + term[at])
        mine, found_in = np.unique(key % known, return_counts=True)
        total = np.zeros(known, dtype=np.int64)
        np.add.at(total, term[at], count[row] * times[at])
        keys.append(np.stack([np.full(len(mine), group), mine]))
        n.append(total[mine])
        in_docs.append(found_in)
    group, mine = np.concatenate(keys, axis=1)
    if not len(group):
        return None
    langs, lang_of = np.unique(np.array(docs["lang"].to_pylist(), dtype=object), return_inverse=True)
    place = lang_of[group] * known + mine
    order = np.argsort(place, kind="stable")
    place, group = place[order], group[order]
    n, in_docs = np.concatenate(n)[order], np.concatenate(in_docs)[order]
    starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    offsets = pa.array(np.append(starts, len(place)).astype(np.int32))
    sources = docs["source"].combine_chunks()
    for plain, escaped in ESCAPES:
        sources = pc.replace_substring(sources, plain, escaped)
    return pa.table(
        [
            pa.array(langs.tolist(), pa.string()).take(pa.array(place[starts] // known)),
            names.dictionary.take(pa.array(place[starts] % known)), pa.array(np.add.reduceat(in_docs, starts)),
            pc.binary_join(pa.ListArray.from_arrays(offsets, sources.take(pa.array(group))), SEPARATOR),
            pc.binary_join(pa.ListArray.from_arrays(offsets, pa.array(n).cast(pa.string())), ","),
        ],
        schema=PARTIAL,
    )


def _codes(rows: pa.Table) -> tuple[list[tuple[str, str]], np.ndarray]:
    """The distinct (lang, source) and the number of each row's."""
    seen: dict[tuple, int] = {}
    code = [seen.setdefault(g, len(seen)) for g in zip(rows["lang"].to_pylist(), rows["source"].to_pylist())]
    return list(seen), np.array(code, dtype=np.int64)


def term_counts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, term, docs, sources, counts), a row per block that has the term in a document of
    the language, with its sources there and their counts as text, and all (lang, source) groups."""
    empty = F.lit("")
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), empty).alias(c) for c in ("lang", "source", "text")])
    counted = stored(rows.mapInArrow(_count, _ddl(COUNTED)), "chunks")
    chunks = counted.filter("chunk is not null").select("block", "local", "chunk")
    terms = chunks.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_tokenise, _ddl(TERMS))
    own = counted.filter("counts is not null").select("block", "lang", "source", "counts")
    blocks = own.unionByName(terms, allowMissingColumns=True)
    return per_group(blocks, ["block"], _by_term, _ddl(PARTIAL)), own.select("lang", "source").distinct()


def kept_terms(partial: DataFrame, least: int) -> DataFrame:
    """(lang, source, term, n, n_lang, one) of the terms in at least ``least`` documents of their
    language; ``one`` marks one row of each. All of it follows one shuffle by (lang, term)."""
    of_term = Window.partitionBy("lang", "term")
    kept = partial.withColumn("in_docs", F.sum("docs").over(of_term)).filter(F.col("in_docs") >= least)

    def unescaped(source: Column) -> Column:
        for plain, escaped in reversed(ESCAPES):
            source = F.replace(source, F.lit(escaped), F.lit(plain))
        return source

    source = F.transform(F.split("source", SEPARATOR, -1), unescaped)
    zipped = F.arrays_zip(source.alias("source"), F.split("counts", ",").cast("array<long>").alias("n"))
    entries = kept.withColumnRenamed("sources", "source").select("lang", "term", F.inline(zipped))
    own = entries.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"))
    return own.select(
        "lang", "source", "term", "n", F.sum("n").over(of_term).alias("n_lang"),
        (F.row_number().over(of_term.orderBy("source")) == 1).alias("one"),
    )


def _share(count: str, total: str) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)) in exact decimals."""
    return F.expr(
        f"1 + ((CAST({count} AS DECIMAL(20,0)) + 2) * {SCALE}) DIV (CAST({total} AS DECIMAL(20,0)) + 2 * CAST(terms AS DECIMAL(20,0)))"
    )


def _pair_sums(cells: DataFrame) -> DataFrame:
    """(lang, source, item, value) summed over the terms of one bucket, source before item."""

    def sums(bucket: pa.Table) -> pa.Table:
        kinds = bucket["term"].is_null()
        default = bucket.filter(kinds)
        some = bucket.filter(pc.invert(kinds))
        sources = sorted(default["source"].to_pylist())
        place = {s: i for i, s in enumerate(sources)}
        usual = dict(zip(default["source"].to_pylist(), default["p"].to_pylist()))
        term = some["term"].combine_chunks().dictionary_encode()
        term = term.combine_chunks() if isinstance(term, pa.ChunkedArray) else term
        p = np.repeat(np.array([usual[s] for s in sources], dtype=np.int64)[:, None], len(term.dictionary), axis=1)
        p[[place[s] for s in some["source"].to_pylist()], term.indices.to_numpy()] = some["p"].to_numpy()
        left, right, value = [], [], []
        for a in range(len(sources) - 1):
            gap = p[a + 1 :] - p[a]
            left += [sources[a]] * (len(sources) - 1 - a)
            right += sources[a + 1 :]
            value += (gap * gap // (p[a + 1 :] + p[a])).sum(axis=1).tolist()
        lang = [bucket["lang"][0].as_py()] * len(value)
        return pa.table([pa.array(c, k) for c, k in zip((lang, left, right, value), [pa.string()] * 3 + [pa.int64()])], names=["lang", "source", "item", "value"])

    return cells.groupBy("lang", "bucket").applyInArrow(sums, "lang string, source string, item string, value long")


def divergence(docs: DataFrame, least: int = LEAST, ranks: int = RANKS) -> DataFrame:
    """(lang, source, part, item, value, rank): for every (lang, source) group the other sources of its
    language by divergence (part ``pair``, all of them), and its own most over-represented terms
    (part ``term``, the first ``ranks``)."""
    partial, groups = term_counts(docs)
    kept = stored(kept_terms(partial, least), "kept-terms")
    langs = kept.groupBy("lang").agg(F.count_if("one").alias("terms"), F.sum("n").alias("total_lang"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    groups = stored(
        groups.join(langs, "lang", "left").join(totals, ["lang", "source"], "left").join(sizes, "lang")
        .fillna(0, ["terms", "total_lang", "total"]),
        "groups",
    )
    known = groups.filter("terms > 0").withColumn("buckets", F.ceil(F.col("terms") * F.col("sources") / CELLS).cast("int"))
    shares = kept.join(known, ["lang", "source"]).withColumns({"p": _share("n", "total"), "q": _share("n_lang", "total_lang")})

    over = shares.filter("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        F.expr("((p - q) * (p - q)) DIV (p + q)").alias("value"),
    )
    bucket = F.pmod(F.xxhash64("term"), F.col("buckets").cast("long")).cast("int")
    cells = shares.select("lang", bucket.alias("bucket"), "source", "term", "p").unionByName(
        known.withColumn("n", F.lit(0)).select(
            "lang", F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)).alias("bucket"), "source",
            F.lit(None).cast("string").alias("term"), _share("n", "total").alias("p"),
        )
    )
    half = _pair_sums(cells)
    ways = F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))
    sums = half.select("lang", "value", F.inline(ways)).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    other = groups.select("lang", F.col("source").alias("item"))
    pairs = groups.select("lang", "source").join(other, "lang").filter("source <> item").join(
        sums, ["lang", "source", "item"], "left"
    ).select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))

    ranking = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = over.withColumn("rank", F.row_number().over(ranking)).filter(F.col("rank") <= ranks)
    return pairs.withColumn("rank", F.row_number().over(ranking)).unionByName(ranked)
