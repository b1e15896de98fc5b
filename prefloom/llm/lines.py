"""Line deduplication: an exact set-similarity join in DataFrame operations.

A line (text between line ends) is the set of its words; blank lines are never
touched. A line is removed if any line before it, by (doc_id, line number),
has a Jaccard similarity of ``threshold`` or more, whether that one is kept or not.

1. Tokens of a line are ordered by rarity: by the number of times words of their hash bucket
   occur in the corpus, then by hash.
2. Lines with equal sets collapse to the first of them, in partial aggregation.
3. Two similar lines share one of their first ``n - ceil(t * n) + 1`` tokens.
   Lines are dealt by these tokens; a pair goes on only if the lengths, the places of
   the shared token and the signatures (two of 64 bits, each the parity of the tokens that fall on it: two sets
   differ in as many tokens as bits at least) leave room for the overlap that the threshold needs.
4. By ``NEIGHBOURS`` of these tokens every line is compared with the first line that has the token and the last one
   before it. The likeliest of these pairs is verified, so that a large group of near copies gives one pair a line.
5. A line not removed by then is joined with all lines before it in its tokens; all pairs left are verified.
6. Verification is on the whole word sets of both lines.

Tokens are compared by a 64-bit hash. Defined results: a null text has
no lines; an empty text has one blank line; rows with the same doc_id and text
are one document and get the same result; rows with one doc_id and other texts are
ordered by a hash of the text; null doc_ids come last; an empty table gives an empty
result; other columns stay as they are, whatever their names.
"""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prefloom.llm import words
from prefloom.llm.tables import drop, free_name, stored

THRESHOLD = 0.8
BUCKETS = 1 << 20
NEIGHBOURS = 4
CHUNK_ROWS = 200_000
FILTER_BITS = 1 << 22
SPACE = " \t\x0b\x0c\r"
LAST = (1 << 63) - 1
ORDER = ("doc", "line", "rid")
SIGNS = ("s0", "s1")  # 128 bits


def _rid() -> Column:
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def _named(docs: DataFrame) -> DataFrame:
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc")
    return docs.filter("text is not null").select(doc, _rid().alias("rid"), "text")


def _pieces(line: Column) -> Column:
    """The words of a line, and empty strings where several spaces meet."""
    # one space is split without a regular expression, which is faster
    return F.when(line.rlike("[\t\x0b\x0c\r]"), F.split(line, r"[\x20\x09-\x0D]+")).otherwise(F.split(line, " "))


def _hashes(line: Column) -> Column:
    """The distinct word hashes of a line, sorted."""
    every = F.transform(_pieces(line), lambda w: F.xxhash64(w))
    return F.sort_array(F.array_distinct(F.array_remove(every, F.xxhash64(F.lit("")))))


def rarity(docs: DataFrame) -> np.ndarray:
    """Logarithmic counts of word occurrences per bucket of hashes."""
    lines = docs.select(F.explode(F.split("text", "\n")).alias("text"))
    found = lines.select(F.explode(_pieces(F.col("text"))).alias("word")).filter("word <> ''")
    bucket = F.xxhash64("word").bitwiseAND(F.lit(BUCKETS - 1)).cast("int")
    got = found.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")).toArrow()  # BUCKETS rows at most
    levels = np.zeros(BUCKETS, dtype=np.uint8)
    levels[got.column("bucket").to_numpy()] = np.minimum(255, 8 * np.log2(1.0 + got.column("n").to_numpy()))
    return levels


def split_words(texts: pa.Array) -> words.Words:
    """The words of some texts with the hashes that ``rarity`` counts, to look them up there."""
    found = words.split_words(texts, hashed=False)
    own = pa.array([found.text(i).decode() for i in range(len(found.starts))], pa.string())
    spark, hashes = SparkSession.getActiveSession(), [np.zeros(0, np.int64)]
    for at in range(0, len(own), CHUNK_ROWS):
        rows = spark.createDataFrame(pa.table({"word": own[at : at + CHUNK_ROWS]}))
        hashes.append(rows.select(F.xxhash64("word").alias("h")).toArrow().column("h").to_numpy())
    return replace(found, hashes=np.concatenate(hashes).view(np.uint64))


def _line_rows(docs: DataFrame, levels: np.ndarray, threshold: float) -> DataFrame:
    """Every line that is not blank with its set's key, size, signature and first tokens."""
    rows = _named(docs).select("doc", "rid", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    rows = rows.filter(F.length(F.btrim("text", F.lit(SPACE))) > 0)
    rows = rows.select("doc", "rid", "line", _hashes(F.col("text")).alias("words"))
    # 16 levels of 4 bits in a long, each an octave and a half
    nibbles = np.minimum(15, levels // 12).astype(np.uint64).reshape(-1, 16) << (4 * np.arange(16, dtype=np.uint64))
    packed = np.bitwise_or.reduce(nibbles, axis=1).view(np.int64)
    table = F.split(F.lit(",".join(map(str, packed.tolist()))), ",").cast("array<long>")

    def code(word: Column) -> Column:
        slot = word.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")
        at = F.shiftleft(slot.bitwiseAND(F.lit(15)), 2)
        level = F.call_function("shiftrightunsigned", F.get(table, F.shiftright(slot, 4)), at).bitwiseAND(F.lit(15))
        return F.shiftleft(level, 55).bitwiseOR(F.shiftrightunsigned(word, 9))

    def bit(word: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), word.bitwiseAND(F.lit(63)).cast("int"))

    none = F.lit(0).cast("long")
    n = F.size("words")
    size = n - F.ceil(n * threshold - 1e-9).cast("int") + 1
    first = F.slice(F.sort_array(F.transform("words", code)), F.lit(1), size)
    return rows.select(
        *ORDER,
        F.xxhash64("words").alias("k"),
        F.xxhash64(F.lit(1), "words").alias("k2"),
        n.alias("n"),
        F.aggregate("words", none, lambda bits, w: F.when(w < 0, bits.bitwiseXOR(bit(w))).otherwise(bits)).alias("s0"),
        F.aggregate("words", none, lambda bits, w: F.when(w < 0, bits).otherwise(bits.bitwiseXOR(bit(w)))).alias("s1"),
        F.transform(first, lambda c: c.bitwiseAND(F.lit((1 << 31) - 1)).cast("int")).alias("head"),
    )


def _dealt(lines: DataFrame, tokens: Column, opened: Column, ranked: bool = True) -> DataFrame:
    """The lines by ``tokens``, with the numbers that the filters need; ``size`` is the length, the
    place of the token (0 if they are not ``ranked``) and, in the last bit, whether the line looks for partners."""
    rows = lines.select("doc", "line", "id", "n", *SIGNS, opened.alias("open"), F.posexplode(tokens).alias("place", "token"))
    place = F.col("place").cast("long") if ranked else F.lit(0).cast("long")
    size = F.shiftleft(F.col("n").cast("long"), 32).bitwiseOR(F.shiftleft(place, 1)).bitwiseOR(F.col("open").cast("long"))
    return rows.select("token", "doc", "line", "id", size.alias("size"), *SIGNS)


def _apart(x: str, y: str) -> Column:
    """The number of signature bits in which two lines differ."""
    return sum((F.bit_count(F.col(x + c).bitwiseXOR(F.col(y + c))) for c in SIGNS), F.lit(0))


def _fits(x: str, y: str, threshold: float) -> Column:
    """Whether lengths, places and signatures of two lines, columns that begin with ``x`` and ``y``, allow
    enough overlap."""
    n, m = (F.shiftright(F.col(f"{t}size"), 32) for t in (x, y))
    at, other = (F.shiftright(F.col(f"{t}size").bitwiseAND(F.lit((1 << 32) - 1)), 1) for t in (x, y))
    need = F.ceil((n + m) * (threshold / (1 + threshold)) - 1e-9)
    fits = (m >= n * threshold - 1e-9) & (n >= m * threshold - 1e-9)
    return fits & (_apart(x, y) <= n + m - 2 * need) & (n - at >= need) & (m - other >= need)


def _line_key(rid: Column, line: Column) -> Column:
    return F.xxhash64(rid, line.cast("int"))


def _marked(keys: DataFrame, key: Column) -> Column:
    """Whether ``key`` may be among the column ``key`` of ``keys``: a bitmap of fixed
    size, as a constant. It only saves work; a join decides."""
    slot = F.pmod(F.col("key"), F.lit(FILTER_BITS))
    words = keys.groupBy(F.shiftright(slot, 6).cast("int").alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))).alias("bits")
    )
    bits = {r.w: r.bits for r in words.collect()}
    table = F.split(F.lit(",".join(str(bits.get(w, 0)) for w in range(FILTER_BITS // 64))), ",").cast("array<long>")
    slot = F.pmod(key, F.lit(FILTER_BITS))
    return F.getbit(F.get(table, F.shiftright(slot, 6).cast("int")), slot.bitwiseAND(F.lit(63)).cast("int")) == 1


def _verified(docs: DataFrame, firsts: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """Ids of the lines in ``pairs`` (a, b) that a similar line comes before, stored."""
    pairs = stored(pairs.select(F.least("a", "b").alias("ia"), F.greatest("a", "b").alias("ib")).distinct(), "asked")
    wanted = pairs.select(F.explode(F.array("ia", "ib")).alias("id")).distinct().join(firsts.select("id", *ORDER), "id")
    wanted = stored(wanted.withColumn("key", _line_key(F.col("rid"), F.col("line"))), "wanted")
    # most lines are not asked for and need not be shuffled
    texts = _named(docs).select("rid", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    texts = texts.filter(_marked(wanted, _line_key(F.col("rid"), F.col("line"))))
    found = wanted.join(texts, ["rid", "line"]).select("id", *ORDER, "text")
    # equal rows bring a line again: any of them will do
    tokens = stored(found.select("id", *ORDER, _hashes(F.col("text")).alias("words")), "tokens")
    drop(wanted)
    found = tokens.dropDuplicates(["id"])
    x, y = found.alias("x"), found.alias("y")
    both = pairs.join(x, F.col("ia") == F.col("x.id")).join(y, F.col("ib") == F.col("y.id"))
    shared = F.size(F.array_intersect("x.words", "y.words"))
    similar = both.filter(shared >= (F.size("x.words") + F.size("y.words") - shared) * threshold - 1e-9)
    x_first = F.struct("x.doc", "x.line", "x.rid") < F.struct("y.doc", "y.line", "y.rid")
    later = stored(similar.select(F.when(x_first, F.col("ib")).otherwise(F.col("ia")).alias("id")).distinct(), "settled")
    drop(pairs, tokens)
    return later


def _nearest(firsts: DataFrame, threshold: float) -> DataFrame:
    """The likeliest pair (a, b) of every line with the first line and the one before it of some of its tokens."""
    # the least by hash: lines that share most of their first tokens share some of these
    rows = _dealt(firsts, F.slice(F.sort_array("head"), 1, NEIGHBOURS), F.lit(True), ranked=False)
    order = Window.partitionBy("token").orderBy("doc", "line", "id")
    before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    columns = ("id", "size", *SIGNS)
    rows = rows.select(
        "*",
        *[F.first(c).over(before).alias(f"first_{c}") for c in columns],
        *[F.lag(c).over(order).alias(f"last_{c}") for c in columns],
    )
    partner = [
        F.when((F.col("id") != F.col(f"{t}id")) & _fits("", t, threshold), F.struct(_apart("", t).alias("apart"), F.col(f"{t}id").alias("b")))
        for t in ("first_", "last_")
    ]
    rows = rows.select("id", F.least(*partner).alias("near")).filter("near is not null")
    return rows.groupBy(F.col("id").alias("a")).agg(F.min("near").alias("near")).select("a", "near.b")


def _further(firsts: DataFrame, done: DataFrame, threshold: float) -> DataFrame:
    """All pairs (a, b) of lines a that are not ``done`` with lines b before them."""
    marked = firsts.join(done.withColumn("done", F.lit(True)), "id", "left")
    rows = _dealt(marked, F.col("head"), F.col("done").isNull())
    x, y = rows.alias("x"), rows.alias("y")
    # in one term with both sides, or one side would be filtered before it is dealt and both dealt apart
    asks = F.col("x.size").bitwiseAND(F.lit(1)) > F.when(F.col("x.id") == F.col("y.id"), 1).otherwise(0)
    # equal places in order: which line is the later one is not known here
    before = (F.col("y.doc") < F.col("x.doc")) | ((F.col("y.doc") == F.col("x.doc")) & (F.col("y.line") <= F.col("x.line")))
    pairs = x.join(y, (F.col("x.token") == F.col("y.token")) & before & asks & _fits("x.", "y.", threshold))
    return pairs.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))


def removed_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(rid, removed): the numbers of the lines to remove, stored; ``rid`` hashes doc_id
    and text."""
    lines = stored(_line_rows(docs, rarity(docs), threshold), "lines")
    first = F.min(F.struct(*ORDER, "n", *SIGNS, "head")).alias("first")
    firsts = lines.groupBy("k", "k2").agg(first, F.count(F.lit(1)).alias("times")).select("k", "k2", "times", "first.*")
    firsts = stored(firsts.withColumn("id", F.monotonically_increasing_id()), "firsts")
    # one pair a line, the likeliest, settles nearly all
    done = _verified(docs, firsts, _nearest(firsts, threshold), threshold)
    more = _verified(docs, firsts, _further(firsts, done, threshold), threshold)

    # every line but the first of its set, and the first too where a similar one comes before
    first = firsts.filter("times > 1").select("k", "k2", *[F.col(c).alias(f"first_{c}") for c in ORDER])
    repeated = lines.select(*ORDER, "k", "k2").join(first, ["k", "k2"])
    repeated = repeated.filter("doc <> first_doc or line <> first_line or rid <> first_rid").select("rid", "line")
    similar = firsts.join(done.union(more), "id").select("rid", "line")
    # a document's lines, as they were in one row
    every = repeated.union(similar).distinct()
    removed = stored(every.groupBy("rid").agg(F.sort_array(F.collect_list("line")).alias("removed")), "removed")
    drop(lines, firsts, done, more)
    return removed


def line_report(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_lines, n_removed and the numbers of the removed lines (from 0) of
    every document."""
    sizes = docs.select("doc_id", _rid().alias("rid"), F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).alias("n_lines"))
    return sizes.join(removed_lines(docs, threshold), "rid", "left").select(
        "doc_id",
        F.col("n_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join(F.col("removed").cast("array<string>"), ","), F.lit("")).alias("removed"),
    )


def remove_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents without the removed lines, all columns as given. A document
    that loses all its lines with words goes; one that had none stays."""
    columns, rid, gone = docs.columns, free_name(docs, "_rid"), free_name(docs, "_removed")
    removed = removed_lines(docs, threshold).select(F.col("rid").alias(rid), F.col("removed").alias(gone))
    rows = docs.withColumn(rid, _rid()).join(removed, rid, "left")
    kept = F.filter(F.split("text", "\n"), lambda line, i: ~F.array_contains(gone, i))
    empty = F.forall(kept, lambda line: F.length(F.btrim(line, F.lit(SPACE))) == 0)
    rows = rows.filter(F.col(gone).isNull() | ~empty)
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return rows.withColumn("text", text).select(*columns)
