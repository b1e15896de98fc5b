"""JSON array files read in byte ranges, and the place of their first error.

An array file is one long list of objects, often in a single line, so that a reader of whole
files gives it to one task. Here Spark cuts the file at every ``}`` while it reads byte
ranges. Whether such a place ends a record depends on what stands before: an open string, or
deeper brackets. Both are sums: the parity of quotes, and opening less closing brackets for either
parity. They are summed within a range and then over the ranges of a file, which tells every range the
state it begins in; a record ends where the depth is that of the list. Spark's parser reads the
records.

The shortest depth a range reaches at a ``}`` is the list's own, if any record ends in it, so
records are counted within the range before its start state is known, and the text is
shuffled by range once. Only records that are cut by nested objects or by a range's end
are put together from several pieces.

Lines end with a line feed. Elements of the list have to be objects.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefloom.functions.json_place import AFTER, VALUE, json_error
from prefloom.functions.text import py_strip
from prefloom.operators.positions import number_rows
from prefloom.operators.staging import written
from prefloom.session import scratch_folder

CONTEXT_LINES = 2
FILE_ROWS = 1 << 20  # records in one array file that is written
_SPACE = r"[ \t\n\r]*"


def _removed(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


def _count(text: Column, characters: str) -> Column:
    return F.length(_removed(text, f"[^{characters}]"))


def _read_pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """What stands between two ``}``, with its quotes, brackets and line ends."""
    paths = [path] if isinstance(path, str) else path
    raw = spark.read.option("lineSep", "}").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"),
        F.col("_metadata.file_size").alias("file_size"), F.monotonically_increasing_id().alias("place"), "value",
    )
    # without escapes every quote opens or closes a string
    plain = _removed(F.col("value"), r"(?s)\\.")
    outside = _removed(F.col("plain"), r'"[^"]*("|\z)')
    behind = _removed(_removed(F.col("plain"), r'^[^"]*("|\z)'), r'"[^"]*("|\z)')
    last_line = F.length("value") - F.instr(F.reverse("value"), "\n") + 1
    return raw.withColumn("plain", plain).select(
        "file", "range", "file_size", "place", "value",
        _count(F.col("plain"), '"').alias("quotes"),
        (_count(outside, r"\[{") - _count(outside, r"\]")).alias("deeper_0"),
        (_count(behind, r"\[{") - _count(behind, r"\]")).alias("deeper_1"),
        _count(F.col("value"), "\n").alias("lines"), F.length("value").alias("chars"),
        F.when(F.contains("value", F.lit("\n")), last_line).alias("line_at"),
        F.octet_length("value").alias("bytes"),
    )


def _within_ranges(pieces: DataFrame) -> DataFrame:
    """Sums up to each piece within its range, for a range that begins outside (0) or inside (1) a string."""
    order = Window.partitionBy("file", "range").orderBy("place")
    before, here = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy("file", "range")

    def earlier(column) -> Column:
        return F.coalesce(F.sum(column).over(before), F.lit(0))

    rows = pieces.withColumns({
        "seen": earlier("quotes"), "line": earlier("lines"), "char": earlier(F.col("chars") + 1),
        "ends_range": F.lead("place").over(order).isNull(),
    })
    for e in (0, 1):
        closed = (F.col("seen") + F.col("quotes") + e) % 2 == 0
        inner = F.when((F.col("seen") + e) % 2 == 0, F.col("deeper_0")).otherwise(F.col("deeper_1"))
        rows = rows.withColumns({f"closed_{e}": closed, f"step_{e}": inner - closed.cast("int")})
    rows = rows.withColumns(
        {f"depth_{e}": F.sum(f"step_{e}").over(here) for e in (0, 1)}
        | {"line_char": F.max(F.col("char") + F.col("line_at")).over(before)}
    )
    inside = ~F.col("ends_range")
    rows = rows.withColumns(
        {f"least_{e}": F.min(F.when(inside & F.col(f"closed_{e}"), F.col(f"depth_{e}"))).over(everything) for e in (0, 1)}
    )
    for e in (0, 1):
        ends = inside & F.col(f"closed_{e}") & (F.col(f"depth_{e}") == F.col(f"least_{e}"))
        rows = rows.withColumn(f"ends_{e}", F.coalesce(ends, F.lit(False)))
    return rows.withColumns(
        {f"record_{e}": earlier(F.col(f"ends_{e}").cast("int")) for e in (0, 1)}
        | {f"fresh_{e}": F.coalesce(F.lag(f"ends_{e}").over(order), F.lit(False)) for e in (0, 1)}
    )


def _ranges(rows: DataFrame) -> DataFrame:
    """The state each range begins in, from those before it in the file. A row per range."""
    def last(column):
        return F.max_by(column, "place")

    totals = rows.groupBy("file", "range").agg(
        (F.sum("quotes") % 2).alias("quotes"), F.sum("lines").alias("lines"), F.sum(F.col("chars") + 1).alias("chars"),
        F.max(F.col("char") + F.col("line_at")).alias("line_char"), F.sum(F.col("bytes") + 1).alias("bytes"),
        F.max("file_size").alias("file_size"),
        *[f(f"{c}_{e}").alias(f"{c}_{e}") for e in (0, 1) for c, f in (("depth", last), ("closed", last), ("least", F.max))],
        *[F.count_if(f"ends_{e}").alias(f"records_{e}") for e in (0, 1)],
    )
    order = Window.partitionBy("file").orderBy("range")
    before = order.rowsBetween(Window.unboundedPreceding, -1)

    def earlier(column) -> Column:
        return F.coalesce(F.sum(column).over(before), F.lit(0))

    def chosen(name: str) -> Column:
        return F.when(F.col("state") == 0, F.col(f"{name}_0")).otherwise(F.col(f"{name}_1"))

    states = totals.withColumns({
        "state": (earlier("quotes") % 2).cast("int"), "line_before": earlier("lines"), "char_before": earlier("chars"),
    })
    states = states.withColumns({
        **{n: chosen(n) for n in ("depth", "closed", "least", "records")},
        "line_char_before": F.max(F.col("char_before") + F.col("line_char")).over(before),
        # the file's last piece has no "}" behind it unless the file ends there
        "whole": F.lead("range").over(order).isNotNull()
        | (F.sum("bytes").over(Window.partitionBy("file")) == F.col("file_size")),
    }).withColumn("depth_before", earlier("depth"))
    has_ends = F.col("depth_before") + F.col("least") == 1
    last_ends = F.col("whole") & F.col("closed") & (F.col("depth_before") + F.col("depth") == 1)
    # a list that is closed too early; what follows is in no record
    sunk = F.col("depth_before") + F.col("least") < 1
    last_sunk = F.col("whole") & F.col("closed") & (F.col("depth_before") + F.col("depth") < 1)
    states = states.withColumns({
        "has_ends": F.coalesce(has_ends, F.lit(False)), "last_ends": last_ends, "sunk": F.coalesce(sunk, F.lit(False)),
        "last_sunk": last_sunk,
    }).withColumn("n", F.when(F.col("has_ends"), F.col("records")).otherwise(0) + F.col("last_ends").cast("int"))
    return states.select(
        "file", "range", "state", "has_ends", "last_ends", "sunk", "last_sunk", "whole", "line_before", "char_before", "line_char_before",
        earlier("n").alias("records_before"), F.sum("n").over(Window.partitionBy("file")).alias("records"),
        (F.col("whole") & F.lead("range").over(order).isNull()).alias("bare"),
        (F.col("line_before") + F.col("lines") + 1).alias("line_end"),
        (
            F.col("char_before") + F.col("chars") + 1
            - F.coalesce(F.col("char_before") + F.col("line_char"), "line_char_before", F.lit(0))
        ).alias("column_end"),
    )


def _units(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, record, records, sunk, text, line, column): the records of every file in order, and what
    follows the last one as the record after it. Line and column are where its text begins; the list
    is closed within a ``sunk`` one, or before it."""
    rows = written(_within_ranges(_read_pieces(spark, path)).drop("plain"), "pieces")
    states = written(_ranges(rows), "ranges")
    first = F.col("state") == 0
    number = F.when(F.col("has_ends"), F.when(first, F.col("record_0")).otherwise(F.col("record_1"))).otherwise(0)
    ends = F.when(
        F.col("ends_range"), F.col("last_ends")
    ).otherwise(F.col("has_ends") & F.when(first, F.col("ends_0")).otherwise(F.col("ends_1")))
    fresh = F.col("has_ends") & F.when(first, F.col("fresh_0")).otherwise(F.col("fresh_1"))
    line_char = F.coalesce(F.col("char_before") + F.col("line_char"), "line_char_before", F.lit(0))
    closing = F.when(F.col("ends_range") & ~F.col("whole"), "").otherwise("}")
    pieces = rows.join(states, ["file", "range"]).select(
        "file", "records", (F.col("sunk") | (F.col("ends_range") & F.col("last_sunk"))).alias("sunk"), (F.col("records_before") + number).alias("record"), (ends & fresh).alias("alone"), "range", "place",
        F.concat("value", closing).alias("text"), (F.col("line_before") + F.col("line") + 1).alias("line"),
        (F.col("char_before") + F.col("char") - line_char + 1).alias("column"),
    )
    # a file that ends with "}" has nothing behind its last record
    nothing = states.filter("bare").select(
        "file", "records", F.lit(False).alias("sunk"), F.col("records").alias("record"), F.lit(False).alias("alone"), "range",
        F.lit((1 << 63) - 1).alias("place"), F.lit("").alias("text"), F.col("line_end").alias("line"), F.col("column_end").alias("column"),
    )
    pieces = pieces.unionByName(nothing)
    # a record in one piece, as most are, needs no other
    alone = pieces.filter("alone").select("file", "record", "records", F.lit(False).alias("sunk"), "text", "line", "column")
    parts = pieces.filter("not alone").groupBy("file", "record").agg(
        F.max("records").alias("records"), F.bool_or("sunk").alias("sunk"), F.sort_array(F.collect_list(F.struct("range", "place", "text", "line", "column"))).alias("p")
    )
    joined = F.array_join(F.transform("p", lambda x: x["text"]), "")
    return alone.unionByName(
        parts.select("file", "record", "records", "sunk", joined.alias("text"), F.col("p")[0]["line"].alias("line"), F.col("p")[0]["column"].alias("column"))
    )


def _checked(units: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Units with their ``fields`` as VARIANT in ``parsed`` and ``ok``: no error in a record, or behind
    the last one."""
    is_record = F.col("record") < F.col("records")
    lead = F.when(F.col("record") == 0, rf"^{_SPACE}\[{_SPACE}(?=\{{)").otherwise(rf"^{_SPACE},{_SPACE}(?=\{{)")
    tail = F.when(F.col("records") == 0, rf"^{_SPACE}\[{_SPACE}\]{_SPACE}\z").otherwise(rf"^{_SPACE}\]{_SPACE}\z")
    schema = T.StructType([*[T.StructField(f, T.VariantType()) for f in fields], T.StructField("_corrupt", T.StringType())])
    body = F.regexp_replace("text", lead, F.lit(""))
    parsed = units.withColumns({"is_record": is_record, "led": F.rlike("text", lead)}).withColumn(
        "parsed", F.when(is_record & F.col("led"), F.from_json(body, schema, {"columnNameOfCorruptRecord": "_corrupt"}))
    )
    # the parser does not look at what follows an object
    ok = F.when(F.col("is_record"), F.col("led") & ~F.col("sunk") & F.col("parsed._corrupt").isNull()).otherwise(F.rlike("text", tail))
    return parsed.select(
        "file", "record", "records", "is_record", "text", "line", "column", ok.alias("ok"), "parsed"
    )


def ingest_array_ranges(
    spark: SparkSession, path: str | list[str], types: dict[str, str], out: str | None = None, skip_bad: bool = False
) -> DataFrame:
    """Records of array files by byte ranges, converted once to Parquet, with their list position ``pos``.

    Files follow each other by name. A file with an error anywhere gives no records: it stops
    the job, unless ``skip_bad`` leaves it to ``array_rejects``. Blank files have none.
    """
    out = out or scratch_folder(spark, "array-records")
    checked = _checked(_units(spark, path), list(types))
    blank = (F.col("records") == 0) & (py_strip(F.col("text")) == "")
    fields = [F.try_variant_get(F.col(f"parsed.`{n}`"), "$", t).alias(n) for n, t in types.items()]
    checked.select("file", "record", "records", "is_record", "ok", blank.alias("blank"), F.struct(*fields).alias("fields")).write.parquet(out)
    rows = spark.read.parquet(out)
    # a row per file
    files = rows.groupBy("file").agg(
        F.max("records").alias("n"), (F.bool_and("ok") | F.bool_and("blank")).alias("_good")
    )
    if not skip_bad:
        told = F.concat(F.lit("no JSON in "), "file")
        files = files.withColumn("_good", F.when(F.col("_good"), True).otherwise(F.raise_error(told).cast("boolean")))
    start = F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    good = files.filter("_good").select("file", start.alias("_start"))
    return rows.filter("is_record").join(good, "file").select((F.col("_start") + F.col("record")).alias("pos"), "fields.*")


def array_rejects(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, message, line, column, context) of the first error of every malformed array file.

    Only the first bad record of a file is looked into, from the state a reader is in at its
    start. A quote that is missing can make it the rest of the file.
    """
    units = _units(spark, path)
    first = _checked(units, []).filter("not ok").groupBy("file").agg(F.min("record").alias("record"))
    blank = (F.col("records") == 0) & (py_strip(F.col("text")) == "")
    bad = units.join(first, ["file", "record"]).filter(~blank)
    begins = F.col("record") == 0
    error = json_error(
        F.col("text"), F.when(begins, VALUE).otherwise(AFTER), F.when(begins, "").otherwise("["),
        F.col("record") < F.col("records"),
    )
    told = bad.select("file", "text", "line", "column", error.alias("error")).select(
        "file", F.col("error.message").alias("message"), *_place(F.col("text"), F.col("error.at"), F.col("line"), F.col("column"))
    )
    told = written(told, "array-errors")
    # the lines around, of these files alone
    lines = numbered_lines(spark, path, told.select("file"))
    near = F.abs(F.col("number") - F.col("line")) <= CONTEXT_LINES
    shown = lines.withColumnRenamed("line", "shown").join(told, "file").filter(near).groupBy("file").agg(
        F.sort_array(F.collect_list(F.struct(F.col("number").alias("line"), F.col("shown").alias("text")))).alias("context")
    )
    return told.join(shown, "file", "left")


def _place(text: Column, at: Column, line: Column, column: Column) -> list[Column]:
    """Line and column, from 1, of a place in a text that begins at a line and column."""
    head = F.substring(text, F.lit(1), at)
    below = F.length(_removed(head, "[^\n]"))
    since = F.instr(F.reverse(head), "\n")
    return [
        (line + below).cast("int").alias("line"),
        F.when(below > 0, since).otherwise(column + at).cast("int").alias("column"),
    ]


def write_array(df: DataFrame, path: str, order: str = "pos", file_rows: int = FILE_ROWS, mode: str = "error") -> None:
    """Rows as JSON array files of ``file_rows`` records, one after another in ``order``, a unique integer.

    Every file is a list of its own, one record a line, and the names of the files are in the
    order of their records, so that together they are the list; with enough ``file_rows`` there
    is one. NULL fields are written. Brackets and commas are part of the rows, so writing is
    Spark's: what a failed attempt of a task leaves is not taken over, and ``path`` has
    its mark only when all files are whole.
    """
    columns = [c for c in df.columns]
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false"})
    placed = number_rows(df.select(F.col(order).alias("_key"), record.alias("_record")), "_key", number="_place")
    first = F.col("_place") % file_rows == 0
    line = F.struct(F.col("_place").alias("place"), F.concat(F.when(first, "[").otherwise(","), "_record").alias("value"))
    # the first row of a file brings its last line along
    end = F.struct(F.lit((1 << 63) - 1).alias("place"), F.lit("]").alias("value"))
    number = F.lpad(F.floor(F.col("_place") / file_rows).cast("string"), 19, "0")
    lines = placed.select(number.alias("file"), F.inline(F.when(first, F.array(line, end)).otherwise(F.array(line))))
    dealt = lines.repartition("file").sortWithinPartitions("file", "place")
    dealt.select("file", "value").write.mode(mode).partitionBy("file").text(path)


def numbered_lines(spark: SparkSession, path: str | list[str], files: DataFrame | None = None) -> DataFrame:
    """(file, number, line): the lines of text files by number from 1, counted within byte ranges
    and then over the ranges of a file."""
    raw = spark.read.option("lineSep", "\n").text([path] if isinstance(path, str) else path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("place"), F.col("value").alias("line"),
    )
    if files is not None:
        raw = raw.join(files, "file", "left_semi")
    counts = raw.groupBy("file", "range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("file", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("file", "range").orderBy("place"))
    return raw.withColumn("inside", inside).join(starts, ["file", "range"]).select(
        "file", (F.col("start") + F.col("inside")).alias("number"), "line"
    )


def with_json_error(df: DataFrame, text: str) -> DataFrame:
    """Add ``error`` (message, line, column, context) for texts that are no JSON; NULL for others."""
    value = F.col(text)
    found = df.withColumn("_error", json_error(value))
    line, column = _place(value, F.col("_error.at"), F.lit(1), F.lit(1))
    lines = F.split(value, "\n")
    first = F.greatest(F.col("_line") - CONTEXT_LINES, F.lit(1))
    last = F.least(F.col("_line") + CONTEXT_LINES, F.size(lines))
    context = F.transform(F.sequence(first, last), lambda n: F.struct(n.alias("line"), F.get(lines, n - 1).alias("text")))
    told = found.withColumns({"_line": line, "_column": column}).withColumn(
        "error",
        F.when(F.col("_error").isNotNull(), F.struct(
            F.col("_error.message").alias("message"), F.col("_line").alias("line"), F.col("_column").alias("column"), context.alias("context"),
        )),
    )
    return told.drop("_error", "_line", "_column")
