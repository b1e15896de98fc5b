"""Record files: reading, checking, position and writing."""

from __future__ import annotations

import json
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefloom.functions.text import py_strip
from prefloom.operators.positions import with_position

ORDER = ("file", "split", "line")


def read_variants(
    spark: SparkSession, path: str | list[str], fields: Sequence[str], layout: str = "lines"
) -> DataFrame:
    """One row per record, each field as VARIANT, plus the columns of ``ORDER``.

    An absent field is NULL, a JSON null is a variant null, and a field of an
    unexpected type breaks nothing. Unparsable text is in ``corrupt``.
    ``layout`` is ``lines`` (one record per line, splittable) or ``array`` (one
    JSON array per file, which one task must read as a whole; ``sources.arrays`` reads
    such files in byte ranges).
    """
    if layout not in ("lines", "array"):
        raise ValueError(f"layout is lines or array, not {layout}")
    schema = T.StructType(
        [T.StructField(f, T.VariantType()) for f in fields] + [T.StructField("corrupt", T.StringType())]
    )
    rows = (
        spark.read.schema(schema)
        .option("multiLine", layout == "array")
        .option("columnNameOfCorruptRecord", "corrupt")
        .json(path)
    )
    # file, split and a number that grows within a split: together the order of the files
    return rows.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("line"),
        *fields, "corrupt",
    )


def read_whole_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line with the whole record, unknown keys included, as VARIANT
    ``extra``. A line that is no JSON stays, with a NULL record; ``malformed_lines``
    has its text."""
    return spark.read.schema("extra VARIANT").option("singleVariantColumn", "extra").json(path)


def typed(records: DataFrame, types: dict[str, str]) -> DataFrame:
    """VARIANT fields as columns of the given types; what does not fit is NULL."""
    return records.withColumns(
        {name: F.try_variant_get(name, "$", kind) for name, kind in types.items()}
    )


def read_records(
    spark: SparkSession,
    path: str | list[str],
    types: dict[str, str],
    layout: str = "lines",
    skip_bad: bool = False,
) -> DataFrame:
    """Typed records with the columns of ``ORDER``.

    An unparsable record stops the job with its file and text, unless ``skip_bad``
    leaves such records to ``read_rejects``.
    """
    records = read_variants(spark, path, list(types), layout)
    good = F.col("corrupt").isNull()
    if not skip_bad:
        told = F.concat(F.lit("no JSON in "), "file", F.lit(": "), F.substring("corrupt", 1, 200))
        good = F.when(good, F.lit(True)).otherwise(F.raise_error(told).cast("boolean"))
    return typed(records.filter(good), types).drop("corrupt")


def read_rejects(spark: SparkSession, path: str | list[str], layout: str = "lines") -> DataFrame:
    """(file, split, line, reason, text) of every record that is no JSON; of an array
    file that is malformed anywhere, one row for the whole file."""
    # a corrupt row has no field; Spark wants one to be read beside the corrupt text
    rows = read_variants(spark, path, ["_none"], layout)
    bad = rows.filter(F.col("corrupt").isNotNull() & F.col("_none").isNull())
    reason = F.lit("malformed_line" if layout == "lines" else "malformed_file")
    return bad.select(*ORDER, reason.alias("reason"), F.col("corrupt").alias("text"))


def ingest_records(
    spark: SparkSession,
    path: str | list[str],
    types: dict[str, str],
    layout: str = "lines",
    out: str | None = None,
    partitions: int | None = None,
    skip_bad: bool = False,
) -> DataFrame:
    """Records converted once to Parquet with their list position ``pos``; bad
    records as in ``read_records``."""
    records = read_records(spark, path, types, layout, skip_bad)
    return with_position(records, ORDER, partitions=partitions, path=out).drop(*ORDER)


def file_starts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, start, rows): the position of each file's first row in a Parquet table.

    Files follow each other by part number, then by name: Spark pads the numbers to
    five digits only, so names alone go wrong from the 100,000th file on.
    """
    paths = [path] if isinstance(path, str) else path
    counts = spark.read.parquet(*paths).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    name = F.element_at(F.split("file", "/"), -1)
    number = F.regexp_extract(name, r"part-(\d+)", 1).try_cast("bigint")
    # one short row per file
    earlier = Window.orderBy(number.asc_nulls_first(), "file").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("file", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("start"), "rows")


def placed_rows(spark: SparkSession, path: str | list[str], starts: DataFrame, name: str = "pos") -> DataFrame:
    """Rows of Parquet files with their position, from the files' starts."""
    paths = [path] if isinstance(path, str) else path
    rows = spark.read.parquet(*paths)
    placed = rows.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at")
    )
    starts = starts.select(F.col("file").alias("_file"), F.col("start").alias("_start"))
    return placed.join(starts, "_file").select((F.col("_start") + F.col("_at")).alias(name), *rows.columns)


def read_snapshot(spark: SparkSession, path: str, name: str = "pos") -> DataFrame:
    """A Parquet table with the stored row order as position.

    File order by part number, then the row's place in its file. The rows are
    neither shuffled nor sorted as long as the list of files is small enough for
    Spark to broadcast.
    """
    return placed_rows(spark, path, file_starts(spark, path), name)


def read_range(spark: SparkSession, starts: DataFrame, begin: int, end: int, schema: T.StructType) -> DataFrame:
    """Rows ``begin`` to ``end`` of a Parquet table by position, from the files that hold some."""
    overlap = starts.filter((F.col("start") < end) & (F.col("start") + F.col("rows") > begin))
    # only the files to read come to the driver, as in any listing
    files = overlap.collect() if begin < end else []
    if not files:
        return spark.createDataFrame([], T.StructType([T.StructField("pos", T.LongType()), *schema.fields]))
    rows = placed_rows(spark, [unquote(f["file"]) for f in files], spark.createDataFrame(files, starts.schema))
    return rows.filter((F.col("pos") >= begin) & (F.col("pos") < end))


def snapshot_size(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def write_records(df: DataFrame, path: str, fmt: str = "json", mode: str = "error") -> None:
    """JSON lines (UTF-8, one record per line) or Parquet. NULL fields are written,
    so that null and absent stay apart."""
    writer = df.write.mode(mode)
    if fmt == "json":
        writer = writer.option("ignoreNullFields", "false")
    writer.format(fmt).save(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a finished job wrote ``path``; a half-written folder has no mark."""
    return path_exists(spark, f"{path}/_SUCCESS")


def write_once(df: DataFrame, path: str, fmt: str = "parquet") -> bool:
    """Write unless a finished result is there; says whether it wrote."""
    if is_complete(df.sparkSession, path):
        return False
    write_records(df, path, fmt, mode="overwrite")
    return True


def input_manifest(spark: SparkSession, path: str | list[str], **parameters) -> DataFrame:
    """(kind, name, value): every input file with its size and time of change, and the parameters."""
    paths = [path] if isinstance(path, str) else path
    # one short row per file; the files' content is not read
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths).select(
        F.lit("file").alias("kind"), F.col("path").alias("name"),
        F.concat_ws(" ", F.col("length").cast("string"), F.unix_micros("modificationTime").cast("string")).alias("value"),
    )
    told = [("parameter", n, json.dumps(v, sort_keys=True)) for n, v in sorted(parameters.items())]
    return files.unionByName(spark.createDataFrame(told, "kind string, name string, value string"))


def write_manifested(df: DataFrame, path: str, inputs: str | list[str], fmt: str = "parquet", **parameters) -> bool:
    """Write unless a finished result made from the same inputs and parameters is there; says whether it wrote.

    The manifest is written after the result, to ``path`` with ``.manifest`` behind it, and removed before it: a
    result without one counts as unfinished.
    """
    spark, place = df.sparkSession, f"{path}.manifest"
    now = input_manifest(spark, inputs, **parameters)
    if is_complete(spark, path) and is_complete(spark, place):
        before = spark.read.schema(now.schema).parquet(place)
        if now.exceptAll(before).isEmpty() and before.exceptAll(now).isEmpty():
            return False
    delete_path(spark, place)
    write_records(df, path, fmt, mode="overwrite")
    write_records(now, place, "parquet", mode="overwrite")
    return True


def delete_path(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path``."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()


def read_if_present(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet rows, or an empty table while ``path`` does not exist."""
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def check_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per array file: ``status`` (ok, empty, malformed) and records.

    The parser streams each file, so no file has to fit into one string.
    """
    paths = [path] if isinstance(path, str) else path
    raw = spark.read.text(paths)
    # scans skip files without a byte, so the list is the one the driver made for the scan
    listed = spark.createDataFrame([(f,) for f in raw.inputFiles()], "file string")
    # the list writes an empty host as scheme:///, the scan as scheme:/
    files = listed.select(F.regexp_replace("file", "^([^:/]+):///", "$1:/").alias("file"))
    lines = raw.select(F.col("_metadata.file_path").alias("file"), "value")
    texts = lines.filter(py_strip(F.col("value")) != "").groupBy("file").agg(
        F.lit(True).alias("_has_text")
    )
    # a corrupt row has no field; Spark wants one to be read beside the corrupt text
    bad = F.col("corrupt").isNotNull() & F.col("_none").isNull()
    parsed = read_variants(spark, paths, ["_none"], "array").groupBy("file").agg(
        F.count_if(~bad).alias("records"), F.count_if(bad).alias("_bad")
    )
    status = (
        F.when(F.col("_bad") > 0, "malformed").when(F.col("_has_text"), "ok").otherwise("empty")
    )
    return files.join(texts, "file", "left").join(parsed, "file", "left").select(
        "file", status.alias("status"),
        F.when(status == "ok", F.coalesce("records", F.lit(0))).otherwise(0).alias("records"),
    )


def line_status(line: Column) -> Column:
    """``ok``, ``empty`` or ``malformed`` for the text of one JSON record."""
    return (
        F.when(py_strip(line) == "", "empty")
        .when(F.try_parse_json(line).isNull(), "malformed").otherwise("ok")
    )


def malformed_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """File and text of every line that is no JSON."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    return lines.filter(line_status(F.col("value")) == "malformed")
