"""Multiple-choice question files in their three shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prefloom.operators.positions import with_position
from prefloom.operators.staging import compute_once

LETTERS = ("A", "B", "C", "D")
# JSON texts that are false as a condition
_EMPTY = ("null", '""', "0", "0.0", "-0.0", "false", "[]", "{}")


def _as_text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _truthy(value: Column) -> Column:
    return value.isNotNull() & ~F.to_json(value).isin(*_EMPTY)


# the fields each shape may use; opened together, an absent one is NULL, a JSON null is not
_LOWER = ("question", "answer", "subject", "category", "options", *LETTERS)
_FIELDS = {"list": ("Question", "Answer", "subject", *LETTERS), "data": _LOWER, "keyed": _LOWER}


def normalise_questions(records: DataFrame, shape: str, keep: tuple[str, ...] = ("pos",)) -> DataFrame:
    """Rows with subject, question, options and answer from VARIANT ``record``.

    ``shape`` tells the spelling: ``list`` (Question, Answer, subject), ``data``
    (question, answer, subject or category) or ``keyed`` (subject is a column).
    Rows without question, answer or options are dropped.
    """
    record = "struct<" + ", ".join(f"{f}: variant" for f in _FIELDS[shape]) + ">"
    opened = compute_once(records, "_f", F.try_variant_get("record", "$", record))
    letters = [F.col(f"_f.{x}") for x in LETTERS]
    lettered = letters[0].isNotNull()
    for x in letters[1:]:
        lettered = lettered & x.isNotNull()
    options = F.when(lettered, F.array(*[_as_text(x) for x in letters]))
    has_options = lettered
    if shape == "list":
        question, answer = F.col("_f.Question"), F.col("_f.Answer")
        subject = F.when(F.col("_f.subject").isNull(), "").otherwise(_as_text(F.col("_f.subject")))
    else:
        question, answer = F.col("_f.question"), F.col("_f.answer")
        listed = F.try_variant_get("_f.options", "$", "array<string>")
        options = options.otherwise(listed)
        has_options = lettered | (F.size(listed) > 0)
        subject = F.col("subject") if shape == "keyed" else None
        if shape == "data":
            named = F.coalesce("_f.subject", "_f.category")
            subject = F.when(named.isNull(), "default").otherwise(_as_text(named))
    return opened.filter(_truthy(question) & _truthy(answer) & has_options).select(
        *keep,
        subject.alias("subject"),
        _as_text(question).alias("question"),
        options.alias("options"),
        _as_text(answer).alias("answer"),
    )


def _shape(doc: Column) -> Column:
    kind = F.schema_of_variant(doc)
    data = F.schema_of_variant(F.try_variant_get(doc, "$.data", "variant"))
    return (
        F.when(kind.startswith("ARRAY"), "list")
        .when(kind.startswith("OBJECT") & data.startswith("ARRAY"), "data")
        .when(kind.startswith("OBJECT"), "keyed")
        .otherwise("unknown")
    )


def read_choice_questions(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Questions of one file or of many files of one shape, with a dense ``pos`` in the
    order of files, then (``keyed``) subjects by name, then the list.

    A question file is one JSON value and is parsed as a whole, so the size of a
    VARIANT bounds it; larger sets come as JSON lines through
    ``read_whole_lines`` and ``normalise_questions``.
    """
    docs = (
        spark.read.option("singleVariantColumn", "doc").option("multiLine", True).json(path)
        .select(F.col("_metadata.file_path").alias("file"), "doc")
        .withColumn("shape", _shape(F.col("doc")))
    )
    # at most four shapes exist
    shapes = {r["shape"] for r in docs.select("shape").distinct().collect()}
    if len(shapes) != 1 or "unknown" in shapes:
        raise ValueError(f"a question file is a list, a data object or subjects: {sorted(shapes)}")
    shape = shapes.pop()
    if shape == "keyed":
        records = spark.sql(
            "SELECT file, s.pos AS part, i.pos AS at, s.key AS subject, i.value AS record"
            " FROM {docs}, LATERAL variant_explode(doc) AS s,"
            " LATERAL variant_explode(CASE WHEN schema_of_variant(s.value) LIKE 'ARRAY%' THEN s.value END) AS i",
            docs=docs,
        )
    else:
        source = "doc" if shape == "list" else "try_variant_get(doc, '$.data', 'variant')"
        records = spark.sql(
            "SELECT file, 0 AS part, i.pos AS at, i.value AS record"
            f" FROM {{docs}}, LATERAL variant_explode({source}) AS i",
            docs=docs,
        )
    order = ("file", "part", "at")
    return with_position(normalise_questions(records, shape, keep=order), order).drop(*order)
