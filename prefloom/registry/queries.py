"""Spark side of the registered queries: (spark, sf_dir) -> DataFrame.

Arrays are joined to text in the last projection, so that results compare by
value in any engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prefloom.functions.prompts import compose_prompt, message, render_chat
from prefloom.operators import chat, choice, completion, judging, positions, preference, splits, training
from prefloom.operators.staging import compute_once, shuffles_freed
from prefloom.plans import choice as choice_plan
from prefloom.plans import judging as judging_plan
from prefloom.plans import preference as preference_plan
from prefloom.plans import splitting
from prefloom.plans import training as training_plan
from prefloom.registry import inputs, stubs
from prefloom.session import scratch_folder
from prefloom.sources import arrays, questions, records
from prefloom.streaming import ledger, ranking, store

MAX_PAIRS = 100  # the cap of the capped queries
PARTS = {"train": 500, "preference": 150, "evaluation": 50}
WIDTH = 8  # rows per padded batch
PAD_ID = 0
STREAM_FILES = 16  # files of the stream; a quarter of them makes a micro-batch
STORE_BITS = 1  # bits of the first bucket: batches are small here
FILE_ROWS = 64  # documents in one array file
QUESTION_ROWS = 256  # positions of the questions in one question file
BALANCED_TASKS = 16  # tasks of equal cost
EPOCHS = 3
COPIES = 20  # times every benchmark item is in the question files


def joined(array: str | Column, sep: str = " ") -> Column:
    array = F.col(array) if isinstance(array, str) else array
    return F.array_join(F.transform(array, lambda x: x.cast("string")), sep)


def _tasks(spark: SparkSession) -> int:
    """Model calls run on every core, however few files hold the rows."""
    return spark.sparkContext.defaultParallelism


def _make(responder):
    """A factory that carries the function alone to the workers."""
    return lambda: responder


def _ranked(spark, sf):
    return preference.parse_rankings(inputs.rank_replies(spark, sf))


def _scored(spark, sf):
    return judging.score_replies(inputs.judge_replies(spark, sf))


def _doc_columns() -> list:
    return ["doc_id", "lang", "source", "n_chars", F.md5("text").alias("text_md5")]


# --- judging


def judge_score(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf).select("pos", "judge_response", "score", "status")


def judge_summary(spark, sf):
    return judging.judge_summary(_scored(spark, sf))


def judge_stats(spark, sf):
    return judging.judge_stats(_scored(spark, sf))


def judge_distribution(spark, sf):
    return judging.judge_distribution(_scored(spark, sf))


def judge_distribution_gap(spark, sf):
    return judging.judge_distribution(_scored(spark, sf), with_gap_bucket=True)


def judge_prompt(spark, sf):
    rows = inputs.instructions(spark, sf).select(
        "pos", "instruction", F.col("output").alias("ground_truth"), F.col("input").alias("response")
    )
    return judging.with_judge_prompt(rows).select("pos", "prompt")


def judge_input_rejects(spark, sf):
    docs, labels = (inputs.table(spark, sf, t) for t in ("documents", "labels"))
    text, none = F.col("text"), F.lit(None).cast("string")
    keep_null = {"ignoreNullFields": "false"}
    # absent response, absent instruction, null response, both texts
    line = (
        F.when(F.col("quality").isNull(), F.to_json(F.struct(text.alias("instruction"))))
        .when(F.col("toxic") == 1, F.to_json(F.struct(text.alias("response"))))
        .when(
            F.col("quality") == 0,
            F.to_json(F.struct(text.alias("instruction"), none.alias("response")), keep_null),
        )
        .otherwise(F.to_json(F.struct(text.alias("instruction"), text.alias("response"))))
    )
    lines = docs.join(labels, "doc_id", "left").select(F.col("doc_id").alias("pos"), line.alias("line"))
    parsed = compute_once(lines, "record", F.parse_json("line"))
    fields = parsed.select("pos", *_fields("instruction", "response"))
    return judging.judge_input_reason(fields).filter("reason IS NOT NULL").select("pos", "reason")


def _fields(*names):
    return [F.try_variant_get("record", f"$.{n}", "variant").alias(n) for n in names]


# --- multiple choice


def _option_rows(spark, sf):
    return inputs.questions(spark, sf).filter("question <> ''").select(
        "pos", "subject", "question", F.array("A", "B", "C", "D").alias("options"), "answer", "model_output"
    )


def _selected(spark, sf):
    return choice.select_subjects(_option_rows(spark, sf), inputs.SUBJECTS)


def _graded(spark, sf):
    return choice.grade_answers(_selected(spark, sf))


def mcq_normalise(spark, sf):
    raw = inputs.questions(spark, sf)
    upper = raw.select(
        "pos",
        F.struct(
            "subject", F.col("question").alias("Question"), F.col("answer").alias("Answer"), "A", "B", "C", "D"
        ).alias("row"),
    )
    lower = raw.select(
        "pos",
        F.struct(
            F.col("subject").alias("category"), "question", "answer", F.array("A", "B", "C", "D").alias("options")
        ).alias("row"),
    )
    parts = []
    for shape, rows in (("list", upper), ("data", lower)):
        parsed = compute_once(rows, "record", F.parse_json(F.to_json("row")))
        parts.append(questions.normalise_questions(parsed, shape).withColumn("shape", F.lit(shape)))
    return parts[0].unionByName(parts[1]).select(
        "shape", "pos", "subject", "question", joined("options", "|").alias("options"), "answer"
    )


def _question_files(spark, sf, shape) -> str:
    """Every benchmark question 20 times, in files of one shape that hold a bounded range
    of one copy (keyed: and one subject). The order of their names is that of the questions."""
    copies = inputs.questions(spark, sf).select("*", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))).alias("copy"))
    upper = F.struct("subject", F.col("question").alias("Question"), F.col("answer").alias("Answer"), "A", "B", "C", "D")
    lower = F.struct(F.col("subject").alias("category"), "question", "answer", F.array("A", "B", "C", "D").alias("options"))
    row = upper if shape == "list" else lower
    keyed = shape == "keyed"
    # "-" comes before all digits, and hexadecimal digits are in the order of the bytes
    number = [F.lpad(F.col("copy").cast("string"), 10, "0"), F.lpad(F.floor(F.col("pos") / QUESTION_ROWS).cast("string"), 19, "0")]
    name = F.concat_ws("-", F.col("copy") % 2, *([F.hex("subject")] if keyed else []), *number)
    rows = copies.select(name.alias("g"), "subject", F.struct("pos", row.alias("row")).alias("item"))
    files = rows.groupBy("g").agg(
        F.first("subject").alias("subject"), F.transform(F.sort_array(F.collect_list("item")), lambda x: x["row"]).alias("rows")
    )
    body = F.create_map("subject", "rows") if keyed else F.col("rows") if shape == "list" else F.struct(F.col("rows").alias("data"))
    path = scratch_folder(spark, "questions")
    files.select("g", F.to_json(body).alias("value")).write.partitionBy("g").text(path)
    return path


def _mcq_read(shape):
    def query(spark, sf):
        read = questions.read_choice_questions(spark, _question_files(spark, sf, shape))
        return read.withColumn("options", joined("options", "|"))

    return query


def mcq_selected(spark, sf):
    return _selected(spark, sf).select("subject_no", "subject", "pos", "question", "answer")


def mcq_subject_counts(spark, sf):
    return choice.subject_counts(_selected(spark, sf))


def mcq_limit(spark, sf):
    return choice.limit_per_subject(_selected(spark, sf), 3).select("subject", "question_id", "pos")


def mcq_prompt(spark, sf):
    return choice.with_choice_prompt(_selected(spark, sf)).select("pos", "prompt")


def mcq_answer(spark, sf):
    return _graded(spark, sf).select("pos", "model_output", "predicted_answer", "is_correct")


def mcq_accuracy(spark, sf):
    return choice.accuracy(_graded(spark, sf))


def mcq_compat(spark, sf):
    listed = [*inputs.SUBJECTS, "anatomy"]
    return choice.listed_accuracy(choice.accuracy(_graded(spark, sf)), listed)


def mcq_running(spark, sf):
    return choice.running_accuracy(_graded(spark, sf), every=3)


def mcq_details(spark, sf):
    graded = choice.grade_answers(
        choice.with_choice_prompt(choice.number_per_subject(_selected(spark, sf)))
    )
    return choice.answer_details(graded).withColumn("options", joined("options", "|"))


def _evaluated(spark, sf):
    """Every selected question prompted, answered by a stub, graded and scored."""
    return choice_plan.evaluate_choices(
        _option_rows(spark, sf).drop("model_output"), inputs.SUBJECTS,
        scratch_folder(spark, "choices"), _make(stubs.chooser), partitions=_tasks(spark),
    )


def choice_accuracy_flow(spark, sf):
    return _evaluated(spark, sf).accuracy


def choice_document(spark, sf):
    """The entries of the written document of the same flow."""
    schema = "results map<string, struct<acc: double, samples: bigint, acc_stderr: double>>"
    entries = _evaluated(spark, sf).document.select(F.explode(F.from_json("document", schema)["results"]).alias("key", "value"))
    return entries.select("key", "value.acc", "value.samples", "value.acc_stderr")


# --- positions and splits


def dense_position(spark, sf):
    docs = inputs.table(spark, sf, "documents")
    return positions.number_rows(docs, "doc_id").select("pos", *_doc_columns())


def dense_position_by_columns(spark, sf):
    docs = inputs.table(spark, sf, "documents")
    return positions.with_position(docs, ["lang", "source", "doc_id"]).select("pos", *_doc_columns())


def snapshot_position(spark, sf):
    return records.read_snapshot(spark, f"{sf}/documents.parquet").select("pos", *_doc_columns())


def snapshot_size(spark, sf):
    return records.snapshot_size(inputs.table(spark, sf, "lineitem"))


def _part(name):
    def query(spark, sf):
        docs = inputs.table(spark, sf, "documents")
        return splits.split_rows(docs, "doc_id", **PARTS)[name].select(*_doc_columns())

    return query


def split_snapshot(spark, sf):
    """The three parts written from a stored table, each from the files that hold its rows."""
    parts = splitting.split_snapshot(
        spark, f"{sf}/documents.parquet", scratch_folder(spark, "parts"), **PARTS
    )
    both = None
    for name, part in parts.items():
        rows = part.select(F.lit(name).alias("part"), "pos", *_doc_columns())
        both = rows if both is None else both.unionByName(rows)
    return both


# --- supervised data and responses


def sft_messages(spark, sf):
    rows = chat.supervised_messages(inputs.instructions(spark, sf), keep=("pos",))
    return rows.select(
        "pos", joined(F.col("messages.role"), ",").alias("roles"),
        F.col("messages")[0]["content"].alias("user_text"),
        F.col("messages")[1]["content"].alias("assistant_text"),
    )


def compose(spark, sf):
    return inputs.instructions(spark, sf).select(
        "pos", compose_prompt(F.col("instruction"), F.col("input")).alias("prompt")
    )


def render(spark, sf):
    content = compose_prompt(F.col("instruction"), F.col("input"))
    return inputs.instructions(spark, sf).select(
        "pos", render_chat(F.array(message("user", content))).alias("chat")
    )


def response_rows(spark, sf):
    generated = F.concat(F.lit(" 　"), "output", F.lit("\n"), "input", F.lit(" \t"))
    rows = inputs.instructions(spark, sf).withColumn("response", generated)
    return chat.response_rows(rows, keep=("pos",))


def positional_zip(spark, sf):
    rows = inputs.instructions(spark, sf)
    turns = inputs.table(spark, sf, "conversations")
    outputs = turns.select(
        (F.col("conv_id") * inputs.TURNS + F.col("turn") - 1).alias("pos"), F.col("text").alias("response")
    )
    return chat.response_rows(chat.zip_outputs(rows, outputs), keep=("pos",))


# --- completion


def _chats(spark, sf):
    content = compose_prompt(F.col("instruction"), F.col("input"))
    return inputs.instructions(spark, sf).select("pos", "instruction", content.alias("prompt"))


def complete_stub(spark, sf):
    done = completion.complete(_chats(spark, sf), "prompt", _make(stubs.last_line), keep_prompt=False)
    return done.select("pos", "response", "status")


def complete_balanced(spark, sf):
    """The rows of ``complete_stub`` from tasks with equal totals of prompt characters."""
    done = completion.complete_balanced(
        _chats(spark, sf), "prompt", _make(stubs.last_line), partitions=BALANCED_TASKS, keep_prompt=False
    )
    return done.select("pos", "response", "status")


def complete_samples(spark, sf):
    done = completion.complete(
        _chats(spark, sf), "prompt", _make(stubs.sampler), out="responses", k=4
    )
    return done.select("pos", joined(F.array_sort("responses"), "|").alias("responses"), "status")


def _some_null(spark, sf) -> DataFrame:
    rows = inputs.instructions(spark, sf)
    return rows.withColumn("instruction", F.when(F.col("sel") % 5 != 0, F.col("instruction")))


def generate_responses(spark, sf):
    """Responses, and the rows without an instruction or whose call failed."""
    made = judging_plan.generate_responses(
        _some_null(spark, sf), scratch_folder(spark, "responses"), _make(stubs.last_line)
    )
    rows = made.rows.select("pos", "instruction", "response", F.lit(None).cast("string").alias("reason"))
    return rows.unionByName(made.rejects, allowMissingColumns=True)


def generate_candidates(spark, sf):
    made = preference_plan.generate_candidates(
        _some_null(spark, sf), scratch_folder(spark, "candidates"), _make(stubs.sampler)
    )
    rows = made.rows.select(
        "pos", "instruction", joined(F.array_sort("responses"), "|").alias("responses"),
        F.lit(None).cast("string").alias("reason"),
    )
    return rows.unionByName(made.rejects, allowMissingColumns=True)


def _judged(spark, sf):
    """Every assistant reply judged by a stub."""
    line = F.to_json(
        F.struct("instruction", F.col("output").alias("ground_truth"), F.col("input").alias("response"))
    )
    parsed = compute_once(inputs.instructions(spark, sf), "record", F.parse_json(line))
    rows = parsed.select("pos", *_fields("instruction", "ground_truth", "response"))
    return judging_plan.judge_records(rows, scratch_folder(spark, "judged"), _make(stubs.judge), partitions=_tasks(spark))


def judging_flow(spark, sf):
    return _judged(spark, sf).statistics


def judge_document(spark, sf):
    """Numbers read back from the written document of the same flow; the scores stay a table."""
    document = _judged(spark, sf).document
    summary = {"total_items": "bigint", "successful_evaluations": "bigint", "failed_evaluations": "bigint", "success_rate": "double"}
    scores = {"average_score": "double", "max_score": "double", "min_score": "double", "median_score": "double"}
    details = {"score_variance": "double", "score_std_dev": "double"}
    found = [
        F.get_json_object("document", f"$.{part}.{name}").cast(kind).alias(name)
        for part, fields in (("summary", summary), ("scores", scores), ("details", details)) for name, kind in fields.items()
    ]
    bands = F.from_json("document", "distribution map<string, bigint>")["distribution"]
    return document.select(*found, joined(F.map_values(bands), ",").alias("bands"))


# --- preference data


def candidate_rejects(spark, sf):
    keep_null = {"ignoreNullFields": "false"}
    text, none = F.col("instruction"), F.lit(None).cast("string")
    as_text = F.col("output").alias("responses")
    one, two = (F.array(*["output"] * n).alias("responses") for n in (1, 2))
    line = (
        F.when(F.col("input") == "", F.to_json(F.struct("instruction")))
        .when(F.col("output") == "", F.to_json(F.struct(two)))
        .when(F.col("sel") % 4 == 0, F.to_json(F.struct("instruction", as_text)))
        .when(F.col("sel") % 4 == 1, F.to_json(F.struct("instruction", one)))
        .when(F.col("sel") % 4 == 2, F.to_json(F.struct(none.alias("instruction"), two), keep_null))
        .otherwise(F.to_json(F.struct(text.alias("instruction"), two)))
    )
    parsed = compute_once(inputs.instructions(spark, sf), "record", F.parse_json(line))
    checked = preference.candidate_reason(parsed.select("pos", *_fields("instruction", "responses")))
    return checked.filter("reason IS NOT NULL").select("pos", "reason")


def rank_prompt(spark, sf):
    return preference.with_rank_prompt(inputs.candidates(spark, sf)).select("pos", "prompt")


def rank_prompt_fixed(spark, sf):
    return preference.with_rank_prompt(inputs.candidates(spark, sf), prompt_fix=True).select("pos", "prompt")


def rank_parse(spark, sf):
    return _ranked(spark, sf).select(
        "pos", joined("sorted_indices", ",").alias("sorted_indices"), "api_response", "rank_status"
    )


def rank_parse_strict(spark, sf):
    ranked = preference.parse_rankings(inputs.rank_replies(spark, sf), strict_permutation=True)
    return ranked.select("pos", joined("sorted_indices", ",").alias("sorted_indices"), "rank_status")


def preference_clean(spark, sf):
    return preference.clean_preferences(_ranked(spark, sf)).select(
        "pos", "instruction", joined("sorted_indices", ",").alias("sorted_indices"),
        joined("responses", "|").alias("responses"),
    )


def preference_reject_reasons(spark, sf):
    return preference.reject_reasons(_ranked(spark, sf))


def preference_cap(spark, sf):
    cleaned = preference.clean_preferences(_ranked(spark, sf))
    return splits.first_n(cleaned, MAX_PAIRS).select("pos", "instruction")


def dpo_pairs(spark, sf):
    cleaned = preference.clean_preferences(_ranked(spark, sf))
    return preference.preference_pairs(cleaned, keep=("pos",))


def dpo_pairs_with_input(spark, sf):
    cleaned = preference.clean_preferences(_ranked(spark, sf))
    return preference.preference_pairs(cleaned, include_input=True, keep=("pos",))


def dpo_pairs_capped(spark, sf):
    return preference_plan.training_pairs(_ranked(spark, sf), MAX_PAIRS, keep=("pos",)).rows


def funnel_counts(spark, sf):
    """Counts of the flow that writes the capped pairs."""
    return preference_plan.store_pairs(_ranked(spark, sf), scratch_folder(spark, "pairs"), MAX_PAIRS).counts


def _with_indices(df: DataFrame) -> DataFrame:
    indices = F.transform(F.split("ranking", ","), lambda x: x.cast("bigint"))
    return df.withColumn("sorted_indices", indices).drop("ranking")


def rank_pending(spark, sf):
    rows = inputs.keyed(spark, sf).select("pos", "instruction", "input")
    done = _with_indices(inputs.earlier(spark, sf))
    return preference.pending_rows(rows, done).select("pos", "key", "input")


def rank_pending_by_input(spark, sf):
    rows = inputs.keyed(spark, sf).select("pos", "instruction", "input")
    done = _with_indices(inputs.earlier(spark, sf))
    return preference.pending_rows(rows, done, ("instruction", "input")).select("pos", "input")


def rank_upsert(spark, sf):
    merged = preference.upsert_results(
        _with_indices(inputs.earlier(spark, sf)), _with_indices(inputs.later(spark, sf))
    )
    return merged.select("key", "batch", "pos", "input", joined("sorted_indices", ",").alias("sorted_indices"))


def rank_upsert_prefer_success(spark, sf):
    merged = preference.upsert_results(
        _with_indices(inputs.earlier(spark, sf)), _with_indices(inputs.later(spark, sf)), prefer_success=True
    )
    return merged.select("key", "batch", "pos", "input", joined("sorted_indices", ",").alias("sorted_indices"))


def _resume_columns(results: DataFrame) -> DataFrame:
    return results.select(
        "key", F.col("batch").cast("bigint").alias("batch"), "pos",
        joined("sorted_indices", ",").alias("sorted_indices"), "rank_status",
    )


def rank_resume(spark, sf):
    """Two runs over all documents: the second asks only what the first left open."""
    rows = inputs.keyed(spark, sf)
    results = scratch_folder(spark, "rankings")
    ranking.rank_run(rows, results, 0, _make(stubs.first_ranker), partitions=_tasks(spark))
    ranking.rank_run(rows, results, 1, _make(stubs.second_ranker), partitions=_tasks(spark))
    return _resume_columns(ranking.read_results(spark, results, 1))


def rank_stream(spark, sf):
    """The same rows as a stream of files, ranked by one start of several micro-batches.

    All rows of a key are in one file, so the batch that ranks them has them all.
    """
    rows = inputs.keyed(spark, sf)
    arriving, results, checkpoint = (
        scratch_folder(spark, n) for n in ("arriving", "streamed", "stream-state")
    )
    rows.repartition(STREAM_FILES, "instruction").write.parquet(arriving)
    query = ranking.rank_stream(
        spark, arriving, rows.schema, results, checkpoint, _make(stubs.second_ranker),
        max_files=STREAM_FILES // 4, partitions=_tasks(spark),
    )
    query.awaitTermination()
    return _resume_columns(ranking.read_results(spark, results)).drop("batch")


def rank_ledger(spark, sf):
    """Two runs over all documents, row by row: the second asks the rows whose reply was no ranking."""
    rows = inputs.keyed(spark, sf)
    folder = scratch_folder(spark, "ledger")
    ledger.rank_recorded(rows, folder, 0, _make(stubs.first_ranker))
    ledger.rank_recorded(rows, folder, 1, _make(stubs.second_ranker))
    return ledger.read_ledger(rows, folder).select(
        "pos", "key", "run", joined("sorted_indices", ",").alias("sorted_indices"), "rank_status"
    )


def rank_store(spark, sf):
    """The files of the ranking stream in four batches, stored in levels."""
    rows = inputs.keyed_dealt(spark, sf, STREAM_FILES)
    arriving, folder, checkpoint = (scratch_folder(spark, n) for n in ("arriving", "store", "stream-state"))
    with shuffles_freed(spark):
        rows.write.option("compression", "zstd").parquet(arriving)
    query = store.rank_store_stream(
        spark, arriving, rows.schema, folder, checkpoint, _make(stubs.second_ranker), max_files=STREAM_FILES // 4,
        base_bits=STORE_BITS
    )
    query.awaitTermination()
    return _resume_columns(store.read_store(spark, folder)).drop("batch")


# --- records


def _instruction_file(spark, sf) -> str:
    """All instruction rows as JSON lines in list order, with an explicit null."""
    rows = inputs.instructions(spark, sf).select(
        F.col("pos").alias("id"), "instruction",
        F.when(F.col("input") != "", F.col("input")).alias("input"), "output",
    )
    path = scratch_folder(spark, "records")
    records.write_records(rows.repartitionByRange("id").sortWithinPartitions("id"), path)
    return path


RECORD_TYPES = {"id": "bigint", "instruction": "string", "input": "string", "output": "string"}


def read_records(spark, sf):
    rows = records.read_variants(spark, _instruction_file(spark, sf), [*RECORD_TYPES, "note"])
    flags = {
        "input_is_null": F.is_variant_null("input"),
        "note_is_absent": F.col("note").isNull(),
    }
    return records.typed(rows.withColumns(flags), RECORD_TYPES).select(*RECORD_TYPES, *flags)


def ingest_records(spark, sf):
    rows = records.ingest_records(spark, _instruction_file(spark, sf), RECORD_TYPES)
    return rows.select("pos", "id", "instruction")


def write_records(spark, sf):
    """Documents written as JSON lines and read back as plain text."""
    path = scratch_folder(spark, "documents")
    records.write_records(inputs.table(spark, sf, "documents").drop("n_chars"), path)
    line = spark.read.text(path)
    return line.select(
        F.get_json_object("value", "$.doc_id").cast("bigint").alias("doc_id"),
        *[F.get_json_object("value", f"$.{c}").alias(c) for c in ("lang", "source")],
        F.md5(F.get_json_object("value", "$.text")).alias("text_md5"),
    )


def write_array(spark, sf):
    """Documents written as array files of 64 records in order, and read back by list position."""
    path = scratch_folder(spark, "documents")
    arrays.write_array(inputs.table(spark, sf, "documents").drop("n_chars"), path, "doc_id", FILE_ROWS)
    kinds = {"doc_id": "bigint", "lang": "string", "source": "string", "text": "string"}
    rows = arrays.ingest_array_ranges(spark, path, kinds)
    return rows.select("pos", "doc_id", "lang", "source", F.md5("text").alias("text_md5"))


def write_manifest(spark, sf):
    """Documents written with a manifest of their files, twice with the same parameters and once with others."""
    path, table = scratch_folder(spark, "documents"), f"{sf}/documents.parquet"
    docs = inputs.table(spark, sf, "documents").select("doc_id", F.md5("text").alias("text_md5"))
    wrote = [records.write_manifested(docs, path, table, level=level) for level in (1, 1, 2)]
    return spark.read.parquet(path).select("*", *[F.lit(w).alias(f"wrote_{k}") for k, w in enumerate(wrote)])


def _document_lines(spark, sf) -> DataFrame:
    """Every document as a line: cut-off JSON or blank for some labels."""
    docs, labels = (inputs.table(spark, sf, t) for t in ("documents", "labels"))
    whole = F.to_json(F.struct("doc_id", "text"))
    line = (
        F.when(F.col("quality") == 0, F.rtrim(whole, F.lit("}")))
        .when(F.col("toxic") == 1, F.lit("  ")).otherwise(whole)
    )
    return docs.join(labels, "doc_id", "left").select("doc_id", line.alias("line"))


def json_quarantine(spark, sf):
    lines = _document_lines(spark, sf)
    return lines.select("doc_id", records.line_status(F.col("line")).alias("status"))


def malformed_lines(spark, sf):
    """The same lines through a file."""
    path = scratch_folder(spark, "lines")
    _document_lines(spark, sf).select("line").write.text(path)
    return records.malformed_lines(spark, path).select(F.md5("value").alias("line_md5"))


def read_rejects(spark, sf):
    """The same lines: those that are no JSON, with their reason."""
    path = scratch_folder(spark, "lines")
    _document_lines(spark, sf).select("line").write.text(path)
    return records.read_rejects(spark, path).select(F.md5("text").alias("line_md5"), "reason")


def _array_files(spark, sf) -> str:
    """Documents in array files of 64: a fifth cut off, a fifth blank."""
    docs = inputs.table(spark, sf, "documents")
    item = F.struct("doc_id", F.to_json(F.struct(F.col("doc_id").alias("id"), "text")).alias("json"))
    files = docs.groupBy(F.floor(F.col("doc_id") / FILE_ROWS).alias("g")).agg(
        F.sort_array(F.collect_list(item)).alias("items")
    )
    body = F.concat(F.lit("["), F.array_join("items.json", ","))
    kind = F.col("g") % 5
    path = scratch_folder(spark, "arrays")
    files.select(
        "g", F.when(kind == 0, body).when(kind == 1, F.lit(" ")).otherwise(F.concat(body, F.lit("]"))).alias("value")
    ).write.partitionBy("g").text(path)
    return path


def _group() -> Column:
    return F.regexp_extract("file", r"g=(\d+)", 1).cast("bigint")


def json_file_check(spark, sf):
    """Status and number of records of every array file."""
    checked = records.check_files(spark, _array_files(spark, sf))
    return checked.select(_group().alias("g"), "status", F.col("records").cast("bigint").alias("records"))


def ingest_rejects(spark, sf):
    """Positions of the good records, and the files that are malformed."""
    path = _array_files(spark, sf)
    good = records.ingest_records(spark, path, {"id": "bigint"}, "array", skip_bad=True)
    bad = records.read_rejects(spark, path, "array")
    return good.select("pos", "id", F.lit(None).cast("string").alias("reason")).unionByName(
        bad.select(F.lit(None).cast("bigint").alias("pos"), _group().alias("id"), "reason")
    )


def json_error_lines(spark, sf):
    """Place of the error in every cut-off document record, written over several lines."""
    docs, labels = (inputs.table(spark, sf, t) for t in ("documents", "labels"))
    text = F.to_json(F.struct("doc_id", "text"), {"pretty": "true"})
    cut = docs.join(labels.filter("quality = 0"), "doc_id").select(
        "doc_id", F.rtrim(text, F.lit("}")).alias("record")
    )
    return arrays.with_json_error(cut, "record").select(
        "doc_id", F.col("error.line").alias("error_line"),
        F.size("error.context").alias("context_lines"),
        F.col("error.context")[0]["line"].alias("first_line"),
    )


def ingest_array_ranges(spark, sf):
    """The rows of ``ingest_rejects`` from byte ranges of the array files, and where each malformed
    one goes wrong."""
    path = _array_files(spark, sf)
    good = arrays.ingest_array_ranges(spark, path, {"id": "bigint"}, skip_bad=True)
    bad = arrays.array_rejects(spark, path)
    none = F.lit(None)
    return good.select("pos", "id", none.cast("string").alias("message"), none.cast("int").alias("line")).unionByName(
        bad.select(none.cast("bigint").alias("pos"), _group().alias("id"), "message", "line")
    )


# --- training tables


def token_rows(spark, sf):
    rows = inputs.instructions(spark, sf)
    tokens = training_plan.supervised_tokens(rows, _make(stubs.code_points))
    return tokens.select(
        "pos", F.size("input_ids").alias("n_tokens"), F.md5(joined("input_ids")).alias("ids_md5"),
        F.md5(joined("labels")).alias("labels_md5"),
    )


def padded_batches(spark, sf):
    rows = inputs.instructions(spark, sf)
    batches = training_plan.supervised_batches(rows, _make(stubs.words), WIDTH, PAD_ID)
    return batches.select(
        "pos", "batch", "width", joined("input_ids").alias("input_ids"), joined("labels").alias("labels")
    )


def epoch_plan(spark, sf):
    """Where every document comes in three epochs of steps of 8 times 4 rows."""
    docs = positions.number_rows(inputs.table(spark, sf, "documents").select("doc_id"), "doc_id")
    return training.epoch_plan(docs, EPOCHS, WIDTH, 4)


def step_plan(spark, sf):
    return training.step_plan(chat.supervised_messages(inputs.instructions(spark, sf)), 1, 16)


QUERIES = {
    "judge_score": judge_score,
    "judge_summary": judge_summary,
    "judge_stats": judge_stats,
    "judge_distribution": judge_distribution,
    "judge_distribution_gap": judge_distribution_gap,
    "judge_prompt": judge_prompt,
    "judge_input_rejects": judge_input_rejects,
    "judging_flow": judging_flow,
    "mcq_normalise": mcq_normalise,
    "mcq_selected": mcq_selected,
    "mcq_subject_counts": mcq_subject_counts,
    "mcq_limit": mcq_limit,
    "mcq_prompt": mcq_prompt,
    "mcq_answer": mcq_answer,
    "mcq_accuracy": mcq_accuracy,
    "mcq_compat": mcq_compat,
    "mcq_running": mcq_running,
    "mcq_details": mcq_details,
    "choice_accuracy_flow": choice_accuracy_flow,
    "dense_position": dense_position,
    "dense_position_by_columns": dense_position_by_columns,
    "snapshot_position": snapshot_position,
    "snapshot_size": snapshot_size,
    "split_train": _part("train"),
    "split_preference": _part("preference"),
    "split_eval": _part("evaluation"),
    "sft_messages": sft_messages,
    "compose_prompt": compose,
    "render_chat": render,
    "response_rows": response_rows,
    "positional_zip": positional_zip,
    "complete_stub": complete_stub,
    "complete_samples": complete_samples,
    "candidate_rejects": candidate_rejects,
    "rank_prompt": rank_prompt,
    "rank_prompt_fixed": rank_prompt_fixed,
    "rank_parse": rank_parse,
    "rank_parse_strict": rank_parse_strict,
    "preference_clean": preference_clean,
    "preference_reject_reasons": preference_reject_reasons,
    "preference_cap": preference_cap,
    "dpo_pairs": dpo_pairs,
    "dpo_pairs_with_input": dpo_pairs_with_input,
    "dpo_pairs_capped": dpo_pairs_capped,
    "funnel_counts": funnel_counts,
    "rank_pending": rank_pending,
    "rank_pending_by_input": rank_pending_by_input,
    "rank_upsert": rank_upsert,
    "rank_upsert_prefer_success": rank_upsert_prefer_success,
    "rank_resume": rank_resume,
    "rank_stream": rank_stream,
    "rank_ledger": rank_ledger,
    "rank_store": rank_store,
    "read_records": read_records,
    "ingest_records": ingest_records,
    "write_records": write_records,
    "json_quarantine": json_quarantine,
    "malformed_lines": malformed_lines,
    "json_error_lines": json_error_lines,
    "json_file_check": json_file_check,
    "read_rejects": read_rejects,
    "ingest_rejects": ingest_rejects,
    "ingest_array_ranges": ingest_array_ranges,
    "generate_responses": generate_responses,
    "generate_candidates": generate_candidates,
    "split_snapshot": split_snapshot,
    "mcq_read_list": _mcq_read("list"),
    "mcq_read_data": _mcq_read("data"),
    "mcq_read_keyed": _mcq_read("keyed"),
    "token_rows": token_rows,
    "padded_batches": padded_batches,
    "step_plan": step_plan,
    "epoch_plan": epoch_plan,
    "write_array": write_array,
    "write_manifest": write_manifest,
    "complete_balanced": complete_balanced,
    "judge_document": judge_document,
    "choice_document": choice_document,
}
