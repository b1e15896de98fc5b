"""The same results in plain SQL on the given tables, for the correctness check."""

from __future__ import annotations

from prefloom.functions import prompts as P
from prefloom.functions.text import PY_SPACES, RANK_PREFIX
from prefloom.operators.judging import BANDS, GAP_BAND
from prefloom.registry import inputs, stubs
from prefloom.operators.training import ROUNDS
from prefloom.registry.queries import COPIES, EPOCHS, FILE_ROWS, MAX_PAIRS, PAD_ID, PARTS, WIDTH

_TABLES = ("conversations", "benchmark", "documents", "labels")
_INPUTS = {
    "instructions": (inputs.INSTRUCTIONS, ()),
    "candidates": (inputs.CANDIDATES, ("instructions",)),
    "rank_replies": (inputs.RANK_REPLIES, ("instructions", "candidates")),
    "judge_replies": (inputs.JUDGE_REPLIES, ()),
    "questions": (inputs.QUESTIONS, ()),
    "keyed": (inputs.KEYED, ()),
    "earlier": (inputs.EARLIER, ()),
    "later": (inputs.LATER, ()),
}


def _with(name: str, *parts: tuple[str, str]) -> str:
    """WITH clause of an input, what it is made of, and further parts."""
    names = [*_INPUTS[name][1], name]
    tables = {t: t for t in _TABLES} | {n: n for n in _INPUTS}
    ctes = [(n, _INPUTS[n][0].format(array="list_value", **tables)) for n in names]
    return "WITH " + ",\n".join(f"{n} AS ({sql})" for n, sql in [*ctes, *parts]) + "\n"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _strip(x: str) -> str:
    return f"trim({x}, {_q(PY_SPACES)})"


# --- judging

_TAG = r"<score>\s*(\d+(?:\.\d+)?)\s*</score>"
_SCORED = _with("judge_replies", ("scored", rf"""
  SELECT pos,
    CASE WHEN t IS NULL THEN '[ERROR: no reply]' ELSE t END AS judge_response,
    CASE WHEN t IS NULL THEN 0.0::DOUBLE
      WHEN regexp_matches(t, '{_TAG}')
        THEN round_even(greatest(1.0::DOUBLE, least(10.0::DOUBLE, CAST(regexp_extract(t, '{_TAG}', 1) AS DOUBLE))), 2)
      ELSE round_even(coalesce(list_filter(list_transform(regexp_extract_all(t, '\b(\d+(?:\.\d+)?)\b', 1),
             lambda x: CAST(x AS DOUBLE)), lambda x: x >= 1 AND x <= 10)[1], 5.0::DOUBLE), 2) END AS score,
    CASE WHEN t IS NULL THEN 'error: no reply' ELSE 'success' END AS status
  FROM (SELECT pos, judge_response AS t FROM judge_replies) r"""))

_STATS = """
SELECT count(*) AS total_items, count(*) FILTER (WHERE status = 'success') AS successful_evaluations,
  count(*) FILTER (WHERE status <> 'success') AS failed_evaluations,
  round_even(count(*) FILTER (WHERE status = 'success') / count(*) * 100, 2) AS success_rate,
  round_even(avg(score) FILTER (WHERE status = 'success'), 2) AS average_score,
  max(score) FILTER (WHERE status = 'success') AS max_score,
  min(score) FILTER (WHERE status = 'success') AS min_score,
  percentile_disc(0.5) WITHIN GROUP (ORDER BY score DESC) FILTER (WHERE status = 'success') AS median_score,
  round_even(var_pop(score) FILTER (WHERE status = 'success'), 4) AS score_variance,
  round_even(stddev_pop(score) FILTER (WHERE status = 'success'), 4) AS score_std_dev
FROM scored HAVING count(*) FILTER (WHERE status = 'success') > 0
"""


def _distribution(bands) -> str:
    rows = []
    for i, (label, low, high, closed) in enumerate(bands):
        test = f"score {'<=' if closed else '<'} {high}" + (f" AND score >= {low}" if low is not None else "")
        rows.append(
            f"SELECT {i} AS band, {_q(label)} AS label, count(*) FILTER (WHERE {test}) AS n, count(*) AS ok"
            " FROM scored WHERE status = 'success'"
        )
    union = " UNION ALL ".join(rows)
    return (
        "SELECT band, label, n, CASE WHEN ok > 0 THEN round_even(n / ok * 100, 2) ELSE 0.0 END AS percentage"
        f" FROM ({union}) b"
    )


_JUDGE_PROMPT = (
    f"concat({_q(P.JUDGE_HEAD)}, instruction, {_q(P.JUDGE_REFERENCE)}, ground_truth,"
    f" {_q(P.JUDGE_RESPONSE)}, response, {_q(P.JUDGE_TAIL)})"
)
_JUDGE_ROWS = ("rows_", "SELECT pos, instruction, output AS ground_truth, input AS response FROM instructions")

# --- multiple choice

_LISTED = ", ".join(f"({i}, {_q(s)})" for i, s in enumerate(inputs.SUBJECTS, 1))
_OPTIONS = "concat_ws('|', A, B, C, D)"
_CHOICE_PROMPT = (
    f"concat({_q(P.CHOICE_HEAD)}, subject, {_q(P.CHOICE_TASK)}, question, chr(10),"
    " 'A. ', A, chr(10), 'B. ', B, chr(10), 'C. ', C, chr(10), 'D. ', D, chr(10), "
    f"{_q(P.CHOICE_TAIL)})"
)
_GRADED = _with(
    "questions",
    ("listed", f"SELECT * FROM (VALUES {_LISTED}) v(subject_no, subject)"),
    ("graded", f"""
  SELECT q.*, l.subject_no, {_strip('model_output')} AS stripped, {_CHOICE_PROMPT} AS prompt,
    row_number() OVER (PARTITION BY subject ORDER BY pos) AS question_id,
    regexp_extract(model_output, '[ABCD]', 0) AS predicted_answer,
    regexp_extract(model_output, '[ABCD]', 0) = answer AS is_correct
  FROM questions q JOIN listed l USING (subject) WHERE question <> ''"""),
)
_PER_SUBJECT = (
    "SELECT subject, count(*) FILTER (WHERE is_correct) AS correct, count(*) AS samples FROM graded GROUP BY subject"
)
_ACCURACY = f"""
SELECT subject, FALSE AS is_total, correct, samples, correct / samples AS acc FROM ({_PER_SUBJECT}) s
UNION ALL
SELECT NULL, TRUE, count(*) FILTER (WHERE is_correct), count(*),
  coalesce(count(*) FILTER (WHERE is_correct) / nullif(count(*), 0), 0.0) FROM graded
"""

# --- positions

_DOC = "doc_id, lang, source, n_chars, md5(text) AS text_md5"


def _numbered(order: str) -> str:
    return f"SELECT row_number() OVER (ORDER BY {order}) - 1 AS pos, {_DOC} FROM documents"


def _part(condition: str) -> str:
    return (
        f"SELECT {_DOC} FROM (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS p,"
        f" count(*) OVER () AS total FROM documents) d WHERE {condition}"
    )


# --- chat and completion

_PROMPT = f"CASE WHEN {_strip('input')} <> '' THEN concat(instruction, chr(10), input) ELSE instruction END"


def _chat(content: str) -> str:
    t = P.CHATML
    return (
        f"concat({_q(t.prefix)}, 'user', {_q(t.role_end)}, {content}, {_q(t.suffix)}, {_q(t.marker)})"
    )


_PROMPTS = ("prompts", f"SELECT pos, {_PROMPT} AS prompt FROM instructions")
_FAILS = f"length(prompt) % {stubs.FAILS_AT} = 0"

# --- preference

_RANK_BODY = (
    f"concat({_q(P.RANK_HEAD)}, instruction, {_q(P.RANK_LIST)},"
    " '1. ', responses[1], chr(10), '2. ', responses[2], chr(10),"
    " '3. ', responses[3], chr(10), '4. ', responses[4], chr(10),"
    f" {_q(P.RANK_FORMAT + P.RANK_EXAMPLE + P.RANK_RULES)}, COUNT_, {_q(P.RANK_END)})"
)
_RANK_PROMPT = _RANK_BODY.replace("COUNT_", _q(P.RANK_COUNT))

_NUMBERS = ("numbers", rf"""
  SELECT *, CASE WHEN contains(api_response, '{RANK_PREFIX}') THEN
    list_transform(regexp_extract_all(split_part(api_response, '{RANK_PREFIX}', 2), '\d+'),
      lambda x: CAST(x AS BIGINT) - 1) END AS a
  FROM rank_replies""")


def _ranked(strict: bool = False) -> str:
    more = " AND len(list_distinct(a)) = len(responses)" if strict else ""
    return _with(
        "rank_replies", _NUMBERS,
        ("ranked", f"""
  SELECT * EXCLUDE (api_response), api_response AS raw_reply,
    CASE WHEN len(a) = len(responses) AND list_min(a) >= 0 AND list_max(a) <= len(responses) - 1{more}
      THEN a END AS sorted_indices
  FROM numbers"""),
        ("reasons", """
  SELECT *, CASE WHEN sorted_indices IS NULL THEN 'no_ranking'
    WHEN len(list_distinct(responses)) < len(responses) THEN 'duplicate_responses'
    WHEN len(responses) < 2 THEN 'too_few_responses' END AS reason FROM ranked"""),
        ("cleaned", "SELECT * FROM reasons WHERE reason IS NULL"),
        ("capped", f"SELECT * FROM cleaned ORDER BY pos LIMIT {MAX_PAIRS}"),
    )


_INDICES = "array_to_string(sorted_indices, ',') AS sorted_indices"
_STATUS = (
    "CASE WHEN sorted_indices IS NOT NULL THEN 'ok' WHEN raw_reply IS NULL THEN 'no_reply'"
    " WHEN a IS NULL THEN 'no_prefix' ELSE 'bad_ranking' END AS rank_status"
)


def _pairs(source: str, content: str = _strip("instruction")) -> str:
    return (
        f"SELECT pos, {_chat(content)} AS prompt, {_strip('responses[sorted_indices[1] + 1]')} AS chosen,"
        f" {_strip('responses[sorted_indices[-1] + 1]')} AS rejected FROM {source}"
    )


_WITH_INPUT = (
    f"CASE WHEN {_strip('input')} <> '' THEN concat({_strip('instruction')}, chr(10), input)"
    f" ELSE {_strip('instruction')} END"
)


def _upsert(prefer_success: bool) -> str:
    first = "(ranking IS NOT NULL) DESC, " if prefer_success else ""
    return (
        "WITH " + _with("earlier").removeprefix("WITH ").rstrip() + ",\n"
        + _with("later").removeprefix("WITH ").rstrip() + f""",
both_ AS (SELECT *, 0 AS batch FROM earlier WHERE ranking IS NOT NULL
  UNION ALL SELECT *, 1 AS batch FROM later)
SELECT md5(instruction) AS key, batch, pos, input, ranking AS sorted_indices FROM both_
QUALIFY row_number() OVER (PARTITION BY md5(instruction) ORDER BY {first}batch DESC, pos DESC) = 1
"""
    )


def _pending(columns: str, key: str) -> str:
    return (
        "WITH " + _with("keyed").removeprefix("WITH ").rstrip() + ",\n"
        + _with("earlier").removeprefix("WITH ")
        + f"SELECT {columns} FROM keyed k WHERE NOT EXISTS"
        f" (SELECT 1 FROM earlier e WHERE e.ranking IS NOT NULL AND {key})"
    )


_RESUME = _with(
    "keyed",
    ("run0", f"""
  SELECT pos, instruction, 0 AS batch,
    CASE WHEN length({_RANK_PROMPT}) % 3 <> 0 THEN '1,0,3,2' END AS ranking FROM keyed"""),
    ("run1", """
  SELECT pos, instruction, 1 AS batch, '3,2,1,0' AS ranking FROM keyed
  WHERE instruction NOT IN (SELECT instruction FROM run0 WHERE ranking IS NOT NULL)"""),
    ("live", "SELECT * FROM run0 WHERE ranking IS NOT NULL UNION ALL SELECT * FROM run1"),
) + """
SELECT md5(instruction) AS key, CAST(batch AS BIGINT) AS batch, pos, ranking AS sorted_indices, 'ok' AS rank_status
FROM live QUALIFY row_number() OVER (PARTITION BY instruction ORDER BY batch DESC, pos DESC) = 1
"""

_STREAM = _with("keyed") + """
SELECT md5(instruction) AS key, max(pos) AS pos, '3,2,1,0' AS sorted_indices,
  'ok' AS rank_status
FROM keyed GROUP BY instruction
"""

# --- training tables

_TEXT = (
    "concat('<|im_start|>user', chr(10), instruction, '<|im_end|>', chr(10),"
    " '<|im_start|>assistant', chr(10), output, '<|im_end|>', chr(10))"
)
_EXAMPLES = ("examples", f"SELECT pos, {_TEXT} AS t FROM instructions WHERE instruction <> '' AND output <> ''")
_CODES = (
    "array_to_string(list_transform(regexp_extract_all(t, '(?s).'), lambda c: unicode(c)), ' ')"
)


def _epochs(epochs: int, width: int, rounds: int) -> str:
    """Places of every epoch: digits to two bases, changed in turns, again while out of range."""
    def once(source: str, x: str) -> str:
        sql = f"SELECT pos, epoch, n, a, b, {x} // b AS l, {x} % b AS r FROM {source}"
        for turn in range(rounds):
            one, other, base = ("l", "r", "a") if turn % 2 == 0 else ("r", "l", "b")
            number = f"CAST('0x' || substr(md5(concat_ws(':', '42', epoch, {turn}, {other})), 1, 15) AS BIGINT)"
            sql = f"SELECT pos, epoch, n, a, b, ({one} + {number}) % {base} AS {one}, {other} FROM ({sql}) t{turn}"
        return f"SELECT pos, epoch, n, a, b, l * b + r AS x FROM ({sql}) t"

    return f"""
WITH RECURSIVE c AS (
  SELECT n, a, CAST(ceil(n / a) AS BIGINT) AS b FROM (SELECT count(*) AS n, CAST(floor(sqrt(count(*) - 1)) AS BIGINT) + 1 AS a FROM documents) c0),
numbered AS (
  SELECT pos, e AS epoch, n, a, b FROM (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents) d, c, range({epochs}) t(e)),
walk AS ({once("(SELECT *, pos AS x0 FROM numbered) s", "x0")} UNION ALL {once("(SELECT * FROM walk WHERE x >= n) s", "x")})
SELECT CAST(epoch AS INT) AS epoch, x // {width} AS step, x % {width} AS slot, pos FROM walk WHERE x < n"""


_IN = _with("instructions")
_RANKED = _ranked()
_LINES = """
  SELECT d.doc_id, CASE WHEN quality = 0 THEN rtrim(to_json({'doc_id': d.doc_id, 'text': text})::VARCHAR, '}')
    WHEN toxic = 1 THEN '  ' ELSE to_json({'doc_id': d.doc_id, 'text': text})::VARCHAR END AS line
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
"""

# --- files

_ARRAYS = f"SELECT doc_id, CAST(floor(doc_id / {FILE_ROWS}.0) AS BIGINT) AS g FROM documents"


def _mcq_read(shape: str) -> str:
    order = "g, subject, copy, pos" if shape == "keyed" else "g, copy, pos"
    return _with(
        "questions",
        ("copies", f"SELECT *, copy % 2 AS g FROM questions, (SELECT unnest(range({COPIES})) AS copy) c WHERE question <> ''"),
    ) + f"""
SELECT row_number() OVER (ORDER BY {order}) - 1 AS pos, subject, question, concat(A, '|', B, '|', C, '|', D) AS options, answer
FROM copies"""


_NULLS = (
    "asked",
    f"SELECT pos, instruction, sel, length({_chat(_PROMPT)}) AS n FROM instructions",
)


_JUDGED = _with(
    "instructions", _JUDGE_ROWS,
    ("asked", f"SELECT pos, length({_JUDGE_PROMPT}) AS n FROM rows_"),
    ("scored", f"""
  SELECT pos, CASE WHEN n % {stubs.FAILS_AT} = 0 THEN 0.0::DOUBLE
  ELSE greatest(1.0::DOUBLE, least(10.0::DOUBLE, n % 12 + 0.5::DOUBLE)) END AS score,
CASE WHEN n % {stubs.FAILS_AT} = 0 THEN 'error: refused' ELSE 'success' END AS status FROM asked"""),
)

_CHOSEN = _GRADED.rstrip() + f""",
asked AS (SELECT subject, substr('ABCDE', CAST(length({_chat('prompt')}) % 5 AS INT) + 1, 1) AS letter, answer FROM graded),
scored AS (SELECT subject, (CASE WHEN letter = 'E' THEN '' ELSE letter END) = answer AS is_correct FROM asked)
"""

_STUB = _with("instructions", _PROMPTS) + f"""
SELECT pos, CASE WHEN NOT {_FAILS} THEN
    concat('  ', split_part(prompt, chr(10), -1), ' ', length(prompt), chr(10)) END AS response,
  CASE WHEN {_FAILS} THEN 'error: refused' ELSE 'success' END AS status FROM prompts"""

ORACLE = {
    "judge_score": _SCORED + "SELECT pos, judge_response, score, status FROM scored",
    "judge_summary": _SCORED + """
SELECT count(*) AS total, count(*) FILTER (WHERE status = 'success') AS successful,
  count(*) FILTER (WHERE status <> 'success') AS failed,
  coalesce(round_even(avg(score) FILTER (WHERE status = 'success'), 2), 0.0) AS average_score FROM scored""",
    "judge_stats": _SCORED + _STATS,
    "judge_distribution": _SCORED + _distribution(BANDS),
    "judge_distribution_gap": _SCORED + _distribution([*BANDS[:4], GAP_BAND, *BANDS[4:]]),
    "judge_prompt": _with("instructions", _JUDGE_ROWS) + f"SELECT pos, {_JUDGE_PROMPT} AS prompt FROM rows_",
    "judge_input_rejects": """
SELECT d.doc_id AS pos, CASE WHEN quality IS NULL THEN 'missing_response' ELSE 'missing_instruction' END AS reason
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE quality IS NULL OR toxic = 1""",
    "judging_flow": _JUDGED + _STATS,
    "judge_document": _JUDGED + f"""
SELECT s.*, (SELECT string_agg(CAST(n AS VARCHAR), ',' ORDER BY band) FROM ({_distribution(BANDS)}) b) AS bands
FROM ({_STATS}) s""",
    "mcq_normalise": _with("questions") + f"""
SELECT shape, pos, subject, question, {_OPTIONS} AS options, answer
FROM questions, (VALUES ('list'), ('data')) v(shape) WHERE question <> ''""",
    "mcq_selected": _GRADED + "SELECT subject_no, subject, pos, question, answer FROM graded",
    "mcq_subject_counts": _GRADED + "SELECT subject, count(*) AS questions FROM graded GROUP BY subject",
    "mcq_limit": _GRADED + "SELECT subject, question_id, pos FROM graded WHERE question_id <= 3",
    "mcq_prompt": _GRADED + "SELECT pos, prompt FROM graded",
    "mcq_answer": _GRADED + "SELECT pos, stripped AS model_output, predicted_answer, is_correct FROM graded",
    "mcq_accuracy": _GRADED + _ACCURACY,
    "mcq_compat": _GRADED + f"""
SELECT l.subject_no, concat('cmmlu:', l.subject) AS key, coalesce(correct / samples, 0.0) AS acc,
  0.0::DOUBLE AS acc_stderr
FROM (SELECT * FROM listed UNION ALL SELECT 6, 'anatomy') l LEFT JOIN ({_PER_SUBJECT}) s USING (subject)""",
    "mcq_running": _GRADED + """
SELECT subject, question_id, correct, correct / question_id AS acc FROM (
  SELECT subject, question_id, CAST(sum(CASE WHEN is_correct THEN 1 ELSE 0 END)
    OVER (PARTITION BY subject ORDER BY pos) AS BIGINT) AS correct FROM graded) r WHERE question_id % 3 = 0""",
    "mcq_details": _GRADED + f"""
SELECT subject, question_id, question, {_OPTIONS} AS options, prompt, stripped AS model_output,
  predicted_answer, answer AS correct_answer, is_correct FROM graded""",
    "choice_accuracy_flow": _CHOSEN + _ACCURACY.replace("graded", "scored"),
    "choice_document": _CHOSEN + f"""
SELECT concat('cmmlu_', subject) AS key, correct / samples AS acc, samples, NULL::DOUBLE AS acc_stderr
FROM ({_PER_SUBJECT.replace("graded", "scored")}) s
UNION ALL SELECT 'cmmlu', coalesce(count(*) FILTER (WHERE is_correct) / nullif(count(*), 0), 0.0), count(*), NULL FROM scored
UNION ALL SELECT concat('cmmlu:', l.subject), coalesce(correct / samples, 0.0), NULL, 0.0
FROM listed l LEFT JOIN ({_PER_SUBJECT.replace("graded", "scored")}) s USING (subject)""",
    "dense_position": _numbered("doc_id"),
    "dense_position_by_columns": _numbered("lang, source, doc_id"),
    "snapshot_position": _numbered("doc_id"),
    "snapshot_size": "SELECT count(*) AS row_count FROM lineitem",
    "split_train": _part(f"p < {PARTS['train']}"),
    "split_preference": _part(
        f"p >= total - {PARTS['preference'] + PARTS['evaluation']} AND p < total - {PARTS['evaluation']}"
    ),
    "split_eval": _part(f"p >= total - {PARTS['evaluation']}"),
    "sft_messages": _IN + """
SELECT pos, 'user,assistant' AS roles, instruction AS user_text, output AS assistant_text
FROM instructions WHERE instruction <> '' AND output <> ''""",
    "compose_prompt": _IN + f"SELECT pos, {_PROMPT} AS prompt FROM instructions",
    "render_chat": _IN + f"SELECT pos, {_chat(_PROMPT)} AS chat FROM instructions",
    "response_rows": _IN + f"""
SELECT pos, instruction, input, output AS ground_truth,
  {_strip("concat(' 　', output, chr(10), input, ' ', chr(9))")} AS response FROM instructions""",
    "positional_zip": _IN + f"""
SELECT pos, instruction, input, output AS ground_truth, {_strip('c.text')} AS response
FROM instructions JOIN conversations c ON c.conv_id * 10000000 + c.turn - 1 = pos""",
    "complete_stub": _STUB,
    "complete_balanced": _STUB,
    "complete_samples": _with("instructions", _PROMPTS) + """
SELECT pos, array_to_string(list_transform(range(4), lambda i: concat(' ', length(prompt), '-', i, ' ')), '|') AS responses,
  'success' AS status FROM prompts""",
    "candidate_rejects": _IN + """
SELECT pos, CASE WHEN input = '' OR output = '' THEN 'missing_field'
  WHEN sel % 4 IN (0, 1) THEN 'invalid_responses' ELSE 'null_instruction' END AS reason
FROM instructions WHERE input = '' OR output = '' OR sel % 4 IN (0, 1, 2)""",
    "rank_prompt": _with("candidates") + f"SELECT pos, {_RANK_PROMPT} AS prompt FROM candidates",
    "rank_prompt_fixed": _with("candidates")
    + f"SELECT pos, {_RANK_BODY.replace('COUNT_', _q('4'))} AS prompt FROM candidates",
    "rank_parse": _RANKED + f"""
SELECT pos, {_INDICES}, CASE WHEN r.sorted_indices IS NOT NULL THEN raw_reply ELSE 'Unknown error' END AS api_response,
  {_STATUS} FROM ranked r""",
    "rank_parse_strict": _ranked(strict=True) + f"SELECT pos, {_INDICES}, {_STATUS} FROM ranked",
    "preference_clean": _RANKED + f"""
SELECT pos, instruction, {_INDICES}, array_to_string(responses, '|') AS responses FROM cleaned""",
    "preference_reject_reasons": _RANKED
    + "SELECT reason, count(*) AS n FROM reasons WHERE reason IS NOT NULL GROUP BY reason",
    "preference_cap": _RANKED + "SELECT pos, instruction FROM capped",
    "dpo_pairs": _RANKED + _pairs("cleaned"),
    "dpo_pairs_with_input": _RANKED + _pairs("cleaned", _WITH_INPUT),
    "dpo_pairs_capped": _RANKED + _pairs("capped"),
    "funnel_counts": _RANKED + """
SELECT 1 AS step, 'raw' AS stage, count(*) AS n FROM ranked UNION ALL
SELECT 2, 'cleaned', count(*) FROM cleaned UNION ALL
SELECT 3, 'capped', count(*) FROM capped UNION ALL SELECT 4, 'pairs', count(*) FROM capped""",
    "rank_pending": _pending("pos, md5(instruction) AS key, input", "e.instruction = k.instruction"),
    "rank_pending_by_input": _pending("pos, input", "e.instruction = k.instruction AND e.input = k.input"),
    "rank_upsert": _upsert(False),
    "rank_upsert_prefer_success": _upsert(True),
    "rank_resume": _RESUME,
    "rank_stream": _STREAM,
    "rank_ledger": _with("keyed") + f"""
SELECT pos, md5(instruction) AS key, CAST(n % 3 = 0 AS BIGINT) AS run,
  CASE WHEN n % 3 = 0 THEN '3,2,1,0' ELSE '1,0,3,2' END AS sorted_indices, 'ok' AS rank_status
FROM (SELECT *, length({_RANK_PROMPT}) AS n FROM keyed) k""",
    "rank_store": _STREAM,
    "read_records": _IN + """
SELECT pos AS id, instruction, nullif(input, '') AS input, output, input = '' AS input_is_null,
  TRUE AS note_is_absent FROM instructions""",
    "ingest_records": _IN + "SELECT row_number() OVER (ORDER BY pos) - 1 AS pos, pos AS id, instruction FROM instructions",
    "write_array": """
SELECT row_number() OVER (ORDER BY doc_id) - 1 AS pos, doc_id, lang, source, md5(text) AS text_md5 FROM documents""",
    "write_manifest": "SELECT doc_id, md5(text) AS text_md5, TRUE AS wrote_0, FALSE AS wrote_1, TRUE AS wrote_2 FROM documents",
    "epoch_plan": _epochs(EPOCHS, WIDTH * 4, ROUNDS),
    "write_records": "SELECT doc_id, lang, source, md5(text) AS text_md5 FROM documents",
    "json_quarantine": f"""
SELECT doc_id, CASE WHEN trim(line) = '' THEN 'empty' WHEN json_valid(line) THEN 'ok' ELSE 'malformed' END AS status
FROM ({_LINES}) l""",
    "malformed_lines": f"SELECT md5(line) AS line_md5 FROM ({_LINES}) l WHERE trim(line) <> '' AND NOT json_valid(line)",
    "json_error_lines": """
SELECT doc_id, 4 AS error_line, 3 AS context_lines, 2 AS first_line
FROM documents JOIN labels USING (doc_id) WHERE quality = 0""",
    "read_rejects": f"""
SELECT md5(line) AS line_md5, 'malformed_line' AS reason FROM ({_LINES}) l WHERE trim(line) <> '' AND NOT json_valid(line)""",
    "json_file_check": f"""
SELECT g, CASE g % 5 WHEN 0 THEN 'malformed' WHEN 1 THEN 'empty' ELSE 'ok' END AS status,
  CASE WHEN g % 5 > 1 THEN count(*) ELSE 0 END AS records FROM ({_ARRAYS}) a GROUP BY g""",
    "ingest_rejects": f"""
SELECT row_number() OVER (ORDER BY CAST(g AS VARCHAR), doc_id) - 1 AS pos, doc_id AS id, NULL::VARCHAR AS reason
FROM ({_ARRAYS}) a WHERE g % 5 > 1
UNION ALL SELECT DISTINCT NULL::BIGINT, g, 'malformed_file' FROM ({_ARRAYS}) b WHERE g % 5 = 0""",
    "ingest_array_ranges": f"""
SELECT row_number() OVER (ORDER BY CAST(g AS VARCHAR), doc_id) - 1 AS pos, doc_id AS id, NULL::VARCHAR AS message, NULL::INT AS line
FROM ({_ARRAYS}) a WHERE g % 5 > 1
UNION ALL SELECT DISTINCT NULL::BIGINT, g, 'Expecting '','' delimiter', 2 FROM ({_ARRAYS}) b WHERE g % 5 = 0""",
    "generate_responses": _with("instructions", _NULLS) + f"""
SELECT pos, CASE WHEN sel % 5 <> 0 AND n % {stubs.FAILS_AT} <> 0 THEN instruction END AS instruction,
  CASE WHEN sel % 5 <> 0 AND n % {stubs.FAILS_AT} <> 0 THEN CAST(n AS VARCHAR) END AS response,
  CASE WHEN sel % 5 = 0 THEN 'null_instruction' WHEN n % {stubs.FAILS_AT} = 0 THEN 'error: refused' END AS reason
FROM asked""",
    "generate_candidates": _with("instructions", _NULLS) + """
SELECT pos, CASE WHEN sel % 5 <> 0 THEN instruction END AS instruction,
  CASE WHEN sel % 5 <> 0 THEN array_to_string(list_transform(range(4), lambda i: concat(n, '-', i)), '|') END AS responses,
  CASE WHEN sel % 5 = 0 THEN 'null_instruction' END AS reason FROM asked""",
    "split_snapshot": f"""
SELECT part, p AS pos, {_DOC} FROM (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS p, count(*) OVER () AS total FROM documents) d,
  (SELECT unnest(['train', 'preference', 'evaluation']) AS part) s
WHERE CASE part WHEN 'train' THEN p < {PARTS['train']} WHEN 'evaluation' THEN p >= total - {PARTS['evaluation']}
  ELSE p >= total - {PARTS['preference'] + PARTS['evaluation']} AND p < total - {PARTS['evaluation']} END""",
    "mcq_read_list": _mcq_read("list"),
    "mcq_read_data": _mcq_read("data"),
    "mcq_read_keyed": _mcq_read("keyed"),
    "token_rows": _with("instructions", _EXAMPLES) + f"""
SELECT pos, CAST(length(t) AS INT) AS n_tokens, md5({_CODES}) AS ids_md5, md5({_CODES}) AS labels_md5 FROM examples""",
    "padded_batches": _with(
        "instructions", _EXAMPLES,
        ("tokens", "SELECT pos, list_transform(string_split(t, ' '), lambda w: CAST(length(w) AS INT)) AS ids FROM examples"),
        ("numbered", f"SELECT *, (row_number() OVER (ORDER BY pos) - 1) // {WIDTH} AS batch FROM tokens"),
        ("wide", "SELECT *, max(len(ids)) OVER (PARTITION BY batch) AS width FROM numbered"),
    ) + f"""
SELECT pos, batch, CAST(width AS INT) AS width,
  array_to_string(list_resize(ids, width, {PAD_ID}), ' ') AS input_ids,
  array_to_string(list_resize(ids, width, -100), ' ') AS labels FROM wide""",
    "step_plan": _with("instructions", _EXAMPLES) + """
SELECT count(*) AS row_count, 1 AS batch_size, 16 AS accumulation, CAST(ceil(count(*) / 16) AS BIGINT) AS steps
FROM examples""",
}
