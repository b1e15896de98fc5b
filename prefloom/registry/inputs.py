"""Operator inputs derived from the given tables.

The SQL of an input runs in Spark and, as a common table expression, in the
engine the results are checked with. ``{array}`` is the one name that differs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TURNS = 10_000_000  # positions set aside for the turns of one conversation
TURN_BITS = 10  # a block holds 1,024 turns of a conversation

# One row per user turn: the turn before is the input, the turn after the output.
# Spark gets the same rows from one shuffle, see instructions().
INSTRUCTIONS = """
SELECT u.conv_id * 10000000 + u.turn AS pos, u.conv_id * 3 + u.turn AS sel, u.text AS instruction,
       coalesce(p.text, '') AS input, coalesce(n.text, '') AS output
FROM {conversations} u
LEFT JOIN {conversations} p ON p.conv_id = u.conv_id AND p.turn = u.turn - 1
LEFT JOIN {conversations} n ON n.conv_id = u.conv_id AND n.turn = u.turn + 1
WHERE u.role = 'user'
"""

# Four candidates of each row; two are equal where the output is empty.
CANDIDATES = """
SELECT pos, sel, instruction, input, output AS ground_truth,
       {array}(output, concat(output, output), instruction, concat(instruction, output)) AS responses
FROM {instructions}
"""

# Ranking replies: valid, short, no prefix, out of range, text before the prefix,
# failed call, repeated indices, second prefix.
RANK_REPLIES = """
SELECT pos, sel, instruction, input, ground_truth, responses, CASE sel % 8
  WHEN 0 THEN concat(instruction, '排名：2 > 1 > 4 > 3')
  WHEN 1 THEN concat(instruction, '排名：1 > 2 > 3')
  WHEN 2 THEN concat(instruction, ' 4 > 3 > 2 > 1')
  WHEN 3 THEN concat(instruction, '排名：5 > 1 > 2 > 3')
  WHEN 4 THEN concat(instruction, '排名： 3>1>2>4')
  WHEN 5 THEN NULL
  WHEN 6 THEN concat(instruction, '排名：1 > 1 > 2 > 1')
  ELSE concat('排名：4 > 3 > 2 > 1 排名：9 ', instruction) END AS api_response
FROM {candidates}
"""

# Judge replies: tagged, clamped high and low, bare number, full-width colon, no
# number, first number out of range, failed call, the gap at 5, decimal.
JUDGE_REPLIES = """
SELECT conv_id * 10000000 + turn AS pos, CASE (conv_id * 3 + turn) % 10
  WHEN 0 THEN concat(text, '<score>8</score>')
  WHEN 1 THEN concat(text, '<score> 11.5 </score>', text)
  WHEN 2 THEN concat('<score>0</score>', text)
  WHEN 3 THEN concat('评分 7 分 ', text)
  WHEN 4 THEN concat('得分：9 ', text)
  WHEN 5 THEN concat('none ', text)
  WHEN 6 THEN concat('first 42 then 6.5 ', text)
  WHEN 7 THEN NULL
  WHEN 8 THEN concat(text, '<score>5</score> 9')
  ELSE concat('3 ', text, '<score>9.5</score>') END AS judge_response
FROM {conversations}
"""

# Choice questions: some without question text or model output, and a sixth
# subject that is never selected.
QUESTIONS = """
SELECT item_id AS pos,
  CASE item_id % 6 WHEN 0 THEN 'computer_science' WHEN 1 THEN 'high_school_mathematics'
    WHEN 2 THEN 'chinese_literature' WHEN 3 THEN 'elementary_commonsense'
    WHEN 4 THEN 'professional_psychology' ELSE 'unselected' END AS subject,
  CASE WHEN item_id % 11 = 10 THEN '' ELSE text END AS question,
  substr(text, 1, q) AS A, substr(text, q + 1, q) AS B,
  substr(text, 2 * q + 1, q) AS C, substr(text, 3 * q + 1) AS D,
  substr('ABCD', CAST(item_id % 4 AS INT) + 1, 1) AS answer,
  CASE item_id % 5 WHEN 0 THEN concat(text, ' 答案是B') WHEN 1 THEN 'A' WHEN 2 THEN concat('I think C, not D ', text)
    WHEN 3 THEN '' ELSE concat(text, ' the answer is d') END AS model_output
FROM (SELECT *, CAST(floor(length(text) / 4) AS INT) AS q FROM {benchmark}) b
"""

# The subjects that are asked.
SUBJECTS = (
    "computer_science", "high_school_mathematics", "chinese_literature",
    "elementary_commonsense", "professional_psychology",
)

# Rows whose instruction is not unique, for the key of resumed runs.
KEYED = """
SELECT doc_id AS pos, text AS instruction, lang AS input, '' AS ground_truth,
       {array}(text, concat(text, ' ', lang), concat(lang, ' ', text), lang) AS responses
FROM {documents}
"""

# What an earlier run left: a ranking where the label is good, a failure elsewhere.
EARLIER = """
SELECT d.doc_id AS pos, d.text AS instruction, d.lang AS input,
       CASE WHEN l.quality = 1 THEN '2,1,0,3' END AS ranking
FROM {documents} d JOIN {labels} l ON l.doc_id = d.doc_id
"""

# A later run over every document, failed where the document has a bad label.
LATER = """
SELECT d.doc_id AS pos, d.text AS instruction, d.lang AS input,
       CASE WHEN coalesce(l.quality, 1) = 1 THEN '0,1,2,3' END AS ranking
FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _run(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    return spark.sql(sql.replace("{array}", "array"), **frames)


def instructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_turns(table(spark, sf_dir, "conversations"))


def user_turns(conversations: DataFrame) -> DataFrame:
    """``INSTRUCTIONS`` with one shuffle and no join.

    Conversations are cut into blocks of 1,024 turns, so a long one is no hot
    key. The first and last turn of a block also go to the block they touch,
    where they serve as neighbours only.
    """
    turn = F.col("turn")
    own, place = F.shiftright(turn, TURN_BITS), F.pmod(turn, F.lit(1 << TURN_BITS))
    touched = (
        F.when(place == 0, F.array(own, own - 1))
        .when(place == (1 << TURN_BITS) - 1, F.array(own, own + 1)).otherwise(F.array(own))
    )
    near = Window.partitionBy("conv_id", "_block").orderBy("turn")
    before = F.when(F.lag("turn").over(near) == turn - 1, F.lag("text").over(near))
    after = F.when(F.lead("turn").over(near) == turn + 1, F.lead("text").over(near))
    return (
        conversations.select("*", own.alias("_own"), F.explode(touched).alias("_block"))
        .select("*", before.alias("_before"), after.alias("_after"))
        .filter((F.col("role") == "user") & (F.col("_block") == F.col("_own")))
        .select(
            (F.col("conv_id") * TURNS + turn).alias("pos"),
            (F.col("conv_id") * 3 + turn).alias("sel"),
            F.col("text").alias("instruction"),
            F.coalesce("_before", F.lit("")).alias("input"),
            F.coalesce("_after", F.lit("")).alias("output"),
        )
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, CANDIDATES, instructions=instructions(spark, sf_dir))


def rank_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, RANK_REPLIES, candidates=candidates(spark, sf_dir))


def judge_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, JUDGE_REPLIES, conversations=table(spark, sf_dir, "conversations"))


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, QUESTIONS, benchmark=table(spark, sf_dir, "benchmark"))


def keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, KEYED, documents=table(spark, sf_dir, "documents"))


def keyed_dealt(spark: SparkSession, sf_dir: str, files: int) -> DataFrame:
    """``keyed`` in ``files`` partitions, all rows of an instruction in one: documents are
    shuffled, which hold each text once."""
    return _run(spark, KEYED, documents=table(spark, sf_dir, "documents").repartition(files, "text"))


def earlier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(
        spark, EARLIER,
        documents=table(spark, sf_dir, "documents"), labels=table(spark, sf_dir, "labels"),
    )


def later(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(
        spark, LATER,
        documents=table(spark, sf_dir, "documents"), labels=table(spark, sf_dir, "labels"),
    )
