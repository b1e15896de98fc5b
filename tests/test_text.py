"""Text functions against small Python counterparts on random strings."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from prefloom.functions import prompts, text

PIECES = [
    "<score>", "</score>", "排名：", "排名", "8", "８", "10", "11.5", "3.7", "0", "٣", "९.५", ".", "分", "评分",
    "_", "a", "é", "²", "①", "½", "́", " ", "\t", "\n", "　", "\x1c", "\x85", " ", "：", ">", " > ", "1", "2",
    "4", "-", "<score>7</score>", "99999999999999999999999", "A", "D", "d", "答案",
]


def random_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 9))) for _ in range(n)]


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, t {kind}").repartition(4)
    return [r["x"] for r in df.select("i", expr.alias("x")).orderBy("i").collect()]


def py_score(reply):
    tag = re.search(r"<score>\s*(\d+(?:\.\d+)?)\s*</score>", reply)
    if tag:
        value = float(tag[1])
        return 10.0 if value > 10 else 1.0 if value < 1 else value
    free = (float(n) for n in re.findall(r"\b(\d+(?:\.\d+)?)\b", reply))
    return next((n for n in free if 1 <= n <= 10), 5.0)


def py_ranking(reply, n):
    parts = reply.split("排名：")
    if len(parts) == 1:
        return None
    numbers = [int(d) - 1 for d in re.findall(r"\d+", parts[1])]
    return numbers if len(numbers) == n and set(numbers) <= set(range(n)) else None


def test_strip(spark):
    values = random_texts(3000, 1)
    assert column(spark, values, text.py_strip(F.col("t"))) == [v.strip() for v in values]


def test_judge_score(spark):
    values = random_texts(6000, 2)
    assert column(spark, values, text.judge_score(F.col("t"))) == [py_score(v) for v in values]


def test_judge_score_without_reply(spark):
    assert column(spark, [None], text.judge_score(F.col("t"))) == [None]


@pytest.mark.parametrize("n", [2, 4])
def test_ranking(spark, n):
    rng = random.Random(3)
    values = random_texts(3000, 4) + [
        "排名：" + " > ".join(rng.choice("01２345") for _ in range(rng.randint(1, 5))) for _ in range(3000)
    ]
    ours = column(spark, values, text.valid_ranking(text.ranking_numbers(F.col("t")), F.lit(n)))
    expected = [py_ranking(v, n) for v in values]
    assert ours == expected
    assert sum(x is not None for x in expected) > 50


def test_strict_ranking(spark):
    strict = text.valid_ranking(text.ranking_numbers(F.col("t")), F.lit(2), strict_permutation=True)
    assert column(spark, ["排名：1 > 1", "排名：2 > 1"], strict) == [None, [1, 0]]


def test_choice_letter(spark):
    values = random_texts(2000, 5)
    expected = [next((c for c in v if c in "ABCD"), "") for v in values]
    assert column(spark, values, text.choice_letter(F.col("t"))) == expected


@pytest.mark.parametrize("digits", [2, 4])
def test_round(spark, digits):
    rng = random.Random(6)
    values = [2.675, 8.125, 0.005, 0.015, 1.005, 7.0, 0.0, 9.995, 0.29, 99.995, 3.125, 0.00005, 1e-9]
    values += [rng.uniform(0, 100) for _ in range(3000)]
    values += [rng.randint(0, 100_000) / 1000 for _ in range(3000)]
    values += [rng.randint(0, 100_000) / 2**rng.randint(1, 12) for _ in range(3000)]
    assert column(spark, values, text.py_round(F.col("t"), digits), "double") == [round(v, digits) for v in values]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(max_size=12), min_size=1, max_size=40))
def test_any_text_strips_and_scores(spark, values):
    values = [v.encode("utf-8", "ignore").decode() for v in values]
    assert column(spark, values, text.py_strip(F.col("t"))) == [v.strip() for v in values]
    assert column(spark, values, text.choice_letter(F.col("t"))) == [
        next((c for c in v if c in "ABCD"), "") for v in values
    ]


def test_compose_prompt(spark):
    df = spark.createDataFrame(
        [(1, "q", ""), (2, "q", " 　\n"), (3, "q", " x "), (4, "q", None)], "i int, a string, b string"
    )
    ours = df.orderBy("i").select(prompts.compose_prompt(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in ours] == ["q", "q", "q\n x ", "q"]


def test_choice_prompt_text(spark):
    df = spark.createDataFrame([("数学", "1+1?", ["一", "二", "三"])], "s string, q string, o array<string>")
    ours = df.select(prompts.choice_prompt(F.col("s"), F.col("q"), F.col("o"))).first()[0]
    assert ours == (
        "以下是中国关于数学的单项选择题，请选出其中的正确答案，仅输出A/B/C/D中的一个选项（仅输出一个大写字母）。\n\n"
        "问题：1+1?\nA. 一\nB. 二\nC. 三\n答案："
    )


def test_rank_prompt_text(spark):
    df = spark.createDataFrame([("问", ["甲", "乙"])], "i string, r array<string>")
    plain = df.select(prompts.rank_prompt(F.col("i"), F.col("r"))).first()[0]
    assert plain.startswith("\n你是一个专业的") and "回答列表：\n1. 甲\n2. 乙\n**请严格" in plain
    assert "排名：1 > 2 > 3 > 4\n" in plain and "1到{len(responses)}之间" in plain
    assert plain.endswith("- 不能包含其他任何文字或解释")
    fixed = df.select(prompts.rank_prompt(F.col("i"), F.col("r"), prompt_fix=True)).first()[0]
    assert "排名：1 > 2\n" in fixed and "1到2之间" in fixed


def test_judge_prompt_text(spark):
    df = spark.createDataFrame([("问", "答", "回")], "a string, b string, c string")
    ours = df.select(prompts.judge_prompt(F.col("a"), F.col("b"), F.col("c"))).first()[0]
    assert ours.startswith("你是一个专业的") and ours.endswith("</score>")
    assert "指令：问\n\n参考答案：答\n\n模型回答：回\n\n请按照以下格式输出：\n\n<evaluation>" in ours


def test_chat_template(spark):
    template = prompts.ChatTemplate(prefix="[", role_end=":", suffix="]", marker="[assistant:", system="s")
    messages = F.array(prompts.message("user", F.lit("u")), prompts.message("assistant", F.lit("a")))
    df = spark.range(1)
    assert df.select(prompts.render_chat(messages, template)).first()[0] == "[system:s][user:u][assistant:a][assistant:"
    assert df.select(prompts.render_chat(messages, generate=False)).first()[0] == (
        "<|im_start|>user\nu<|im_end|>\n<|im_start|>assistant\na<|im_end|>\n"
    )


def test_filters_do_not_repeat_the_parsing(spark):
    from prefloom.operators.judging import score_replies
    from prefloom.operators.preference import clean_preferences, parse_rankings

    df = spark.createDataFrame(
        [(0, "<score>9</score> 排名：2 > 1", ["a", "b"])], "pos bigint, reply string, responses array<string>"
    )
    ranked = clean_preferences(parse_rankings(df, "reply")).select("pos", "sorted_indices")
    scored = score_replies(df, "reply").filter("score > 5").select("pos", "score")
    for query, rows_ in ((ranked, [(0, [1, 0])]), (scored, [(0, 9.0)])):
        plan = query._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_extract_all(") == 1
        assert [tuple(r) for r in query.collect()] == rows_
