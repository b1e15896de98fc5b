"""Prompt texts and the chat template as column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from prefloom.functions.text import py_strip

# The prompt texts, which the models' replies depend on.
CHOICE_HEAD = "以下是中国关于"
CHOICE_TASK = (
    "的单项选择题，请选出其中的正确答案，仅输出A/B/C/D中的一个选项（仅输出一个大写字母）。\n\n问题："
)
CHOICE_TAIL = "答案："

JUDGE_HEAD = """你是一个专业的 AI 模型评估员，负责评估模型回答的质量。请根据以下标准对模型的回答进行评分（1-10分）：

评估标准：
1. **准确性**：回答是否准确反映了指令的要求
2. **完整性**：回答是否全面覆盖了问题要点
3. **流畅性**：语言表达是否自然流畅
4. **相关性**：回答是否与指令紧密相关

指令："""
JUDGE_REFERENCE = "\n\n参考答案："
JUDGE_RESPONSE = "\n\n模型回答："
JUDGE_TAIL = """

请按照以下格式输出：

<evaluation>
[在这里给出 1-10 分的评分，并简要说明理由]
</evaluation>

<score>
[只输出数字分数：1-10]
</score>"""

RANK_HEAD = """
你是一个专业的 AI 模型评估员，负责对多个模型回答进行偏好排序。

请根据以下标准对模型回答按质量从高到低排序：
1. **准确性**：回答是否准确反映了指令的要求
2. **完整性**：回答是否全面覆盖了问题要点
3. **流畅性**：语言表达是否自然流畅
4. **相关性**：回答是否与指令紧密相关

指令："""
RANK_LIST = "\n\n回答列表：\n"
RANK_FORMAT = "**请严格按照以下格式输出，不要添加任何额外内容：**\n\n排名："
RANK_EXAMPLE = "1 > 2 > 3 > 4"
RANK_RULES = """

其中数字对应回答的序号，从最好到最差排列。

**重要要求：**
- 必须包含"排名："前缀
- 必须使用" > "作为分隔符
- 必须包含所有回答的序号
- 序号必须是1到"""
RANK_COUNT = "{len(responses)}"
RANK_END = "之间的整数\n- 不能包含其他任何文字或解释"


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def compose_prompt(instruction: Column, extra: Column) -> Column:
    """Instruction, then the input on a new line unless it is blank."""
    has_input = py_strip(_text(extra)) != ""
    return F.when(has_input, F.concat(instruction, F.lit("\n"), extra)).otherwise(instruction)


def choice_prompt(subject: Column, question: Column, options: Column) -> Column:
    lines = F.transform(
        options,
        lambda o, i: F.concat(F.char(F.lit(65) + i), F.lit(". "), _text(o), F.lit("\n")),
    )
    return F.concat(
        F.lit(CHOICE_HEAD), subject, F.lit(CHOICE_TASK), question, F.lit("\n"),
        F.array_join(lines, ""), F.lit(CHOICE_TAIL),
    )


def judge_prompt(instruction: Column, reference: Column, response: Column) -> Column:
    return F.concat(
        F.lit(JUDGE_HEAD), instruction,
        F.lit(JUDGE_REFERENCE), _text(reference),
        F.lit(JUDGE_RESPONSE), _text(response),
        F.lit(JUDGE_TAIL),
    )


def rank_prompt(instruction: Column, responses: Column, prompt_fix: bool = False) -> Column:
    """The example always shows four ranks and the count is a literal placeholder;
    ``prompt_fix`` writes both for the actual number of responses."""
    lines = F.transform(
        responses,
        lambda r, i: F.concat((i + 1).cast("string"), F.lit(". "), _text(r), F.lit("\n")),
    )
    example, count = F.lit(RANK_EXAMPLE), F.lit(RANK_COUNT)
    if prompt_fix:
        numbers = F.transform(responses, lambda r, i: (i + 1).cast("string"))
        example, count = F.array_join(numbers, " > "), F.size(responses).cast("string")
    return F.concat(
        F.lit(RANK_HEAD), instruction, F.lit(RANK_LIST), F.array_join(lines, ""),
        F.lit(RANK_FORMAT), example, F.lit(RANK_RULES), count, F.lit(RANK_END),
    )


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


@dataclass(frozen=True)
class ChatTemplate:
    """How a model family marks turns. The model's own template decides the
    values; the defaults are the widespread ChatML marks."""

    prefix: str = "<|im_start|>"
    role_end: str = "\n"
    suffix: str = "<|im_end|>\n"
    marker: str = "<|im_start|>assistant\n"
    system: str | None = None


CHATML = ChatTemplate()


def render_chat(messages: Column, template: ChatTemplate = CHATML, generate: bool = True) -> Column:
    """Chat text of an array of (role, content), with the mark that asks for a reply."""
    turns = F.transform(
        messages,
        lambda m: F.concat(
            F.lit(template.prefix), m["role"], F.lit(template.role_end),
            m["content"], F.lit(template.suffix),
        ),
    )
    head = ""
    if template.system is not None:
        head = f"{template.prefix}system{template.role_end}{template.system}{template.suffix}"
    return F.concat(
        F.lit(head), F.array_join(turns, ""), F.lit(template.marker if generate else "")
    )
