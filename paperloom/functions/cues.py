"""Fixed patterns and word lists of exam papers, and the predicates over them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Results depend on each of them.
SECTION = r"^[一二三四五六七八九十]+[、.．]\s*(选择|非选择|填空|解答|计算|证明|应用|综合|压轴).*$"
TEXT_SECTION = r"^[一二三四五六七八九十]+[、.．]\s*(选择|填空|解答|计算|证明|应用|综合|压轴).*$"
ALT_SECTION = r"^(?:向量\s*)?小题[A-Z]$|^(?:考点|专题|模块)[一二三四五六七八九十0-9]+|^第[0-9一二三四五六七八九十]+[章节]"
SUBSECTION = r"(?:小题|专题|模块|题组|类型|考点|向量小题|第[一二三四五六七八九十]+组|[A-H][组类])"
ANSWER_SECTION = r"^(参考答案|答案|解析|答案与解析|试卷答案|详解)\s*$"
ARABIC_NUMBER = r"^\s*(?:第\s*)?([0-9]{1,3})(?:\s*题)?\s*[\.．、)：：]\s*"
CHINESE_NUMBER = r"^\s*[（(]?\s*([一二三四五六七八九十]{1,4})\s*[）)、.．：：]\s*"
LECTURE_NUMBER = r"^\s*【\s*(例|例题|典例|变式|练习)\s*([0-9一二三四五六七八九十]{1,4}(?:[-－—][0-9一二三四五六七八九十]{1,4})?)\s*】\s*"
OPTION_LABEL = r"^\s*[A-H][\.．、:：]\s+"
VISUAL_CUE = r"(如图|下图|图中|图示|函数图像|坐标系|表格|统计图|几何图)"
EMBEDDED_NUMBER = r"[。，；\s](?:第\s*)?([0-9]{1,3})(?:\s*题)?[\.．、)]\s*\S"
LINE_NUMBER = r"^\s*(?:第\s*)?(\d{1,3})(?:\s*题)?(?:[、.．]\s*(.*)|\s*)$"
CHOICE_LINE = r"^\s*([A-H])\s*[.．、:：]\s*(.*)$"
IMAGE_REFERENCE = r"(如图|下图|图中|由图|见图|\[图\])"
BLANK = r"(__+|_{2,}|（\s*）|\(\s*\)|填空)"
ANSWER_LABEL = r"(?i)(?:答案|正确答案|故选|故答案为|选)\s*[:：]?\s*([A-H])(?=$|[^A-Za-z])"
LEADING_LABEL = r"(?i)^\s*([A-H])\s*(?:[.．、。\n]|$)"
CHOICE_MARKER = r"(?:^|\n)\s*[A-H]\s*[.．、]"
NON_ANSWER_CUES = ("本卷共", "试卷共", "答题前", "一、选择题", "二、填空题", "三、解答题", "<details", "<summary", "![](")
INSTRUCTION_CUES = (
    "答题前", "考生须知", "注意事项", "本试卷", "本卷", "考试时间", "满分", "答案写在答题卡", "用2B铅笔", "用 2B 铅笔", "不准使用", "考试结束后",
    "选择题作答", "非选择题必须", "将答案写在", "答题卡上", "写在试卷上", "试卷满分", "考试用时", "考生务必将", "务必", "每小题", "本卷共",
    "参考公式", "答案标号", "涂黑", "黑色墨水", "钢笔或签字笔", "用铅笔",
)
STRONG_INSTRUCTION_CUES = (
    "答题前", "考生须知", "注意事项", "每小题", "参考公式", "答案标号", "涂黑", "黑色墨水", "钢笔或签字笔", "答题卡上", "将答案写在", "写在试卷上",
    "用2B铅笔", "用 2B 铅笔", "用铅笔",
)
MATH_FEATURES = (
    "已知", "若", "证明", "计算", "函数", "数列", "集合", "方程", "不等式", "概率", "椭圆", "双曲线", "抛物线", "向量", "三角形", "圆", "$", "∠", "△",
    "⊙", "∥", "⊥", "≤", "≥", "≠", "°", "′", "″", "α", "β", "γ", "θ", "π", "sin", "cos", "tan", "log",
)
ACTIONS = ("已知", "证明", "计算", "解答")
ASK = "(?<!要)求(?!作答|填写|涂|改|交|使用)"
LET = "设(?!置|备|施|计)"
IF = "若(?!干)"
ANSWER_PATH = "参考答案"
ASSET_TYPES = ("image", "table", "figure")
ELEMENT_TYPES = ("text", "formula", "image", "table", "figure", "line", "header", "footer")


def unicode(pattern: str) -> str:
    """The pattern with Unicode meaning for ``\\s`` and ``\\d``."""
    return "(?U)" + pattern


def matches(x: Column, pattern: str) -> Column:
    return x.rlike(unicode(pattern))


def holds_any(x: Column, words: tuple[str, ...]) -> Column:
    return F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(x, w))


def asks_for_action(x: Column) -> Column:
    """True if a text asks for something to be solved."""
    return holds_any(x, ACTIONS) | x.rlike(ASK) | x.rlike(LET) | x.rlike(IF)


def has_math(x: Column) -> Column:
    return holds_any(x, MATH_FEATURES) | x.rlike(ASK) | x.rlike(LET)


def is_instruction(full: Column, rest: Column) -> Column:
    """True for a numbered item that instructs candidates instead of asking a question."""
    seen = F.concat(full, F.lit(" "), rest)
    return F.when(~holds_any(seen, INSTRUCTION_CUES), False).when(holds_any(seen, STRONG_INSTRUCTION_CUES), ~asks_for_action(seen)).otherwise(~has_math(seen))


def answer_label(answer: Column, labels: Column) -> Column:
    """The choice that an answer's text names, or null."""
    first, second = (F.upper(F.regexp_extract(answer, unicode(p), 1)) for p in (ANSWER_LABEL, LEADING_LABEL))
    return F.when(F.array_contains(labels, first), first).when(F.array_contains(labels, second), second)


def is_not_an_answer(answer: Column, block_text: Column) -> Column:
    """True if an answer is really a whole question, a notice or markup."""
    kept = F.regexp_replace(answer, r"(?U)^\s+|\s+\z", "")
    copied = (F.length(kept) >= 80) & F.contains(F.coalesce(block_text, F.lit("")), F.substring(kept, 1, 80))
    return (F.length(kept) > 0) & (holds_any(kept, NON_ANSWER_CUES) | (F.regexp_count(kept, F.lit(unicode(CHOICE_MARKER))) >= 3) | copied)
