import pytest
from pyspark.sql import functions as F

from paperloom.functions import cues, text
from paperloom.operators import rules, segment
from paperloom.plans.ingest import from_markdown
from paperloom.sources.providers import Retrying, structured

PAPER = """前言
一、选择题
1. 下列正确的是
A. 甲
B．乙

第 2 题、 填写（ ）
续行
二、解答题
3
证明 x
参考答案
1. 答案：B 解析：因为乙
2. 解析：略
答案：7
3. 旧
3. 新
4.
"""


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([("p", PAPER), ("empty", ""), ("none", None), ("text", "没有题号\n参考答案")], "paper_id string, markdown string")


def test_sections(docs):
    got = {r.paper_id: r for r in segment.document_sections(docs).collect()}
    assert got["p"].answers.startswith("1. 答案") and "参考答案" not in got["p"].body and got["text"].body == "没有题号"
    assert got["empty"].body == got["none"].body == ""


def test_blocks(docs):
    got = segment.question_blocks(docs).orderBy("block_index").collect()
    assert [(r.id, r.question_number, r.section_title) for r in got] == [("p_qb_0001", "1", "一、选择题"), ("p_qb_0002", "2", "一、选择题"), ("p_qb_0003", "3", "二、解答题")]
    assert got[1].raw_markdown == "第 2 题、 填写（ ）\n续行" and got[2].raw_markdown == "3\n证明 x"


def test_choices(docs):
    got = segment.choices(segment.question_blocks(docs)).orderBy("sort_order").collect()
    assert [(r.block_index, r.label, r.content_latex, r.sort_order) for r in got] == [(1, "A", "甲", 1), (1, "B", "乙", 2)]


def test_answers(docs):
    got = {r.question_number: r for r in segment.answer_entries(docs).withColumn("p", segment.answer_parts(F.col("entry"))).where("paper_id = 'p'").collect()}
    assert set(got) == {"1", "2", "3"}
    assert tuple(got["1"].p) == ("B", "因为乙") and tuple(got["2"].p) == ("7", "略") and got["3"].entry == "新"


def test_questions_of_a_paper(docs):
    got = {r.question_number: r for r in from_markdown(docs).collect()}
    assert [got[n].question_type for n in "123"] == ["single_choice", "fill_blank", "short_answer"]
    assert got["1"].answer_latex == "B" and got["1"].gate == "pass" and [i.code for i in got["1"].issues] == ["too_few_choices"]
    assert got["3"].analysis_latex == rules.PLACEHOLDER and got["3"].needs_review


@pytest.mark.parametrize("x,odd", [("$a$", False), ("$a", True), (r"\$a$", True), (r"\\$a$", False), (None, False), ("", False)])
def test_dollars(spark, x, odd):
    assert spark.createDataFrame([(x,)], "x string").select(text.unbalanced_dollars(F.col("x"))).first()[0] is odd


@pytest.mark.parametrize("x,want", [("本卷共 10 题", True), ("每小题 5 分，已知 x", False), ("请按要求作答，满分 100", True), ("满分 100，求 x", False), ("求 x", False), ("考试时间设置为 120 分", True), ("注意事项：若干", True), ("注意事项：若 x", False)])
def test_instructions(spark, x, want):
    assert spark.createDataFrame([(x,)], "x string").select(cues.is_instruction(F.col("x"), F.lit(""))).first()[0] is want


def question(spark, **given):
    base = {"question_type": "single_choice", "stem_latex": "x", "choices": [("A", "甲"), ("B", "乙丙")], "answer_latex": "A", "analysis_latex": "", "model_warnings": [], "raw_markdown": "A. 甲\nB. 乙", "n_assets": 0, "parsed_choices": [("A", "甲"), ("C", "丁")]}
    row = {**base, **given}
    kind = "array<struct<label:string,content_latex:string>>"
    return spark.createDataFrame([tuple(row.values())], f"question_type string, stem_latex string, choices {kind}, answer_latex string, analysis_latex string, model_warnings array<string>, raw_markdown string, n_assets int, parsed_choices {kind}")


@pytest.mark.parametrize(
    "given,answer",
    [
        ({"answer_latex": "故选：b。"}, "B"), ({"answer_latex": "A. 甲"}, "A"), ({"answer_latex": "乙"}, "B"), ({"answer_latex": "本卷共 3 页"}, ""), ({"answer_latex": "b"}, "B"), ({"answer_latex": "d"}, "D"), ({"answer_latex": "xyz"}, "xyz"),
        ({"choices": [("A", "甲")], "answer_latex": "C"}, "C"), ({"choices": [("A", "甲"), ("B", "乙")], "answer_latex": "\nA. 1\nB. 2\nC. 3"}, "A"),
    ],
)
def test_repaired_answers(spark, given, answer):
    assert rules.repair(question(spark, **given)).first().answer_latex == answer


def test_repairs(spark):
    r = rules.repair(question(spark, choices=[("A", "甲")], n_assets=1)).first()
    assert [c.label for c in r.choices] == ["A", "C"] and r.stem_latex == "x [图]"
    p = rules.repair(question(spark, question_type="proof")).first()
    assert p.analysis_latex == rules.PLACEHOLDER and p.model_warnings == ["analysis_fallback: no analysis in source"]


@pytest.mark.parametrize(
    "given,codes",
    [
        ({}, []), ({"stem_latex": " "}, ["empty_stem"]), ({"choices": [("A", "甲")]}, ["too_few_choices"]), ({"answer_latex": "D"}, ["answer_not_in_choices"]),
        ({"question_type": "proof"}, ["missing_analysis"]), ({"stem_latex": "$x"}, ["unbalanced_latex_delimiters"]), ({"question_type": "multiple_choice", "choices": []}, []),
    ],
)
def test_gates(spark, given, codes):
    r = question(spark, **given).select(rules.gate().alias("g")).first().g
    assert r.codes == codes and r.gate == ("failed" if codes == ["empty_stem"] else "warning" if codes else "pass")


def test_fallback_raises_the_gate(spark):
    g = question(spark).select(rules.with_fallback(rules.gate(), F.array(F.lit("deepseek_fallback: x"))).alias("g")).first().g
    assert (g.gate, g.codes) == ("warning", ["deepseek_fallback"])


def test_validation_counts(spark):
    r = rules.validate(question(spark, stem_latex="如图 $x", choices=[], answer_latex="")).first()
    assert [i.code for i in r.issues] == ["unbalanced_latex_delimiters", "missing_choices", "missing_answer", "missing_referenced_image"]
    assert r.overall_score == 0.2 and r.needs_review


@pytest.mark.parametrize("x,want", [("MinerU connection refused", "mineru_transient"), ("mineru: psycopg", "mineru_non_transient"), ("", "unknown"), ("psycopg down", "database"), ("crop failed", "asset_crop"), ("storage", "asset_store")])
def test_failure_classes(spark, x, want):
    assert spark.createDataFrame([(x,)], "x string").select(rules.text_class(F.col("x"), "failure")).first()[0] == want


def test_transient_errors(spark):
    rows = spark.createDataFrame([("Read timed out",), ("model: read timed out",), ("other",)], "x string")
    assert [r[0] for r in rows.select(rules.is_transient(F.col("x"))).collect()] == [True, False, False]


class Flaky:
    def __init__(self, fails):
        self.fails = fails

    def structure(self, markdown):
        if self.fails:
            self.fails -= 1
            raise ValueError("no luck")
        return {"question_type": "proof", "stem_latex": markdown, "choices": [], "answer_latex": "", "analysis_latex": "", "knowledge_points": [], "difficulty": None, "warnings": []}


def test_providers_are_asked_again():
    assert Retrying(Flaky(1)).structure("m")["warnings"][0].startswith("deepseek_retry: recovered on attempt 2")
    assert Retrying(Flaky(2)).structure("m")["warnings"] == ["deepseek_fallback: no luck"]


def test_providers_run_in_tasks(spark, docs):
    rows = structured(segment.question_blocks(docs), Flaky(0)).collect()
    assert {r.question_type for r in rows} == {"proof"} and all(r.stem_latex == r.raw_markdown for r in rows)


@pytest.mark.parametrize("x,want", [("a\r\nb\x0bc d\n", ["a", "b", "c", "d"]), ("", []), (None, []), ("\n", [""]), ("a\x85b", ["a", "b"])])
def test_lines(spark, x, want):
    assert spark.createDataFrame([(x,)], "x string").select(text.lines(F.col("x"))).first()[0] == want
