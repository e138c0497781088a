import pytest

from paperloom.plans.layout import layout
from tests.elements import frame, paper

T = "text"


def ran(spark, *papers):
    made = layout(frame(spark, *papers))
    blocks = {}
    for b in made.blocks.collect():
        blocks.setdefault(b.paper_id, []).append(b)
    return {k: sorted(v, key=lambda b: b.block_index) for k, v in blocks.items()}, made.warnings.collect()


@pytest.fixture(scope="module")
def result(spark):
    papers = [
        paper("columns", ("s", 1, T, (0.1, 0.05, 0.4, 0.08), "一、选择题"), ("a", 1, T, (0.1, 0.1, 0.4, 0.13), "1. 计算 x"), ("b", 1, T, (0.1, 0.14, 0.4, 0.17), "A. 1"), ("c", 1, T, (0.6, 0.06, 0.9, 0.09), "2. 计算 y"), ("d", 1, "formula", (0.6, 0.1, 0.9, 0.13), "$y$")),
        paper("pages", ("a", 1, T, (0.1, 0.8, 0.9, 0.85), "8. 证明 x"), ("b", 2, T, (0.1, 0.1, 0.9, 0.15), "继续"), ("c", 2, T, (0.1, 0.3, 0.9, 0.35), "9. 计算 y")),
        paper("far", ("a", 1, T, (0.1, 0.1, 0.9, 0.15), "1. 计算 x"), ("b", 3, T, (0.1, 0.1, 0.9, 0.15), "中间"), ("c", 5, T, (0.1, 0.3, 0.9, 0.35), "2. 计算 y")),
        paper("answers", ("a", 1, T, (0.1, 0.1, 0.9, 0.15), "1. 计算 x"), ("h", 1, T, (0.1, 0.3, 0.9, 0.33), "参考答案"), ("b", 1, T, (0.1, 0.4, 0.9, 0.45), "1. A")),
        paper("picture", ("a", 1, T, (0.1, 0.1, 0.4, 0.2), "1. 如图，计算 x"), ("i", 1, "image", (0.1, 0.15, 0.4, 0.25), ""), ("b", 1, T, (0.1, 0.6, 0.4, 0.65), "2. 计算 y"), ("z", 2, "image", (0.5, 0.9, 0.6, 0.95), "")),
        paper("marks", ("n", 1, T, (0.1, 0.05, 0.9, 0.08), "1. 答题前，考生务必将姓名填写"), ("a", 1, T, (0.1, 0.1, 0.9, 0.15), "1. 2+3 是数"), ("b", 1, T, (0.1, 0.2, 0.9, 0.22), "2."), ("c", 1, T, (0.1, 0.24, 0.9, 0.26), "计算 y。 7. 又一题"), ("d", 1, T, (0.4, 0.5, 0.9, 0.55), "3. 缩进太多"), ("f", 1, "formula", (0.1, 0.97, 0.9, 0.99), "noise")),
        paper("nested", ("m", 1, T, (0.1, 0.05, 0.9, 0.08), "专题一"), ("s", 1, T, (0.1, 0.1, 0.9, 0.12), "一、选择题"), ("a", 1, T, (0.1, 0.15, 0.9, 0.2), "1. 计算 x"), ("t", 1, T, (0.1, 0.3, 0.9, 0.32), "二、填空题"), ("b", 1, T, (0.1, 0.35, 0.9, 0.4), "1. 计算 y"), ("c", 1, T, (0.1, 0.45, 0.9, 0.5), "1. 计算 z")),
        paper("bad", (None, 1, T, (0, 0, 1, 1), "x"), ("p", 0, T, (0, 0, 1, 1), "x"), ("k", 1, "odd", (0, 0, 1, 1), "x"), ("b", 1, T, (0, 0, 1), "x"), ("d", 1, T, (0.5, 0, 0.5, 1), "x"), ("a", 1, T, (0.1, 0.1, 0.9, 0.15), "1. 计算 x"), ("n", 1, T, None, None)),
        paper("lecture", ("k", 1, T, (0.1, 0.1, 0.9, 0.15), "1. 定义 x"), ("e", 1, T, (0.1, 0.2, 0.9, 0.25), "【例 1－2】计算 x"), ("f", 1, T, (0.1, 0.3, 0.9, 0.35), "【变式3】 计算 y")),
        paper("header", *[(f"h{p}", p, T, (0.1, 0.05, 0.5, 0.07), "校名") for p in (1, 2, 3)], ("a", 1, T, (0.1, 0.1, 0.9, 0.15), "1. 计算 x"), ("o", 1, "formula", (0.1, 0.085, 0.3, 0.095), "$z$")),
        paper("none", ("a", 1, T, (0.1, 0.1, 0.9, 0.15), "没有题号")),
    ]
    return ran(spark, *papers)


def test_columns_stay_apart(result):
    one, two = result[0]["columns"]
    assert (one.question_number, one.column_index, one.element_ids) == ("1", 0, ["a", "b"])
    assert (two.question_number, two.column_index, two.element_ids) == ("2", 1, ["c", "d"])
    assert one.section_title == "一、选择题" and list(one.section_path) == ["一、选择题"]


def test_questions_go_on_to_the_next_page(result):
    eight, nine = result[0]["pages"]
    assert eight.element_ids == ["a", "b"] and eight.pages == [1, 2] and nine.pages == [2]


def test_questions_do_not_span_many_pages(result):
    one, _ = result[0]["far"]
    assert one.pages == [1] and one.element_ids == ["a"]
    assert any(w.paper_id == "far" and w.code == "question_spans_too_many_pages" for w in result[1])


def test_answers_own_nothing(result):
    (one,) = result[0]["answers"]
    assert one.element_ids == ["a"]


def test_pictures_go_to_the_best_block(result):
    one, two = result[0]["picture"]
    assert [(a.asset_id, a.needs_review) for a in one.assets] == [("i", False)] and "visual_cue" in one.assets[0].reasons
    assert one.question_bbox[3] == pytest.approx(0.25) and not two.assets
    assert any(w.warning.startswith("unassigned_visual_asset: z") for w in result[1])


def test_markers(result):
    assert [b.question_number for b in result[0]["marks"]] == ["2"]
    codes = {w.code for w in result[1] if w.paper_id == "marks"}
    assert codes == {"instruction_number_filtered", "missing_anchor_suspected"}


def test_nested_sections(result):
    assert [list(b.section_path) for b in result[0]["nested"]] == [["专题一", "一、选择题"], ["二、填空题"], ["二、填空题"]]
    told = [w.warning for w in result[1] if w.paper_id == "nested"]
    assert "duplicate_question_number: 1 appears at anchor c in section_path ('二、填空题',)" in told
    assert any(w.startswith("section_hierarchy_suspected: 1 question numbers") for w in told)


def test_bad_elements_are_named(result):
    told = sorted(w.warning for w in result[1] if w.paper_id == "bad")
    assert told == sorted(["invalid_layout_element: missing id", "invalid_layout_element: p missing or invalid page", "invalid_layout_element: k invalid type 'odd'", "invalid_layout_element: b invalid bbox", "invalid_layout_element: d invalid bbox dimensions", "invalid_layout_element: n invalid bbox"])
    assert len(result[0]["bad"]) == 1 and len(result[0]["bad"][0].warnings) == 6


def test_lecture_examples(result):
    assert [b.question_number for b in result[0]["lecture"]] == ["例1-2", "变式3"]
    assert any(w.code == "knowledge_note_number_filtered" for w in result[1] if w.paper_id == "lecture")


def test_running_headers_and_orphans(result):
    (one,) = result[0]["header"]
    assert one.element_ids == ["a"] and any(w.warning == "orphan_formula: o not owned by any question block" for w in result[1])


def test_paper_without_questions(result):
    assert "none" not in result[0]
