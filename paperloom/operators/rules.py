"""Rules over structured questions: types, validation, gating, repair; and classes of errors and papers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions import cues
from paperloom.functions.text import is_blank, strip, text_or_empty, unbalanced_dollars

# The types of questions, placeholders and marks, and below the codes and messages of findings.
QUESTION_TYPES = ("single_choice", "multiple_choice", "fill_blank", "short_answer", "proof", "unknown")
PLACEHOLDER = "暂无解析，待人工补充"
NO_ANSWER = "暂无答案，待人工补充"
IMAGE_MARK = " [图]"


def _listed(*tests: tuple[Column, Column | str]) -> Column:
    """The values whose condition holds, in order."""
    return F.array_compact(F.array(*[F.when(c, v if isinstance(v, Column) else F.lit(v)) for c, v in tests]))


def _labels(choices: Column) -> Column:
    return F.transform(choices, lambda c: F.upper(strip(c["label"])))


def _size(x: Column) -> Column:
    return F.when(x.isNull(), 0).otherwise(F.size(x))


def _texts(sep: str = "") -> Column:
    return F.concat_ws(sep, *[text_or_empty(F.col(c)) for c in ("stem_latex", "answer_latex", "analysis_latex")])


def gate(assets: Column | None = None) -> Column:
    """struct(gate, codes): failed for an empty stem, warning for any code, else pass."""
    kind, answer, choices = F.col("question_type"), F.upper(strip(text_or_empty(F.col("answer_latex")))), F.col("choices")
    single = kind == "single_choice"
    odd = unbalanced_dollars(F.col("stem_latex")) | unbalanced_dollars(F.col("answer_latex")) | unbalanced_dollars(F.col("analysis_latex"))
    pictured = F.lit(False) if assets is None else (_size(assets) > 0) & ~_texts().rlike(cues.IMAGE_REFERENCE)
    codes = _listed(
        (single & (_size(choices) < 2), "too_few_choices"),
        (single & (_size(choices) > 0) & (F.length(answer) > 0) & ~F.array_contains(_labels(choices), answer), "answer_not_in_choices"),
        (kind.isin("proof", "short_answer") & is_blank(F.col("analysis_latex")), "missing_analysis"),
        (odd, "unbalanced_latex_delimiters"),
        (pictured, "asset_without_text_reference"),
    )
    made = lambda g, c: F.struct(g.alias("gate"), c.alias("codes"))
    return F.when(is_blank(F.col("stem_latex")), made(F.lit("failed"), F.array(F.lit("empty_stem")))).otherwise(made(F.when(F.size(codes) > 0, "warning").otherwise("pass"), codes))


def with_fallback(gated: Column, warnings: Column) -> Column:
    """A gate raised to a warning where the provider fell back."""
    fell = F.exists(F.coalesce(warnings, F.array().cast("array<string>")), lambda w: F.startswith(w, F.lit("deepseek_fallback")))
    codes = F.when(fell & ~F.array_contains(gated["codes"], "deepseek_fallback"), F.array_append(gated["codes"], F.lit("deepseek_fallback"))).otherwise(gated["codes"])
    return F.struct(F.when(fell & (gated["gate"] == "pass"), "warning").otherwise(gated["gate"]).alias("gate"), codes.alias("codes"))


def issues(n_assets: Column) -> Column:
    """All findings about a question, as structs of code, message, severity and field."""
    kind, answer, choices = F.col("question_type"), F.upper(strip(text_or_empty(F.col("answer_latex")))), F.col("choices")
    single, n = kind == "single_choice", _size(F.col("choices"))
    issue = lambda code, text, field: F.struct(F.lit(code).alias("code"), F.lit(text).alias("message"), F.lit("error").alias("severity"), F.lit(field).alias("field"))
    dollars = [(unbalanced_dollars(F.col(f)), issue("unbalanced_latex_delimiters", "LaTeX 美元符号疑似不闭合。", f)) for f in ("stem_latex", "answer_latex", "analysis_latex")]
    return _listed(
        (is_blank(F.col("stem_latex")), issue("missing_stem", "题干为空。", "stem_latex")),
        *dollars,
        (single & (n == 0), issue("missing_choices", "选择题缺少选项。", "choices")),
        (single & (n > 0) & (n < 4), issue("too_few_choices", "选择题选项少于 4 个。", "choices")),
        (single & (F.length(answer) == 0), issue("missing_answer", "选择题缺少答案。", "answer_latex")),
        (single & (F.length(answer) > 0) & (n > 0) & ~F.array_contains(_labels(choices), answer), issue("answer_not_in_choices", "选择题答案未命中任何选项。", "answer_latex")),
        (kind.isin("fill_blank", "short_answer", "proof") & is_blank(F.col("answer_latex")), issue("missing_answer", "非选择题缺少答案。", "answer_latex")),
        (kind.isin("proof", "short_answer") & is_blank(F.col("analysis_latex")), issue("missing_analysis", "解答/证明题缺少解析。", "analysis_latex")),
        (text_or_empty(F.col("stem_latex")).rlike(cues.IMAGE_REFERENCE) & (n_assets == 0), issue("missing_referenced_image", "题干引用图片，但题目没有关联资源。", "assets")),
    )


def validate(questions: DataFrame, n_assets: Column | None = None) -> DataFrame:
    """``questions`` with ``issues``, ``overall_score`` (a fifth less for each) and ``needs_review``."""
    found = questions.withColumn("issues", issues(F.lit(0) if n_assets is None else n_assets))
    return found.withColumns({"overall_score": F.bround(F.greatest(F.lit(0.0), 1.0 - 0.2 * F.size("issues")), 2), "needs_review": F.size("issues") > 0})


def inferred_type(section: Column) -> Column:
    """The question's type from its choices, its section's title and its stem; set types stay."""
    kind, stem, title = F.col("question_type"), text_or_empty(F.col("stem_latex")), text_or_empty(section)
    sure = F.when(kind.isin(*QUESTION_TYPES), kind).otherwise(F.raise_error(F.concat(F.lit("unknown question type "), kind)))
    return (
        F.when(~kind.isin("unknown", "short_answer"), sure)
        .when(_size(F.col("choices")) > 0, "single_choice")
        .when(F.contains(title, F.lit("证明")) | F.startswith(strip(stem), F.lit("证明")), "proof")
        .when(cues.matches(stem, cues.BLANK), "fill_blank")
        .when(F.contains(title, F.lit("选择")), "single_choice")
        .when(F.contains(title, F.lit("填空")), "fill_blank")
        .when(cues.holds_any(title, ("解答", "计算", "应用", "综合", "压轴")), "short_answer")
        .otherwise(kind)
    )


def repair(questions: DataFrame, parsed: str = "parsed_choices", block_text: str = "raw_markdown", assets: str = "n_assets") -> DataFrame:
    """Questions repaired before gating, with ``model_warnings`` extended.

    Missing choices come from the block's own, answers become labels or are
    cleared, empty analyses get a placeholder, and unmentioned pictures a mark.
    """
    first_of_each = lambda cs: F.filter(cs, lambda c, i: F.array_position(_labels(cs), F.upper(strip(c["label"]))) == i + 1)
    fresh = F.filter(first_of_each(F.col(parsed)), lambda c: ~F.array_contains(_labels(F.col("choices")), F.upper(strip(c["label"]))))
    single = F.col("question_type") == "single_choice"
    rows = questions.withColumn("model_warnings", F.coalesce("model_warnings", F.array().cast("array<string>")))
    rows = rows.withColumn("choices", F.when(single & (_size(F.col("choices")) < 2), F.concat("choices", fresh)).otherwise(F.col("choices")))
    rows = rows.withColumns({"_a": strip(text_or_empty(F.col("answer_latex"))), "_l": _labels(F.col("choices"))}).withColumn("_u", F.upper("_a"))
    off = single & (_size(F.col("choices")) > 0) & (F.length("_a") > 0) & ~F.array_contains("_l", F.col("_u"))
    rows = rows.withColumn("_named", F.when(off, cues.answer_label(F.col("_a"), F.col("_l"))))
    content = lambda c: F.upper(strip(text_or_empty(c["content_latex"])))
    alike = F.filter("choices", lambda c: (F.length(content(c)) > 0) & (F.contains(content(c), F.col("_u")) | F.contains(F.col("_u"), content(c))))
    rows = rows.withColumns({"_junk": off & F.col("_named").isNull() & cues.is_not_an_answer(F.col("_a"), F.col(block_text)), "_alike": F.when(off, F.get(alike, 0)["label"])})
    letter = F.when(F.col("_u").rlike("^[A-H]$"), F.col("_u"))
    to = F.when(F.col("_named").isNotNull(), F.col("_named")).when(F.col("_junk"), F.lit("")).when(F.col("_alike").isNotNull(), F.col("_alike")).when(off, letter)
    shown = F.substring("_a", 1, 60)
    note = F.when(F.col("_named").isNull() & F.col("_junk"), F.concat(F.lit("answer_cleared_non_answer: '"), shown, F.lit("'"))).when(to.isNotNull(), F.concat(F.lit("answer_normalized: '"), shown, F.lit("' -> "), to))
    lower_only = single & (_size(F.col("choices")) > 0) & ~off & (F.length("_a") == 1) & (F.col("_a") != F.col("_u"))
    add = lambda w: F.when(w.isNotNull(), F.array_append("model_warnings", w)).otherwise(F.col("model_warnings"))
    rows = rows.withColumns({"answer_latex": F.coalesce(F.when(off, to), F.when(lower_only, F.col("_u")), F.col("answer_latex")), "model_warnings": add(F.when(off, note))})
    bare = F.col("question_type").isin("proof", "short_answer") & is_blank(F.col("analysis_latex"))
    rows = rows.withColumns({"model_warnings": add(F.when(bare, F.lit("analysis_fallback: no analysis in source"))), "analysis_latex": F.when(bare, PLACEHOLDER).otherwise(F.col("analysis_latex"))})
    pictured = (F.col(assets) > 0) & ~_texts().rlike(cues.IMAGE_REFERENCE)
    return rows.withColumn("stem_latex", F.when(pictured, F.concat("stem_latex", F.lit(IMAGE_MARK))).otherwise(F.col("stem_latex"))).drop("_a", "_l", "_u", "_named", "_junk", "_alike")


def payload_error(payload: Column) -> Column:
    """The first rule that a provider's payload (a VARIANT or struct of PAYLOAD's fields) breaks, or null."""
    conf = lambda f: payload["confidence"][f]
    out = F.lit(None).cast("string")
    for f in ("knowledge", "answer", "latex", "structure"):
        out = F.when(~F.coalesce(conf(f).between(0, 1), F.lit(True)), f"confidence.{f} must be from 0 to 1").otherwise(out)
    out = F.when(~F.coalesce(payload["difficulty"].between(1, 5), F.lit(True)), "difficulty must be from 1 to 5 or null").otherwise(out)
    bad = F.exists(F.coalesce(payload["choices"], F.array()), lambda c: c["label"].isNull() | c["content_latex"].isNull())
    out = F.when(bad, "choices need a label and a content").otherwise(out)
    for f in ("warnings", "knowledge_points", "analysis_latex", "answer_latex", "choices", "stem_latex"):
        out = F.when(payload[f].isNull(), f"missing field {f}").otherwise(out)
    return F.when(~F.coalesce(payload["question_type"].isin(*QUESTION_TYPES), F.lit(False)), "unknown question type").otherwise(out)


def missing_fields(raw_json: Column, required: tuple[str, ...]) -> Column:
    """Required keys that a JSON object lacks, in order; null if the text is no object."""
    keys = F.json_object_keys(raw_json)
    return F.when(keys.isNotNull(), F.array_sort(F.array_except(F.array(*[F.lit(r) for r in required]), keys)))


# The fields that a provider's answer has to have.
REQUIRED_FIELDS = ("question_type", "stem_latex", "choices", "answer_latex", "analysis_latex", "knowledge_points", "difficulty", "confidence", "warnings")


def chat_content(response: Column) -> Column:
    """The first choice's message in a chat response; null for any other shape."""
    return F.get_json_object(response, "$.choices[0].message.content")


def parsed_response(content: Column) -> Column:
    """struct(problem, missing): what keeps a response's content from being an answer, and the fields it lacks."""
    lacks = missing_fields(content, REQUIRED_FIELDS)
    problem = F.when(content.isNull(), "unexpected shape").when(lacks.isNull(), "not a JSON object").when(F.size(lacks) > 0, "missing required fields")
    return F.struct(problem.alias("problem"), F.when(F.size(lacks) > 0, lacks).alias("missing"))


# Parts of parser errors that never pass with time, and of those that may.
PERMANENT = ("no such file or directory", "pdf file not found", "filenotfounderror", "model", "invalid argument", "unknown option", "cannot open", "permission denied")
TRANSIENT = (
    "all connection attempts failed", "timed out while polling task status", "connection reset", "connection refused", "connection aborted",
    "remote end closed connection", "could not resolve host", "temporary failure in name resolution", "connect timed out", "read timed out", "broken pipe",
    "network is unreachable",
)
PARSER = "mineru"
PARSER_TRANSIENT = ("connection", "timeout", "timed out", "refused", "reset", "broken pipe", "unreachable")

# For each report, words and the class of the first that a text holds; then the rest's length.
CLASSES: dict[str, tuple[tuple[tuple[tuple[str, ...], str], ...], int]] = {
    "failure": (
        ((("deepseek",), "deepseek"), (("database", "psycopg", "postgres"), "database"), (("layout",), "layout"), (("crop",), "asset_crop"), (("store", "storage"), "asset_store")), 0),
    "ingest_error": (
        ((("layout",), "Layout Ownership: error"), (("deepseek",), "DeepSeek: error"), (("database", "psycopg"), "Database: connection error"), (("memory", "timeout"), "Resource: ")), 80),
    "ingest_warning": (
        ((("crop",), "Crop: partial failure"), (("save", "duplicate"), "Duplicate: save failure"), (("visual",), "Visual: candidate generation"), (("phash",), "pHash: computation"), (("asset",), "Asset: identification")), 80),
    "linkage_error": (
        ((("layout",), "Layout Ownership: error"), (("deepseek",), "DeepSeek: error"), (("database", "psycopg"), "Database: error"), (("schema",), "Schema: missing tables")), 80),
    "linkage_warning": (
        ((("crop",), "Crop: failure"), (("phash",), "pHash: computation failure"), (("save",), "Save: DB write"), (("duplicate",), "Duplicate: save failure"), (("visual",), "Visual: candidate generation")), 80),
    "structure_error": (
        ((("mineru",), "MinerU: error"), (("deepseek",), "DeepSeek: API error"), (("layout",), "Layout Ownership: error"), (("memory", "timeout"), "Resource: ")), 80),
}


def text_class(text: Column, report: str) -> Column:
    """Class of an error or warning text in one of the reports of CLASSES."""
    table, rest = CLASSES[report]
    full = text_or_empty(text)
    low = F.lower(full)
    chain = F.when(F.lit(False), "")
    if report == "failure":
        parser = F.when(cues.holds_any(low, PARSER_TRANSIENT), "mineru_transient").otherwise("mineru_non_transient")
        chain = F.when(full == "", "unknown").when(F.contains(low, F.lit(PARSER)), parser)
    elif report == "ingest_error":
        exit_ = F.when(F.contains(full, F.lit("code 1")), "MinerU: exited with code 1").when(F.contains(low, F.lit("not found")), "MinerU: command not found")
        chain = F.when(F.contains(low, F.lit(PARSER)), exit_.otherwise("MinerU: runtime error"))
    elif report == "linkage_error":
        chain = F.when(F.contains(low, F.lit(PARSER)), F.when(F.contains(full, F.lit("code 1")), "MinerU: code 1").otherwise("MinerU: runtime error"))
    for words, name in table:
        value = F.concat(F.lit(name), F.substring(full, 1, 60)) if name.endswith(": ") else F.lit(name)
        chain = chain.when(cues.holds_any(low, words), value)
    return chain.otherwise(F.concat(F.lit("Other: "), F.substring(full, 1, rest)) if rest else F.lit("unknown"))


def is_transient(error: Column) -> Column:
    low = F.lower(text_or_empty(error))
    return ~cues.holds_any(low, PERMANENT) & cues.holds_any(low, TRANSIENT)


def warning_code(warning: Column) -> Column:
    return strip(F.substring_index(text_or_empty(warning), ":", 1))


def paper_class(elements: DataFrame) -> DataFrame:
    """``(paper_id, stratum)`` from layout elements, the most specific first."""
    text = strip(text_or_empty(F.col("text")))
    nonstandard = F.bool_or(cues.matches(text, cues.ALT_SECTION))
    answers = F.bool_or(F.contains(text, F.lit("参考答案")) | F.contains(text, F.lit("答案与解析")))
    placed = F.coalesce(F.size("bbox") == 4, F.lit(False)) & F.col("type").isin("text", "formula")
    spread = F.coalesce(F.stddev_pop(F.when(placed, (F.get("bbox", 0) + F.get("bbox", 2)) / 2)), F.lit(0.0))
    pictures = F.avg((F.col("type") == "image").cast("int"))
    name = F.when(nonstandard, "nonstandard_section").when(spread > 0.22, "two_column").when(pictures > 0.15, "figure_heavy").when((F.max("page") >= 10) | answers, "cross_page").otherwise("single_column")
    return elements.groupBy("paper_id").agg(name.alias("stratum"))
