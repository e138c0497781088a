"""Segmentation of Markdown: sections, question blocks, answer entries, choices.

Texts become lines, lines segments by running counts, segments rows again; one
document's lines fit one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions import cues
from paperloom.functions.text import lines, strip


def stripped_lines(docs: DataFrame, key: str = "paper_id", text: str = "markdown") -> DataFrame:
    """``(key, n, line)``: the non-blank lines of each text, stripped, in order."""
    cut = docs.select(key, F.posexplode(F.transform(lines(F.col(text)), strip)).alias("n", "line"))
    return cut.where(F.length("line") > 0)


def _order(key: str, *more: str) -> Window:
    return Window.partitionBy(key, *more).orderBy("n").rowsBetween(Window.unboundedPreceding, 0)


def _joined(rows: str = "l") -> Column:
    """The lines gathered as structs (n, text) in order, as one stripped text."""
    kept = F.transform(F.array_sort(F.col(rows)), lambda x: x["t"])
    return strip(F.array_join(kept, "\n"))


def document_sections(docs: DataFrame, key: str = "paper_id", text: str = "markdown") -> DataFrame:
    """``(key, body, answers)``: lines before the first answer heading and lines after it, without headings."""
    rows = stripped_lines(docs, key, text).withColumn("head", cues.matches(F.col("line"), cues.ANSWER_SECTION))
    rows = rows.withColumn("late", F.max("head").over(_order(key)))
    item = F.struct("n", F.col("line").alias("t"))
    parts = rows.where("not head").groupBy(key).agg(F.collect_list(F.when(~F.col("late"), item)).alias("b"), F.collect_list(F.when(F.col("late"), item)).alias("a"))
    parts = parts.select(key, _joined("b").alias("body"), _joined("a").alias("answers"))
    none = F.lit("")
    return docs.select(key).distinct().join(parts, key, "left").select(key, F.coalesce("body", none).alias("body"), F.coalesce("answers", none).alias("answers"))


def question_blocks(docs: DataFrame, key: str = "paper_id", text: str = "markdown") -> DataFrame:
    """``(key, block_index, id, question_number, section_title, raw_markdown)``: the numbered items of each body.

    A section heading ends an item; lines outside items are dropped.
    """
    rows = stripped_lines(docs, key, text).withColumn("head", cues.matches(F.col("line"), cues.ANSWER_SECTION))
    rows = rows.withColumn("late", F.max("head").over(_order(key))).where("not late")
    section = cues.matches(F.col("line"), cues.TEXT_SECTION)
    number = F.regexp_extract("line", cues.unicode(cues.LINE_NUMBER), 1)
    rows = rows.withColumns({"section": section, "q": F.when(~section & (F.length(number) > 0), number)})
    rows = rows.withColumns({
        "section_title": F.coalesce(F.last(F.when(F.col("section"), F.col("line")), True).over(_order(key)), F.lit("")),
        "piece": F.sum((F.col("section") | F.col("q").isNotNull()).cast("int")).over(_order(key)),
    })
    gathered = rows.where("not section").groupBy(key, "piece").agg(F.max("q").alias("question_number"), F.max("section_title").alias("section_title"), F.collect_list(F.struct("n", F.col("line").alias("t"))).alias("l"))
    found = gathered.where("question_number is not null")
    index = F.row_number().over(Window.partitionBy(key).orderBy("piece"))
    found = found.withColumn("block_index", index)
    return found.select(key, "block_index", F.format_string("%s_qb_%04d", F.col(key).cast("string"), "block_index").alias("id"), "question_number", "section_title", _joined().alias("raw_markdown"))


def answer_entries(docs: DataFrame, key: str = "paper_id", text: str = "markdown") -> DataFrame:
    """``(key, question_number, entry)``: text after each number; a number's last entry counts, blank ones are dropped."""
    rows = stripped_lines(docs, key, text).where(~cues.matches(F.col("line"), cues.ANSWER_SECTION))
    number = F.regexp_extract("line", cues.unicode(cues.LINE_NUMBER), 1)
    rows = rows.withColumn("q", F.when(F.length(number) > 0, number))
    rows = rows.withColumn("piece", F.sum(F.col("q").isNotNull().cast("int")).over(_order(key))).where("piece > 0")
    rest = strip(F.regexp_extract("line", cues.unicode(cues.LINE_NUMBER), 2))
    shown = F.when(F.col("q").isNull(), F.col("line")).when(F.length(rest) > 0, rest)
    pieces = rows.withColumn("t", shown).groupBy(key, "piece").agg(F.max("q").alias("question_number"), F.collect_list(F.when(F.col("t").isNotNull(), F.struct("n", "t"))).alias("l"))
    last = Window.partitionBy(key, "question_number").orderBy(F.desc("piece"))
    kept = pieces.withColumn("r", F.row_number().over(last)).where("r = 1").select(key, "question_number", _joined().alias("entry"))
    return kept.where(F.length("entry") > 0)


def answer_parts(entry: Column) -> Column:
    """struct(answer, analysis) of an entry, by its labels; text without a label is the answer."""
    text = strip(entry)
    # The labels of answers and analyses, and the group that holds each.
    forms = (
        (r"(?Us)^(?:答案|答)[:：]\s*(.*?)\s*(?:解析|详解|解法)[:：]\s*(.*)$", 1, 2),
        (r"(?Us)^(?:解析|详解|解法|解)[:：]\s*(.*?)\s*(?:答案|答)[:：]\s*(.*)$", 2, 1),
        (r"(?Us)^(?:答案|答)[:：]\s*(.*)$", 1, 0),
        (r"(?Us)^(?:解析|详解|解法|解)[:：]\s*(.*)$", 0, 1),
    )
    get = lambda pattern, group: strip(F.regexp_extract(text, pattern, group)) if group else F.lit("")
    pair = lambda a, b: F.struct(a.alias("answer"), b.alias("analysis"))
    chain = None
    for pattern, a, b in forms:
        made = pair(get(pattern, a), get(pattern, b))
        chain = F.when(text.rlike(pattern), made) if chain is None else chain.when(text.rlike(pattern), made)
    return chain.otherwise(pair(text, F.lit("")))


def choices(blocks: DataFrame, keys: tuple[str, ...] = ("paper_id", "block_index"), text: str = "raw_markdown") -> DataFrame:
    """``(keys, label, content_latex, sort_order)``: labelled options of each block; empty ones are dropped."""
    cut = blocks.select(*keys, F.posexplode(F.transform(lines(F.col(text)), strip)).alias("n", "line")).where(F.length("line") > 0)
    label = F.regexp_extract("line", cues.unicode(cues.CHOICE_LINE), 1)
    rest = strip(F.regexp_extract("line", cues.unicode(cues.CHOICE_LINE), 2))
    so_far = Window.partitionBy(*keys).orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    cut = cut.withColumn("label", F.when(F.length(label) > 0, label))
    cut = cut.withColumn("piece", F.sum(F.col("label").isNotNull().cast("int")).over(so_far)).where("piece > 0")
    shown = F.when(F.col("label").isNull(), F.col("line")).when(F.length(rest) > 0, rest)
    found = cut.withColumn("t", shown).groupBy(*keys, "piece").agg(F.max("label").alias("label"), F.collect_list(F.when(F.col("t").isNotNull(), F.struct("n", "t"))).alias("l"))
    found = found.select(*keys, "piece", "label", _joined().alias("content_latex")).where(F.length("content_latex") > 0)
    order = Window.partitionBy(*keys).orderBy("piece")
    return found.select(*keys, "label", "content_latex", F.row_number().over(order).alias("sort_order"))


def filled(questions: DataFrame, entries: DataFrame) -> DataFrame:
    """``questions(paper_id, question_number, answer_latex, analysis_latex, ...)`` with empty answers and
    analyses taken from ``entries`` of the same number."""
    parts = entries.withColumn("p", answer_parts(F.col("entry"))).select("paper_id", "question_number", "p")
    joined = questions.join(parts, ["paper_id", "question_number"], "left")
    take = lambda own, other: F.coalesce(F.nullif(own, F.lit("")), other, F.lit(""))
    return joined.withColumns({"answer_latex": take(F.col("answer_latex"), F.col("p.answer")), "analysis_latex": take(F.col("analysis_latex"), F.col("p.analysis"))}).drop("p")
