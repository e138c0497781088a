"""Exported questions and reports: nested JSON and Markdown out, and both back in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paperloom.functions.text import first_heading, is_blank, safe_file_name, strip, text_or_empty
from paperloom.sources.layout_json import files

#: Kinds of questions that get room for an answer.
ROOM = ("short_answer", "proof", "fill_blank")
NO_ANSWER = "（暂无答案）"


def _listed(item: Column, order: str = "ord") -> Column:
    return F.transform(F.array_sort(F.collect_list(F.struct(order, item.alias("x")))), lambda r: r["x"])


def paper_json(questions: DataFrame) -> DataFrame:
    """``(paper_id, value)``: each paper's questions as one JSON text, in order."""
    fields = [c for c in questions.columns if c not in ("paper_id", "ord")]
    gathered = questions.groupBy("paper_id").agg(F.count("*").alias("question_count"), _listed(F.struct(*fields)).alias("questions"))
    return gathered.select("paper_id", F.to_json(F.struct("paper_id", "question_count", "questions")).alias("value"))


def _question_text(with_room: bool) -> Column:
    choices = F.transform(F.coalesce("choices", F.array()), lambda c: F.concat(c["label"], F.lit(". "), c["content_latex"]))
    room = F.when(F.col("question_type").isin(*ROOM), F.lit("\n\n\n")).otherwise("") if with_room else F.lit("")
    head = F.concat(F.col("n").cast("string"), F.lit(". "), strip(text_or_empty(F.col("stem_latex"))))
    return F.concat(F.array_join(F.concat(F.array(head), choices), "\n"), room)


def paper_markdown(questions: DataFrame, title: Column) -> DataFrame:
    """``(paper_id, file_name, paper, answers)``: the paper and its answers as Markdown, questions by ``n``."""
    answer = F.coalesce(F.when(~is_blank(F.col("answer_latex")), strip(F.col("answer_latex"))), F.lit(NO_ANSWER))
    rows = questions.withColumns({"q": _question_text(True), "a": F.concat(F.col("n").cast("string"), F.lit(". "), answer), "title": title})
    made = rows.groupBy("paper_id").agg(F.first("title").alias("title"), _listed(F.col("q"), "n").alias("q"), _listed(F.col("a"), "n").alias("a"))
    text = lambda parts, suffix: F.concat(F.lit("# "), F.col("title"), F.lit(suffix + "\n\n"), F.array_join(parts, "\n\n"), F.lit("\n"))
    return made.select("paper_id", safe_file_name(F.col("title")).alias("file_name"), text("q", "").alias("paper"), text("a", " 答案").alias("answers"))


def write_json(questions: DataFrame, path: str) -> None:
    """One JSON text for each paper, in one folder for each."""
    paper_json(questions).write.partitionBy("paper_id").text(path)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Questions of exported JSON with their file; those with a blank stem are dropped."""
    found = files(spark, path, "*").select("path", F.from_json("text", f"paper_id string, questions array<struct<{schema}>>").alias("p"))
    rows = found.select(F.col("path").alias("source"), "p.paper_id", F.explode("p.questions").alias("q")).select("source", "paper_id", "q.*")
    return rows.where(~is_blank(F.col("stem_latex")))


def recent_reports(spark: SparkSession, path: str, limit: int = 20) -> DataFrame:
    """The newest Markdown reports with their first headings."""
    found = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md").text(path, wholetext=True)
    return found.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("modified"), first_heading(F.col("value")).alias("title")).orderBy(F.desc("modified"), "path").limit(limit)


MANIFEST = "paper_id string, pdf_path string, status string, started_at string, finished_at string, attempts int, last_error string, run_report_path string"


def manifest(paths: DataFrame, prefix: str) -> DataFrame:
    """A pending entry for each file, numbered from one in order of paths. Files of a batch, not rows, meet in one task."""
    n = F.row_number().over(Window.orderBy("path"))
    none = F.lit(None).cast("string")
    return paths.select(
        F.format_string(f"{prefix}_%04d", n).alias("paper_id"), F.col("path").alias("pdf_path"), F.lit("pending").alias("status"), none.alias("started_at"), none.alias("finished_at"),
        F.lit(0).alias("attempts"), none.alias("last_error"), none.alias("run_report_path"),
    )


def save_manifest(entries: DataFrame, path: str) -> None:
    """A batch's entries as JSON lines."""
    entries.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def load_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The entries of a saved manifest; lines that are no entries are left out."""
    read = spark.read.schema(MANIFEST).option("mode", "PERMISSIVE").json(path)
    return read.where("paper_id is not null")


def to_run(entries: DataFrame) -> DataFrame:
    """Entries that a resumed batch runs: all but completed and partial ones."""
    return entries.where(~F.col("status").isin("completed", "partial"))
