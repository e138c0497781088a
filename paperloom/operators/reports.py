"""Roll-ups of runs, steps, questions, assets and comparisons, each one aggregate over all papers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.text import natural_key
from paperloom.operators.rules import warning_code


def ratio(a: Column, b: Column, digits: int = 4) -> Column:
    """a over b, rounded; 0 over nothing."""
    return F.round(F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0)), digits)


def histogram(values: DataFrame, column: str, name: str = "n", top: int | None = None) -> DataFrame:
    """Counts of a column's values, most frequent first, ties by value; ``top`` bounds the report."""
    found = values.groupBy(column).agg(F.count("*").alias(name))
    return found if top is None else found.orderBy(F.desc(name), column).limit(top)


def warning_histogram(warnings: DataFrame, column: str = "warning") -> DataFrame:
    return histogram(warnings.select(warning_code(F.col(column)).alias("code")), "code")


def step_timings(steps: DataFrame) -> DataFrame:
    """For each step: total, count, mean and greatest seconds, and the paper that took longest (the first of equals)."""
    took = steps.withColumn("s", F.timestamp_diff("MICROSECOND", "started_at", "finished_at") / 1e6).where("s is not null")
    longest = F.max_by("paper_id", F.struct(F.col("s"), (-F.col("ord")).alias("o")))
    return took.groupBy("step").agg(F.sum("s").alias("total_s"), F.count("*").alias("n"), F.avg("s").alias("avg_s"), F.max("s").alias("max_s"), longest.alias("slowest_paper"))


def run_status(steps: DataFrame, critical: tuple[str, ...], gates: DataFrame) -> DataFrame:
    """``(paper_id, status)``: failed for a failed critical step; partial for another failure or warning, or if
    every question failed; else completed."""
    bad = steps.groupBy("paper_id").agg(F.bool_or((F.col("status") == "failed") & F.col("step").isin(*critical)).alias("broke"), F.bool_or(F.col("status").isin("failed", "warning")).alias("odd"))
    counts = gates.groupBy("paper_id").agg(F.count_if(F.col("gate") == "failed").alias("failed"), F.count("*").alias("n"))
    joined = bad.join(counts, "paper_id", "left")
    none_left = F.coalesce((F.col("n") > 0) & (F.col("failed") == F.col("n")), F.lit(False))
    return joined.select("paper_id", F.when(F.col("broke"), "failed").when(F.col("odd") | none_left, "partial").otherwise("completed").alias("status"))


def batch_summary(results: DataFrame, wall_seconds: float) -> DataFrame:
    """One row of totals and rates over ``results(status, questions, passed, warned, failed_questions, pages)``."""
    count = lambda s: F.count_if(F.col("status") == s)
    total = F.count("*")
    out = results.agg(
        total.alias("papers"), count("completed").alias("completed"), count("partial").alias("partial"), count("failed").alias("failed"), count("crashed").alias("crashed"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("questions", "passed", "warned", "failed_questions", "pages")],
    )
    wall = F.lit(float(wall_seconds))
    return out.withColumns({
        "success_rate": ratio(F.col("completed") + F.col("partial"), F.col("papers")),
        "pass_rate": ratio(F.col("passed"), F.col("questions")),
        "warning_rate": ratio(F.col("warned"), F.col("questions")),
        "sec_per_paper": ratio(wall, F.col("papers"), 1),
        "sec_per_page": ratio(wall, F.col("pages"), 1),
        "sec_per_question": ratio(wall, F.col("questions"), 1),
    })


def structure_verdict(passed: Column, warned: Column, failed: Column, failed_papers: Column) -> Column:
    n = passed + warned + failed
    return F.when((n == 0) | (failed > 0) | (failed_papers > 0), "BLOCKED").when(F.try_divide(warned, n) > 0.3, "CONDITIONAL").otherwise("PASS")


def acceptance_gates(totals: DataFrame) -> DataFrame:
    """``totals`` with ten gates and ``accepted``. Counts: papers, completed, partial, failed, questions, warned,
    failed_questions, papers_with_assets, assets, links, unlinked, broken_links, crops, crops_failed, hashes."""
    c = F.col
    or_one = lambda a, b: F.when(b == 0, 1.0).otherwise(F.try_divide(a.cast("double"), b.cast("double")))
    share = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    gates = {
        "g_success": share(c("completed") + c("partial"), c("papers")) >= 0.9,
        "g_no_failed": c("failed") == 0,
        "g_no_failed_questions": c("failed_questions") == 0,
        "g_warnings": share(c("warned"), c("questions")) <= 0.1,
        "g_with_assets": share(c("papers_with_assets"), c("papers")) >= 0.5,
        "g_links": c("links") > 0,
        "g_unlinked": share(c("unlinked"), c("assets")) <= 0.1,
        "g_broken": c("broken_links") == 0,
        "g_crops": or_one(c("crops"), c("crops") + c("crops_failed")) >= 0.8,
        "g_hashes": or_one(c("hashes"), c("crops")) >= 0.8,
    }
    return totals.withColumns(gates).withColumn("accepted", F.forall(F.array(*[F.col(g) for g in gates]), lambda g: g))


def asset_metrics(assets: DataFrame, links: DataFrame, blocks: DataFrame) -> DataFrame:
    """For each paper: assets, links, unlinked visual assets (figures are not counted), weak and broken links."""
    a = assets.select(F.col("id").alias("raw_asset_id"), "paper_id", "asset_type")
    per = a.groupBy("paper_id").agg(F.count("*").alias("assets"))
    joined = links.join(a, "raw_asset_id")
    linked = joined.groupBy("paper_id").agg(F.count("*").alias("links"), F.count_if(F.col("confidence") < 0.8).alias("weak_links"))
    loose = a.where(F.col("asset_type").isin("image", "table", "chart")).join(links, "raw_asset_id", "left_anti").groupBy("paper_id").agg(F.count("*").alias("unlinked"))
    broken = joined.join(blocks.select(F.col("id").alias("question_id")), "question_id", "left_anti").groupBy("paper_id").agg(F.count("*").alias("broken_links"))
    out = per
    for more in (linked, loose, broken):
        out = out.join(more, "paper_id", "left")
    return out.na.fill(0)


def compared(old: DataFrame, new: DataFrame) -> DataFrame:
    """``(paper_id, old_count, new_count, both, only_old, only_new)`` of two sets of (paper_id, question_number); lists in natural order."""
    o = old.select("paper_id", "question_number").distinct().withColumn("o", F.lit(True))
    n = new.select("paper_id", "question_number").distinct().withColumn("n", F.lit(True))
    met = o.join(n, ["paper_id", "question_number"], "full").withColumn("k", F.struct(natural_key(F.col("question_number")).alias("k"), F.col("question_number").alias("q")))
    listed = lambda when: F.transform(F.array_sort(F.collect_list(F.when(when, F.col("k")))), lambda x: x["q"])
    return met.groupBy("paper_id").agg(
        F.count("o").alias("old_count"), F.count("n").alias("new_count"), F.count_if(F.col("o") & F.col("n")).alias("both"),
        listed(F.col("n").isNull()).alias("only_old"), listed(F.col("o").isNull()).alias("only_new"),
    )


def collisions(identities: DataFrame) -> DataFrame:
    """For each paper, blocks beyond the first of each text fingerprint."""
    rows = identities.where(F.length("text_fingerprint") > 0)
    per = rows.groupBy("paper_id", "text_fingerprint").agg(F.count("*").alias("n"))
    return per.groupBy("paper_id").agg(F.sum(F.col("n") - 1).alias("collisions"))


def strata_summary(papers: DataFrame) -> DataFrame:
    """Totals by stratum and over all, of ``papers(stratum, blocks, warnings)``."""
    return papers.rollup("stratum").agg(F.count("*").alias("papers"), F.sum("blocks").alias("blocks"), F.sum("warnings").alias("warnings"), F.grouping("stratum").cast("int").alias("overall"))


def shadow_gates(papers: DataFrame) -> DataFrame:
    """Whether a batch is large and varied enough, and how often section hierarchy was in doubt."""
    rate = F.try_divide(F.count_if(F.col("hierarchy_warnings") > 0).cast("double"), F.count("*").cast("double"))
    s = lambda name: F.count_if(F.col("stratum") == name)
    return papers.agg((F.coalesce(rate, F.lit(0.0)) <= 0.2).alias("g_hierarchy"), (F.count("*") >= 30).alias("g_papers"), (s("two_column") >= 8).alias("g_two_column"), (s("nonstandard_section") >= 5).alias("g_nonstandard"))


def group_summaries(groups: DataFrame, most: int = 50, papers: int = 3) -> DataFrame:
    """The largest candidate groups with their first papers; ``most`` is the report's length."""
    names = F.slice(F.array_sort(F.array_distinct(F.transform("items", lambda i: i["paper_id"]))), 1, papers)
    return groups.orderBy(F.desc("candidate_count"), "id").limit(most).select("id", "fingerprint_type", "candidate_count", "max_similarity", F.array_join(names, ", ").alias("papers"))


def groups_json(groups: DataFrame, scores: DataFrame) -> DataFrame:
    """``(id, value)``: each group with its items and the scores of its pairs, keyed ``i,j``, as JSON."""
    key = F.concat_ws(",", F.col("i").cast("string"), F.col("j").cast("string"))
    listed = scores.groupBy("fingerprint").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key.alias("k"), "score")))).alias("pairwise"))
    return groups.join(listed, "fingerprint", "left").select("id", F.to_json(F.struct("id", "fingerprint", "fingerprint_type", "status", "items", "pairwise")).alias("value"))


def markdown_table(rows: DataFrame, title: str, order: list[Column]) -> DataFrame:
    """A report's rows as one Markdown text ``value``; for summaries, whose length is bounded."""
    cells = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rows.columns]), F.lit(" |"))
    keyed = rows.select(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], cells.alias("line")).alias("r"))
    lines = F.transform(F.array_sort(F.collect_list("r")), lambda r: r["line"])
    head = [f"# {title}", "", "| " + " | ".join(rows.columns) + " |", "|" + " --- |" * len(rows.columns)]
    return keyed.agg(F.array_join(F.concat(F.array(*[F.lit(h) for h in head]), lines), "\n").alias("value"))


def error_summaries(steps: DataFrame, errors: DataFrame) -> DataFrame:
    """``(paper_id, summary)`` of each paper of ``steps(paper_id, ord, step, status, error)``: the non-blank
    ``errors(paper_id, ord, error)`` of its run, or else its failed steps with theirs; null if there are neither."""
    line = lambda when, text: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(when, F.struct("ord", text.alias("t"))))), lambda x: x["t"]), "; ")
    told = F.when(F.length("error") > 0, F.concat_ws(": ", "step", "error")).otherwise(F.col("step"))
    failed = steps.groupBy("paper_id").agg(line(F.col("status") == "failed", told).alias("failed"))
    own = errors.groupBy("paper_id").agg(line(F.length(F.trim("error")) > 0, F.col("error")).alias("own"))
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    return failed.join(own, "paper_id", "left").select("paper_id", F.coalesce(blank("own"), blank("failed")).alias("summary"))
