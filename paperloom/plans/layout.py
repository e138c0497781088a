"""The layout program: page elements of all papers to question blocks, as one plan of windows and joins.

A paper's elements fit one task; no step gathers more than a paper, and none pairs a paper's elements with its blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions import cues
from paperloom.functions.geometry import gap, overlap_share
from paperloom.functions.text import strip, text_or_empty
from paperloom.plans.best_blocks import best_two, first_meeting
from paperloom.scratch import stored

SPLIT_GAP = 0.18
WIDE_TEXT = 0.75
INDENT = 0.12
MARKER_GAP = 0.035
MOST_PAGES = 3
ASSIGN, REVIEW, CONFLICT = 0.62, 0.45, 0.12


@dataclass
class Layout:
    """Frames that the program makes; all have paper_id."""

    elements: DataFrame
    blocks: DataFrame
    warnings: DataFrame


def accepted(raw: DataFrame) -> DataFrame:
    """``raw(paper_id, ord, id, page, type, bbox, text, confidence)`` with ``reject``, the reason or null."""
    sound = F.coalesce(F.size("bbox") == 4, F.lit(False))
    reject = (
        F.when(F.col("id").isNull(), "missing id")
        .when(F.col("page").isNull() | (F.col("page") < 1), F.concat(F.col("id"), F.lit(" missing or invalid page")))
        .when(~F.coalesce(F.col("type").isin(*cues.ELEMENT_TYPES), F.lit(False)), F.concat(F.col("id"), F.lit(" invalid type "), F.coalesce(F.concat(F.lit("'"), F.col("type"), F.lit("'")), F.lit("None"))))
        .when(~sound, F.concat(F.col("id"), F.lit(" invalid bbox")))
        .when((F.get("bbox", 2) <= F.get("bbox", 0)) | (F.get("bbox", 3) <= F.get("bbox", 1)), F.concat(F.col("id"), F.lit(" invalid bbox dimensions")))
    )
    return raw.withColumn("reject", reject)


def prepared(raw: DataFrame) -> DataFrame:
    """Accepted elements with box sides and the noise and running-header flags."""
    sides = {s: F.get("bbox", i) for i, s in enumerate(("x1", "y1", "x2", "y2"))}
    rows = accepted(raw).where("reject is null").withColumns({**sides, "text": text_or_empty(F.col("text")), "confidence": F.coalesce("confidence", F.lit(1.0))}).drop("reject")
    rows = rows.withColumns({"norm": strip(F.col("text")), "x_center": (F.col("x1") + F.col("x2")) / 2})
    small = (F.col("y2") - F.col("y1") < 0.006) & (F.col("x2") - F.col("x1") < 0.01)
    rows = rows.withColumn("noise", small | (F.col("y2") < 0.04) | (F.col("y1") > 0.96))
    texty = ~F.col("noise") & F.col("type").isin("text", "formula") & (F.length("norm") > 0)
    pages = F.size(F.collect_set(F.when(texty, F.col("page"))).over(Window.partitionBy("paper_id", "norm")))
    edge = texty & (pages >= 3) & ((F.col("y2") < 0.08) | (F.col("y1") > 0.92))
    rows = rows.withColumn("edge", edge)
    return rows.withColumn("header", F.max("edge").over(Window.partitionBy("paper_id", "id"))).drop("edge")


def columns_of(rows: DataFrame) -> DataFrame:
    """``(paper_id, page, cols)``: each page's columns from left to right, as structs of x1 and x2."""
    live = rows.where("not noise and not header")
    fit = F.col("type").isin("text", "formula") & (F.col("x2") - F.col("x1") < WIDE_TEXT)
    across = Window.partitionBy("paper_id", "page").orderBy("x_center", "ord")
    text = live.where(fit).withColumn("new", F.coalesce((F.col("x_center") - F.lag("x_center").over(across) >= SPLIT_GAP).cast("int"), F.lit(0)))
    text = text.withColumn("idx", F.sum("new").over(across.rowsBetween(Window.unboundedPreceding, 0)))
    cols = text.groupBy("paper_id", "page", "idx").agg(F.min("x1").alias("x1"), F.max("x2").alias("x2"), F.count("*").alias("n"))
    pages = cols.groupBy("paper_id", "page").agg(F.array_sort(F.collect_list(F.struct("idx", "x1", "x2"))).alias("c"), F.sum("n").alias("n"))
    whole = F.array(F.struct(F.lit(0.0).alias("x1"), F.lit(1.0).alias("x2")))
    known = F.transform("c", lambda c: F.struct(c["x1"].alias("x1"), c["x2"].alias("x2")))
    every = live.select("paper_id", "page").distinct().join(pages, ["paper_id", "page"], "left")
    return every.select("paper_id", "page", F.when(F.coalesce("n", F.lit(0)) >= 2, known).otherwise(whole).alias("cols"))


def _best_column(x1: Column, x2: Column, cols: Column) -> Column:
    """(index, share) of the column that holds most of an interval, the first of equals."""
    shares = F.transform(cols, lambda c, i: F.struct(overlap_share(x1, x2, c["x1"], c["x2"]).alias("share"), (-i).alias("i")))
    return F.array_max(shares)


def ordered(rows: DataFrame) -> DataFrame:
    """Elements with their page's columns, their own column, and the reading order of all but noise."""
    rows = rows.join(columns_of(rows), ["paper_id", "page"], "left")
    best = F.when(F.col("noise") | F.col("cols").isNull(), F.lit(-1)).otherwise(-_best_column(F.col("x1"), F.col("x2"), F.col("cols"))["i"])
    rows = rows.withColumn("col", best.cast("int"))
    read = Window.partitionBy("paper_id", "noise").orderBy("page", F.greatest("col", F.lit(0)), "y1", "x1", "ord")
    return rows.withColumn("ro", F.when(~F.col("noise"), F.row_number().over(read) - 1))


def sections(rows: DataFrame) -> DataFrame:
    """Section flags and paths. State runs in input order: a section heading nests under the marker before it
    if that is a nonstandard one; other headings start anew."""
    live = ~F.col("noise") & ~F.col("header") & (F.length("norm") > 0)
    kind = F.when(live & cues.matches(F.col("norm"), cues.ANSWER_SECTION), "answer").when(live & cues.matches(F.col("norm"), cues.ALT_SECTION), "alt").when(live & cues.matches(F.col("norm"), cues.SECTION), "section")
    rows = rows.withColumn("kind", kind)
    so_far = Window.partitionBy("paper_id").orderBy("ord")
    last = F.when(F.col("kind") == "answer", F.lit(cues.ANSWER_PATH)).when(F.col("kind").isNotNull(), F.col("norm"))
    rows = rows.withColumn("before", F.last(last, True).over(so_far.rowsBetween(Window.unboundedPreceding, -1)))
    nests = (F.col("kind") == "section") & F.coalesce(cues.matches(F.col("before"), cues.SUBSECTION), F.lit(False))
    rows = rows.withColumn("root", F.last(F.when(F.col("kind").isNotNull() & ~nests, last), True).over(so_far.rowsBetween(Window.unboundedPreceding, 0)))
    path = F.when(F.col("kind").isin("alt", "section"), F.when(nests, F.array("root", "norm")).otherwise(F.array("norm")))
    return rows.withColumn("section_path", path).drop("before", "root")


def anchors(rows: DataFrame) -> DataFrame:
    """Elements with what decides whether they start a question: ``number`` (of an anchor) and ``note`` (a warning)."""
    paper = Window.partitionBy("paper_id")
    texty = F.col("type").isin("text", "formula")
    rows = rows.withColumn("answer_at", F.min(F.when((F.col("kind") == "answer"), F.col("ro"))).over(paper))
    lecture = F.regexp_extract("norm", cues.unicode(cues.LECTURE_NUMBER), 0)
    rows = rows.withColumn("lecture", F.when(~F.col("noise") & texty & (F.length(lecture) > 0), F.length(lecture)))
    rows = rows.withColumn("lecture_at", F.min(F.when(F.col("lecture").isNotNull(), F.col("ro"))).over(paper))
    read = Window.partitionBy("paper_id", "noise").orderBy("ro")
    rows = rows.withColumns({"next_page": F.lead("page").over(read), "next_y1": F.lead("y1").over(read)})
    option = texty & ~F.col("noise") & ~F.col("header") & cues.matches(F.col("norm"), cues.OPTION_LABEL)
    rows = rows.withColumn("option", option)
    open_ = texty & ~F.col("noise") & ~F.col("header") & F.col("kind").isNull() & ~F.col("option") & (F.length("norm") > 0)
    open_ &= F.col("answer_at").isNull() | (F.col("ro") < F.col("answer_at"))
    rows = rows.withColumn("open", open_)
    part = lambda p, g: F.regexp_extract("norm", cues.unicode(p), g)
    suffix = F.replace(F.replace(part(cues.LECTURE_NUMBER, 2), F.lit("－"), F.lit("-")), F.lit("—"), F.lit("-"))
    arabic, chinese = part(cues.ARABIC_NUMBER, 0), part(cues.CHINESE_NUMBER, 0)
    mark = F.when(F.col("lecture").isNotNull(), F.struct(F.concat(part(cues.LECTURE_NUMBER, 1), suffix).alias("q"), F.col("lecture").alias("end")))
    mark = mark.when(F.length(arabic) > 0, F.struct(part(cues.ARABIC_NUMBER, 1).alias("q"), F.length(arabic).alias("end")))
    mark = mark.when(F.length(chinese) > 0, F.struct(part(cues.CHINESE_NUMBER, 1).alias("q"), F.length(chinese).alias("end")))
    rows = rows.withColumn("mark", F.when(F.col("open"), mark))
    rest = F.expr("substring(norm, mark.end + 1)")
    in_column = (F.col("col") < 0) | (F.col("col") >= F.size("cols")) | (F.col("x1") <= F.get("cols", F.col("col"))["x1"] + INDENT)
    number_goes_on = F.col("lecture").isNull() & rest.rlike(r"^\p{Nd}")
    rows = rows.withColumn("rest", strip(rest)).withColumn("marked", F.col("mark").isNotNull() & in_column & ~number_goes_on)
    early = F.col("marked") & F.col("lecture").isNull() & F.coalesce(F.col("ro") < F.col("lecture_at"), F.lit(False))
    told = F.when(F.length("rest") > 0, F.col("rest")).otherwise(F.col("norm"))
    instructs = F.col("marked") & ~early & cues.is_instruction(F.col("text"), told)
    close = (F.col("next_page") == F.col("page")) & (F.col("next_y1") - F.col("y2") <= MARKER_GAP)
    is_anchor = F.col("marked") & ~early & ~instructs & ((F.length("rest") > 0) | F.coalesce(close, F.lit(False)))
    where = F.concat(F.col("mark.q"), F.lit(" at "), F.col("id"))
    note = F.when(early, F.concat(F.lit("knowledge_note_number_filtered: "), where, F.lit(" appears before first lecture example, not a question")))
    note = note.when(instructs, F.concat(F.lit("instruction_number_filtered: "), where, F.lit(" looks like instruction/preamble, not a real question")))
    rows = rows.withColumns({"number": F.when(is_anchor, F.col("mark.q")), "note": note})
    missing = F.col("open") & F.col("number").isNull() & cues.matches(F.col("norm"), cues.EMBEDDED_NUMBER)
    return rows.withColumn("missing", missing).drop("mark", "rest", "marked", "next_page", "next_y1", "lecture", "lecture_at", "open")


def _tuple_text(path: Column) -> Column:
    """A path as the warnings print it."""
    quoted = F.transform(path, lambda p: F.concat(F.lit("'"), p, F.lit("'")))
    return F.when(F.size(path) == 0, "()").when(F.size(path) == 1, F.concat(F.lit("("), quoted[0], F.lit(",)"))).otherwise(F.concat(F.lit("("), F.array_join(quoted, ", "), F.lit(")")))


def boundaries(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """One row for each anchor: its number in order, section, and how far its question may reach."""
    read = Window.partitionBy("paper_id").orderBy("ro")
    live = rows.where("not noise")
    title = F.struct(F.col("norm").alias("title"), F.col("section_path").alias("path"))
    live = live.withColumn("section", F.last(F.when(F.col("section_path").isNotNull(), title), True).over(read.rowsBetween(Window.unboundedPreceding, -1)))
    # From the end, as a frame that shrinks is summed anew for every row.
    after = Window.partitionBy("paper_id").orderBy(F.desc("ro")).rowsBetween(Window.unboundedPreceding, -1)
    live = live.withColumn("section_after", F.min(F.when(F.col("section_path").isNotNull() & ~F.col("header"), F.col("ro"))).over(after))
    found = live.where("number is not null").withColumn("index", F.row_number().over(read) - 1)
    same = Window.partitionBy("paper_id", "page", "col").orderBy("ro")
    found = found.withColumns({"next_same": F.lead("ro").over(same), "next_ro": F.lead("ro").over(read), "next_page": F.lead("page").over(read)})
    found = found.withColumns({
        "section_title": F.coalesce("section.title", F.lit("")),
        "path": F.coalesce("section.path", F.array().cast("array<string>")),
        "cross": F.col("next_same").isNull() & F.coalesce(F.col("next_page") > F.col("page"), F.lit(False)),
    })
    found = found.withColumn("long", F.col("cross") & (F.col("next_page") - F.col("page") + 1 > MOST_PAGES))
    found = found.withColumn("pages", F.when(F.col("cross") & ~F.col("long"), F.sequence("page", "next_page")).otherwise(F.array("page")))
    by_paper = pages.groupBy("paper_id").agg(F.map_from_entries(F.collect_list(F.struct("page", "cols"))).alias("by_page"))
    found = found.join(by_paper, "paper_id").withColumns({"eff": F.col("col"), "mismatch": F.array().cast("array<string>")})
    for step in range(1, MOST_PAGES):
        there = F.try_element_at("by_page", F.col("page") + step)
        own = F.get("cols", F.col("eff"))
        lost = F.array_contains("pages", F.col("page") + step) & there.isNotNull() & (F.col("eff") >= F.size(there)) & (F.col("eff") < F.size("cols"))
        best = _best_column(own["x1"], own["x2"], there)
        found = found.withColumn("best", F.when(F.coalesce(lost, F.lit(False)), best))
        told = F.concat(F.lit("cross_page_column_mismatch: question "), F.col("number"), F.lit(" column "), F.col("eff"), F.lit(" on page "), F.col("page"), F.lit(" has low overlap ("), F.format_string("%.3f", "best.share"), F.lit(") with best column on page "), F.col("page") + step)
        found = found.withColumn("mismatch", F.when(F.col("best.share") < 0.35, F.array_append("mismatch", told)).otherwise(F.col("mismatch")))
        found = found.withColumn("eff", F.coalesce((-F.col("best.i")).cast("int"), F.col("eff")))
    bound = F.least(F.coalesce("next_same", F.when(F.col("cross"), F.col("next_ro"))), F.col("answer_at"), F.col("section_after"))
    scope = Window.partitionBy("paper_id", "path", "number").orderBy("ro")
    return found.withColumns({"bound": bound, "again": F.row_number().over(scope) > 1})


def owned(bounds: DataFrame, rows: DataFrame) -> DataFrame:
    """``(paper_id, index, ro, id, x1, y1, x2, y2, cue)``: text and formulas that belong to each anchor.

    An anchor reaches at most to the next one of its column or, across pages, of the paper, and a page's column
    is read without a break: an element can only belong to the last anchor before it.
    """
    a = bounds.select("paper_id", "ro", F.struct("index", "bound", "cross", "pages", F.col("page").alias("a_page"), F.col("col").alias("a_col"), "eff").alias("a"))
    read = Window.partitionBy("paper_id").orderBy("ro")
    e = rows.where("not noise").select("paper_id", "ro", "id", "page", "col", "x1", "y1", "x2", "y2", "text", "type", "header", "kind").join(a, ["paper_id", "ro"], "left")
    e = e.withColumn("a", F.last("a", True).over(read.rowsBetween(Window.unboundedPreceding, 0))).where("a is not null and not header and kind is null")
    e = e.where(F.col("type").isin("text", "formula")).select("paper_id", "a.*", "ro", "id", "page", "col", "x1", "y1", "x2", "y2", "text", "type")
    reach = F.col("bound").isNull() | (F.col("ro") < F.col("bound"))
    home = F.col("page") == F.col("a_page")
    crossing = F.array_contains("pages", F.col("page")) & (home | (F.col("col") == F.col("eff")))
    place = F.when(F.col("cross"), crossing).otherwise(home & (F.col("col") == F.col("a_col")))
    return e.where(reach & place)


def assigned(blocks: DataFrame, rows: DataFrame) -> DataFrame:
    """Each asset's best block, its score and reasons, and the second-best score, from the two best blocks of its paper."""
    assets = rows.where(~F.col("noise") & F.col("type").isin(*cues.ASSET_TYPES)).select("paper_id", F.col("ord").alias("asset_ord"), F.col("id").alias("asset_id"), "page", "x1", "y1", "x2", "y2", "cols")
    shares = F.transform("cols", lambda c: overlap_share(F.col("x1"), F.col("x2"), c["x1"], c["x2"]))
    near_by = best_two(assets.withColumn("shares", shares), blocks)
    b = blocks.select("paper_id", "index", "pages", F.col("column_index").alias("bc"), "text_bbox", "question_number", "cue")
    pairs = assets.join(near_by, ["paper_id", "asset_ord"], "left").join(b, ["paper_id", "index"], "left")
    t1, t2 = F.get("text_bbox", 1), F.get("text_bbox", 3)
    up = lambda by: (F.greatest(F.lit(0.0), t1 - by), F.least(F.lit(1.0), t2 + by))
    same_page = F.array_contains("pages", F.col("page")).cast("double")
    vertical = overlap_share(F.col("y1"), F.col("y2"), *up(0.04))
    own = F.get("cols", F.col("bc"))
    in_column = F.when(F.col("bc") < F.coalesce(F.size("cols"), F.lit(0)), overlap_share(F.col("x1"), F.col("x2"), own["x1"], own["x2"])).otherwise(1.0)
    wide = (F.col("x2") - F.col("x1") > 0.55) & (overlap_share(F.col("y1"), F.col("y2"), *up(0.06)) > 0)
    column = F.when(wide, 1.0).otherwise(in_column)
    near = F.exp(-gap(F.col("y1"), F.col("y2"), t1, t2) / 0.08)
    cue = F.col("cue").cast("double")
    scored = pairs.withColumns({"sp": same_page, "ve": vertical, "co": column, "ne": near, "wide": wide, "cu": cue})
    score = 0.35 * F.col("sp") + 0.25 * F.col("ve") + 0.20 * F.col("co") + 0.15 * F.col("ne") + 0.05 * F.col("cu")
    reasons = F.array_compact(F.array(
        F.when(F.col("sp") > 0, "same_page"), F.when(F.col("ve") > 0, "vertical_near"), F.when(F.col("wide"), "cross_column"),
        F.when(F.col("co") >= 0.5, "same_column").when(F.col("co") > 0, "partial_column"), F.when(F.col("ne") > 0.5, "proximity"), F.when(F.col("cu") > 0, "visual_cue"),
    ))
    scored = scored.withColumns({"score": score, "reasons": reasons})
    order = Window.partitionBy("paper_id", "asset_ord").orderBy(F.desc("score"), "index")
    best = scored.withColumns({"rank": F.row_number().over(order), "second": F.lead("score").over(order)})
    return best.where("rank = 1").select("paper_id", "asset_ord", "asset_id", "index", "question_number", "score", "second", "reasons", "x1", "y1", "x2", "y2")


def _asset_warnings(best: DataFrame) -> DataFrame:
    number = lambda c: F.format_string("%.3f", c)
    none = F.col("index").isNull()
    clash = F.when(~none & (F.col("score") - F.col("second") < CONFLICT), F.concat(F.lit("asset_assignment_conflict: "), F.col("asset_id"), F.lit(" top scores "), number("score"), F.lit(" vs "), number("second"), F.lit(" gap < 0.12")))
    weak = F.when(none, F.concat(F.lit("unassigned_visual_asset: "), F.col("asset_id"), F.lit(" could not be assigned to any question")))
    weak = weak.when(F.col("score") < REVIEW, F.concat(F.lit("unassigned_visual_asset: "), F.col("asset_id"), F.lit(" best score "), number("score"), F.lit(" < 0.45")))
    weak = weak.when(F.col("score") < ASSIGN, F.concat(F.lit("low_confidence_asset_assignment: "), F.col("asset_id"), F.lit(" to question "), F.col("question_number"), F.lit(" score="), number("score")))
    both = F.array_compact(F.array(clash, weak))
    return best.select("paper_id", F.lit(7).alias("phase"), F.col("asset_ord").cast("long").alias("seq"), F.posexplode(both).alias("sub", "warning"))


def _drift_warnings(rows: DataFrame, own: DataFrame, blocks: DataFrame) -> DataFrame:
    """Formulas that no block owns, and unowned text beside a block in another column."""
    ids = own.select("paper_id", "id").distinct()
    free = rows.where("not noise and not header and kind is null").join(ids, ["paper_id", "id"], "left_anti")
    orphan = free.where("type = 'formula'").select("paper_id", F.lit(5).alias("phase"), F.col("ro").cast("long").alias("seq"), F.lit(0).alias("sub"), F.concat(F.lit("orphan_formula: "), F.col("id"), F.lit(" not owned by any question block")).alias("warning"))
    text = free.where("type = 'text'").select("paper_id", "ro", "id", "page", "col", "y1", "y2")
    sides = blocks.select("paper_id", F.explode("pages").alias("page"), "column_index").groupBy("paper_id", "page").agg(F.min("column_index").alias("low"), F.max("column_index").alias("high"))
    text = text.join(sides, ["paper_id", "page"]).where((F.col("col") != F.col("low")) | (F.col("col") != F.col("high"))).drop("low", "high")
    b = blocks.select("paper_id", "index", F.col("column_index").alias("bc"), "question_number")
    first = text.join(first_meeting(text, blocks), ["paper_id", "ro"]).join(b, ["paper_id", "index"]).select("paper_id", "ro", F.struct("id", "page", "question_number", "col", "bc").alias("b"))
    told = F.concat(F.lit("cross_column_question: "), F.col("b.id"), F.lit(" on page "), F.col("b.page"), F.lit(" overlaps question "), F.col("b.question_number"), F.lit(" y-range but is in column "), F.col("b.col"), F.lit(" (question column "), F.col("b.bc"), F.lit(")"))
    return orphan.unionByName(first.select("paper_id", F.lit(5).alias("phase"), F.col("ro").cast("long").alias("seq"), F.lit(0).alias("sub"), told.alias("warning")))


def _hierarchy_warnings(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """Numbers that three or more blocks share without sections to tell them apart."""
    odd = rows.where(F.col("section_path").isNotNull() & ~cues.matches(F.col("norm"), cues.SECTION) & cues.matches(F.col("norm"), cues.SUBSECTION)).select("paper_id").distinct()
    numbers = blocks.join(odd, "paper_id", "left_semi").groupBy("paper_id", "question_number").agg(F.count("*").alias("n"), F.collect_set("section_path").alias("paths"))
    numbers = numbers.where((F.col("n") >= 3) & (F.size("paths") != F.col("n")))
    value = F.when(F.col("question_number").rlike(r"^\p{Nd}+$"), F.expr("try_cast(question_number as bigint)")).otherwise(0)
    papers = numbers.groupBy("paper_id").agg(F.array_sort(F.collect_list(F.struct(value.alias("v"), F.col("question_number").alias("q")))).alias("q"), F.size(F.array_distinct(F.flatten(F.collect_list("paths")))).alias("n_paths"))
    shown = F.array_join(F.transform(F.slice("q", 1, 10), lambda x: x["q"]), ", ")
    told = F.concat(F.lit("section_hierarchy_suspected: "), F.size("q"), F.lit(" question numbers appear >= 3 times across "), F.col("n_paths"), F.lit(" unresolved section paths (numbers: "), shown, F.when(F.size("q") > 10, "...").otherwise(""), F.lit(")"))
    return papers.select("paper_id", F.lit(6).alias("phase"), F.lit(0).cast("long").alias("seq"), F.lit(0).alias("sub"), told.alias("warning"))


def _block_warnings(bounds: DataFrame, count: DataFrame) -> DataFrame:
    b = bounds.join(count, ["paper_id", "index"], "left")
    again = F.when(F.col("again"), F.concat(F.lit("duplicate_question_number: "), F.col("number"), F.lit(" appears at anchor "), F.col("id"), F.lit(" in section_path "), _tuple_text(F.col("path"))))
    far = F.when(F.col("long"), F.concat(F.lit("question_spans_too_many_pages: question "), F.col("number"), F.lit(f" exceeds {MOST_PAGES} pages")))
    empty = F.when(F.col("n").isNull(), F.concat(F.lit("question_without_text: question "), F.col("number"), F.lit(" has no owned text elements")))
    both = F.concat(F.array_compact(F.array(again, far)), F.col("mismatch"), F.array_compact(F.array(empty)))
    return b.select("paper_id", F.lit(4).alias("phase"), F.col("index").cast("long").alias("seq"), F.posexplode(both).alias("sub", "warning"))


def attached(warnings: DataFrame, blocks: DataFrame) -> DataFrame:
    """``(paper_id, index, warnings)``: each warning with the first block whose number its text holds, or the first of all.

    A paper has few distinct numbers (999 in Arabic digits), of which the first block counts.
    """
    numbers = blocks.where(F.length("question_number") > 0).groupBy("paper_id", "question_number").agg(F.min("index").alias("index"))
    numbers = numbers.groupBy("paper_id").agg(F.array_sort(F.collect_list(F.struct("index", "question_number"))).alias("numbers"))
    first = F.get(F.filter("numbers", lambda n: F.contains(F.col("warning"), n["question_number"])), 0)["index"]
    placed = warnings.join(numbers, "paper_id", "left").withColumn("at", first)
    placed = placed.select("paper_id", F.coalesce("at", F.lit(0)).alias("index"), F.struct(F.col("at").isNull().alias("late"), "phase", "seq", "sub", "warning").alias("w"))
    return placed.groupBy("paper_id", "index").agg(F.transform(F.array_sort(F.collect_list("w")), lambda w: w["warning"]).alias("warnings"))


def layout(raw: DataFrame) -> Layout:
    """Run the program over ``raw(paper_id, ord, id, page, type, bbox, text, confidence)``.

    Elements, anchors, ownership and assignments are each read several times
    and so are written once.
    """
    rows = stored(anchors(sections(ordered(prepared(raw)))), "layout-elements")
    pages = rows.where("cols is not null").groupBy("paper_id", "page").agg(F.first("cols").alias("cols"))
    bounds = stored(boundaries(rows, pages).drop("by_page"), "layout-anchors")
    own = stored(owned(bounds, rows), "layout-owned")
    item = F.struct("ro", "id")
    cue = F.max(F.coalesce(cues.matches(F.col("text"), cues.VISUAL_CUE), F.lit(False)))
    held = own.groupBy("paper_id", "index").agg(
        F.transform(F.array_sort(F.collect_list(item)), lambda x: x["id"]).alias("element_ids"), F.array(F.min("x1"), F.min("y1"), F.max("x2"), F.max("y2")).alias("box"), cue.alias("cue"), F.count("*").alias("n")
    )
    plain = F.regexp_replace("number", "[^A-Za-z0-9]", "")
    name = F.concat(F.col("paper_id"), F.lit("_qb_"), F.when(F.length(plain) > 0, plain).otherwise(F.format_string("%04d", F.col("index") + 1)))
    blocks = bounds.join(held, ["paper_id", "index"], "left").select(
        "paper_id", "index", name.alias("question_block_id"), F.col("number").alias("question_number"), "section_title", F.col("path").alias("section_path"), "pages",
        F.greatest("eff", F.lit(0)).alias("column_index"), F.coalesce("box", F.array("x1", "y1", "x2", "y2")).alias("text_bbox"),
        F.coalesce("element_ids", F.array().cast("array<string>")).alias("element_ids"), F.coalesce("cue", F.lit(False)).alias("cue"),
    )
    blocks = stored(blocks, "layout-blocks")
    best = stored(assigned(blocks, rows), "layout-assets")
    told = lambda df, phase, seq, text: df.select("paper_id", F.lit(phase).alias("phase"), F.col(seq).cast("long").alias("seq"), F.lit(0).alias("sub"), text.alias("warning"))
    refused = accepted(raw).where("reject is not null")
    warnings = told(refused, 1, "ord", F.concat(F.lit("invalid_layout_element: "), F.col("reject")))
    warnings = warnings.unionByName(told(rows.where("note is not null"), 2, "ro", F.col("note")))
    warnings = warnings.unionByName(told(rows.where("missing"), 3, "ro", F.concat(F.lit("missing_anchor_suspected: "), F.col("id"), F.lit(" contains embedded question number"))))
    for more in (_block_warnings(bounds, held.select("paper_id", "index", "n")), _drift_warnings(rows, own, blocks), _hierarchy_warnings(rows, blocks), _asset_warnings(best)):
        warnings = warnings.unionByName(more)
    warnings = stored(warnings, "layout-warnings")
    sure = best.where((F.col("score") >= REVIEW) & F.col("index").isNotNull())
    entry = F.struct("asset_ord", "asset_id", F.round("score", 4).alias("score"), "reasons", (F.col("score") < ASSIGN).alias("needs_review"))
    taken = sure.groupBy("paper_id", "index").agg(
        F.transform(F.array_sort(F.collect_list(entry)), lambda a: F.struct(a["asset_id"].alias("asset_id"), a["score"].alias("score"), a["reasons"].alias("reasons"), a["needs_review"].alias("needs_review"))).alias("assets"),
        F.array(F.min("x1"), F.min("y1"), F.max("x2"), F.max("y2")).alias("asset_box"),
    )
    t, a = (lambda i: F.get("text_bbox", i)), (lambda i: F.get("asset_box", i))
    around = F.array(F.least(t(0), a(0)), F.least(t(1), a(1)), F.greatest(t(2), a(2)), F.greatest(t(3), a(3)))
    kind = "array<struct<asset_id:string,score:double,reasons:array<string>,needs_review:boolean>>"
    done = blocks.join(taken, ["paper_id", "index"], "left").join(attached(warnings, blocks), ["paper_id", "index"], "left")
    done = done.select(
        "paper_id", F.col("index").alias("block_index"), "question_block_id", "question_number", "section_title", "section_path", "pages", "column_index", "text_bbox",
        around.alias("question_bbox"), "element_ids", F.coalesce(F.col("assets").cast(kind), F.array().cast(kind)).alias("assets"), F.coalesce("warnings", F.array().cast("array<string>")).alias("warnings"),
    )
    coded = warnings.withColumn("code", F.substring_index("warning", ":", 1))
    return Layout(elements=rows, blocks=done, warnings=coded)
