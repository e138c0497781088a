"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.llm.shared import unused, words_of
from paperloom.scratch import stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
_SEED = 8
#: The rank's bits that are settled in one pass, and the passes over the rank and over its ties.
DIGIT_BITS, RANK_DIGITS, TIE_DIGITS = 16, 3, 2
_RANK_BITS = DIGIT_BITS * RANK_DIGITS
_ROW = {"source": "source", "size": "size", "u": "u", "tie": "tie"}


def _low_bits(number: Column) -> Column:
    return number.bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))


def _rows(docs: DataFrame, names: dict[str, str]) -> DataFrame:
    """``docs`` with each row's source, size in words (null text: 0), repeatable random number in (0, 1) and a
    number for ties, under ``names``."""
    noise = F.shiftrightunsigned(F.xxhash64(F.lit(_SEED), "doc_id", "text"), 11)
    return docs.withColumns({
        names["source"]: F.col("source").cast("string"),
        names["size"]: F.size(words_of(F.col("text"))).cast("long"),
        names["u"]: (noise.cast("double") + 0.5) / float(1 << 53),
        # Rows that agree in id and text are told apart by where they are written; which of them is taken can't be seen.
        names["tie"]: F.shiftleft(_low_bits(F.xxhash64(F.lit(_SEED + 1), "doc_id", "text")), DIGIT_BITS).bitwiseOR(_low_bits(F.xxhash64(F.monotonically_increasing_id()))),
    })


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST_COPIES) -> DataFrame:
    """``(source, source_size, target)`` for ``sizes(source, source_size)``, one row for each source.

    Sources in order of code points, null last, get the weights in turn and
    share ``share`` of all words. No target is above ``most`` times its source's
    size: the excess goes to the others by weight until none is above. The
    sources that stay below are those whose size by weight is above a common
    level, found over the sources in order of that ratio. Sources, not rows, meet in one task.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("w", weight).withColumn("cap", most * F.col("source_size").cast("double"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), "source")
    all_rows, before = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing), by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    full = F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    rest = F.sum("w").over(all_rows) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    # The level if this source and those after it were below; it rises with every source that is full.
    rows = rows.withColumn("level", (share * F.sum("source_size").over(all_rows) - full) / rest)
    level = F.first(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.col("level")), True).over(all_rows)
    return rows.withColumn("top", level).select("source", "source_size", F.coalesce(F.least("cap", F.col("top") * F.col("w")), F.col("cap")).alias("target"))


def _odds(rows: DataFrame, per_source: DataFrame, most: int) -> DataFrame:
    """``per_source(source, source_size, target)`` with ``whole``, ``rest`` and ``unit``.

    Every row is taken ``whole`` times; ``rest`` words are sampled, a row of s
    words with probability min(1, unit * s). ``unit`` makes the expected words
    ``rest``: rows longer than 1 / unit are certain, and are found over the
    distinct sizes of each source, largest first.
    """
    size = F.col("source_size")
    whole = F.when(size > 0, F.least(F.floor(F.col("target") / F.greatest(size, F.lit(1)) + 1e-12), F.lit(most))).otherwise(0).cast("int")
    goal = per_source.withColumn("whole", whole).withColumn("rest", F.greatest(F.col("target") - F.col("whole") * size, F.lit(0.0)))
    kinds = rows.where("size > 0").groupBy("source", "size").agg(F.count("*").alias("n"))
    kinds = kinds.join(goal.select(F.col("source").alias("gs"), "rest"), F.col("source").eqNullSafe(F.col("gs"))).drop("gs")
    down = Window.partitionBy("source").orderBy(F.desc("size"))
    n, s = F.col("n").cast("double"), F.col("size").cast("double")
    longer = F.coalesce(F.sum(n * s).over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    squares = F.sum(n * s * s).over(down.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    kinds = kinds.withColumn("unit", (F.col("rest") - longer) / squares).where(F.col("unit") * s <= 1)
    unit = kinds.groupBy("source").agg(F.max_by("unit", "size").alias("unit")).select(F.col("source").alias("us"), "unit")
    joined = goal.join(unit, F.col("source").eqNullSafe(F.col("us")), "left").drop("us")
    return joined.withColumn("unit", F.greatest(F.coalesce("unit", F.lit(0.0)), F.lit(0.0)))


def _rank(size: Column, u: Column, unit: Column) -> Column:
    """The Pareto ratio r = odds(u) / odds(inclusion) as r / (1 + r), in whole units: 0 for certain rows."""
    p = F.least(F.greatest(unit * size, F.lit(1e-15)), F.lit(1.0))
    t = u * (1 - p) / (u * (1 - p) + p * (1 - u))
    return F.least((t * float(1 << _RANK_BITS)).cast("long"), F.lit((1 << _RANK_BITS) - 1))


def _digit(at: int) -> Column:
    """The digit of a row's rank, or of its ties' number, that pass ``at`` settles."""
    key, left = ("rank", RANK_DIGITS - 1 - at) if at < RANK_DIGITS else ("tie", RANK_DIGITS + TIE_DIGITS - 1 - at)
    return _low_bits(F.shiftright(key, DIGIT_BITS * left))


def _cuts(ranked: DataFrame, plan: DataFrame) -> DataFrame:
    """``plan`` with ``cut_rank`` and ``cut_tie``: rows of lower (rank, tie) are sampled, others are not.

    In order of rank, a row is sampled if the words before it and half its own
    fit into ``rest``. The passes narrow down where the words reach ``rest``, a
    digit of the rank at a time, by a histogram of the words; the rows of the
    last cell are taken in order.
    """
    ranked = ranked.where("size > 0")
    state = stored(plan.select("source", "rest").withColumns({"before": F.lit(0).cast("long"), "path": F.array().cast("array<long>")}), "mix-state")
    def here(at: int) -> DataFrame:
        met = ranked.join(state.withColumnRenamed("source", "ss"), F.col("source").eqNullSafe(F.col("ss"))).drop("ss")
        return met.where(F.array(*[_digit(i) for i in range(at)]) == F.col("path")) if at else met

    passed = lambda words: (F.col("start") <= F.col("rest")) & (F.col("rest") < F.col("start") + F.col(words))
    carried = [F.first(c).alias(c) for c in ("rest", "before", "path")]
    for at in range(RANK_DIGITS + TIE_DIGITS):
        cells = here(at).groupBy("source", _digit(at).alias("d")).agg(F.sum("size").alias("words"), *carried)
        # The cell in which the words pass the rest; a source without one is taken whole. Groups of cells come first, so
        # that a window has no more rows of a source than a group has cells, or than there are groups.
        high = F.shiftright("d", DIGIT_BITS // 2)
        groups = cells.groupBy("source", high.alias("high")).agg(F.sum("words").alias("all"), *carried)
        up = Window.partitionBy("source").orderBy("high").rowsBetween(Window.unboundedPreceding, -1)
        group = groups.withColumn("start", F.col("before") + F.coalesce(F.sum("all").over(up), F.lit(0))).where(passed("all"))
        group = group.select(F.col("source").alias("gs"), F.col("high").alias("gh"), F.col("start").alias("first"))
        inner = cells.join(group, F.col("source").eqNullSafe(F.col("gs")) & (high == F.col("gh")))
        up = Window.partitionBy("source").orderBy("d").rowsBetween(Window.unboundedPreceding, -1)
        found = inner.withColumn("start", F.col("first") + F.coalesce(F.sum("words").over(up), F.lit(0))).where(passed("words"))
        state = stored(found.select("source", "rest", F.col("start").alias("before"), F.array_append("path", F.col("d")).alias("path")), "mix-state")
    order = Window.partitionBy("source").orderBy("rank", "tie", "size").rowsBetween(Window.unboundedPreceding, -1)
    last = here(RANK_DIGITS + TIE_DIGITS).withColumn("start", F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0)))
    last = last.groupBy("source").agg(F.min("rank").alias("cell_rank"), F.min("tie").alias("cell_tie"), F.count_if(F.col("start") + F.col("size") / 2 <= F.col("rest")).alias("more"))
    last = last.select(F.col("source").alias("ls"), "cell_rank", "cell_tie", "more")
    joined = plan.join(last, F.col("source").eqNullSafe(F.col("ls")), "left").drop("ls")
    # No more than one row of a cell can be the last to fit: a cell's rows agree in rank and tie.
    everything = F.lit(1 << _RANK_BITS)
    return joined.select(
        "*", F.when(F.col("rest") <= 0, -1).otherwise(F.coalesce("cell_rank", everything)).cast("long").alias("cut_rank"),
        F.coalesce("cell_tie", F.lit(0)).alias("cut_tie"), F.coalesce("more", F.lit(0)).alias("cut_more"),
    )


def _copied(placed: DataFrame, names: dict[str, str], copies: str, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """``placed`` (a written table) with ``source_size``, ``target`` and the number of ``copies`` under these names."""
    slim = placed.select(*[F.col(c).alias(k) for k, c in names.items() if k in _ROW])
    by_source = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = stored(_odds(slim, targets(by_source, weights, share, most), most), "mix-plan")
    told = plan.select(F.col("source").alias("ps"), "unit")
    ranked = slim.join(told, F.col("source").eqNullSafe(F.col("ps"))).select("source", "size", "tie", _rank(F.col("size"), F.col("u"), F.col("unit")).alias("rank"))
    cuts = stored(_cuts(ranked, plan), "mix-cuts")
    fields = F.struct("source_size", "target", "whole", "unit", "cut_rank", "cut_tie", "cut_more")
    joined = placed.join(cuts.select(F.col("source").alias(names["ps"]), fields.alias(names["plan"])), F.col(names["source"]).eqNullSafe(F.col(names["ps"]))).drop(names["ps"])
    p, size = F.col(names["plan"]), F.col(names["size"])
    rank = _rank(size, F.col(names["u"]), p["unit"])
    first = F.struct(rank, F.col(names["tie"])) < F.struct(p["cut_rank"], p["cut_tie"])
    at_cut = (rank == p["cut_rank"]) & (F.col(names["tie"]) == p["cut_tie"]) & (p["cut_more"] > 0)
    extra = (size > 0) & (first | at_cut)
    return joined.withColumn(copies, p["whole"] + F.when(extra & (p["whole"] < most), 1).otherwise(0))


def _names(columns: list[str]) -> dict[str, str]:
    return {k: unused(columns, f"mix_{k}") for k in (*_ROW, "ps", "plan", "copies")}


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """``(doc_id, size, source_size, target, taken, copies)`` of every row of ``docs(doc_id, text, source)``.

    Every document of a source is taken as many certain whole times as the
    source's target holds its size. What is left is sampled with unequal odds: a
    document's inclusion probability is its share of what is left by length
    (``unit`` times its words), so that longer ones are likelier and those that
    reach one are certain. Documents rank by the odds of a random number over
    the odds of their inclusion (Pareto order sampling), and the first ones in
    rank are taken once more. The sample's fixed size is in words, the unit of the targets:
    it ends where the next document would miss the target by more than stopping does.

    A source's words therefore miss its target by half of one document's size
    at most. A null source is a source. Null and wordless texts have size 0 and
    are taken with whole copies only. Repeated rows are counted one by one. Other
    columns are ignored; an empty table gives no rows; reruns agree.
    """
    names = _names([])
    slim = _rows(docs.select("doc_id", "text", "source"), names).select(F.col("doc_id").cast("long").alias("doc_id"), *[names[k] for k in _ROW])
    done = _copied(stored(slim, "mix-rows"), names, names["copies"], weights, share, most)
    size, n, p = F.col(names["size"]), F.col(names["copies"]), F.col(names["plan"])
    return done.select("doc_id", size.alias("size"), p["source_size"].alias("source_size"), p["target"].alias("target"), (n * size).cast("long").alias("taken"), n.cast("int").alias("copies"))


def materialize(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """``docs`` with every row as often as ``mix`` takes it, row by row: null and shared ids do not matter.

    Columns stay as they are, whatever their names; the rows are written once, with their numbers, and not moved otherwise.
    """
    names = _names(docs.columns)
    done = _copied(stored(_rows(docs, names), "mix-rows"), names, names["copies"], weights, share, most)
    n = names["copies"]
    return done.where(F.col(n) > 0).withColumn(n, F.explode(F.sequence(F.lit(1), F.col(n).cast("int")))).select(*docs.columns)
