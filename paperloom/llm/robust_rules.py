"""Quality rules: robust multivariate outliers by the minimum covariance determinant.

Everything is DataFrame functions. Each text is read once for its statistics;
the estimates are refined over the small written table of these.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.shared import let, words_of
from paperloom.scratch import stored

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
#: Share of a group's documents that the estimates rest on.
CORE = 0.75
#: Concentration steps. Each lowers the determinant; few are needed from a robust start.
STEPS = 6
#: Spread that each feature has at least, in the order of FEATURES: constant ones stay usable, and
#: repeated lines and passages, which good texts have too, weigh little beside the base rule on them.
FLOORS = (0.05, 0.035, 0.14, 0.14, 0.05)
#: Squared distances up to this are inliers: the chi-square quantile of 1 - 1e-6 for five degrees of freedom.
CUTOFF = 35.9
#: Ratio of the covariance of a normal distribution to that of its nearest CORE share, five dimensions.
CONSISTENCY = 1.76
#: Documents that a language and source need for estimates of their own.
LEAST_GROUP = 100
FEATURES = ("f_length", "f_symbols", "f_lines", "f_repeats", "f_upper")


def _windows(words: Column) -> Column:
    """Hashes of all three-word windows of an array of words."""
    last = F.size(words) - 2
    one = lambda i: F.xxhash64(F.get(words, i - 1), F.get(words, i), F.get(words, i + 1))
    return F.when(last >= 1, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), one)).otherwise(F.array().cast("array<bigint>"))


def _repeated(words: Column) -> Column:
    """Number of words inside three-word windows that are found more than once.

    Windows are compared by 64-bit hash: sorted with their places, equal
    neighbours are repeats, and the words at the places they cover are counted.
    """

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            twice = F.filter(s, lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)))
            return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.sequence(x["i"], x["i"] + 2)))))

        return let(placed, places)

    return let(_windows(words), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h)))


def statistics(docs: DataFrame) -> DataFrame:
    """``(doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper)`` of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    plain = text
    for c in SYMBOLS:
        plain = F.replace(plain, F.lit(c), F.lit(""))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), text.alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.btrim(x, F.lit(" \t\n\x0b\f\r"))) > 0)

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"), _repeated(w).cast("long").alias("n_repeat_words"))

    of_lines = let(lines, lambda x: F.struct((F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"), F.size(x).cast("long").alias("n_lines")))
    upper = F.octet_length("text") - F.octet_length(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    symbols = (F.octet_length("text") - F.octet_length(plain)).cast("long")
    found = slim.select("doc_id", "lang", "source", let(words_of(F.col("text")), of_words).alias("w"), symbols.alias("n_symbols"), of_lines.alias("l"), upper.cast("long").alias("n_upper"))
    return found.select("doc_id", "lang", "source", "w.n_words", "w.word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "l.n_lines", "n_upper")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def transformed(stats: DataFrame) -> DataFrame:
    """``stats`` with the feature vector, each on a scale where ordinary texts are near normal."""
    share = lambda a, b: F.sqrt(F.col(a) / F.greatest(F.col(b), F.lit(1)))
    return stats.select(
        "*",
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))).alias("f_length"),
        share("n_symbols", "word_chars").alias("f_symbols"),
        share("n_dup_lines", "n_lines").alias("f_lines"),
        share("n_repeat_words", "n_words").alias("f_repeats"),
        share("n_upper", "word_chars").alias("f_upper"),
    )


def _whitened(moments: DataFrame, p: int) -> DataFrame:
    """``(g, m_i, w_i_j)``: means, and the inverse of the covariances' Cholesky factor, for each group.

    Each row of the factor and of its inverse is a projection over those before it.
    """
    low = lambda i, j: F.col(f"l_{i}_{j}")
    inv = lambda i, j: F.col(f"w_{i}_{j}")
    total = lambda terms: sum(terms, F.lit(0.0))
    at = moments
    for j in range(p):
        at = at.withColumn(f"l_{j}_{j}", F.sqrt(F.greatest(F.col(f"c_{j}_{j}") - total(low(j, k) * low(j, k) for k in range(j)), F.lit(1e-9))))
        at = at.withColumns({f"l_{i}_{j}": (F.col(f"c_{i}_{j}") - total(low(i, k) * low(j, k) for k in range(j))) / low(j, j) for i in range(j + 1, p)})
    for i in range(p):
        at = at.withColumns({f"w_{i}_{j}": (F.lit(1.0 if i == j else 0.0) - total(low(i, k) * inv(k, j) for k in range(j, i))) / low(i, i) for j in range(i + 1)})
    return at.select("g", *[f"m_{i}" for i in range(p)], *[f"w_{i}_{j}" for i in range(p) for j in range(i + 1)])


def _distance(p: int) -> Column:
    """Squared Mahalanobis distance of the features from the estimates beside them."""
    terms = (sum((F.col(f"w_{i}_{j}") * (F.col(FEATURES[j]) - F.col(f"m_{j}")) for j in range(i + 1)), F.lit(0.0)) for i in range(p))
    return sum((F.pow(t, F.lit(2.0)) for t in terms), F.lit(0.0))


def _moments(core: DataFrame, p: int) -> DataFrame:
    """Means and floored covariances of the features for each group."""
    pairs = [(i, j) for i in range(p) for j in range(i + 1)]
    means = [F.avg(FEATURES[i]).alias(f"m_{i}") for i in range(p)]
    products = [F.covar_pop(FEATURES[i], FEATURES[j]).alias(f"c_{i}_{j}") for i, j in pairs]
    found = core.groupBy("g").agg(*means, *products)
    grown = [(CONSISTENCY * F.col(f"c_{i}_{j}") + (FLOORS[i] ** 2 if i == j else 0.0)).alias(f"c_{i}_{j}") for i, j in pairs]
    return found.select("g", *[f"m_{i}" for i in range(p)], *grown)


def estimates(rows: DataFrame, core: float = CORE, steps: int = STEPS) -> DataFrame:
    """Robust location and whitened scatter ``(g, m_i, w_i_j)`` of the features for each group ``g`` of ``rows``.

    Starts from the documents nearest the coordinate-wise medians in units of
    the median absolute deviation, then repeats: estimate from the core, take
    the documents of the least distances as the next core.
    """
    p = len(FEATURES)
    exact = F.lit(10_000)
    middle = rows.groupBy("g").agg(*[F.percentile_approx(f, F.lit(0.5), exact).alias(f"med_{i}") for i, f in enumerate(FEATURES)])
    around = rows.join(F.broadcast(middle), "g")
    spread = around.groupBy("g").agg(*[F.percentile_approx(F.abs(F.col(f) - F.col(f"med_{i}")), F.lit(0.5), exact).alias(f"mad_{i}") for i, f in enumerate(FEATURES)])
    start = around.join(F.broadcast(spread), "g")
    scaled = [(F.col(f) - F.col(f"med_{i}")) / (1.4826 * F.col(f"mad_{i}") + FLOORS[i]) for i, f in enumerate(FEATURES)]
    ranked = start.select("g", *FEATURES, sum((x * x for x in scaled), F.lit(0.0)).alias("d2"))
    found = None
    for step in range(steps + 1):
        limit = ranked.groupBy("g").agg(F.percentile_approx("d2", F.lit(core), exact).alias("limit"))
        inner = ranked.join(F.broadcast(limit), "g").where("d2 <= limit")
        found = stored(_whitened(_moments(inner, p), p), "mcd")
        if step < steps:
            ranked = rows.select("g", *FEATURES).join(F.broadcast(found), "g").select("g", *FEATURES, _distance(p).alias("d2"))
    return found


def classify(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, group, distance)``
    of every row of ``docs(doc_id, text, lang, source)``.

    A document is kept if the base rules pass and its squared Mahalanobis
    distance from its group's robust estimates is at most CUTOFF. Groups are
    languages and sources (null is one); those with fewer than LEAST_GROUP
    passing documents join their language's, and these all others'. Only
    documents that pass the base rules shape the estimates. Null and empty
    texts fail the base rules. Repeated rows count and are judged alike.
    """
    stats = stored(transformed(statistics(docs)).withColumn("base_failed", base_failed()), "quality-statistics")
    sound = stats.where("not base_failed")
    by_both = sound.groupBy("lang", "source").agg(F.count("*").alias("n"))
    by_lang = by_both.groupBy("lang").agg(F.sum("n").alias("of_lang"))
    # One row for each language and source that occurs, whether or not it passes the rules.
    kinds = stats.select("lang", "source").distinct()
    joined = kinds.join(by_both.toDF("l1", "s1", "n"), kinds["lang"].eqNullSafe(F.col("l1")) & kinds["source"].eqNullSafe(F.col("s1")), "left")
    joined = joined.join(by_lang.toDF("l2", "of_lang"), joined["lang"].eqNullSafe(F.col("l2")), "left")
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-"))
    group = F.when(F.col("n") >= LEAST_GROUP, F.concat_ws("/", name("lang"), name("source"))).when(F.col("of_lang") >= LEAST_GROUP, name("lang")).otherwise("all")
    groups = stored(joined.select(F.col("lang").alias("gl"), F.col("source").alias("gs"), group.alias("g")), "quality-groups")
    grouped = stats.join(groups, stats["lang"].eqNullSafe(groups["gl"]) & stats["source"].eqNullSafe(groups["gs"])).drop("gl", "gs")
    found = estimates(grouped.where("not base_failed").select("g", *FEATURES))
    judged = grouped.join(F.broadcast(found), "g", "left").withColumn("d2", _distance(len(FEATURES)))
    kept = ~F.col("base_failed") & F.coalesce(F.col("d2") <= CUTOFF, F.lit(True))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), F.col("g").alias("group"), "d2", *FEATURES)
