"""Small tables with everything that an operator has to bear."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> str:
    import random

    rng = random.Random(seed)
    parts = ["an", "re", "tion", "th", "er", "in", "on", "es", "st", "le"]
    words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    return " ".join(w.capitalize() + "." if i % 9 == 8 else w for i, w in enumerate(words))


def odd_docs():
    """Null and empty texts, ties, repeats, one very long text, null keys."""
    same = prose(1, 80)
    rows = [
        (1, same, "en", "a"), (2, same, "en", "a"), (3, same, "en", "b"), (3, same, "en", "b"), (4, None, "en", "a"), (5, "", "fr", None), (6, " \n\t", None, "b"),
        (7, "one", "en", "b"), (8, "one two", "fr", "c"), (9, prose(2, 30_000), "en", "a"), (10, prose(3, 120), None, None), (None, prose(4, 90), "fr", "c"),
        (11, "naïve café \U0001f600 ▁ x\x00y", "fr", "c"), (12, prose(1, 80) + " end", "en", "a"),
    ]
    return [(i, t, l, s, None if t is None else len(t)) for i, t, l, s in rows]


def docs(spark, rows=None, clash=()):
    """Documents with extra columns of the given names."""
    from pyspark.sql import functions as F

    made = spark.createDataFrame(odd_docs() if rows is None else rows, DOCS)
    return made.withColumns({c: F.lit("mine") for c in clash}) if clash else made


def no_docs(spark):
    return spark.createDataFrame([], DOCS)
