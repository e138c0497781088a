"""Builders of small papers."""

ELEMENTS = "paper_id string, ord int, id string, page int, type string, bbox array<double>, text string, confidence double"


def paper(name, *items):
    """Rows of a paper from (id, page, type, box, text)."""
    return [(name, i, e, p, k, list(map(float, b)) if b is not None else None, t, 1.0) for i, (e, p, k, b, t) in enumerate(items)]


def frame(spark, *papers):
    return spark.createDataFrame([r for p in papers for r in p], ELEMENTS)
