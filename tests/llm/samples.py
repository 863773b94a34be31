"""Small tables with the awkward rows that every operator must take."""

from __future__ import annotations

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, size bigint, kept string"

PROSE = (
    "the quick brown fox jumps over the lazy dog while nine small birds watch from an old oak tree near the river bank "
    "and the miller counts his sacks of flour before the evening bell calls every worker home for bread soup and a "
    "long story about ships that never came back from the northern sea in that cold and windy winter"
)


def awkward(spark):
    """Nulls in any column, empty and long texts, repeated rows, columns that clash with outputs."""
    rows = [
        (1, PROSE, "en", "a", 5, 0.5, 7, "x"),
        (1, PROSE, "en", "a", 5, 0.5, 7, "x"),
        (2, None, None, None, None, None, None, None),
        (3, "", "en", "b", 0, None, None, None),
        (4, " \n\t ", "de", "b", 4, None, None, None),
        (5, PROSE + " once", "en", "c", 9, None, None, None),
        (6, "word", "en", None, 4, None, None, None),
        (7, "lorem ipsum été " * 20_000, "fr", "c", None, None, None, None),
        (None, PROSE.upper(), "en", "a", 1, None, None, None),
    ]
    return spark.createDataFrame(rows, DOCS)


def labels(spark, rows=()):
    """A label table."""
    return spark.createDataFrame(list(rows), "doc_id bigint, quality int, toxic int")


def empty(spark):
    """No document."""
    return spark.createDataFrame([], DOCS)
