"""Quality rules as a short-circuit cascade, in Spark expressions only.

Every rule is timed on a bounded sample, after a first run that is not timed, and its share of rejected rows is taken
there; rules then run in the order of rejections per second. A rule sees only rows that no earlier rule rejected: what
it ``needs`` beyond the counts, which every row gets, is computed under that condition. The verdict is the conjunction
of all rules, so it does not depend on the measured order.

Null text counts as empty. Empty texts and texts without a word have zero counts and fail on ``few_words``. Repeated
rows get equal verdicts, an empty table gives an empty result, other columns pass through; clashing output columns are
replaced.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafline.llm.common import WORD_GAP_CHARS, words_of

#: Rows on which costs and selectivities are estimated.
SAMPLE_ROWS = 2_000
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``rejects`` says which rows fail; ``needs`` are columns computed only for rows still undecided."""

    name: str
    rejects: Column
    needs: dict[str, Column] = field(default_factory=dict)


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``COUNTS`` and ``n_lines`` (lines with a word) of every whole text.

    Three-word windows are compared by 64-bit hash inside one text. The windows are sorted only in texts that hold
    an equal pair.
    """
    keep = [c for c in docs.columns if c not in (*COUNTS, "n_lines")]
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.trim(x, F.lit(WORD_GAP_CHARS)) != "")
    w, t, e, p, ln = (F.col(f"__{x}") for x in "wtepl")
    staged = docs.select(*keep, words_of(F.col(text)).alias("__w"), lines.alias("__l"))
    windows = F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    staged = staged.withColumn(
        "__t", F.when(F.size(w) >= 3, F.slice(windows, F.lit(1), F.greatest(F.size(w) - 2, F.lit(1))))
    )
    pairs = F.array_sort(F.transform(t, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    staged = staged.withColumn("__e", F.when(F.size(F.array_distinct(t)) < F.size(t), pairs))
    repeated = F.transform(
        e, lambda x, j: F.when((x.h == F.get(e, j - 1).h) | (x.h == F.get(e, j + 1).h), x.i)
    )
    staged = staged.withColumn("__p", F.array_sort(F.filter(repeated, lambda i: i.isNotNull())))
    covered = F.aggregate(
        F.transform(p, lambda i, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - i, F.lit(3)))),
        F.lit(0).cast("bigint"),
        lambda a, x: a + x,
    )
    return staged.select(
        *keep,
        F.size(w).cast("bigint").alias("n_words"),
        F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
        (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size(ln) - F.size(F.array_distinct(ln))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"),
        F.size(ln).cast("bigint").alias("n_lines"),
    )


def base_failed() -> Column:
    """Too short, or more than half of the words stand in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def default_rules(text: str = "text") -> list[Rule]:
    """Rules over ``base_counts``; thresholds leave ordinary prose alone."""
    whole = F.coalesce(F.col(text), F.lit(""))
    upper = F.length(whole) - F.length(F.translate(whole, UPPER, ""))
    digits = F.length(whole) - F.length(F.translate(whole, "0123456789", ""))
    # Any character above 127 counts as a letter.
    bare = F.size(F.filter(words_of(F.col(text)), lambda w: ~w.rlike(r"[A-Za-z]|[^\x00-\x7F]")))
    paragraphs = F.filter(F.split(whole, "\n\n"), lambda p: F.trim(p, F.lit(WORD_GAP_CHARS)) != "")
    return [
        Rule("few_words", F.col("n_words") < 50),
        Rule("repeated_windows", 100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        Rule("symbols", 100 * F.col("n_symbols") > 20 * F.col("n_words")),
        # A short text may say a line twice.
        Rule("repeated_lines", 100 * F.col("n_dup_lines") > F.when(F.col("n_lines") >= 10, 30).otherwise(60) * F.col("n_lines")),
        Rule(
            "word_length",
            (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 15 * F.col("n_words")),
        ),
        Rule("shouting", 100 * F.col("__upper") > 40 * F.col("word_chars"), {"__upper": upper}),
        Rule("figures", 100 * F.col("__digits") > 40 * F.col("word_chars"), {"__digits": digits}),
        Rule("no_letters", 100 * F.col("__bare") > 50 * F.col("n_words"), {"__bare": bare}),
        Rule(
            "repeated_paragraphs",
            (F.size("__paragraphs") >= 4) & (100 * F.size(F.array_distinct("__paragraphs")) < 50 * F.size("__paragraphs")),
            {"__paragraphs": paragraphs},
        ),
    ]


def ordered(
    docs: DataFrame, rules: Sequence[Rule], text: str = "text", sample_rows: int = SAMPLE_ROWS
) -> list[Rule]:
    """``rules`` by rejected rows per second, estimated on at most about ``sample_rows`` rows of ``docs``.

    A rule is timed with the counts that it reads; Spark prunes the others.
    """
    total = docs.count()
    if not total or len(rules) < 2:
        return list(rules)
    sample = docs.sample(min(1.0, sample_rows / total), seed=1).limit(2 * sample_rows).persist()
    try:
        sample.count()
        gain = {}
        for rule in rules:
            tried = base_counts(sample, text).withColumns(rule.needs).agg(F.sum(rule.rejects.cast("int")))
            tried.collect()  # the first run also generates and compiles code
            start = time.perf_counter()
            rejected = tried.collect()[0][0] or 0
            gain[rule.name] = rejected / (time.perf_counter() - start)
    finally:
        sample.unpersist()
    return sorted(rules, key=lambda r: -gain[r.name])


def cascade(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``kept``: false as soon as a rule, in the given order, rejects the row."""
    columns = [c for c in df.columns if c != "kept"]
    alive = F.lit(True)
    for k, rule in enumerate(rules):
        for name, needed in rule.needs.items():
            df = df.withColumn(name, F.when(alive, needed))
        df = df.withColumn(f"__alive{k}", alive & ~F.coalesce(rule.rejects, F.lit(False)))
        alive = F.col(f"__alive{k}")
    return df.select(*columns, alive.alias("kept"))


def apply_rules(docs: DataFrame, text: str = "text", rules: Sequence[Rule] | None = None) -> DataFrame:
    """``docs`` with counts, ``base_failed`` and ``kept``."""
    rules = ordered(docs, default_rules(text) if rules is None else rules, text)
    return cascade(base_counts(docs, text).withColumn("base_failed", base_failed()), rules)
