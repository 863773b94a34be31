"""URL deduplication without a window, so that one URL repeated a billion times is one partial aggregate."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_urls(
    df: DataFrame, mode: str = "flag", keys: Sequence[str] = ("rdi", "url"), seq: str = "seq"
) -> DataFrame:
    """Keep the first row per key (``drop``) or mark the later ones in ``is_duplicate`` (``flag``).

    ``seq`` is the arrival ordinal, unique within a repository. Flagging joins back on the key
    *and* the ordinal, which is unique, so the join has no hot key either.
    """
    keys = list(keys)
    if mode == "drop":
        rest = [c for c in df.columns if c not in keys and c != seq]
        first = df.groupBy(*keys).agg(F.min_by(F.struct(seq, *rest), seq).alias("__first"))
        return first.select(*keys, "__first.*").select(*df.columns)
    if mode != "flag":
        raise ValueError(f"unknown mode: {mode}")
    firsts = df.groupBy(*keys).agg(F.min(seq).alias(seq))
    firsts = firsts.select(*[F.col(c).alias(f"__f_{c}") for c in (*keys, seq)], F.lit(True).alias("__is_first"))
    # Null keys are equal to each other, as they are when grouped.
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__f_{c}")) for c in (*keys, seq)])
    return df.join(firsts, same, "left").select(
        *[F.col(c) for c in df.columns], F.col("__is_first").isNull().alias("is_duplicate")
    )


def duplicate_outcomes(flagged: DataFrame) -> DataFrame:
    """Skip outcomes of the flagged rows."""
    return flagged.filter("is_duplicate").select(
        "rdi",
        "seq",
        F.lit("skip").alias("kind"),
        F.lit(None).cast("string").alias("arc_json"),
        F.lit(None).cast("string").alias("record_id"),
        F.col("url").alias("source_url"),
        F.concat(F.lit("Duplicate sitemap entry skipped: "), F.col("url")).alias("message"),
    )
