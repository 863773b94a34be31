"""Catalogue predicates as Column algebra; on a typed record table they reach the Parquet scan."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafline.functions.text import all_of, any_of

DATASET_LEVELS = ("dataset", "series", "nongeographicdataset")


def is_dataset_level(hierarchy: Column) -> Column:
    """Dataset-like hierarchy levels; an absent level passes."""
    return hierarchy.isNull() | (hierarchy == "") | F.lower(hierarchy).isin(*DATASET_LEVELS)


def filter_hierarchy(df: DataFrame) -> DataFrame:
    """Drop records of other hierarchy levels; they appear in no counter."""
    return df.filter(is_dataset_level(F.col("hierarchy")))


def any_text_like(pattern: str, *texts: Column, lists: Iterable[Column] = ()) -> Column:
    """LIKE over all texts and list elements of a record, each taken by itself."""
    parts = [F.coalesce(t, F.lit("")).like(pattern) for t in texts]
    parts += [F.coalesce(F.exists(a, lambda x: x.like(pattern)), F.lit(False)) for a in lists]
    return any_of(*parts)


def equals(col: Column, value) -> Column:
    """PropertyIsEqualTo; a null property does not match."""
    return F.coalesce(col == F.lit(value), F.lit(False))


def like(col: Column, pattern: str, wildcard: str = "%", single: str = "_", escape: str = "\\") -> Column:
    """PropertyIsLike with its own wildcard, single-character and escape signs; null does not match."""
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == escape and i + 1 < len(pattern):
            i += 1
            out.append("\\" + pattern[i] if pattern[i] in "%_\\" else pattern[i])
        elif ch == wildcard:
            out.append("%")
        elif ch == single:
            out.append("_")
        else:
            out.append("\\" + ch if ch in "%_\\" else ch)
        i += 1
    return F.coalesce(col.like("".join(out)), F.lit(False))


def all_match(*predicates: Column) -> Column:
    """And."""
    return all_of(*predicates)


def any_match(*predicates: Column) -> Column:
    """Or."""
    return any_of(*predicates)


def none_match(*predicates: Column) -> Column:
    """Not over a disjunction."""
    return ~any_of(*predicates)
