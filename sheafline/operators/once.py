"""Evaluate costly columns once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """``keep`` plus new columns that the optimizer will not copy into filters and projections above.

    A filter on a projected column is pushed below the projection with the column's whole expression in it,
    so a parse would run again for every use. What a generator emits is not pushed; a one-element generator
    adds no rows and no shuffle.
    """
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
