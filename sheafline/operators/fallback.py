"""Stable identifiers for records that failed to parse and carry no identifier of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANDOM_PREFIX = "owslib_random_"


def is_random_id(col):
    """A placeholder id given to a response entry without identifier."""
    return col.startswith(RANDOM_PREFIX)


def batch_positions(df: DataFrame, order: str = "pos", name: str = "rn") -> DataFrame:
    """Position within a page.

    A page is the content of one response body, so the window partition is bounded by one input row.
    """
    return df.withColumn(name, F.row_number().over(Window.partitionBy("rdi", "batch").orderBy(order)))


def unmatched_ids(brief_ids: DataFrame, parsed: DataFrame) -> DataFrame:
    """Brief identifiers that no successfully parsed record of the same page has."""
    good = parsed.select("rdi", "batch", F.col("identifier").alias("dc_id"))
    return brief_ids.join(good, ["rdi", "batch", "dc_id"], "left_anti")


def apply_id_fallback(errors: DataFrame, brief_ids: DataFrame, parsed: DataFrame) -> DataFrame:
    """The n-th nameless error of a page takes the n-th unmatched brief identifier of that page."""
    nameless = batch_positions(errors.filter(is_random_id(F.col("record_id"))))
    named = errors.filter(~is_random_id(F.col("record_id")))
    spare = batch_positions(unmatched_ids(brief_ids, parsed)).select("rdi", "batch", "rn", "dc_id")
    fixed = nameless.join(spare, ["rdi", "batch", "rn"], "left").withColumn(
        "record_id", F.coalesce("dc_id", "record_id")
    )
    return fixed.select(*errors.columns).unionByName(named)
