"""Page-level rules: where a harvest stops, which pages count, what total was announced."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafline.operators.scan import blocked_scan, ordinal_block


def batch_counts(results: DataFrame) -> DataFrame:
    """Successes and rows per page; only successes count toward a record limit."""
    return results.groupBy("rdi", "batch").agg(
        F.count_if(F.col("ok")).alias("n_ok"), F.count(F.lit(1)).alias("n_rows")
    )


def limit_pages(pages: DataFrame, max_records: int, block: Column | None = None) -> DataFrame:
    """Pages read under a record limit. The page that reaches the limit is kept whole.

    ``pages`` has one row per page: ``rdi, batch, n_ok``. Adds ``ok_total`` up to that page.
    """
    block = ordinal_block(F.col("batch")) if block is None else block
    scanned = blocked_scan(
        pages,
        ["rdi"],
        [F.col("batch")],
        block,
        {"ok_total": ("sum", F.col("n_ok")), "__page": ("count", F.lit(1))},
    )
    before = F.col("ok_total") - F.col("n_ok")
    return scanned.filter((before < max_records) | (F.col("__page") == 1)).drop("__page")


def pages_read(pages: DataFrame, block: Column | None = None) -> DataFrame:
    """Pages a full harvest reads: up to the announced total, and never past an empty page.

    ``pages``: ``rdi, batch, n_rows, matches``; a null ``matches`` means no usable total, so only an
    empty page ends the scan.
    """
    block = ordinal_block(F.col("batch")) if block is None else block
    order = [F.col("batch")]
    with_total = blocked_scan(pages, ["rdi"], order, block, {"row_total": ("sum", F.col("n_rows"))})
    reached = (F.col("row_total") >= F.col("matches")) & F.col("matches").isNotNull()
    stops = blocked_scan(
        with_total.withColumn("__reached", reached.cast("int")).withColumn(
            "__empty", (F.col("n_rows") == 0).cast("int")
        ),
        ["rdi"],
        order,
        block,
        {"__n_reached": ("sum", F.col("__reached")), "__n_empty": ("sum", F.col("__empty"))},
    )
    return stops.filter(
        (F.col("__n_empty") == 0) & (F.col("__n_reached") - F.col("__reached") == 0)
    ).select(*pages.columns, "row_total")


def expected_count_catalogue(pages: DataFrame) -> DataFrame:
    """Announced total per repository from ``matches_text``: a number, or the first of a list; else 0."""
    text = F.col("matches_text")
    number = F.coalesce(
        text.try_cast("bigint"), F.get(F.from_json(text, "array<string>"), F.lit(0)).try_cast("bigint")
    )
    return pages.groupBy("rdi").agg(F.coalesce(F.max(number), F.lit(0).cast("bigint")).alias("expected"))


def expected_count_search(pages: DataFrame) -> DataFrame:
    """Announced total of a search source: the first page's ``num_found``; null when that page failed."""
    return pages.groupBy("rdi").agg(F.min_by("num_found", "start").alias("expected"))


def expected_count_sitemap(repos: DataFrame) -> DataFrame:
    """A sitemap announces no total."""
    return repos.select("rdi").distinct().withColumn("expected", F.lit(None).cast("bigint"))


def count_probe(pages: DataFrame) -> DataFrame:
    """One page is enough to learn the total."""
    return pages.select("rdi", "matches").limit(1)
